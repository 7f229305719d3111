"""Approximate nearest neighbours by an adaptive dimension scan over an inverted file.

Centroids are fitted on a bounded sample (``sample_rows``); every valid row is indexed in the list of its
nearest centroid, and the number of lists to probe is the smallest that reaches ``recall`` among the sample.
Lists are cut into blocks of bounded size, so a list that holds a third of all rows is many tasks.

Inside a block the unit vectors are rotated by one random orthogonal matrix and kept by columns.  The scan
adds the squared distance of a few columns at a time; as the rotation spreads a difference evenly over the
dimensions, a candidate is dropped once its partial distance, scaled up, lies beyond the k-th best so far by
more than the test's margin (a few true neighbours in a thousand are lost).  The first list of each query runs first and hands its k-th distance to the
others.  What survives is scored with the cosine of the original vectors in double precision.
"""

from __future__ import annotations

import math
import os
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

STEP = 16  # columns between two tests
WIDTH = 3.0  # of the test, in standard deviations
SLACK = 1e-9  # rounding of equal vectors


def rotation(dim: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(20_24).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)  # no overflow for large components
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _matrix(col) -> np.ndarray:
    return np.frombuffer(b"".join(col.to_pylist()), np.float64).reshape(len(col), -1)


def kmeans(x: np.ndarray, lists: int, rounds: int = 8) -> np.ndarray:
    rng = np.random.default_rng(7)
    c = x[rng.choice(len(x), lists, replace=False)]
    for _ in range(rounds):
        near = np.concatenate([np.argmax(x[a : a + 4096] @ c.T, axis=1) for a in range(0, len(x), 4096)])
        total = np.zeros_like(c)
        np.add.at(total, near, x)
        size = np.sqrt((total * total).sum(axis=1))
        c = np.where(size[:, None] > 1e-12, total / np.maximum(size, 1e-12)[:, None], c)
    return c


def nearest_of_ids(distance: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the nearest row of each of the k nearest ids (of all ids if there are fewer)."""
    m = min(len(ids), 2 * k)
    while True:
        near = np.argpartition(distance, m - 1)[:m] if m < len(ids) else np.arange(m)
        near = near[np.argsort(distance[near], kind="stable")]
        first = np.sort(np.unique(ids[near], return_index=True)[1])
        if len(first) >= k or m == len(ids):
            return near[first[:k]]
        m = min(len(ids), 4 * m)


def probes_needed(x: np.ndarray, ids: np.ndarray, c: np.ndarray, k: int, recall: float, queries: int = 256) -> int:
    """The smallest number of lists that finds ``recall`` of the sample's own neighbours (rows of other ids)."""
    need, home = [], np.argmax(x @ c.T, axis=1)
    for i in np.arange(0, len(x), max(1, len(x) // queries))[:queries]:
        others = np.flatnonzero(ids != ids[i])
        if len(others):
            near = others[nearest_of_ids(-(x[others] @ x[i]), ids[others], k)]
            order = np.argsort(np.argsort(-(x[i] @ c.T)))  # rank of each list for the query
            need.append(order[home[near]])
    return min(len(c), int(np.quantile(np.concatenate(need), recall, method="higher")) + 1) if need else len(c)


def scan(q: np.ndarray, columns: np.ndarray, limit: float, k: int, ids: np.ndarray | None = None, own: int | None = None) -> np.ndarray:
    """Rows of a block (``columns``: dimension by row, rotated) that may be the best of the k nearest ids of
    ``q`` other than ``own``; without ``ids`` each row is one."""
    dim, n = columns.shape
    ids = np.arange(n) if ids is None else ids
    alive = np.arange(n) if own is None else np.flatnonzero(ids != own)
    part = np.zeros(len(alive))
    for at in range(0, dim, STEP):
        end = min(dim, at + STEP)
        block = columns[at:end][:, alive] if len(alive) < n else columns[at:end]
        part = part + ((block - q[at:end, None]) ** 2).sum(axis=0)
        if end == dim:
            break
        if len(alive) > k:
            # The k ids that look nearest now give a distance that the k nearest cannot exceed.
            best = alive[nearest_of_ids(part, ids[alive], k)]
            if len(best) == k:
                limit = min(limit, ((columns[:, best] - q[:, None]) ** 2).sum(axis=0).max())
        # Of a squared distance D, a random rotation puts D * Beta(end / 2, (dim - end) / 2) in the first columns.
        spread = np.sqrt(2 * (dim - end) / (end * (dim + 2)))
        keep = part * (dim / end) <= limit * (1 + WIDTH * spread) + SLACK
        alive, part = alive[keep], part[keep]
    return alive


_FOUND = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])
_EMPTY = _FOUND.empty_table()


def _search(k: int, turn: np.ndarray):
    def run(key, rows: pa.Table, queries: pa.Table) -> pa.Table:
        if not len(rows) or not len(queries):
            return _EMPTY
        ids, raw = rows.column("vec_id").to_numpy(), _matrix(rows.column("vec"))
        unit, q_ids, q_raw = _unit(raw), queries.column("query_id").to_numpy(), _matrix(queries.column("vec"))
        q_unit, columns = _unit(q_raw), np.ascontiguousarray((unit @ turn).T)
        limits = queries.column("worst").to_numpy()
        out = []
        for i, q in enumerate(q_unit @ turn):
            near = scan(q, columns, limits[i], k, ids, q_ids[i])
            score = (unit[near] * q_unit[i]).sum(axis=1)
            order = np.lexsort((ids[near], -score))
            seen: dict[int, float] = {}
            for j in order:
                seen.setdefault(int(ids[near[j]]), float(score[j]))
                if len(seen) == k:
                    break
            out += [(int(q_ids[i]), v, s) for v, s in seen.items()]
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), _FOUND.types)], schema=_FOUND) if out else _EMPTY

    return run


def nearest(vectors: DataFrame, every: int = 50, k: int = 5, recall: float = 0.98, sample_rows: int | None = None, block_rows: int = 4_096) -> DataFrame:
    """The k nearest rows, by cosine, of each row whose vec_id is divisible by ``every``.

    Input: ``vec_id``, ``embedding`` (others are ignored, whatever their names).  Result: query_id, rank (from
    1), vec_id, score; ties go to the smaller vec_id; all candidates if there are fewer than k.  Rows without a
    vec_id, and vectors that are null, empty, zero or hold a null or non-finite component take no part, nor do
    vectors of another dimension than most.  Rows that repeat a vec_id count as one vector with the best score
    (as a query, the smallest vector), and never answer their own id.  An empty table gives an empty table.
    """
    spark = vectors.sparkSession
    base = os.path.join(ensure_checkpoint_dir(spark), "ann", uuid.uuid4().hex)
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))
    sound = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("v").isNotNull()).where(sound)
    size = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    schema = "query_id long, rank int, vec_id long, score double"
    if size is None:
        return spark.createDataFrame([], schema)
    dim, total = size["d"], size["count"]
    rows = rows.where(F.size("v") == dim).distinct()  # equal rows count once, however many there are

    sample_rows = sample_rows or min(65_536, max(16_384, 16 * math.isqrt(total)))
    # A bounded sample in the order of a hash of the row, so that no id fills it.
    sample = rows.orderBy(F.xxhash64("vec_id", "v"), "vec_id", "v").limit(sample_rows).toArrow()
    x = _unit(np.array(sample.column("v").to_pylist(), np.float64))
    lists = max(1, min(int(total**0.5), len(x) // 16))
    c = kmeans(x, lists)
    probes = probes_needed(x, sample.column("vec_id").to_numpy(), c, k, recall) if len(x) > 1 else lists

    def place(batches):
        for b in batches:
            v = np.array(b.column("v").to_pylist(), np.float64)
            if len(v):
                near = np.argmax(_unit(v) @ c.T, axis=1).astype(np.int32)
                yield pa.RecordBatch.from_arrays([b.column("vec_id"), pa.array(near), pa.array([r.tobytes() for r in v], pa.binary())], names=["vec_id", "list", "vec"])

    rows.mapInArrow(place, "vec_id long, list int, vec binary").write.parquet(base)
    index = spark.read.parquet(base)
    sizes = {r["list"]: r["n"] for r in index.groupBy("list").agg(F.count("*").alias("n")).collect()}  # one row per list
    blocks = {i: -(-n // block_rows) for i, n in sizes.items()}
    # Each id counts in one of its lists only: more than k ids in any probed lists.
    homes = index.groupBy("vec_id").agg(F.min("list").alias("list")).groupBy("list").agg(F.count("*").alias("n")).collect()
    few = np.cumsum([0] * (lists - len(homes)) + sorted(r["n"] for r in homes))
    probes = max(probes, min(lists, int(np.searchsorted(few, k, side="right")) + 1))
    counts = F.create_map(*[F.lit(z) for kv in sorted(blocks.items()) for z in kv])
    index = index.withColumn("block", F.pmod(F.xxhash64("vec_id", "vec"), counts[F.col("list")]).cast("int"))

    queries = index.where(F.col("vec_id") % every == 0).groupBy(F.col("vec_id").alias("query_id")).agg(F.min("vec").alias("vec"))
    def route(batches):
        for b in batches:
            v = _matrix(b.column("vec"))
            if not len(v):
                continue
            near = np.argsort(-(_unit(v) @ c.T), axis=1, kind="stable")[:, :probes]
            n = near.shape[1]
            rep = np.repeat(np.arange(len(v)), n)
            yield pa.RecordBatch.from_arrays(
                [b.column("query_id").take(pa.array(rep)), b.column("vec").take(pa.array(rep)), pa.array(near.ravel().astype(np.int32)), pa.array(np.tile(np.arange(n, dtype=np.int32), len(v)))],
                names=["query_id", "vec", "list", "turn"],
            )

    sent = queries.mapInArrow(route, "query_id long, vec binary, list int, turn int").where(F.col("list").isin(list(blocks)))
    # Queries of a list in parts of at most about block_rows, so that a task's queries are bounded too.
    asked = {r["list"]: -(-r["n"] // block_rows) for r in sent.groupBy("list").agg(F.count("*").alias("n")).collect()}  # one row per list
    parts = F.create_map(*[F.lit(z) for kv in sorted(asked.items()) for z in kv]) if asked else F.create_map().cast("map<int,int>")
    sent = sent.withColumn("block", F.explode(F.sequence(F.lit(0), (counts[F.col("list")] - 1).cast("int")))).withColumn("part", F.pmod(F.xxhash64("query_id"), parts[F.col("list")]).cast("int"))
    cells = index.where(F.col("list").isin(list(asked))).withColumn("part", F.explode(F.sequence(F.lit(0), (parts[F.col("list")] - 1).cast("int"))))
    turn = rotation(dim)

    def search(q: DataFrame) -> DataFrame:
        key = ["list", "block", "part"]
        got = cells.groupBy(*key).cogroup(q.groupBy(*key)).applyInArrow(_search(k, turn), "query_id long, vec_id long, score double")
        return got

    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")

    def ranked(found: DataFrame) -> DataFrame:
        """The k best ids of each query; an id can come from several blocks and lists."""
        found = found.repartition("query_id").groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
        return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)

    path = f"{base}-first"
    ranked(search(sent.where("turn = 0").withColumn("worst", F.lit(float("inf"))))).drop("rank").write.parquet(path)
    first = spark.read.parquet(path)
    # Squared distance of unit vectors: 2 - 2 cos.
    worst = first.groupBy("query_id").agg(F.count("*").alias("n"), F.min("score").alias("low"))
    worst = worst.where(F.col("n") >= k).select("query_id", (2 - 2 * F.col("low")).alias("worst"))
    others = sent.where("turn > 0").join(worst, "query_id", "left").withColumn("worst", F.coalesce("worst", F.lit(float("inf"))))
    found = first.unionByName(search(others))
    return ranked(found).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
