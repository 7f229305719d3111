"""Hard negatives by a vertical scan with branch and bound (BOND).

Vectors are integers kept by columns.  For an anchor the columns are read in the order of its descending
magnitudes; after each step a row's score lies between its partial score plus the least and plus the most that
the columns still unread can add, by their minimum and maximum.  Rows whose range misses every wanted window,
or lies below the scores already found, leave the candidate bitmap; what is left at the last column has its
exact score.

Anchors come in blocks of bounded size, read by the driver one at a time and sent to all tasks; every task
scans its own part of the rows for the block and returns at most k rows for each window.  A pass over one row
in ``share`` goes first and gives all tasks their first limits.  Nothing but found rows is shuffled.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

STEP = 8  # columns between two tests
EXACT = 2**53  # doubles add integers below it exactly
RANGE = 2.0**62
ANCHOR_BYTES = 8 << 20
LEAST, MOST = -(2**63) + 1, 2**63 - 1  # no limit


def kth(x: np.ndarray, k: int) -> int:
    return LEAST if len(x) < k else int(np.partition(x, len(x) - k)[len(x) - k])


def scan(columns: np.ndarray, low: np.ndarray, high: np.ndarray, anchor: np.ndarray, windows: list, limits: list, k: int, without: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Rows of ``columns`` (dimension by row, each between ``low`` and ``high``) and their scores, among them the k
    best of each window ``(least, most)`` that reach the window's limit (the k-th score known, or LEAST);
    rows marked in ``without`` take no part."""
    dim, n = columns.shape
    order = np.argsort(-np.abs(anchor), kind="stable")
    ends = np.stack([anchor * low, anchor * high])[:, order]
    # What the columns from each place on can still add.
    rest = [np.concatenate([np.cumsum(e[::-1])[::-1], [0]]) for e in (ends.min(axis=0), ends.max(axis=0))]
    limits = list(limits)
    alive = np.arange(n) if without is None else np.flatnonzero(~without)
    part = np.zeros(len(alive), columns.dtype)
    for at in range(0, dim, STEP):
        read = order[at : at + STEP]
        block = columns[read] if len(alive) == n else columns[np.ix_(read, alive)]
        part = part + anchor[read] @ block
        end = at + len(read)
        least, most = part + rest[0][end], part + rest[1][end]
        for i, (lo, hi) in enumerate(windows):
            limits[i] = max(limits[i], kth(least[(least >= lo) & (most <= hi)], k))
        floors = [max(lo, limit) for (lo, _), limit in zip(windows, limits)]
        bitmap = (most >= min(floors)) & (least <= max(hi for _, hi in windows))
        alive, part = alive[bitmap], part[bitmap]
    return alive, part


class Block:
    """Rows of one dimension, by label, as columns."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray):
        order = np.argsort(labels, kind="stable")
        self.ids, labels = ids[order], labels[order]
        self.labels, self.at = np.unique(labels, return_index=True)
        self.at = np.append(self.at, len(ids))
        top = int(np.abs(vectors).max(initial=0))
        self.largest = top
        self.columns = {np.int64: np.ascontiguousarray(vectors[order].T)}
        parts = [vectors[order][a:b] for a, b in zip(self.at, self.at[1:])]
        self.low, self.high = np.array([p.min(axis=0) for p in parts]), np.array([p.max(axis=0) for p in parts])

    def typed(self, anchor: np.ndarray):
        """Columns in doubles where every sum is exact in them, else in integers."""
        safe = len(anchor) * self.largest * int(np.abs(anchor).max(initial=0)) < EXACT
        kind = np.float64 if safe else np.int64
        if kind not in self.columns:
            self.columns[kind] = self.columns[np.int64].astype(kind)
        return self.columns[kind], kind

    def search(self, own: int, anchor: np.ndarray, label: int, same: bool, windows: list, limits: list, k: int):
        """Ids and scores of rows of other ids, of the same label or of all others, that may belong to a window's best."""
        columns, kind = self.typed(anchor)
        i = int(np.searchsorted(self.labels, label))
        has = i < len(self.labels) and self.labels[i] == label
        if same:
            pieces = [(i, i + 1)] if has else []
        else:
            pieces = [(0, i), (i + has, len(self.labels))]
        for a, b in pieces:
            if a < b:
                span = slice(self.at[a], self.at[b])
                low, high = self.low[a:b].min(axis=0).astype(kind), self.high[a:b].max(axis=0).astype(kind)
                mine = self.ids[span] == own
                near, score = scan(columns[:, span], low, high, anchor.astype(kind), windows, limits, k, mine if mine.any() else None)
                yield self.ids[span][near], score.astype(np.int64)


def _vectors(col: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(v, np.int64) for v in col.to_pylist()]


def blocks(batch: pa.RecordBatch) -> dict[int, Block]:
    ids, labels = batch.column("vec_id").to_numpy(), batch.column("label").to_numpy()
    dims = batch.column("dim").to_numpy()
    vectors = _vectors(batch.column("vec"))
    out = {}
    for d in np.unique(dims):
        at = np.flatnonzero(dims == d)
        out[int(d)] = Block(ids[at], labels[at], np.stack([vectors[i] for i in at]).reshape(len(at), d))
    return out


def best(ids: np.ndarray, score: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    if len(ids) > k:
        at = np.flatnonzero(score >= np.partition(score, len(score) - k)[len(score) - k])
        ids, score = ids[at], score[at]
    at = np.lexsort((ids, -score))[:k]
    return ids[at], score[at]


_FOUND = pa.schema([("anchor_id", pa.int64()), ("place", pa.int32()), ("vec_id", pa.int64()), ("score", pa.int64())])


def searcher(anchors: list, same: bool, k: int):
    """A task: ``anchors`` holds (id, label, vector, windows with their place and limit); at most k rows for each window."""

    def run(batches):
        found: dict = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            here = blocks(batch)
            for n, (own, label, vector, windows) in enumerate(anchors):
                block = here.get(len(vector))
                if block is None:
                    continue
                spans = [(lo, hi) for _, lo, hi, _ in windows]
                held = [found.get((n, place)) for place, *_ in windows]
                limits = [max(limit, h[1][-1] if h is not None and len(h[1]) == k else LEAST) for (*_, limit), h in zip(windows, held)]
                for ids, score in block.search(own, vector, label, same, spans, limits, k):
                    for place, lo, hi, limit in windows:
                        fit = (score >= max(lo, limit)) & (score <= hi)
                        if fit.any():
                            i, s = found.get((n, place), (ids[:0], score[:0]))
                            found[n, place] = best(np.concatenate([i, ids[fit]]), np.concatenate([s, score[fit]]), k)
        for n, place in sorted(found):
            ids, score = found[n, place]
            m = len(ids)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(m, anchors[n][0])), pa.array(np.full(m, place, np.int32)), pa.array(ids), pa.array(score)], schema=_FOUND)

    return run


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("anchor_id", "place").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _in_blocks(index: DataFrame, anchors: DataFrame, block_rows: int, same: bool, k: int, share: int) -> DataFrame:
    """The first k rows of ``index`` for each window of each anchor (id, label, vec, windows array of place, lo, hi)."""
    size = anchors.agg(F.count("*").alias("n"), F.sum(F.octet_length("vec")).alias("b")).first()
    parts = max(1, math.ceil(size["n"] / block_rows), math.ceil((size["b"] or 0) / ANCHOR_BYTES))
    anchors = anchors.withColumn("part", F.pmod(F.xxhash64("anchor_id"), F.lit(parts)))
    schema = "anchor_id long, place int, vec_id long, score long"
    out = []
    for part in range(parts):
        block = [r.asDict(recursive=True) for r in anchors.where(F.col("part") == part).orderBy("anchor_id").collect()]

        def job(rows: DataFrame, limits: dict) -> DataFrame:
            sent = [(r["anchor_id"], r["label"], np.frombuffer(r["vec"], np.int64), [(w["place"], w["lo"], w["hi"], limits.get((r["anchor_id"], w["place"]), LEAST)) for w in r["windows"]]) for r in block]
            return _ranked(rows.mapInArrow(searcher(sent, same, k), schema), k)

        # One row in `share` gives the first limits: at most k rows for each window of the block.
        first = job(index.where(F.pmod(F.xxhash64("vec_id", "vec"), F.lit(share)) == 0), {})
        limits = {(r["anchor_id"], r["place"]): r["score"] for r in first.where(F.col("rank") == k).collect()}
        out.append(materialize(job(index, limits)))
    whole = out[0]
    for df in out[1:]:
        whole = whole.unionByName(df)
    return whole


def hard_negatives(vectors: DataFrame, every: int = 100, n_positives: int = 5, n_negatives: int = 10, least_percent: int = 30, most_percent: int = 90,
                   block_rows: int = 2_048, share: int = 16) -> DataFrame:
    """Hard negatives of each anchor (rows whose vec_id is divisible by ``every``) and each of its positives.

    Input: ``vec_id``, ``label``, ``embedding`` (others are ignored, whatever their names).  Result: anchor_id,
    positive_id, rank (from 1), negative_id, positive_score, negative_score.  Components count as floor(256 x);
    scores are integer inner products, higher first, ties by smaller vec_id.  Positives are the first rows of the
    anchor's label, negatives the first of other labels, both with another vec_id; a negative's score is between
    ``least_percent`` and ``most_percent`` of the positive's (nothing fits a negative score).

    Rows without a vec_id, label or vector, or with a null or non-finite component, take no part.  Rows that
    repeat a vec_id each count as candidates; as an anchor, an id is its smallest (label, vector).  Inner products
    exist between vectors of one dimension only: an anchor meets rows of its own.  Scores are meant to fit 64
    bits.  An anchor without positives, or a positive without negatives, has no rows; an empty table gives an
    empty table.  Anchors are sent to tasks in blocks of ``block_rows`` (at most 8 MB of vectors); one row in
    ``share`` is scanned first for limits.
    """
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("int").alias("label"), F.col("embedding").cast("array<double>").alias("v"))
    sound = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.dropna().where(sound)
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = rows.select("vec_id", moved.cast("int").alias("label"), "v")

    def integers(batches):
        for b in batches:
            lists = b.column("v")
            flat = np.clip(np.floor(256.0 * lists.flatten().to_numpy(zero_copy_only=False)), -RANGE, RANGE).astype(np.int64)
            size = lists.value_lengths().to_numpy().astype(np.int32)
            ends = np.cumsum(size)
            vec = [flat[e - s : e].tobytes() for s, e in zip(size, ends)]
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), b.column("label"), pa.array(size), pa.array(vec, pa.binary())], names=["vec_id", "label", "dim", "vec"])

    index = materialize(rows.mapInArrow(integers, "vec_id long, label int, dim int, vec binary"))
    own = index.where(F.col("vec_id") % every == 0).groupBy(F.col("vec_id").alias("anchor_id")).agg(F.min(F.struct("label", "vec")).alias("r"))
    own = materialize(own.select("anchor_id", "r.label", "r.vec"))
    whole = F.array(F.struct(F.lit(1).alias("place"), F.lit(LEAST).alias("lo"), F.lit(MOST).alias("hi")))
    positives = _in_blocks(index, own.withColumn("windows", whole), block_rows, True, n_positives, share)
    positives = materialize(positives.select("anchor_id", F.col("rank").alias("place"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")))
    # 30 p <= 100 s <= 90 p in whole numbers, hundreds and rest apart: s from ceil(30 p / 100) to floor(90 p / 100).
    p = F.col("positive_score")
    tens, rest = F.expr("positive_score div 100"), p % 100
    lo = tens * least_percent + F.ceil(rest * least_percent / 100).cast("long")
    hi = tens * most_percent + F.floor(rest * most_percent / 100).cast("long")
    window = F.struct("place", lo.alias("lo"), hi.alias("hi"))
    windows = positives.where((p >= 0) & (lo <= hi)).groupBy("anchor_id").agg(F.sort_array(F.collect_list(window)).alias("windows"))
    negatives = _in_blocks(index, own.join(windows, "anchor_id"), block_rows, False, n_negatives, share)
    out = positives.join(negatives, ["anchor_id", "place"])
    return out.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


ORACLE_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same, CAST(list_inner_product(a.e, r.e) AS BIGINT) AS score
  FROM v a JOIN v r ON a.vec_id % 100 = 0 AND a.vec_id <> r.vec_id
), p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
), n AS (
  SELECT p.anchor_id, positive_id, positive_score, s.vec_id AS negative_id, s.score AS negative_score,
         CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank
  FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT s.same AND 30 * positive_score <= 100 * s.score AND 100 * s.score <= 90 * positive_score
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10
"""
