"""Near-duplicate documents: fast similarity sketches, banding, verification on full shingle sets.

Sketch: t bins are filled in rounds.  In round i < t every shingle is thrown into a hashed bin; in round
t + j all shingles go to bin j.  A bin keeps the smallest value of the first round that reaches it, and a
document stops when its bins are full: after O(t log t + n) throws none is empty, each bin agrees between
two sets with probability equal to their Jaccard similarity, and the agreement is sharply concentrated.

1. Documents with equal shingle sets become one class, whose first document stands for it.
2. Classes that agree in all rows of a band share a bucket.  The member that shares most places with others
   is compared with all others of its buckets: in a group of copies of one text, this is the text itself.
3. Verified links give components.  Buckets that still hold several components may hide links between
   members that were never compared; these members go through an exact prefix-filter join (any two sets of
   that similarity share one of their rarest shingles, with enough shingles of both after it), restricted to pairs of
   different components.

No step emits all pairs of a bucket; a class is compared at most once per band with a bucket's leader.
"""

from __future__ import annotations

import os
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.sizing import broadcast_if_small
from ..session import ensure_checkpoint_dir
from . import words as W
from .bpe import forget, slices
from .components import connected_components

U = np.uint64
BANDS, ROWS = 36, 4  # a link of similarity 0.75 shares no band with probability 1e-6
EMPTY = U(0xFFFFFFFFFFFFFFFF)
PART_BYTES = 1 << 20


def shingle_sets(texts, size: int = 5):
    """Names of the distinct shingles of each row, sorted, and each row's offsets; texts in lower case (A-Z)."""
    data, off = W.text_bytes(texts, lower=True)
    starts, ends, row_off = W.word_spans(data, off)
    names = W.word_names(data, starts, ends)
    counts = np.diff(row_off)
    full = np.maximum(counts - size + 1, 0)
    row = np.repeat(np.arange(len(counts)), full)
    at = np.arange(len(row)) - np.repeat(np.cumsum(full) - full, full) + np.repeat(row_off[:-1], full)
    grams = W.gram_names(names, size)[at] if len(row) else np.zeros(0, U)
    for n in range(1, size):  # shorter texts: the whole sequence
        short = np.flatnonzero(counts == n)
        if len(short):
            row = np.append(row, short)
            grams = np.append(grams, W.gram_names(names, n, 100 + n)[row_off[short]])
    order = np.lexsort((grams, row))
    row, grams = row[order], grams[order]
    new = np.append(True, (row[1:] != row[:-1]) | (grams[1:] != grams[:-1])) if len(row) else np.zeros(0, bool)
    row, grams = row[new], grams[new]
    return grams, np.searchsorted(row, np.arange(len(counts) + 1))


def sketches(grams: np.ndarray, off: np.ndarray, t: int = BANDS * ROWS) -> np.ndarray:
    """One row of ``t`` bin values per set; rows of empty sets are all ``EMPTY``."""
    rows = len(off) - 1
    out = np.full((rows, t), EMPTY, U)
    flat = out.reshape(-1)
    row = np.repeat(np.arange(rows), np.diff(off))
    for i in range(2 * t):
        if not len(row):
            break
        h = W.mix(grams, 1000 + i)
        bin_ = (h % U(t)).astype(np.int64) if i < t else i - t
        np.minimum.at(flat, row * t + bin_, (U(i) << U(48)) | (h >> U(16)))
        open_ = (out == EMPTY).any(axis=1)[row]
        row, grams = row[open_], grams[open_]
    return out


def set_prints(grams: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits of each set, from sums over its shingles."""
    out = []
    for seed in (31, 32):
        total = np.append(U(0), np.cumsum(W.mix(grams, seed), dtype=U))
        out.append(W.mix(total[off[1:]] - total[off[:-1]], seed).view(np.int64))
    return out[0], out[1]


def _sketch_batches(batches):
    forget()
    for batch in batches:
        for part in slices(batch, size=PART_BYTES):
            grams, off = shingle_sets(part.column("text"))
            p1, p2 = set_prints(grams, off)
            s = sketches(grams, off).reshape(-1, BANDS, ROWS)
            key = np.zeros((len(off) - 1, BANDS), U)
            for r in range(ROWS):
                key = W.mix(key + s[:, :, r], 40 + r)
            key = W.mix(key + np.arange(BANDS, dtype=U), 50).view(np.int64)
            bands = pa.ListArray.from_arrays(pa.array(np.arange(len(off), dtype=np.int32) * BANDS), pa.array(key.ravel()))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("h"), pa.array(np.diff(off)), pa.array(p1), pa.array(p2), bands], names=["doc_id", "h", "n", "p1", "p2", "bands"])


def _set_batches(batches):
    forget()
    for batch in batches:
        for part in slices(batch, size=PART_BYTES):
            grams, off = shingle_sets(part.column("text"))
            p1, p2 = set_prints(grams, off)
            mine = (p1 == part.column("p1").to_numpy()) & (p2 == part.column("p2").to_numpy())  # else another row of that doc_id
            sets = pa.ListArray.from_arrays(pa.array(off.astype(np.int32)), pa.array(grams.view(np.int64)))
            out = pa.RecordBatch.from_arrays([part.column("cls"), pa.array(np.diff(off)), sets], names=["cls", "n", "grams"])
            yield out.filter(pa.array(mine))


def _verify(percent: int):
    def run(batches):
        for batch in batches:
            xs, ys = batch.column("x_grams"), batch.column("y_grams")
            keep = np.zeros(batch.num_rows, bool)
            for i in range(batch.num_rows):
                x, y = xs[i].values.to_numpy(), ys[i].values.to_numpy()
                both = np.concatenate([x, y])
                both.sort()
                common = int((both[1:] == both[:-1]).sum())
                keep[i] = 100 * common >= percent * (len(x) + len(y) - common)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(keep))

    return run


def near_duplicates(docs: DataFrame, percent: int = 75) -> DataFrame:
    """Components of documents whose sets of 5-word shingles have ``100 * |A & B| >= percent * |A | B|``.

    Input: ``doc_id``, ``text`` (others are ignored, whatever their names).  One row per input row: doc_id,
    n_shingles, component_id (the smallest doc_id of the component), kept (doc_id is component_id, also where
    both are null).  Null texts, empty texts and texts without words have no shingles and are linked with
    nothing.  A null doc_id is never the smallest unless all are null.  Rows that repeat the smallest doc_id of
    their component are all kept.  An empty table gives an empty table.
    """
    spark = docs.sparkSession
    base = os.path.join(ensure_checkpoint_dir(spark), "minhash", uuid.uuid4().hex)

    def written(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{base}/{name}")
        return spark.read.parquet(f"{base}/{name}")

    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    docs = docs.withColumn("h", F.xxhash64("text"))  # tells rows that repeat a doc_id apart
    made = docs.mapInArrow(_sketch_batches, "doc_id long, h long, n long, p1 long, p2 long, bands array<long>")
    rows = written(made.withColumn("row", F.monotonically_increasing_id()), "rows")

    # 1. Classes of equal sets: cls is the row of the first document.
    ids = rows.select("row", "doc_id", "h", "n", "p1", "p2")
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row", "h")
    classes = ids.where("n > 0").groupBy("p1", "p2", "n").agg(F.min(order).alias("first"))
    classes = written(classes.select("p1", "p2", "n", F.col("first.doc_id").alias("doc_id"), F.col("first.h").alias("h"), F.col("first.row").alias("cls")), "classes")

    # 2. Buckets with more than one class, their leaders, and verified links.
    bands = rows.select(F.col("row").alias("cls"), "bands").join(classes.select("cls"), "cls").select("cls", F.explode("bands").alias("key"))
    shared = bands.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
    members = written(bands.join(shared, "key"), "members")
    places = members.groupBy("cls").agg(F.sum("size").alias("places"))
    leads = members.join(places, "cls").groupBy("key").agg(F.max(F.struct("places", (-F.col("cls")).alias("neg"))).alias("top"))
    leads = leads.select("key", (-F.col("top.neg")).alias("lead"))
    pairs = members.join(leads, "key").where("cls <> lead").select(F.least("cls", "lead").alias("a"), F.greatest("cls", "lead").alias("b")).distinct()
    pairs = written(pairs, "pairs")

    met = members.select("cls").distinct().join(classes, "cls").select("cls", "p1", "p2", F.col("doc_id").alias("met_id"), F.col("h").alias("met_h")).hint("shuffle_hash")
    texts = docs.join(met, F.col("doc_id").eqNullSafe(F.col("met_id")) & (F.col("h") == F.col("met_h"))).select("cls", "p1", "p2", "text")
    # Rows that repeat a doc_id and its text give one set.
    sets = written(texts.mapInArrow(_set_batches, "cls long, n long, grams array<long>").groupBy("cls").agg(F.first("n").alias("n"), F.first("grams").alias("grams")), "sets")

    def verified(pairs: DataFrame) -> DataFrame:
        x = sets.select(F.col("cls").alias("a"), F.col("n").alias("x_n"), F.col("grams").alias("x_grams"))
        y = sets.select(F.col("cls").alias("b"), F.col("n").alias("y_n"), F.col("grams").alias("y_grams"))
        sizes = (F.least("x_n", "y_n") * 100 >= F.greatest("x_n", "y_n") * percent)
        both = pairs.join(x, "a").join(y, "b").where(sizes).select("a", "b", "x_grams", "y_grams")
        return both.mapInArrow(_verify(percent), "a long, b long")

    links = written(verified(pairs), "links")
    comps = connected_components(links)

    # 3. Members of buckets that hold several components.
    own = members.join(comps, F.col("cls") == F.col("node"), "left").select("cls", "key", F.coalesce("comp", "cls").alias("comp"))
    mixed = own.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi").select("key")
    rest = written(own.join(mixed, "key", "left_semi").select("cls", "comp").distinct(), "mixed")
    grams = sets.join(rest, "cls").select("cls", "comp", "n", F.explode("grams").alias("gram"))
    # Only shingles of two or more of these sets can meet; all others come first in the order of rarity.
    often = grams.groupBy("gram").agg(F.count("*").alias("f"), F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("f > 1")
    by_doc = Window.partitionBy("cls")
    known = grams.join(often, "gram").withColumn("m", F.count("*").over(by_doc)).withColumn("rank", F.row_number().over(by_doc.orderBy("f", "gram")))
    known = known.withColumn("place", F.expr("n - m + rank"))  # in the order of all shingles of the set
    prefix = F.expr(f"n - cast(ceil(n * {percent} / 100.0) as bigint) + 1")
    known = known.where((F.col("place") <= prefix) & (F.col("lo") < F.col("hi"))).select("gram", "cls", "comp", "n", F.expr("n - place").alias("left"))
    x = known.select("gram", F.col("cls").alias("a"), F.col("comp").alias("x"), F.col("n").alias("x_n"), F.col("left").alias("x_left"))
    y = known.select("gram", F.col("cls").alias("b"), F.col("comp").alias("y"), F.col("n").alias("y_n"), F.col("left").alias("y_left"))
    # If this is their first common shingle, only what comes after it in both sets can be common too.
    enough = (100 + percent) * (1 + F.least("x_left", "y_left")) >= percent * (F.col("x_n") + F.col("y_n"))
    fits = (F.col("a") < F.col("b")) & (F.col("x") != F.col("y")) & (F.least("x_n", "y_n") * 100 >= F.greatest("x_n", "y_n") * percent) & enough
    more = x.join(y, "gram").where(fits).select("a", "b").distinct().join(pairs, ["a", "b"], "left_anti")
    more = written(verified(more), "more-links")
    if more.head(1):
        comps = connected_components(links.unionByName(more))

    # 4. Back to the rows.
    linked = written(classes.join(comps, F.col("cls") == F.col("node")).select("cls", "doc_id", "comp"), "linked")
    firsts = linked.groupBy("comp").agg(F.min(F.struct(F.col("doc_id").isNull().alias("last"), F.col("doc_id").alias("id"))).alias("first"))
    firsts = broadcast_if_small(written(firsts.select("comp", F.col("first.id").alias("first_id")), "firsts"))
    heads = linked.join(firsts, "comp").select("cls", "first_id", F.lit(True).alias("in_component"))
    named = classes.join(heads, "cls", "left")
    named = written(named.select("p1", "p2", "n", F.when(F.col("in_component"), F.col("first_id")).otherwise(F.col("doc_id")).alias("first_id"), F.lit(True).alias("shingled")), "named")
    component = F.when(F.col("shingled"), F.col("first_id")).otherwise(F.col("doc_id"))
    out = ids.join(named, ["p1", "p2", "n"], "left").select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
