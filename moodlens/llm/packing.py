"""Harmonic packing of tokenised documents into sequences of a fixed capacity.

Lengths fall into classes of reciprocal capacity: class k holds pieces of ``capacity // k`` ids, and k of
them fill a sequence.  Since documents may be cut, a document is cut into the largest class size that
fits, again and again (two or three pieces after its full sequences), so no class wastes more than its
rounding, at most 1/512 of the capacity.

Every task fills the sequences of its classes by itself, a fixed count of pieces each.  What is left in a
task (fewer than k pieces of class k) is numbered across tasks from one count per task and class and fills
further sequences; what is left then, fewer than k pieces of each class in the whole corpus, is a bounded
set that one first-fit pass packs.
"""

from __future__ import annotations

import os
import uuid
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from .bpe import PART_BYTES, loaded, slices

END = 1  # id after each document


def class_counts(capacity: int) -> list[int]:
    """Counts k whose k pieces of capacity // k ids waste at most 1/512 of a sequence."""
    out: dict[int, int] = {}
    for k in range(1, capacity + 1):
        size = capacity // k
        if capacity - size * k <= capacity // 512:
            out[size] = k  # the largest count of this size
    return sorted(out.values())


def cut(length: int, sizes: list[int]) -> list[int]:
    """Piece lengths, greedily the largest class size (``sizes`` descending, ends with 1)."""
    out = [sizes[0]] * (length // sizes[0])
    length -= sizes[0] * len(out)
    for s in sizes[1:]:
        while length >= s:
            out.append(s)
            length -= s
    return out


_PIECES = "task int, k int, nth long, doc_id long, start long, length long, ids_crc32 long, doc_tokens long, ids binary"


def _cut_batches(path: str, capacity: int, with_ids: bool):
    counts = class_counts(capacity)
    sizes = [capacity // k for k in counts]
    count_of = dict(zip(sizes, counts))
    kinds = [pa.int32(), pa.int32(), *[pa.int64()] * 6, pa.binary()]
    names = [x.split()[0] for x in _PIECES.split(", ")]

    def run(batches):
        bpe, task = loaded(path), TaskContext.get().partitionId()
        seen = dict.fromkeys(counts, 0)
        end = np.array([END], "<u4").tobytes()
        for batch in batches:
            for part in slices(batch, size=PART_BYTES):
                rows = []
                for doc, ids in zip(part.column("doc_id").to_pylist(), bpe.encode_all(part.column("text").to_pylist())):
                    ids += end
                    n, at = len(ids) // 4, 0
                    for size in cut(n, sizes):
                        k, piece = count_of[size], ids[4 * at : 4 * (at + size)]
                        rows.append((task, k, seen[k], doc, at, size, zlib.crc32(piece), n, piece if with_ids else None))
                        seen[k] += 1
                        at += size
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)

    return run


def _first_fit(capacity: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "task", "k", "nth"], ascending=[False, True, True, True])
        used, seq, off = [], [], []
        for n in pdf["length"]:
            i = next((i for i, u in enumerate(used) if u + n <= capacity), len(used))
            if i == len(used):
                used.append(0)
            seq.append(i)
            off.append(used[i])
            used[i] += n
        return pdf.assign(sequence_id=np.array(seq, np.int64), offset=np.array(off, np.int64))

    return run


def pack(docs: DataFrame, path: str, capacity: int = 2048, with_ids: bool = False) -> DataFrame:
    """Tokenise, cut and pack all documents.

    Input: ``doc_id``, ``text`` (others are ignored, whatever their names).  A document's ids are those of
    ``path`` (a vocabulary file that the workers can read) followed by one end id; a null or empty text is the
    end id alone.  One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, and
    with ``with_ids`` the ids as binary.  Sequence numbers are unique, not gapless.  Repeated rows and null
    doc_ids are packed like any other; an empty table gives an empty table.
    """
    spark = docs.sparkSession
    base = os.path.join(ensure_checkpoint_dir(spark), "packing", uuid.uuid4().hex)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # Written once: a piece's number in its task must not change when the task runs again.
    docs.mapInArrow(_cut_batches(path, capacity, with_ids), _PIECES).write.parquet(base)
    pieces = spark.read.parquet(base)

    # One row per task and class (at most a few dozen classes).
    left = pieces.groupBy("task", "k").agg(F.count("*").alias("n")).withColumn("left", F.expr("n % k"))
    by_class = Window.partitionBy("k")
    before = by_class.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    left = left.withColumn("before", F.coalesce(F.sum("left").over(before), F.lit(0))).withColumn("all_left", F.sum("left").over(by_class))
    p = pieces.join(left, ["task", "k"])
    rest = F.col("nth") >= F.col("n") - F.col("left")
    p = p.withColumn("rank", F.when(rest, F.expr("before + nth - (n - left)")).otherwise(F.col("nth")))
    p = p.withColumn("tail", rest & (F.col("rank") >= F.expr("all_left - all_left % k")))
    # Sequence numbers: 0 for the tail, 1 for what tasks leave, then the tasks; below them class and bin.
    owner = F.when(F.col("tail"), 0).otherwise(F.when(rest, 1).otherwise(F.col("task") + 2)).cast("long")
    bin_ = F.expr("shiftleft(cast(k as bigint), 28) + cast(floor(rank / k) as bigint)")
    full = p.where(~F.col("tail")).withColumn("sequence_id", F.shiftleft(owner, 40) + bin_).withColumn("offset", F.expr("(rank % k) * length"))
    keep = [*pieces.columns, "sequence_id", "offset"]
    # Fewer than k pieces of each class k, whatever the input's size.
    tail = p.where("tail").select(*pieces.columns, F.lit(0).alias("one")).groupBy("one").applyInPandas(
        lambda pdf: _first_fit(capacity)(pdf)[keep], _PIECES + ", sequence_id long, offset long"
    )
    out = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] + ["ids"] * with_ids
    return full.select(*keep).unionByName(tail).select(*out)


def sequences(pieces: DataFrame, capacity: int = 2048, pad: int = 0) -> DataFrame:
    """The packed ids (``pack(..., with_ids=True)``): sequence_id, ids array<long>, n_ids.  Padded to the capacity unless
    a sequence's length is a power of two.  A sequence never holds more than ``capacity`` ids."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        ids = np.frombuffer(b"".join(pdf.sort_values("offset")["ids"]), "<u4").astype(np.int64)
        n = len(ids)
        if n & (n - 1):
            ids = np.pad(ids, (0, capacity - n), constant_values=pad)
        return pd.DataFrame({"sequence_id": [pdf["sequence_id"].iloc[0]], "ids": [ids], "n_ids": [n]})

    return pieces.groupBy("sequence_id").applyInPandas(run, "sequence_id long, ids array<long>, n_ids long")
