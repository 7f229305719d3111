"""Exact dedup with an extendible-hash index on shared files; DataFrame functions only.

* Every row leaves an index record: its 64-bit key and SHA-256 digest, no text.
* The directory starts as one bucket; where a bucket holds more than ``capacity`` records, its depth grows
  by one key bit (the directory doubles) until it fits; the depth that can be reached follows from the number
  of records.  Records with one key cannot be split: they are the bucket's overflow chain, and are summed
  before they are shuffled.
* Index files are partitioned by bucket.  Owner tasks take the keys of a bucket's range; only where a key
  has several records are the texts fetched, and their bytes compared as grouping keys: texts that share a
  key but not their bytes become separate entries of its chain.
"""

from __future__ import annotations

import math
import os
import string
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.sizing import broadcast_if_small
from ..session import ensure_checkpoint_dir, materialize


def lower_ascii(c):
    """A-Z to a-z and nothing else; ``lower`` is exact (and faster) where all characters are ASCII."""
    return F.when(F.length(c) == F.octet_length(c), F.lower(c)).otherwise(F.translate(c, string.ascii_uppercase, string.ascii_lowercase))


def directory(records: DataFrame, capacity: int, max_depth: int) -> DataFrame:
    """(slot, bucket): the bucket of each used slot of the full directory; at most 2**max_depth rows, which is in
    proportion to records / capacity."""
    slots = records.groupBy("slot").agg(F.count("*").alias("n"))
    levels = slots.withColumn("depth", F.explode(F.sequence(F.lit(0), F.lit(max_depth))))
    levels = levels.withColumn("part", F.expr(f"shiftright(slot, {max_depth} - depth)"))
    sizes = levels.groupBy("depth", "part").agg(F.sum("n").alias("size"))
    fits = sizes.where((F.col("size") <= capacity) | (F.col("depth") == max_depth)).select("depth", "part")
    # All slots share the part of depth 0: the side that is a row per part goes to them.
    local = levels.join(broadcast_if_small(materialize(fits)), ["depth", "part"]).groupBy("slot").agg(F.min("depth").alias("depth"))
    return local.select("slot", F.expr(f"shiftleft(1L, depth) + shiftright(slot, {max_depth} - depth)").alias("bucket"))


def exact_dedup(docs: DataFrame, capacity: int | None = None, max_depth: int | None = None) -> DataFrame:
    """Group documents whose texts are equal after lower-casing A-Z; the largest doc_id of a group stays.

    Input: ``doc_id``, ``text`` (others are ignored, whatever their names).  One row per input row: doc_id,
    keep_id, group_size (rows), kept, text_sha256 (of the normalised text).  Null text equals empty text.
    A null doc_id is smaller than any other.  Of rows that tie in text and doc_id exactly one stays.  An empty
    table gives an empty table.
    """
    spark = docs.sparkSession
    base = os.path.join(ensure_checkpoint_dir(spark), "exact-dedup", uuid.uuid4().hex)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    norm = docs.select("doc_id", lower_ascii(F.coalesce("text", F.lit(""))).alias("norm"))

    # The records, written once: a row's number must not change when a task is run again.
    records = norm.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.xxhash64("norm").alias("key"), F.sha2("norm", 256).alias("sha"))
    records.write.parquet(f"{base}/records")
    records = spark.read.parquet(f"{base}/records")
    total = records.count()
    if capacity is None:
        parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
        capacity = max(1 << 14, min(1 << 22, total // max(1, 4 * parts)))
    if max_depth is None:
        # Two bits more than equal buckets would need: keys are hashes, so only copies can overfill such a bucket.
        max_depth = max(1, math.ceil(math.log2(max(total, 1) / capacity)) + 2) if total > capacity else 1
    records = records.withColumn("slot", F.expr(f"shiftrightunsigned(key, {64 - max_depth})"))

    # The index: one entry per digest, summed before it is shuffled, in the files of its bucket.
    slots = broadcast_if_small(materialize(directory(records, capacity, max_depth)))
    found = records.groupBy("slot", "key", "sha").agg(F.count("*").alias("n"))
    found = found.join(slots, "slot").drop("slot").repartition("bucket").sortWithinPartitions("bucket", "key", "sha")
    found.write.partitionBy("bucket").parquet(f"{base}/index")
    index = spark.read.schema("key long, sha string, n long, bucket long").parquet(f"{base}/index")

    # Rows of entries that were met again, and their texts.  They come by doc_id, which no group of copies
    # makes hot; equal (doc_id, key) rows come as one, so a text meets its own key once.
    met = records.join(index.where("n > 1"), ["key", "sha"]).groupBy("doc_id", "bucket", "key").agg(F.max("row").alias("row"))
    met = met.withColumnRenamed("doc_id", "met_id").hint("shuffle_hash")
    texts = docs.join(met, F.col("doc_id").eqNullSafe(F.col("met_id"))).select("doc_id", "row", "bucket", "key", lower_ascii(F.coalesce("text", F.lit(""))).alias("norm"))
    same = texts.where(F.xxhash64("norm") == F.col("key")).groupBy("bucket", "key", "norm")
    chain = same.agg(F.max(F.struct("doc_id", "row")).alias("last"), F.count("*").alias("n")).where("n > 1")
    chain.select("key", F.sha2("norm", 256).alias("sha"), "last", "n").write.parquet(f"{base}/chains")
    chains = spark.read.parquet(f"{base}/chains")

    out = records.join(chains, ["key", "sha"], "left")
    return out.select(
        "doc_id",
        F.when(F.col("n").isNull(), F.col("doc_id")).otherwise(F.col("last.doc_id")).alias("keep_id"),
        F.coalesce("n", F.lit(1).cast("long")).alias("group_size"),
        (F.coalesce("last.row", "row") == F.col("row")).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


ORACLE_SQL = """
WITH t AS (SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS h FROM documents),
g AS (SELECT h, max(doc_id) AS keep_id, count(*) AS n FROM t GROUP BY h)
SELECT doc_id, keep_id, n AS group_size, doc_id = keep_id AS kept, h AS text_sha256 FROM t JOIN g USING (h)
"""
