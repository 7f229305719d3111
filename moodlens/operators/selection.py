"""Exact order statistics and global row numbers without a one-task sort.

``top_k`` finds the row at place ``k`` first and then filters.  Three steps, each a scan with a small
aggregate: the histogram of counts gives the count at the cut; among the rows with that count, histograms
of two more bytes of the tie-breaking text each narrow down the bucket that holds the cut; the last bucket,
once small, is sorted.  However many rows tie at the cut, no task ever sorts more than ``bucket_rows`` of
them.

``numbered`` gives each row its place in a total order: a range partitioning sorts in parallel, and the
sizes of the partitions (one number each) give every partition its first place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

BUCKET_ROWS = 10_000
STEP_BYTES = 2  # a histogram has at most 65 536 + 1 rows


def count_at_place(df: DataFrame, k: int, count_col: str) -> tuple[int, int] | None:
    """``(cut, above)``: the count of the row at place ``k`` (largest first) and the number of rows with a larger
    one; None if there are no more than ``k`` rows.  The histogram has a row per distinct count: a few thousand
    for word frequencies, never more than the root of twice their sum."""
    hist = df.groupBy(count_col).agg(F.count(F.lit(1)).alias("_n"))
    w = Window.orderBy(F.desc(count_col)).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = hist.select(count_col, "_n", F.sum("_n").over(w).alias("_at_least"))
    row = ranked.filter(F.col("_at_least") > k).orderBy(F.desc(count_col)).first()
    return None if row is None else (row[count_col], row["_at_least"] - row["_n"])


def _text_at_place(df: DataFrame, k: int, text: str, bucket_rows: int, column: Column) -> str | None:
    """The ``k``-th smallest of the distinct texts of ``df`` (``k`` from 1, at most the number of rows)."""
    prefix, left = b"", k
    while True:
        # Texts with the prefix, by their next bytes (as many as there are: a text that ends here sorts first).
        size = len(prefix)
        here = df.filter(F.substring(column, 1, size) == F.lit(bytearray(prefix))) if size else df
        hist = here.groupBy(F.substring(column, size + 1, STEP_BYTES).alias("next")).agg(F.count(F.lit(1)).alias("n"))
        rows = hist.orderBy("next").collect()  # at most 256 + 65 536 + 1 rows
        for r in rows:
            if left <= r["n"]:
                break
            left -= r["n"]
        bucket, step = r["n"], bytes(r["next"])
        prefix += step
        if len(step) < STEP_BYTES:
            return prefix.decode()  # this text itself: nothing follows
        if bucket <= bucket_rows:
            inside = df.filter(F.substring(column, 1, len(prefix)) == F.lit(bytearray(prefix)))
            return inside.select(text).orderBy(text).limit(bucket).collect()[left - 1][text]


def top_k(df: DataFrame, k: int, count_col: str, tie_col: str, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """The ``k`` rows with the largest ``count_col``, ties by ``tie_col`` ascending (exact, in no order).

    ``tie_col`` is a text column of distinct values, such as the terms of a vocabulary.  ``df`` is read several
    times, so pass a materialized table."""
    if k <= 0:
        return df.limit(0)
    found = count_at_place(df, k, count_col)
    if found is None:
        return df
    cut, above = found
    ties = df.filter(F.col(count_col) == F.lit(cut))
    more = F.col(count_col) > F.lit(cut)
    if k == above:
        return df.filter(more)
    last = _text_at_place(ties, k - above, tie_col, bucket_rows, F.col(tie_col).cast("binary"))
    return df.filter(more | ((F.col(count_col) == F.lit(cut)) & (F.col(tie_col) <= F.lit(last))))


def partition_keys(spark, n: int) -> list[int]:
    """``n`` ints that hash partitioning deals into ``n`` partitions, one into each."""
    key = F.col("id").cast("int")
    found = spark.range(32 * n + 1_000).groupBy(F.pmod(F.hash(key), F.lit(n)).alias("at")).agg(F.min(key).alias("key")).collect()
    return sorted(r["key"] for r in found)


def numbered(df: DataFrame, order: list[Column], out_col: str, start: int = 1, partitions: int | None = None) -> DataFrame:
    """``df`` plus ``out_col`` (long): the row's place in ``order``, from ``start``.  ``order`` must be total for a
    repeatable numbering; a hot value of the first key is split by the next ones."""
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parted = df.repartitionByRange(n, *order).sortWithinPartitions(*order)
    # The id holds the partition in its upper bits and the place in it below.  Written once: the bounds of a
    # range partitioning are sampled, so they must not be drawn again.
    parted = materialize(parted.withColumn("_at", F.monotonically_increasing_id()))
    part, place = F.shiftrightunsigned("_at", 33), F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = parted.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))  # a row per partition
    before = sizes.select("_part", F.sum("_n").over(Window.orderBy("_part")).alias("_to"), "_n")
    before = before.select("_part", (F.col("_to") - F.col("_n")).alias("_before"))
    out = parted.withColumn("_part", part).join(F.broadcast(before), "_part")
    return out.withColumn(out_col, F.col("_before") + place + start).drop("_part", "_before", "_at")
