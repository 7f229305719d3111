"""Table profiling: nulls, size, duplicates, dedup and class balance.

Each profile is one aggregate (partial aggregation map-side, one small shuffle) instead of one
action per column.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def missing_count(df: DataFrame) -> DataFrame:
    """Nulls per column, all columns in one pass; one row, same column names."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])


def row_col_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.lit(len(df.columns)).alias("n_cols"))


def duplicate_groups(df: DataFrame, cols=None, digest: str | None = None) -> DataFrame:
    """Rows that occur more than once, with their multiplicity (HAVING count > 1).

    With ``digest`` (a long text column) repeated digests are found first, and only the rows that hold
    one are grouped by the text itself: the bytes decide, few texts are shuffled.
    """
    cols = list(cols or df.columns)
    if digest is not None:
        keyed = df.withColumn("_digest", F.sha2(digest, 256))
        again = keyed.groupBy("_digest").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select(F.col("_digest").alias("_again"))
        df = keyed.join(again, F.col("_digest").eqNullSafe(F.col("_again")), "left_semi").drop("_digest")
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("count")).filter(F.col("count") > 1)


def drop_duplicates(df: DataFrame, cols=None, text: str | None = None) -> DataFrame:
    """Distinct rows.  A long column ``text`` is not a key: rows meet by the other columns and its 64-bit hash, copies
    within a task before the shuffle, and the bytes decide (a set per key, of one text unless hashes collide)."""
    if text is None:
        return df.dropDuplicates(list(cols) if cols else None)
    others = [c for c in df.columns if c != text]
    sets = df.groupBy(*others, F.xxhash64(text).alias("_hash")).agg(F.collect_set(text).alias("_texts"))
    return sets.select(*others, F.explode_outer("_texts").alias(text)).select(*df.columns)


def distinct_rows(df: DataFrame, digest: str) -> DataFrame:
    """Distinct rows with the text column ``digest`` replaced by its SHA-256 digest: for counts, which never
    need the text itself."""
    return df.withColumn(digest, F.sha2(digest, 256)).distinct()


def class_counts(df: DataFrame, col: str) -> DataFrame:
    """Rows per class value, ascending by count (ties by value)."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("count")).orderBy("count", col)


def inspect_schema(df: DataFrame) -> DataFrame:
    """``printSchema`` as data, with the non-null count of each column from one aggregate:
    ``(position, name, type, non_null)``."""
    fields = df.schema.fields
    counts = df.agg(*[F.count(F.col(f.name)).alias(f"n{i}") for i, f in enumerate(fields)])
    stacked = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(i).alias("position"),
                    F.lit(f.name).alias("name"),
                    F.lit(f.dataType.simpleString()).alias("type"),
                    F.col(f"n{i}").alias("non_null"),
                )
                for i, f in enumerate(fields)
            ]
        )
    )
    return counts.select(stacked.alias("s")).select("s.*")


def preview(df: DataFrame, order_by, n: int = 5, tail: bool = False) -> DataFrame:
    """Deterministic ``show(n)`` / ``tail(n)``: explicit order, then a limit (TakeOrdered)."""
    keys = [F.col(c) if isinstance(c, str) else c for c in ([order_by] if isinstance(order_by, str) else order_by)]
    if tail:
        keys = [k.desc() for k in keys]
    return df.orderBy(*keys).limit(n)
