"""Term statistics per class: the tables behind word clouds.

``explode`` is narrow; the ``groupBy(label, term)`` aggregates map-side first, so a hot term (the
most common word may be a large share of all tokens) reaches the shuffle as one partial count
per task, not one row per occurrence.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import explode_rows


def term_counts(df: DataFrame, label_col: str, tokens_col: str) -> DataFrame:
    """``(label, term, cnt)``."""
    rows = explode_rows(df, F.col(tokens_col), "term", keep=[F.col(label_col).alias("label")])
    return rows.groupBy("label", "term").agg(F.count(F.lit(1)).alias("cnt"))


def term_freq_by_class(df: DataFrame, label_col: str, tokens_col: str) -> DataFrame:
    """``(label, term, cnt, rel)``: occurrences per class, and the ratio to the class's top count."""
    counts = term_counts(df, label_col, tokens_col)
    class_max = counts.groupBy("label").agg(F.max("cnt").alias("max_cnt"))
    # class_max has one row per class: a tiny, bounded side.
    return counts.join(F.broadcast(class_max), "label").select(
        "label", "term", "cnt", (F.col("cnt") / F.col("max_cnt")).alias("rel")
    )


def top_terms_by_class(df: DataFrame, label_col: str, tokens_col: str, k: int = 1000) -> DataFrame:
    """The ``k`` most frequent terms of each class, ties broken by term: ``(label, rank, term, cnt, rel)``."""
    counts = term_counts(df, label_col, tokens_col)
    w = Window.partitionBy("label").orderBy(F.desc("cnt"), F.asc("term"))
    # Spark plans rank-limited windows as WindowGroupLimit: each task keeps only its own top k
    # per class before the shuffle, so a class holding most rows does not ship all its terms.
    # The class's top count is the first row of that same window: no second pass over the counts.
    top = counts.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
    top = top.withColumn("max_cnt", F.first("cnt").over(w))
    return top.select("label", "rank", "term", "cnt", (F.col("cnt") / F.col("max_cnt")).alias("rel"))
