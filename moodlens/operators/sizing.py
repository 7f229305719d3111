"""Broadcast a join side only when its size is measured, not assumed.

A side capped by row count (a top-k vocabulary, a lexicon) can still be large in bytes when its strings are
long, so both are measured, by partial aggregates over the side.  Sides over either bound are returned unchanged
and the join shuffles on its key (AQE may still pick a broadcast at run time from real sizes).
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, StringType

MAX_BROADCAST_ROWS = 2_000_000
MAX_BROADCAST_BYTES = 256 * 1024 * 1024


def _row_bytes(df: DataFrame):
    parts = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (StringType, BinaryType)):
            parts.append(F.coalesce(F.octet_length(c), F.lit(0)) + F.lit(8))
        elif isinstance(f.dataType, ArrayType) and isinstance(f.dataType.elementType, StringType):
            parts.append(F.coalesce(F.octet_length(F.array_join(c, "")) + F.size(c) * 8, F.lit(0)) + F.lit(16))
        else:
            parts.append(F.lit(8))
    total = parts[0]
    for p in parts[1:]:
        total = total + p
    return total.cast("bigint")


def measure(df: DataFrame) -> tuple[int, int]:
    """``(rows, bytes)``, counted where the rows lie: a row per task is shuffled."""
    row = df.agg(F.count(F.lit(1)).alias("n"), F.sum(_row_bytes(df)).alias("b")).first()
    return int(row["n"]), int(row["b"] or 0)


def is_small(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS, max_bytes: int = MAX_BROADCAST_BYTES) -> bool:
    n, b = measure(df)
    return n <= max_rows and b <= max_bytes


def broadcast_if_small(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS,
                       max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    return F.broadcast(df) if is_small(df, max_rows, max_bytes) else df


TARGET_PARTITION_BYTES = 128 * 1024 * 1024


def total_bytes(df: DataFrame) -> int:
    """Estimated bytes of all rows (strings and string arrays by length; other columns 8 bytes)."""
    return int(df.agg(F.sum(_row_bytes(df)).alias("b")).first()["b"] or 0)


def fit_partitions(df: DataFrame, est_bytes: int, target: int = TARGET_PARTITION_BYTES) -> DataFrame:
    """About one partition per ``target`` bytes for the input of an iterative fit.

    L-BFGS and similar fits run one Spark job per iteration, and each pays per-stage and per-task
    costs: a small input spread over many tiny partitions spends most of its time scheduling (and
    its tree aggregation adds a stage).  This only ever lowers the partition count, without a
    shuffle; a large input keeps its splits.
    """
    want = max(1, math.ceil(est_bytes / target))
    return df.coalesce(want) if want < df.rdd.getNumPartitions() else df
