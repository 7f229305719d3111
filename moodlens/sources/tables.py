"""Parquet scans of the driver tables.

Scans are lazy and pruned: callers select the columns they need and Catalyst pushes the
projection (``ReadSchema``) and filters (``PushedFilters``) into the Parquet reader.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def spread(df: DataFrame, key: str, min_partitions: int | None = None) -> DataFrame:
    """Hash-partition on ``key`` only when the scan yields fewer tasks than the cluster can run.

    Text cleaning is CPU-bound per row; a source with few, large splits (one Parquet row group is
    one task) would otherwise run it on a handful of cores.  On a cluster reading many splits this
    is a no-op, so no shuffle is added where the input is already parallel.  Hashing on the key
    (not round-robin) keeps the placement deterministic when a task is retried.
    """
    target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= target:
        return df
    return df.repartition(target, key)
