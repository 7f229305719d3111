"""Session helpers for tests, the bench and command-line use.

Library code never builds a session; it receives DataFrames.  On a cluster the caller owns the
session and its ``spark.checkpoint.dir`` (a shared folder); only when that is unset, as in local
tests, do we point it at a fresh scratch folder.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "moodlens") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("MOODLENS_DRIVER_MEMORY", "16g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's ``spark.checkpoint.dir``; set a scratch one only when it is unset in local mode, where
    driver and executors are one machine.  Anywhere else a missing setting is an error."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir", None
    )
    if configured:
        spark.sparkContext.setCheckpointDir(configured)
        return configured
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    path = tempfile.mkdtemp(prefix="moodlens-ckpt-", dir="/tmp")
    spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    return path


def materialize(df: DataFrame) -> DataFrame:
    """Cut lineage before a result feeds several passes (model fits, metric sweeps).

    The rows are written once as a Parquet table under the session's shared checkpoint folder and
    read back: one computation (``Dataset.checkpoint`` would compute an unpersisted plan twice, once
    for its count and once for the files), a durable copy that survives executor loss without
    replaying the text cleaning, and file statistics for the optimizer.
    """
    spark = df.sparkSession
    base = ensure_checkpoint_dir(spark)
    path = os.path.join(base, "moodlens-tables", uuid.uuid4().hex)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
