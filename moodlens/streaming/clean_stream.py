"""Clean tweets arriving as files, with Structured Streaming.

The reference has no streaming; this only shows that the same stateless columns run on a stream:
``readStream`` of Parquet/CSV files → ``social_tokens_df`` → a Parquet sink with a checkpoint in
the session's shared checkpoint folder (exactly-once file sink, restartable after executor or
driver loss).  No state, no watermark: every micro-batch is independent.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..plans import social

DOC_SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)


def read_documents_stream(spark: SparkSession, path: str, schema=DOC_SCHEMA, max_files_per_trigger: int = 64) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger).parquet(path)


def clean_stream(stream: DataFrame, text_col: str = "text", id_col: str = "doc_id", **lexicons) -> DataFrame:
    """``(id, tokens)`` for every arriving row."""
    return social.social_tokens_df(stream.select(id_col, text_col), text_col, "tokens", keep=[id_col], **lexicons)


def start_clean_sink(stream: DataFrame, out_dir: str, checkpoint_dir: str | None = None, available_now: bool = False):
    spark = stream.sparkSession
    base = checkpoint_dir or os.path.join(spark.conf.get("spark.checkpoint.dir"), "moodlens-stream")
    writer = stream.writeStream.format("parquet").option("checkpointLocation", base).option("path", out_dir)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    return writer.start()
