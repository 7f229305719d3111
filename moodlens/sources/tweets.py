"""The tweet table: CSV scans and sinks, positional renames, and the views built from driver tables.

The original corpus is a headerless six-column CSV.  We read it with an explicit schema (schema
inference costs a full extra pass over the file) and keep the same six columns when we derive a
tweet-shaped view from the driver's ``documents`` and ``labels`` tables.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ensure_checkpoint_dir
from .tables import read_table, spread

TWEET_COLUMNS = ["Polarity", "TweetID", "Date", "QueryFlag", "User", "TweetText"]
CORRUPT = "_corrupt_record"
POSITIONAL_COLUMNS = [f"_c{i}" for i in range(6)]
TWEET_SCHEMA = T.StructType(
    [
        T.StructField("Polarity", T.IntegerType()),
        T.StructField("TweetID", T.LongType()),
        T.StructField("Date", T.StringType()),
        T.StructField("QueryFlag", T.StringType()),
        T.StructField("User", T.StringType()),
        T.StructField("TweetText", T.StringType()),
    ]
)
CLEANED_SCHEMA = T.StructType([T.StructField("text", T.StringType()), T.StructField("label", T.IntegerType())])

# The driver's documents have no date; the view gives all rows one of the corpus's form.
TWEET_DATE = "Mon Apr 06 22:19:45 PDT 2009"

# Test decorations (our own) appended by doc_id so every cleaning rule has something to act on;
# the driver's prose has no links, emoticons, entities or apostrophes.
DECORATIONS = [
    " see https://ex.org/a?b=1 now",
    " @ann #Spark",
    " wow!!! really?? hmm...",
    " they'll say it's fine, can't",
    " so happy :)) at 12:30",
    " Tom &amp; Ann &lt;3",
    " lol! brb w/ u",
    " ok :-D mail bob@x.org :thumbs_up: :fire:",
    " it&#8217;s caf&eacute; &lt x &AMP &notit; &#x41;&#150;& &zzz;",
]


def _csv_reader(spark: SparkSession, schema, header: bool, encoding: str = "UTF-8", multi_line: bool = False):
    return (
        spark.read.schema(schema)
        .option("header", header)
        .option("encoding", encoding)
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", multi_line)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
    )


def scan_tweets_csv(spark: SparkSession, path: str, encoding: str = "UTF-8", positional: bool = True,
                    multi_line: bool = False, with_corrupt: bool = False) -> DataFrame:
    """Headerless tweet CSV with an explicit schema; ``positional`` keeps ``_c0.._c5`` names.

    A file is split among tasks unless ``multi_line`` (quoted line ends in texts) asks for whole files.
    ``with_corrupt`` adds ``_corrupt_record``: the raw line of a row whose fields do not fit, else NULL
    (see :func:`sound_only` and :func:`malformed_count`).
    """
    names = POSITIONAL_COLUMNS if positional else TWEET_COLUMNS
    schema = T.StructType([T.StructField(n, f.dataType) for n, f in zip(names, TWEET_SCHEMA)])
    if with_corrupt:
        schema = T.StructType([*schema, T.StructField(CORRUPT, T.StringType())])
    return _csv_reader(spark, schema, header=False, encoding=encoding, multi_line=multi_line).csv(path)


def scan_tweets_latin1(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    return rename_columns(scan_tweets_csv(spark, path, encoding="ISO-8859-1", multi_line=multi_line))


def sound_only(label: Column) -> Column:
    """``label``, or NULL for a malformed row (which would otherwise become a negative tweet)."""
    return F.when(F.col(CORRUPT).isNull(), label)


def malformed_count(df: DataFrame) -> DataFrame:
    """One row: ``n_rows``, ``n_malformed`` of a scan ``with_corrupt``."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.count(CORRUPT).alias("n_malformed"))


def rename_columns(df: DataFrame, names=TWEET_COLUMNS) -> DataFrame:
    """Positional rename of all columns in one projection."""
    return df.toDF(*names)


def write_tweets_csv(df: DataFrame, path: str, encoding: str = "UTF-8", header: bool = False) -> None:
    (
        df.write.mode("overwrite")
        .option("header", header)
        .option("encoding", encoding)
        .option("quote", '"')
        .option("escape", '"')
        .csv(path)
    )


def write_cleaned(df: DataFrame, path: str, fmt: str = "csv") -> None:
    """Sink of cleaned ``(text, label)`` rows: CSV with a header, or Parquet."""
    out = df.select("text", "label")
    if fmt == "csv":
        write_tweets_csv(out, path, header=True)
    else:
        out.write.mode("overwrite").parquet(path)


def scan_cleaned(spark: SparkSession, path: str, fmt: str = "csv", multi_line: bool = False) -> DataFrame:
    if fmt == "csv":
        return _csv_reader(spark, CLEANED_SCHEMA, header=True, multi_line=multi_line).csv(path)
    return spark.read.schema(CLEANED_SCHEMA).parquet(path)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the session's shared checkpoint folder (never machine-local on a cluster)."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, "moodlens-out", f"{name}-{uuid.uuid4().hex}")


def decoration(doc_id: Column) -> Column:
    out = None
    for i, text in enumerate(DECORATIONS):
        out = F.when(doc_id % len(DECORATIONS) == i, F.lit(text)) if out is None else out.when(
            doc_id % len(DECORATIONS) == i, F.lit(text)
        )
    return out.otherwise(F.lit(""))


def polarity_from_labels(quality: Column, toxic: Column) -> Column:
    """quality 1 → 4 (positive), else toxic 1 → 0 (negative), else 2 (neutral); unlabelled → NULL."""
    return (
        F.when(quality == 1, F.lit(4))
        .when(toxic == 1, F.lit(0))
        .when(quality.isNotNull(), F.lit(2))
        .cast("int")
    )


def text_view(spark: SparkSession, sf_dir: str, decorate: bool = True) -> DataFrame:
    """Every document as a tweet row without ``Polarity``: for queries of the text alone, which need no join."""
    docs = spread(read_table(spark, sf_dir, "documents").select("doc_id", "text", "source"), "doc_id")
    text = F.concat(F.col("text"), decoration(F.col("doc_id"))) if decorate else F.col("text")
    return docs.select(
        F.col("doc_id").alias("TweetID"),
        F.lit(TWEET_DATE).alias("Date"),
        F.lit("NO_QUERY").alias("QueryFlag"),
        F.col("source").alias("User"),
        text.alias("TweetText"),
    )


def tweet_view(spark: SparkSession, sf_dir: str, decorate: bool = True) -> DataFrame:
    """``text_view`` with ``Polarity`` from ``labels`` (NULL when unlabelled).

    Only the needed columns are scanned.  The join is left to Catalyst/AQE: ``labels`` grows with
    the corpus, so it is not force-broadcast; AQE broadcasts it at run time when it is small.
    """
    labels = read_table(spark, sf_dir, "labels").select(F.col("doc_id").alias("TweetID"), "quality", "toxic")
    j = text_view(spark, sf_dir, decorate).join(labels, "TweetID", "left")
    return j.select(
        polarity_from_labels(F.col("quality"), F.col("toxic")).alias("Polarity"),
        "TweetID", "Date", "QueryFlag", "User", "TweetText",
    )


def labelled_tweets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tweet_view(spark, sf_dir).filter(F.col("Polarity").isNotNull())


def positional_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tweet view as the headerless CSV scan sees it (``_c0.._c5``)."""
    return tweet_view(spark, sf_dir).toDF(*POSITIONAL_COLUMNS)
