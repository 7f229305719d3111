"""Corpus pipeline: five stages, each written as Parquet and read again as the next one's documents.

Every stage but the last returns the columns of ``documents``; the last returns the packed pieces.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from moodlens.llm.crf import score, train
from moodlens.llm.exact_dedup import exact_dedup, lower_ascii
from moodlens.llm.minhash import near_duplicates
from moodlens.llm.packing import pack
from moodlens.llm.queries import vocabulary
from moodlens.llm.substring_dedup import substring_dedup
from moodlens.session import ensure_checkpoint_dir
from moodlens.sources.tables import read_table


def _carried(made: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` from an operator's carried ones."""
    return made.select(*[F.col(f"carried_{i}").alias(c) for i, c in enumerate(docs.columns)])


def _free(docs: DataFrame, *names: str) -> list[str]:
    """Column names that ``docs`` does not have."""
    taken = {c.lower() for c in docs.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        out.append(name)
    return out


def _without(docs: DataFrame, decided: DataFrame) -> DataFrame:
    """Documents less those of whose rows ``decided`` keeps none (a null doc_id matches a null one)."""
    (gone_id,) = _free(docs, "gone_id")
    gone = decided.groupBy(F.col("doc_id").alias(gone_id)).agg(F.max("kept").alias("any")).where("NOT any").select(gone_id)
    return docs.join(gone, F.col("doc_id").eqNullSafe(F.col(gone_id)), "left_anti")


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts (a score of 0.7 or more); every row is judged by itself."""
    made = score(docs, train(docs, read_table(spark, sf_dir, "labels")), carry=tuple(docs.columns))
    return _carried(made.where("predicted = 1"), docs)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal texts (A-Z lower-cased) the one with the largest doc_id.  Rows are told apart by
    doc_id and text; of rows that are equal in both one stays."""
    decided = exact_dedup(docs)
    gone_id, gone_sha, sha = _free(docs, "gone_id", "gone_sha", "pipeline_sha")
    groups = decided.groupBy(F.col("doc_id").alias(gone_id), F.col("text_sha256").alias(gone_sha)).agg(F.max("kept").alias("any"), F.count("*").alias("n"))
    same = F.col("doc_id").eqNullSafe(F.col(gone_id)) & (F.col(sha) == F.col(gone_sha))
    keyed = docs.withColumn(sha, F.sha2(lower_ascii(F.coalesce("text", F.lit(""))), 256))
    left = keyed.join(groups.where("NOT any").select(gone_id, gone_sha), same, "left_anti")
    if groups.where("n > 1 AND any").head(1):
        left = left.dropDuplicates(["doc_id", sha])
    return left.select(*docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the smallest doc_id, of each component of near-duplicates; rows that share a doc_id stay
    together."""
    return _without(docs, near_duplicates(docs))


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the words of passages that start earlier; a document that loses no word keeps its text
    as it is, one that loses all keeps the empty text.  ``n_chars`` follows the text."""
    others = [c for c in docs.columns if c != "text"]  # the text comes back as kept_text
    made = substring_dedup(docs, window=20, carry=tuple(others))
    carried = {c: F.col(f"carried_{i}") for i, c in enumerate(others)}
    if "n_chars" in carried:
        chars = F.length("kept_text").cast(docs.schema["n_chars"].dataType)
        carried["n_chars"] = F.when(F.col("n_removed") > 0, chars).otherwise(carried["n_chars"])
    return made.select(*[carried.get(c, F.col("kept_text")).alias(c) for c in docs.columns])


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the tokenised documents in sequences of 2048."""
    return pack(docs, vocabulary(), capacity=2048)


STAGES = [
    ("quality", quality_filter),
    ("exact_dedup", exact_copies),
    ("near_dedup", near_copies),
    ("substring_dedup", repeated_passages),
    ("packing", packing),
]

#: Model fits, banding and tokenizers are beyond SQL; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``; each result is written as Parquet in the shared folder."""
    docs = read_table(spark, sf_dir, "documents")
    base = os.path.join(ensure_checkpoint_dir(spark), "corpus-pipeline", uuid.uuid4().hex)
    for name, stage in STAGES:
        path = os.path.join(base, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
