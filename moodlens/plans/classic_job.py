"""The classic workload end to end: cleaned corpus → hash split → TF-IDF (fit on train) →
Naive Bayes (relational) → metrics.  Every step is a DataFrame; nothing passes through the driver
except scalars (document count, vocabulary size, per-class constants)."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.labels import label_replace
from ..functions.text import keep_where
from ..session import materialize
from ..operators import features as FE
from ..operators import sizing
from ..operators.naive_bayes import NaiveBayesModel, fit_naive_bayes
from ..sources import tweets as SRC
from . import classic

MAX_FEATURES = 500_000
TRAIN_PCT = 90


def classic_corpus(spark: SparkSession, sf_dir: str, train_pct: int = TRAIN_PCT) -> DataFrame:
    """``(doc_id, label, text, words, is_train)`` for labelled documents whose cleaned text is not empty."""
    v = SRC.labelled_tweets(spark, sf_dir).select(
        F.col("TweetID").alias("doc_id"), label_replace("Polarity").cast("int").alias("label"), "TweetText"
    )
    cleaned = classic.clean_classic_df(v, "TweetText", "text", keep=["doc_id", "label"])
    cleaned = keep_where(cleaned, F.length("text") > 0).withColumn("words", F.split("text", " "))
    return FE.hash_split(cleaned, "doc_id", train_pct)


@dataclass
class ClassicJob:
    corpus: DataFrame
    tf: DataFrame
    fit: FE.TfidfFit

    @cached_property
    def features(self) -> DataFrame:
        """``(doc_id, term, idx, is_train, label, x)``, written on first use: counts and vocabulary do not need it."""
        w = self.fit.transform(self.tf)
        return materialize(w.select("doc_id", "term", F.col("idx").cast("int").alias("idx"), "is_train", "label", F.col("weight").alias("x")))

    @cached_property
    def rows(self) -> DataFrame:
        """``(doc_id, label, is_train, ids, x)``: a sparse row per document, also of one without known terms."""
        docs = self.corpus.select("doc_id", "label", "is_train")
        return materialize(FE.sparse_rows(self.features, docs))

    @cached_property
    def n_terms(self) -> int:
        return self.fit.vocab_size()

    def train_rows(self) -> DataFrame:
        return self._sized(self.rows.filter("is_train"))

    def test_rows(self) -> DataFrame:
        return self._sized(self.rows.filter("not is_train"))

    def _sized(self, rows: DataFrame) -> DataFrame:
        """About 12 bytes per non-zero; an iterative fit runs a job per pass, so small inputs get few tasks."""
        if "_bytes" not in self.__dict__:
            self._bytes = int(self.rows.agg(F.sum(F.size("ids") * 12 + 64).alias("b")).first()["b"] or 0)
        return sizing.fit_partitions(rows.drop("is_train"), self._bytes, target=16 * 1024 * 1024)

    def train_docs(self) -> DataFrame:
        return self.corpus.filter("is_train").select("doc_id", "label")

    def test_docs(self) -> DataFrame:
        return self.corpus.filter("not is_train").select("doc_id", "label")

    def naive_bayes(self, kind: str = "multinomial", smoothing: float = 1.0) -> NaiveBayesModel:
        train = self.features.filter("is_train").select("doc_id", "term", "label", "x")
        return fit_naive_bayes(train, self.train_docs(), "label", kind, smoothing,
                               vocab_size=self.fit.vocab_size(), bounded=self.fit.bounded)

    def predict(self, model: NaiveBayesModel) -> DataFrame:
        test = self.features.filter("not is_train").select("doc_id", "term", "x")
        return model.transform(test, self.test_docs())


def classic_job(spark: SparkSession, sf_dir: str, max_features: int | None = MAX_FEATURES) -> ClassicJob:
    # The fit reads the corpus and the features several times (counts, statistics, scoring): cut
    # lineage once each, in the session's checkpoint folder, so neither the cleaning nor the
    # TF-IDF joins are recomputed, and a lost executor does not replay them.
    corpus = materialize(classic_corpus(spark, sf_dir))
    # (doc, term) counts feed the term statistics and the features.
    tf = materialize(FE.doc_terms(corpus, "doc_id", "words", extra=("is_train", "label")))
    # A cleaned text is never empty, so every training document holds a term.
    return ClassicJob(corpus, tf, FE.TfidfFit(tf, max_features, corpus.filter("is_train").count()))
