"""Queries: n-grams, splits, vocabulary, TF-IDF, relational Naive Bayes and metrics
(inventory 2.9-2.12, the SQL-checkable part)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as TX
from ..functions.fixed import CLASSIC_EMOJIS, CLASSIC_STOPWORDS, DEFAULT_ABBREVIATIONS
from ..operators import features as FE
from ..operators import metrics as M
from ..sources import tweets as SRC
from ..sources.tables import read_table
from . import sqltext as S
from .catalog import register
from .classic_job import MAX_FEATURES, classic_corpus, classic_job

JOB = S.classic_job_ctes(DEFAULT_ABBREVIATIONS, CLASSIC_EMOJIS, CLASSIC_STOPWORDS, MAX_FEATURES)


@register(
    "hash_split",
    f"SELECT doc_id, {S.md5_bucket('doc_id')} AS bucket, {S.md5_bucket('doc_id')} < 90 AS is_train FROM documents",
)
def q_hash_split(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id")
    return FE.hash_split(docs, "doc_id", 90).select("doc_id", FE.hash_bucket("doc_id").alias("bucket"), "is_train")


@register(
    "ngrams_1_2",
    f"""{JOB}
SELECT doc_id, array_to_string(g, '|') AS grams, CAST(len(g) AS INTEGER) AS n_grams FROM (
  SELECT doc_id, words || CASE WHEN len(words) >= 2
         THEN list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1])
         ELSE []::VARCHAR[] END AS g FROM corpus)""",
)
def q_ngrams(spark, sf_dir):
    c = classic_corpus(spark, sf_dir)
    g = TX.ngrams_1_2("words")
    return c.select("doc_id", F.array_join(g, "|").alias("grams"), F.size(g).alias("n_grams"))


@register("tfidf_doc_freq", f"{JOB}\nSELECT term, df, cf FROM stats")
def q_doc_freq(spark, sf_dir):
    job = classic_job(spark, sf_dir)
    return FE.term_stats(job.tf.filter("is_train")).select("term", "df", "cf")


@register(
    "top_vocabulary",
    f"{JOB}\nSELECT term, df, cf, row_number() OVER (ORDER BY cf DESC, term) AS rank FROM vocab",
)
def q_top_vocab(spark, sf_dir):
    job = classic_job(spark, sf_dir)
    return job.fit.vocab.select("term", "df", "cf", (F.col("idx") + 1).alias("rank"))


@register("tfidf", f"{JOB}\nSELECT doc_id, term, round(x, 6) AS weight FROM feat")
def q_tfidf(spark, sf_dir):
    job = classic_job(spark, sf_dir)
    return job.features.select("doc_id", "term", F.round("x", 6).alias("weight"))


def _nb_predictions(spark, sf_dir, kind, lam):
    job = classic_job(spark, sf_dir)
    model = job.naive_bayes(kind, lam)
    pred = job.predict(model)
    scores = [c for c in pred.columns if c.startswith("score_")]
    return pred.select("doc_id", "label", "prediction", F.greatest(*scores).alias("score"))


def _nb_sql(kind, lam):
    return f"{JOB},\n{S.nb_sql(kind, lam)}"


@register("nb_multinomial", _nb_sql("multinomial", 1.0) + "\nSELECT doc_id, label, prediction, round(score, 6) AS score FROM pred")
def q_nb_multinomial(spark, sf_dir):
    p = _nb_predictions(spark, sf_dir, "multinomial", 1.0)
    return p.select("doc_id", "label", "prediction", F.round("score", 6).alias("score"))


@register("nb_bernoulli", _nb_sql("bernoulli", 2.0) + "\nSELECT doc_id, label, prediction, round(score, 6) AS score FROM pred")
def q_nb_bernoulli(spark, sf_dir):
    p = _nb_predictions(spark, sf_dir, "bernoulli", 2.0)
    return p.select("doc_id", "label", "prediction", F.round("score", 6).alias("score"))


METRICS_SQL = _nb_sql("multinomial", 1.0) + ",\n" + S.metrics_ctes()


def _summary(spark, sf_dir):
    return M.summary_metrics(_nb_predictions(spark, sf_dir, "multinomial", 1.0))


def _metric_query(name, sql_expr):
    def run(spark, sf_dir):
        return _summary(spark, sf_dir).select(F.round(name, 6).alias(name))

    run.__name__ = name
    register(name, f"{METRICS_SQL}\nSELECT round({sql_expr}, 6) AS {name} FROM prf")(run)


_metric_query("accuracy", "sum(tp) / sum(support)")
_metric_query("weighted_precision", "sum(precision * support) / sum(support)")
_metric_query("weighted_recall", "sum(recall * support) / sum(support)")
_metric_query("weighted_f1", "sum(f1 * support) / sum(support)")


@register(
    "classification_report",
    f"""{METRICS_SQL}
SELECT CAST(cls AS VARCHAR) AS row, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1,
       CAST(support AS BIGINT) AS support FROM prf
UNION ALL SELECT 'accuracy', NULL, NULL, round(sum(tp) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM prf
UNION ALL SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6), CAST(sum(support) AS BIGINT) FROM prf
UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support), 6), round(sum(recall * support) / sum(support), 6),
       round(sum(f1 * support) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM prf""",
)
def q_report(spark, sf_dir):
    r = M.classification_report(_nb_predictions(spark, sf_dir, "multinomial", 1.0))
    return r.select("row", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")], "support")


@register(
    "confusion_matrix",
    f"""{METRICS_SQL},
cl AS (SELECT label AS c FROM pairs UNION SELECT prediction FROM pairs),
grid AS (SELECT a.c AS label, b.c AS prediction FROM cl a CROSS JOIN cl b)
SELECT g.label, g.prediction, CAST(coalesce(p.n, 0) AS BIGINT) AS n,
       round(coalesce(p.n, 0) / (SELECT sum(n) FROM pairs), 6) AS pct
FROM grid g LEFT JOIN pairs p ON p.label = g.label AND p.prediction = g.prediction""",
)
def q_confusion(spark, sf_dir):
    cm = M.confusion_matrix(_nb_predictions(spark, sf_dir, "multinomial", 1.0))
    return cm.select("label", "prediction", "n", F.round("pct", 6).alias("pct"))


@register(
    "confusion_cells",
    f"""{METRICS_SQL}
SELECT cls, CAST(sum(support) OVER () - support - fp AS BIGINT) AS true_neg, CAST(fp AS BIGINT) AS false_pos,
       CAST(support - tp AS BIGINT) AS false_neg, CAST(tp AS BIGINT) AS true_pos FROM prf""",
)
def q_confusion_cells(spark, sf_dir):
    return M.confusion_cells(_nb_predictions(spark, sf_dir, "multinomial", 1.0))


TIE_K = 40


@register(
    "top_vocabulary_small",
    f"{S.classic_job_ctes(DEFAULT_ABBREVIATIONS, CLASSIC_EMOJIS, CLASSIC_STOPWORDS, TIE_K)}\n"
    "SELECT term, df, cf, row_number() OVER (ORDER BY cf DESC, term) AS rank FROM vocab",
)
def q_top_vocab_small(spark, sf_dir):
    """The same cut at a small k, where it does drop terms."""
    job = classic_job(spark, sf_dir, TIE_K)
    return job.fit.vocab.select("term", "df", "cf", (F.col("idx") + 1).alias("rank"))
