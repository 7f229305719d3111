"""Model invariants (FIXTURES §5): relational NB equals pyspark.ml NaiveBayes, metrics equal the
ML evaluator, probabilities are distributions, Word2Vec has 100 dimensions, results do not depend
on the number of input partitions."""

import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from moodlens.operators import metrics as M
from moodlens.operators import ml as ML
from moodlens.plans.classic_job import classic_job

from .conftest import SF_MID


@pytest.fixture(scope="module")
def job(spark):
    return classic_job(spark, SF_MID)


@pytest.mark.parametrize("kind,lam", [("multinomial", 1.0), ("bernoulli", 2.0)])
def test_relational_nb_equals_ml_nb(spark, job, kind, lam):
    rel = job.predict(job.naive_bayes(kind, lam)).select("doc_id", F.col("prediction").alias("rel"))
    vec = ML.tfidf_vectors(job.corpus, job.fit.idf).withColumn("label", F.col("label").cast("double"))
    if kind == "bernoulli":
        from pyspark.ml.feature import Binarizer

        vec = Binarizer(threshold=0.0, inputCol="features", outputCol="bin").transform(vec).drop("features").withColumnRenamed("bin", "features")
    model = ML.naive_bayes(kind, lam).fit(vec.filter("is_train"))
    ml = model.transform(vec.filter("not is_train")).select("doc_id", F.col("prediction").alias("ml"))
    both = rel.join(ml, "doc_id").collect()
    assert len(both) == job.test_docs().count() > 0
    assert all(r["rel"] == r["ml"] for r in both)


def test_metrics_equal_evaluator(spark, job):
    pred = job.predict(job.naive_bayes("multinomial", 1.0)).withColumn("label", F.col("label").cast("double"))
    ours = M.summary_metrics(pred).collect()[0]
    for ours_name, spark_name in [("accuracy", "accuracy"), ("weighted_precision", "weightedPrecision"),
                                  ("weighted_recall", "weightedRecall"), ("weighted_f1", "f1")]:
        ev = MulticlassClassificationEvaluator(metricName=spark_name, labelCol="label", predictionCol="prediction")
        assert ours[ours_name] == pytest.approx(ev.evaluate(pred), abs=1e-12), ours_name


def test_confusion_matrix_totals(spark, job):
    pred = job.predict(job.naive_bayes("multinomial", 1.0))
    cm = M.confusion_matrix(pred).collect()
    n_classes = len({r["label"] for r in cm})
    assert len(cm) == n_classes * n_classes
    assert sum(r["n"] for r in cm) == pred.count()
    assert sum(r["pct"] for r in cm) == pytest.approx(1.0)


def test_mlp_probabilities_and_w2v_dims(spark):
    import __spark_entry__ as E

    pred = E.queries()["mlp_binary"](spark, "/root/testdata/sf0.001")
    rows = pred.collect()
    assert rows
    for r in rows:
        assert sum(r["probability"]) == pytest.approx(1.0, abs=1e-6)
        assert r["prediction"] == float(max(range(2), key=lambda i: r["probability"][i]))
    emb = E.queries()["word2vec_embed"](spark, "/root/testdata/sf0.001").select("dims").distinct().collect()
    assert [r["dims"] for r in emb] == [100]


def test_partition_independence(spark):
    """hash_split + TF-IDF + NB give the same predictions whatever the input partitioning."""
    from moodlens.sources import tweets as SRC

    base = job_predictions(spark)
    orig = SRC.tweet_view

    def repartitioned(spark_, sf_dir, decorate=True):
        return orig(spark_, sf_dir, decorate).repartition(3)

    SRC.tweet_view = repartitioned
    try:
        again = job_predictions(spark)
    finally:
        SRC.tweet_view = orig
    assert base == again


def job_predictions(spark):
    j = classic_job(spark, "/root/testdata/sf0.001")
    p = j.predict(j.naive_bayes("multinomial", 1.0))
    return sorted((r["doc_id"], r["prediction"], round(r["score_1"], 9)) for r in p.collect())


def test_vector_tfidf_equals_relational(spark, job):
    model = ML.tfidf_vectorizer(job.fit.idf)
    vec = ML.tfidf_vectors(job.corpus, job.fit.idf, model=model)
    terms = model.stages[0].vocabulary
    assert sorted(terms) == sorted(r["term"] for r in job.fit.idf.select("term").collect())
    dense = vec.select("doc_id", vector_to_array("features").alias("v")).collect()
    by_doc = {r["doc_id"]: r["v"] for r in dense}
    rel = job.features.collect()
    index = {t: i for i, t in enumerate(terms)}
    for r in rel[:2000]:
        assert by_doc[r["doc_id"]][index[r["term"]]] == pytest.approx(r["x"], rel=1e-9)
