"""Queries fitted with ``pyspark.ml`` (rows-only checks: floating-point training results) and the
argmax scalar (SQL)."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from ..functions import text as TX
from ..functions.fixed import CLASSIC_EMOJIS, CLASSIC_STOPWORDS, DEFAULT_ABBREVIATIONS, DEFAULT_POS_TAGS
from ..functions.labels import label_binary, label_ternary
from ..functions.porter import stem
from ..operators import features as FE
from ..operators import forest as RF
from ..operators import incremental as INC
from ..operators import linear as LIN
from ..operators import metrics as M
from ..operators import ml as ML
from ..operators import sizing
from ..operators.vocabulary import apply_word_rule
from ..session import materialize
from ..sources import tweets as SRC
from ..sources.tables import read_table
from . import social
from . import sqltext as S
from .catalog import register
from .classic_job import MAX_FEATURES, classic_job
from .q_model import _nb_sql


@register(
    "argmax_label",
    "SELECT vec_id, label, CAST(list_position(embedding, list_max(embedding)) - 1 AS INTEGER) AS argmax FROM embeddings",
)
def q_argmax(spark, sf_dir):
    e = read_table(spark, sf_dir, "embeddings")
    return e.select("vec_id", "label", TX.argmax_index("embedding").alias("argmax"))


def _main_frame(spark, sf_dir, *keep):
    """Ternary-model input: labelled tweets, Tokenizer + StopWordsRemover, ternary label; the columns that are read later."""
    v = SRC.labelled_tweets(spark, sf_dir).select("TweetID", "TweetText", label_ternary("Polarity").alias("label"))
    stages = ML.tokens_stopwords_stages("TweetText")
    return Pipeline(stages=stages).fit(v).transform(v).select("TweetID", *keep, "label", "filtered_words")


def _social_frame(spark, sf_dir):
    """Binary-model input: social tokens with the tag filter (those of ``clean_social_tagged``), stemmed, binary label."""
    v = SRC.labelled_tweets(spark, sf_dir).select("TweetID", "TweetText", label_binary("Polarity").alias("label"))
    t = social.social_tokens_df(v, "TweetText", "tokens_cleaned", pos_lexicon=DEFAULT_POS_TAGS, keep=["TweetID", "label"])
    return apply_word_rule(materialize(t), "tokens_cleaned", stem)


@register("word2vec_embed")
def q_word2vec(spark, sf_dir):
    """Mean Word2Vec vector (100 dims, minCount 5) of each cleaned tweet, as an array."""
    t = _fit_frame(_social_frame(spark, sf_dir))
    model = FE.word2vec_embed(t, "tokens_cleaned", "features", num_partitions=_w2v_partitions(t, "tokens_cleaned"))
    out = model.transform(t)
    return out.select("TweetID", F.size(ML.vector_to_array("features")).alias("dims"),
                      ML.vector_to_array("features").alias("features"))


@register("random_split")
def q_random_split(spark, sf_dir):
    """``randomSplit([0.8, 0.2], 24)`` of the labelled tweets, tagged (depends on partitioning)."""
    v = SRC.labelled_tweets(spark, sf_dir).select("TweetID")
    train, test = FE.random_split(v, (0.8, 0.2), 24)
    return train.withColumn("split", F.lit("train")).unionByName(test.withColumn("split", F.lit("test")))


def _fit_frame(frame):
    """Materialize a model input and size its partitions to its bytes (see ``sizing.fit_partitions``)."""
    frame = materialize(frame)
    return sizing.fit_partitions(frame, sizing.total_bytes(frame), FIT_BYTES)


#: Tokens are some three times their vectors: about 2 MB of those in a task of the perceptron's passes.
FIT_BYTES = 5 * 1024 * 1024

# Word2Vec trains one model per partition and averages them; the scripts used one partition, which
# cannot scale.  Their number follows the words, so that the result does not depend on the cluster; it is
# bounded, as each partition sends the vectors of all its words.
W2V_PARTITIONS, W2V_MOST, W2V_WORDS = 8, 24, 1_000_000


def _w2v_partitions(frame, tokens_col):
    words = frame.agg(F.sum(F.size(tokens_col))).first()[0] or 0
    return min(W2V_MOST, max(W2V_PARTITIONS, -(-words // W2V_WORDS)))


def _fit_predict(pipeline, frame, weights):
    """Fit on ``weights[0]`` of the rows by the hash of their id: the split does not depend on partitions."""
    split = FE.hash_split(frame, "TweetID", round(100 * weights[0]))
    model = pipeline.fit(split.filter("is_train"))
    return model, model.transform(split.filter("not is_train")).drop("is_train")


@register("mlp_ternary")
def q_mlp_ternary(spark, sf_dir):
    """Word2Vec + MLP [100, 64, 32, 3], 70/30 hash split."""
    frame = _fit_frame(_main_frame(spark, sf_dir))
    _, pred = _fit_predict(ML.w2v_mlp("filtered_words", 3, w2v_partitions=_w2v_partitions(frame, "filtered_words")), frame, (0.7, 0.3))
    return ML.probability_columns(pred).select("TweetID", "label", "probability", "prediction")


@register("mlp_binary")
def q_mlp_binary(spark, sf_dir):
    """Social tokens + Word2Vec + MLP [100, 64, 32, 2], 80/20 hash split."""
    frame = _fit_frame(_social_frame(spark, sf_dir))
    _, pred = _fit_predict(ML.w2v_mlp("tokens_cleaned", 2, w2v_partitions=_w2v_partitions(frame, "tokens_cleaned")), frame, (0.8, 0.2))
    return ML.probability_columns(pred).select("TweetID", "label", "probability", "prediction")


@register("select_predictions")
def q_select_predictions(spark, sf_dir):
    """``TweetText, probability, prediction`` of the ternary model."""
    frame = _fit_frame(_main_frame(spark, sf_dir, "TweetText"))
    _, pred = _fit_predict(ML.w2v_mlp("filtered_words", 3, w2v_partitions=_w2v_partitions(frame, "filtered_words")), frame, (0.7, 0.3))
    return ML.probability_columns(pred).select("TweetText", "probability", "prediction")


@register("mlp_metrics")
def q_mlp_metrics(spark, sf_dir):
    """Accuracy and weighted precision/recall/F1 of the binary MLP, in one aggregate."""
    frame = _fit_frame(_social_frame(spark, sf_dir))
    _, pred = _fit_predict(ML.w2v_mlp("tokens_cleaned", 2, w2v_partitions=_w2v_partitions(frame, "tokens_cleaned")), frame, (0.8, 0.2))
    return M.summary_metrics(pred)


@register("nb_on_embeddings")
def q_nb_embeddings(spark, sf_dir):
    """Word2Vec → Gaussian NB, 80/20 split (the NB script, made runnable)."""
    frame = _fit_frame(_social_frame(spark, sf_dir))
    _, pred = _fit_predict(ML.nb_on_embeddings("tokens_cleaned", w2v_partitions=_w2v_partitions(frame, "tokens_cleaned")), frame, (0.8, 0.2))
    return pred.select("TweetID", "label", "prediction")


@register("predict", _nb_sql("multinomial", 1.0) + "\nSELECT doc_id, CAST(label AS DOUBLE) AS label, prediction FROM pred")
def q_predict(spark, sf_dir):
    """``pyspark.ml`` multinomial NaiveBayes on the TF-IDF vectors, scored on the held-out rows."""
    job = classic_job(spark, sf_dir)
    train, test = (ML.sparse_vectors(r.withColumn("label", F.col("label").cast("double")), job.n_terms) for r in (job.train_rows(), job.test_rows()))
    model = ML.naive_bayes("multinomial", 1.0).fit(train)
    return model.transform(test).select("doc_id", "label", "prediction")


#: Gradient norm at which the SVM stops, as a share of the zero model's; its objective is then right to three digits.
SVM_TOL = 1e-3


def _held_out(pred):
    return pred.select("doc_id", F.col("label").cast("double").alias("label"), "prediction")


@register("logistic_regression")
def q_lr(spark, sf_dir):
    """Multinomial logistic regression, C = 2, to a gradient tolerance; 90/10 hash split."""
    job = classic_job(spark, sf_dir)
    return _held_out(LIN.fit_linear(job.train_rows(), job.n_terms, "softmax", c=2.0).transform(job.test_rows()))


@register("fit_history")
def q_fit_history(spark, sf_dir):
    """Objective and gradient norm of the logistic regression after each Newton step, with the passes so far."""
    job = classic_job(spark, sf_dir)
    model = LIN.fit_linear(job.train_rows(), job.n_terms, "softmax", c=2.0)
    return spark.createDataFrame(model.history, "iteration int, objective double, gradient_norm double, passes int")


_FOREST_JOB = S.classic_job_ctes(DEFAULT_ABBREVIATIONS, CLASSIC_EMOJIS, CLASSIC_STOPWORDS, MAX_FEATURES) + ",\n"


@register("random_forest", _FOREST_JOB + S.forest_ctes() + "\nSELECT doc_id, CAST(label AS DOUBLE) AS label, CAST(prediction AS DOUBLE) AS prediction, round(score, 6) AS score FROM pred")
def q_rf(spark, sf_dir):
    """2 trees of depth 5 on the full vocabulary, from sparse histograms."""
    job = classic_job(spark, sf_dir)
    forest = RF.fit_forest(job.train_rows(), job.n_terms)
    pred = forest.transform(RF.binned(job.test_rows(), "doc_id", "label"))
    score = F.round(F.array_max("probability"), 6).alias("score")
    return pred.select("doc_id", F.col("label").cast("double").alias("label"), "prediction", score)


@register(
    "forest_first_split",
    _FOREST_JOB + S.forest_ctes(max_depth=1) + """
SELECT CAST(tree AS INTEGER) AS tree, CAST(idx AS INTEGER) AS idx, bin, CAST(right_rows AS BIGINT) AS right_rows, CAST(left_rows AS BIGINT) AS left_rows, round(score, 6) AS score FROM best1""",
)
def q_first_split(spark, sf_dir):
    """The root of each tree: the term and bin it splits on, the (weighted) documents right and left, the score."""
    job = classic_job(spark, sf_dir)
    forest = RF.fit_forest(job.train_rows(), job.n_terms, max_depth=1)
    rows = []
    for t in range(forest.num_trees):
        node, right, left = (forest.nodes[t, i].counts if i > 1 else forest.nodes[t, 1] for i in (1, 3, 2))
        score = sum(c * c for c in right) / sum(right) + sum(c * c for c in left) / sum(left)
        rows.append((t, *node.split, sum(right), sum(left), round(score, 6)))
    return spark.createDataFrame(rows, "tree int, idx int, bin int, right_rows long, left_rows long, score double")


@register("linear_svc")
def q_svc(spark, sf_dir):
    """Linear SVM, squared hinge, C = 1, one class against the rest, to a gradient tolerance."""
    job = classic_job(spark, sf_dir)
    return _held_out(LIN.fit_linear(job.train_rows(), job.n_terms, "squared_hinge", tol=SVM_TOL).transform(job.test_rows()))


@register("eval_curve")
def q_eval_curve(spark, sf_dir):
    """Training loss, validation loss and accuracy by step of one epoch in 15 batches."""
    job = classic_job(spark, sf_dir)
    return INC.IncrementalFit(job.train_rows(), job.n_terms).run().curve(job.test_rows())


@register("model_comparison")
def q_model_comparison(spark, sf_dir):
    """Accuracy per classifier on the same labels and held-out rows, best first."""
    job = classic_job(spark, sf_dir)
    train, test, n = job.train_rows(), job.test_rows(), job.n_terms
    preds = {
        "Multinomial Naive Bayes": job.predict(job.naive_bayes("multinomial", 1.0)),
        "Bernoulli Naive Bayes": job.predict(job.naive_bayes("bernoulli", 2.0)),
        "Logistic Regression": LIN.fit_linear(train, n, "softmax", c=2.0).transform(test),
        "Random Forest": RF.fit_forest(train, n).transform(RF.binned(test, "doc_id", "label")),
        "LinearSVC": LIN.fit_linear(train, n, "squared_hinge", tol=SVM_TOL).transform(test),
    }
    rows = [M.summary_metrics(p).select(F.lit(name).alias("classifier"), "accuracy") for name, p in preds.items()]
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out.orderBy(F.desc("accuracy"), "classifier")
