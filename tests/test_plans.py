"""Plans and scans: no needless join, splittable CSV, malformed rows."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from moodlens.functions.labels import label_binary
from moodlens.operators import lexicon_ops as LX
from moodlens.operators import metrics as M
from moodlens.functions.lexicon import lexicon_frame
from moodlens.session import ensure_checkpoint_dir
from moodlens.sources import tweets as SRC

from .conftest import SF_SMALL

TEXT_ONLY = (
    "lower_strip replace_url replace_url_padded html_unescape expand_abbrev_words expand_abbrev_tokens expand_abbrev_substring remove_unicode "
    "emoticon_to_words emoji_to_words_padded replace_mention replace_mention_padded remove_stopwords strip_hashtag collapse_exclaim collapse_question "
    "collapse_stop collapse_repeats expand_contractions keep_alnum clean_social_text clean_social clean_classic clean_classic_wordwise tokenize_ws "
    "tokenize_regex min_length_filter pos_filter lemmatize_vocabulary lexicon_lookup stopword_anti emojize demojize stem_vocabulary filter_having_dups"
).split()


@pytest.mark.parametrize("name", TEXT_ONLY)
def test_text_queries_do_not_read_labels(spark, name):
    plan = E.queries()[name](spark, SF_SMALL)._jdf.queryExecution().toString()
    assert "labels.parquet" not in plan and "SortMergeJoin LeftOuter" not in plan


def test_csv_is_split(spark, tmp_path):
    path = str(tmp_path / "t.csv")
    spark.range(20_000).selectExpr("4", "id", "'d'", "'q'", "'u'", "concat('text of some length ', id)").coalesce(1).write.csv(path)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200k")
    try:
        df = SRC.scan_tweets_csv(spark, path, positional=False)
        assert df.rdd.getNumPartitions() > 1
        assert df.count() == 20_000 and df.columns == ["Polarity", "TweetID", "Date", "QueryFlag", "User", "TweetText"]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_malformed_rows_get_no_label(spark, tmp_path):
    path = tmp_path / "bad.csv"
    path.write_text('4,1,d,q,u,good\nbad,2,d,q,u,text\n0,3\n0,4,d,q,u,"a, b"\n')
    df = SRC.scan_tweets_csv(spark, str(path), positional=False, with_corrupt=True).cache()
    assert SRC.malformed_count(df).first() == (4, 2)
    got = {r.TweetID: r.label for r in df.select("TweetID", SRC.sound_only(label_binary("Polarity")).alias("label")).collect()}
    assert got[1] == 1.0 and got[4] == 0.0 and sorted(map(str, got.values())) == ["0.0", "1.0", "None", "None"]


def test_gather_keeps_rows_that_share_an_id(spark):
    df = spark.createDataFrame([(1, ["a", "b"]), (1, ["c", "d"]), (2, []), (3, None), (4, ["b"])], "id int, t array<string>")
    lex = lexicon_frame(spark, [("b", "x y")])
    got = sorted((r.id, r.tokens) for r in LX.lexicon_lookup_join(df, "id", "t", lex).collect())
    assert got == [(1, ["a", "x", "y"]), (1, ["c", "d"]), (2, []), (3, []), (4, ["x", "y"])]
    stop = spark.createDataFrame([("b",), ("c",)], "word string")
    got = sorted((r.id, r.tokens) for r in LX.stopword_anti_join(df, "id", "t", stop).collect())
    assert got == [(1, ["a"]), (1, ["d"]), (2, []), (3, []), (4, [])]


def test_metrics_scan_the_predictions_once(spark, tmp_path):
    path = str(tmp_path / "p")
    spark.range(100).select((F.col("id") % 2).alias("label"), (F.col("id") % 3).alias("prediction")).write.parquet(path)
    plan = M.summary_metrics(spark.read.parquet(path))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1


def test_shared_folder_is_required_on_a_cluster(spark, monkeypatch):
    class Context:
        master = "spark://host:7077"

        def getConf(self):
            return self

        def get(self, key, default=None):
            return default

        def setCheckpointDir(self, path):
            raise AssertionError

    class Session:
        conf, sparkContext = Context(), Context()

    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(Session())


def test_long_fold_equals_chain(spark):
    from moodlens.functions.lexicon import ordered_replace

    pairs = [(f":k{i}:", f"<{i}>") for i in range(5_000)] + [("<7>", "seven")]
    df = spark.createDataFrame([(":k7: and :k4999: k",), ("plain",), (None,)], "t string")
    assert [r.o for r in df.select(ordered_replace(F.col("t"), pairs).alias("o")).collect()] == ["seven and <4999> k", "plain", None]
