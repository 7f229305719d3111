"""Word rules over the dictionary, in place and by the join; lemmas; the replacement automaton; the tagger."""

import itertools
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from moodlens.functions.automaton import Fold
from moodlens.functions.lexicon import lexicon_frame, ordered_replace
from moodlens.functions.porter import stem
from moodlens.operators import lexicon_ops as LX
from moodlens.operators import tagger as TG
from moodlens.operators import vocabulary as V

ROWS = [(1, ["cats", "run", None, "runs", "cats"]), (2, []), (3, None), (4, ["x"]), (4, ["runs", "boxes"]), (None, ["cats"])]


def _frame(spark):
    return spark.createDataFrame(ROWS, "id long, t array<string>").repartition(3)


def _sorted(rows):
    return sorted(rows, key=repr)


@pytest.mark.parametrize("max_rows", [0, 10_000])
def test_replace_tokens_in_place_and_by_join(spark, max_rows):
    d = spark.createDataFrame([("cats", ["the", "cat"]), ("x", []), ("runs", ["run"]), ("never", ["y"])], "word string, out array<string>")
    got = V.replace_tokens(_frame(spark), "t", d, max_rows=max_rows).collect()
    table = {"cats": ["the", "cat"], "x": [], "runs": ["run"]}
    want = [(i, None if t is None else [o for w in t for o in table.get(w, [w])]) for i, t in ROWS]
    assert _sorted(map(tuple, got)) == _sorted(want)


def test_replaced_keeps_slices_and_nulls():
    t = pa.array([["a", "b"], None, [], ["b", None, "z"], ["q"]])
    table = {"a": ("1", "2"), "b": (), "z": ("y",)}
    assert V.replaced(t, table).to_pylist() == [["1", "2"], None, [], [None, "y"], ["q"]]
    assert V.replaced(t.slice(3), table).to_pylist() == [[None, "y"], ["q"]]
    assert V.replaced(t.slice(0, 0), table).to_pylist() == []


@pytest.mark.parametrize("max_rows", [0, 10_000])
def test_each_distinct_word_is_stemmed_once(spark, max_rows):
    rnd = random.Random(2)
    words = ["running", "ponies", "relational", "cats", "a", "sky", "generalizations"]
    rows = [(i, rnd.choices(words, k=rnd.randint(0, 30))) for i in range(200)]
    df = spark.createDataFrame(rows, "id long, t array<string>").repartition(6)
    calls = spark.sparkContext.accumulator(0)

    def counted(w):
        calls.add(1)
        return stem(w)

    got = {r["id"]: r["t"] for r in V.apply_word_rule(df, "t", counted, max_rows=max_rows).collect()}
    assert got == {i: [stem(w) for w in t] for i, t in rows}
    assert calls.value == len(words)


def test_an_expression_as_rule(spark):
    got = V.apply_word_rule(_frame(spark), "t", expression=lambda w: F.regexp_replace(w, "s$", "")).where("id = 1").first()
    assert got["t"] == ["cat", "run", None, "run", "cat"]


def test_numbered_words(spark):
    words = V.distinct_words(_frame(spark), "t")
    assert {r["word"]: r["id"] for r in V.numbered_words(words).collect()} == {"boxes": 0, "cats": 1, "run": 2, "runs": 3, "x": 4}


def test_noun_lemmas(spark):
    words = spark.createDataFrame([(w,) for w in "cats cat boxes box ponies pony women woman glass glas s buses geese wolves wolf churches church dogs ies".split()], "word string")
    exceptions = lexicon_frame(spark, [("geese", "goose"), ("cats", "feline"), ("unseen", "z")])
    got = {r["word"]: r["lemma"] for r in V.noun_lemmas(words, exceptions).collect()}
    assert got == {"cats": "feline", "boxes": "box", "ponies": "pony", "women": "woman", "glass": "glas", "geese": "goose", "wolves": "wolf", "churches": "church"}
    nouns = spark.createDataFrame([("dog",), ("bus",)], "word string")
    got = {r["word"]: r["lemma"] for r in V.noun_lemmas(words, None, nouns).collect()}
    assert got == {"dogs": "dog", "buses": "bus"}


@pytest.mark.parametrize("max_rows", [0, 10_000])
def test_lexicon_forms(spark, max_rows):
    df = _frame(spark)
    lex = lexicon_frame(spark, [("cats", "many cats"), ("runs", "jog"), ("cats", "two cats"), ("x", " ")])
    got = _sorted(tuple(r) for r in LX.lexicon_lookup_join(df, "id", "t", lex, max_rows=max_rows).collect())
    assert got == _sorted([(1, ["two", "cats", "run", None, "jog", "two", "cats"]), (2, []), (3, []), (4, []), (4, ["jog", "boxes"]), (None, ["two", "cats"])])
    tags = lexicon_frame(spark, [("cats", "NN"), ("run", "VB"), ("runs", "DT")])
    keep = _sorted(tuple(r) for r in LX.tag_filter_join(df, "id", "t", tags, max_rows=max_rows).collect())
    assert keep == _sorted([(1, ["cats", "run", None, "cats"]), (2, []), (3, []), (4, ["x"]), (4, ["boxes"]), (None, ["cats"])])
    only = _sorted(tuple(r) for r in LX.tag_filter_join(df, "id", "t", tags, default_tag="DT", max_rows=max_rows).collect())
    assert only == _sorted([(1, ["cats", "run", None, "cats"]), (2, []), (3, []), (4, []), (4, []), (None, ["cats"])])


# ------------------------------------------------------------------------- automaton


def _fold(text, pairs):
    for k, v in pairs:
        text = text.replace(k, v)
    return text


def test_automaton_equals_the_fold_on_random_lexicons():
    rnd = random.Random(0)
    for _ in range(3_000):
        keys = sorted({"".join(rnd.choices("ab:)", k=rnd.randint(1, 4))) for _ in range(rnd.randint(0, 12))})
        rnd.shuffle(keys)
        pairs = [(k, "".join(rnd.choices("ab:) ", k=rnd.randint(0, 4)))) for k in keys]
        text = "".join(rnd.choices("ab:) ", k=rnd.randint(0, 25)))
        assert Fold(pairs)(text) == _fold(text, pairs)


def _many_keys():
    """4 345 aliases, of which 221 are shadowed by a shorter key that comes first."""
    pairs = [(f":name_{i}:", chr(0x1F300 + i % 900)) for i in range(4_124)]
    return pairs + [(f":name_{i}::", f"<{i}>") for i in range(221)]


def test_many_keys_and_shadowed_ones(spark):
    pairs = _many_keys()
    rnd = random.Random(1)
    texts = [None, "", "plain text", ":name_5::", ":name_1", "::name_7:::name_8::"] + ["".join(rnd.choice([":name_%d:" % rnd.randrange(4_200), ":", "word ", "name_3:"]) for _ in range(12)) for _ in range(60)]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = {r["i"]: r["o"] for r in df.select("i", ordered_replace("t", pairs).alias("o")).collect()}
    assert got == {i: None if t is None else _fold(t, pairs) for i, t in enumerate(texts)}


def test_the_number_of_keys_does_not_count():
    text = "a text with :name_17: in it " * 50
    reads = []
    for pairs in (_many_keys()[:100], _many_keys()):
        fold = Fold(pairs)
        first, n = fold.first, [0]

        def counted(*a):
            n[0] += 1
            return first(*a)

        fold.first = counted
        assert fold(text) == _fold(text, pairs)
        reads.append(n[0])
    assert reads == [2, 2]


# ---------------------------------------------------------------------------- tagger


def _all_paths(tagger, costs):
    """The cheapest path; of equal ones the one whose tags, read from the end, come first."""
    k = len(tagger.tags)
    paths = [tuple(reversed(p)) for p in itertools.product(range(k), repeat=len(costs))]

    def total(p):
        return tagger.start[p[0]] + sum(int(costs[i][t]) for i, t in enumerate(p)) + sum(int(tagger.step[a][b]) for a, b in zip(p, p[1:]))

    return min(paths, key=lambda p: (total(p), p[::-1]))


TAGGED = [(["the", "dog", "runs"], ["D", "N", "V"]), (["a", "walk", "helps"], ["D", "N", "V"]), (["dogs", "walk"], ["N", "V"]), (["the", "old", "dog"], ["D", "J", "N"]), ([], [])]


def test_paths_equal_all_paths(spark):
    df = spark.createDataFrame(TAGGED, "t array<string>, tags array<string>")
    tagger = TG.fit_tagger(TG.tagged(df, "t", "tags"))
    assert tagger.tags == ["D", "J", "N", "V"]
    rng = np.random.default_rng(0)
    for _ in range(60):
        costs = rng.integers(0, 4, (rng.integers(1, 6), 4)) * 500_000
        assert tuple(tagger.path(costs)) == _all_paths(tagger, costs)
    known = {r["word"]: np.array(r["costs"]) for r in tagger.words.collect()}
    rows = [(1, ["the", "walk", "runs"]), (2, ["dogs", "walk"]), (3, ["the", "zzz", "barks"]), (4, []), (5, None)]
    got = {r["i"]: r["tags"] for r in tagger.transform(spark.createDataFrame(rows, "i int, t array<string>"), "t").collect()}
    for i, t in rows:
        if t:
            costs = [known[w] if w in known else tagger.unknown(w) for w in t]
            assert got[i] == [tagger.tags[x] for x in _all_paths(tagger, costs)]
    # The same word, a noun after an article and a verb after a noun.
    assert got[1][1] == "N" and got[2][1] == "V" and got[4] == [] and got[5] is None


def test_joined_costs_give_the_same_tags(spark, monkeypatch):
    df = spark.createDataFrame(TAGGED + [(None, None), (["walk", None, "xyz"], ["N", "V", "N"])], "t array<string>, tags array<string>").select("t")
    lex = lexicon_frame(spark, [("the", "D"), ("dog", "N"), ("runs", "V"), ("walk", "V"), ("walk", "N"), ("old", "J")])
    tagger = TG.fit_tagger(TG.lexicon_tagged(df, "t", lex))
    want = _sorted(map(tuple, tagger.transform(df, "t").collect()))
    monkeypatch.setattr(TG, "MAX_SENT_ROWS", 0)
    assert _sorted(map(tuple, tagger.transform(df, "t").collect())) == want


def test_unknown_words_go_by_their_ending(spark):
    rows = [(["slowly", "badly", "gladly", "cat", "hat", "mat"], ["R", "R", "R", "N", "N", "N"])]
    tagger = TG.fit_tagger(TG.tagged(spark.createDataFrame(rows, "t array<string>, tags array<string>"), "t", "tags"))
    got = tagger.transform(spark.createDataFrame([(["nicely"],), (["flat"],)], "t array<string>"), "t").collect()
    assert [r["tags"] for r in got] == [["R"], ["N"]]


# ------------------------------------------------------- lexicons beyond a map literal


def test_cleaners_take_lexicons_of_any_size(spark):
    from moodlens.functions.lexicon import MAX_INLINE_MAP
    from moodlens.plans import classic, social

    many = [(f"zz{i}", f"word {i}") for i in range(MAX_INLINE_MAP + 1)]
    small = [("brb", "be right back"), ("lol", "laughing"), ("u", "you")]
    texts = ["LOL brb, u there? zz17 http://x.org/a", None, "", "the zz20000 @ann nothing", "@a brb"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    few = small + [("zz17", "word 17"), ("zz20000", "word 20000")]
    tags = [("there", "DT"), ("word", "IN")]
    more_tags = tags + [(f"yy{i}", "DT") for i in range(MAX_INLINE_MAP)]

    def rows(frame):
        return sorted(map(repr, frame.collect()))

    for large in (small + many, lexicon_frame(spark, small + many)):
        for pos, large_pos in ((None, None), (tags, more_tags), (tags, lexicon_frame(spark, more_tags))):
            want = social.social_tokens_df(df, "t", "o", abbreviations=few, pos_lexicon=pos, keep=["id"])
            assert rows(social.social_tokens_df(df, "t", "o", abbreviations=large, pos_lexicon=large_pos, keep=["id"])) == rows(want)
        want = classic.clean_classic_df(df, "t", "o", keep=["id"], abbreviations=few, abbrev_mode="word", lemma_lexicon=few)
        assert rows(classic.clean_classic_df(df, "t", "o", keep=["id"], abbreviations=large, abbrev_mode="word", lemma_lexicon=large)) == rows(want)
    want = classic.clean_classic_df(df, "t", "o", keep=["id"], abbreviations=few, abbrev_mode="word")
    assert classic.clean_classic_df(df, "t", "o", keep=["id"], abbreviations=small + many, abbrev_mode="substring").count() == want.count()


def test_joined_dictionary_moves_chunks_not_tokens(spark, monkeypatch):
    monkeypatch.setattr(V, "CHUNK_TOKENS", 3)
    df = spark.createDataFrame(ROWS * 3, "id long, t array<string>").repartition(2)
    d = spark.createDataFrame([("cats", ["the", "cat"]), ("x", [])], "word string, out array<string>")
    got = V.replace_tokens(df, "t", d, max_rows=0)
    assert "posexplode" not in got._jdf.queryExecution().optimizedPlan().toString()
    table = {"cats": ["the", "cat"], "x": []}
    want = [(i, None if t is None else [o for w in t for o in table.get(w, [w])]) for i, t in ROWS * 3]
    assert _sorted(map(tuple, got.collect())) == _sorted(want)
