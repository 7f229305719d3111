"""Steps that work on whole batches give what the same steps give row by row."""

from collections import Counter

import numpy as np
import pyarrow as pa

from moodlens.llm import substring_dedup as SD
from moodlens.operators import features as FE
from moodlens.operators import linear as LIN
from moodlens.operators.tagger import Tagger
from moodlens.plans import q_ml as Q


def test_gram_counts_of_a_batch():
    rows = [["a", "b", "a", "b"], None, [], ["c"], ["b", "a"], ["x", "x", "x"], ["a", None, "b"]]
    row, term, tf = (x.to_pylist() for x in FE.gram_counts(pa.array(rows, pa.list_(pa.string())).slice(0)))
    want = Counter()
    for i, words in enumerate(rows):
        for w in words or []:
            want[i, w] += w is not None
        for u, v in zip(words or [], (words or [])[1:]):
            if u is not None and v is not None:
                want[i, f"{u} {v}"] += 1
    assert dict(zip(zip(row, term), tf)) == {k: n for k, n in want.items() if n}
    assert FE.gram_counts(pa.array([], pa.list_(pa.string())))[2].to_pylist() == []


def test_repeated_and_null_ids_keep_their_norms(spark):
    tf = spark.createDataFrame([(1, "a", 3), (1, "a", 4), (None, "a", 3), (None, "b", 4), (2, "b", 2)], "doc_id long, term string, tf long")
    idf = spark.createDataFrame([("a", 1, 1.0), ("b", 1, 1.0)], "term string, df long, idf double")
    got = {(r["doc_id"], r["term"], r["tf"]): round(r["weight"], 9) for r in FE.tfidf(tf, idf, True).collect()}
    assert got == {(1, "a", 3): 0.6, (1, "a", 4): 0.8, (None, "a", 3): 0.6, (None, "b", 4): 0.8, (2, "b", 2): 1.0}


def test_paths_of_many_rows_are_those_of_each():
    rng = np.random.default_rng(5)
    k = 4
    tagger = Tagger(list("wxyz"), rng.integers(0, 4, k), rng.integers(0, 4, (k, k)), {}, None)
    size = np.array([3, -1, 1, 0, 9, 9, 2])
    n = int(np.maximum(size, 0).sum())
    table = rng.integers(0, 3, (6, k))  # few values: many ties
    words = rng.integers(0, 6, n)
    got = tagger.tag_lists(words, size, table).to_pylist()
    at = 0
    for s, tags in zip(size, got):
        costs = table[words[at : at + max(s, 0)]]
        at += max(s, 0)
        if s < 1:
            assert tags == (None if s < 0 else [])
            continue
        total, came = tagger.start + costs[0], []
        for own in costs[1:]:
            by = total[:, None] + tagger.step
            came.append(by.argmin(axis=0))
            total = by.min(axis=0) + own
        path = [int(total.argmin())]
        for best in reversed(came):
            path.append(int(best[path[-1]]))
        assert tags == [tagger.tags[i] for i in reversed(path)]


def test_blocks_do_not_depend_on_the_rows_chosen_together(monkeypatch):
    rng = np.random.default_rng(3)
    names = rng.integers(0, 40, 5000).astype(np.uint64)
    off = np.concatenate([[0], np.sort(rng.integers(0, 5000, 30)), [5000]])
    whole = SD._chosen(names, off, 20)
    for words in (1, 300, 10**6):
        monkeypatch.setattr(SD.row_groups, "__defaults__", (words,))
        assert len(list(SD.row_groups(off))) > 1 or words == 10**6
        for x, y in zip(whole, SD.chosen_blocks(names, off, 20)):
            assert np.array_equal(x, y)


def test_packed_rows_give_the_same_pass(spark):
    rng = np.random.default_rng(1)
    data = [(int(rng.integers(0, 3)), sorted(rng.choice(50, n, replace=False).tolist()), rng.random(n).tolist()) for n in rng.integers(0, 9, 200).tolist()]
    rows = spark.createDataFrame(data, "y int, ids array<int>, x array<double>").coalesce(1)
    w, v = rng.random((51, 3)), rng.random((51, 3))
    packed = LIN.packed(rows)
    assert dict(packed.dtypes)["x"] == "binary" and packed.count() < 200
    for args in ((w,), (w, v)):
        a, b = LIN.run_pass(rows, "softmax", *args), LIN.run_pass(packed, "softmax", *args)
        assert a[:3] == b[:3] and all(np.allclose(x, y, rtol=1e-12) for x, y in zip(a[3], b[3]))


def test_word_vector_partitions_follow_the_words(spark):
    frame = spark.createDataFrame([(["a"] * 1000,)] * 3 + [(None,)], "t array<string>")
    assert Q._w2v_partitions(frame, "t") == 8
    assert Q._w2v_partitions(frame.crossJoin(spark.range(3500)), "t") == 11
    assert Q._w2v_partitions(frame.where("t is null"), "t") == 8
