import hashlib
import random

import numpy as np
import pytest

from moodlens.llm import substring_dedup as S
from moodlens.llm import words as W

from .brute import substring_rows


def _got(df):
    return {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in df.collect()}


@pytest.mark.parametrize("seed", range(4))
def test_random_texts(table, seed):
    rnd = random.Random(seed)
    vocab = [f"w{i}" for i in range(2 + 10 * seed)]
    passages = [" ".join(rnd.choices(vocab, k=rnd.randint(5, 60))) for _ in range(6)]
    docs = []
    for i in range(40):
        parts = [rnd.choice(passages) if rnd.random() < 0.5 else "\n".join(rnd.choices(vocab, k=rnd.randint(0, 40))) for _ in range(rnd.randint(0, 4))]
        docs.append((i, " \t".join(parts)))
    got = _got(S.substring_dedup(table(docs), window=20, chunk_bytes=500))
    assert got == substring_rows(docs, 20)


def test_runs_and_periods(table):
    docs = [(1, "a " * 100), (2, "b a " * 60), (3, "a " * 19 + "c"), (4, "a " * 20), (5, "x " * 19), (6, "x " * 19)]
    assert _got(S.substring_dedup(table(docs))) == substring_rows(docs, 20)


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert _got(S.substring_dedup(docs, with_text=False)) == substring_rows(rows, 20)


def test_window_choice_depends_on_the_window_alone():
    rnd = np.random.default_rng(0)
    for size in (2, 5, 1000):
        window = rnd.integers(0, size, 20)
        offsets = set()
        for _ in range(60):
            left, right = rnd.integers(0, size, rnd.integers(0, 30)), rnd.integers(0, size, rnd.integers(0, 30))
            names = W.mix(np.concatenate([left, window, right]).astype(np.uint64))
            places, block = S.chosen_blocks(names, np.array([0, len(names)]), 20)
            offsets.add(int(block[len(left)] - places[len(left)]))
        assert len(offsets) == 1


def test_odd_rows(table, odd_rows):
    rows = S.substring_dedup(table(odd_rows), window=2).collect()
    assert len(rows) == len(odd_rows)
    empty = hashlib.sha256(b"").hexdigest()
    got = sorted((r.doc_id or 99, r.n_words, r.n_removed, r.kept_sha256 == empty, r.kept_text) for r in rows)
    assert (1, 0, 0, True, None) in got and (2, 0, 0, True, "") in got and (3, 0, 0, True, " \n\t ") in got
    # the second row of doc 4 repeats the first; the row without an id comes last and repeats "b c" only
    assert [x[2] for x in got if x[0] == 4] == [0, 3]
    assert (99, 3, 2, False, "a") in got
    assert S.substring_dedup(table(odd_rows).limit(0)).count() == 0


def test_carried_columns(table):
    df = table([(1, "a b")]).select("doc_id", "text", "chunk", "kept")
    row = S.substring_dedup(df, carry=("chunk", "doc_id")).collect()[0]
    assert (row.carried_0, row.carried_1, row.kept_text) == ("x", 1, "a b")
