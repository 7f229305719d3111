import random

import numpy as np
import pytest

from moodlens.llm import minhash as M
from moodlens.llm.components import connected_components

from .brute import near_rows


def _got(df):
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in df.collect()}


@pytest.mark.parametrize("edits", [1, 3, 6])
def test_copies_of_one_text(table, edits):
    """Copies link to their text but not always to one another."""
    rnd = random.Random(edits)
    vocab = [f"w{i}" for i in range(500)]
    docs, i = [], 0
    for _ in range(6):
        base = rnd.choices(vocab, k=rnd.randint(40, 160))
        for _ in range(12):
            copy = list(base)
            for _ in range(rnd.randint(0, edits)):
                copy[rnd.randrange(len(copy))] = rnd.choice(vocab)
            docs.append((i, " ".join(copy).upper() if i % 3 else " ".join(copy)))
            i += 1
    rnd.shuffle(docs)
    assert _got(M.near_duplicates(table(docs))) == near_rows(docs)


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert _got(M.near_duplicates(docs)) == near_rows([(r.doc_id, r.text) for r in docs.collect()])


def test_odd_rows(table, odd_rows):
    rows = M.near_duplicates(table(odd_rows)).collect()
    assert len(rows) == len(odd_rows)
    assert all(r.kept and r.component_id == r.doc_id and r.n_shingles == 0 for r in rows if r.doc_id in (1, 2, 3))
    assert sorted((r.doc_id or 99, r.component_id, r.kept) for r in rows if r.n_shingles == 1 and r.doc_id != 5) == [(4, 4, True), (4, 4, True), (99, 4, False)]
    assert M.near_duplicates(table(odd_rows).limit(0)).count() == 0


def test_sketch_estimates_similarity():
    rnd = np.random.default_rng(5)
    common, a, b = (rnd.integers(0, 2**63, n).astype(np.uint64) for n in (600, 100, 100))
    x, y = np.sort(np.append(common, a)), np.sort(np.append(common, b))
    s = M.sketches(np.concatenate([x, y, x[:1]]), np.array([0, 700, 1400, 1401, 1401]))
    assert abs((s[0] == s[1]).mean() - 0.75) < 0.15
    assert (s[:3] != M.EMPTY).all() and (s[3] == M.EMPTY).all()


def test_components(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(0, 40)] + [(100, 102), (101, 102), (5, 5)], "a long, b long")
    got = {r.node: r.comp for r in connected_components(links).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in (100, 101, 102)}}


def test_repeated_and_null_ids(table):
    rnd = random.Random(8)
    vocab = [f"v{i}" for i in range(300)]
    bases = [rnd.choices(vocab, k=60) for _ in range(12)]
    docs = []
    for i in range(160):
        w = list(bases[i % 12])
        w[rnd.randrange(60)] = "x"
        docs.append((None if i % 3 == 0 else i % 20, " ".join(w)))  # null ids in bulk; ids that repeat with other texts
    docs += [(7, docs[1][1]), (7, docs[1][1]), (None, ""), (None, None), (3, "")]
    # Brute force over row numbers, in the order in which ids count: null last.
    order = sorted(range(len(docs)), key=lambda i: (docs[i][0] is None, docs[i][0] or 0))
    want = []
    by_row = near_rows([(n, docs[i][1]) for n, i in enumerate(order)])
    for n, i in enumerate(order):
        size, comp, _ = by_row[n]
        first = docs[order[comp]][0] if size else docs[i][0]
        want.append((docs[i][0], size, first, docs[i][0] == first))
    got = [(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in M.near_duplicates(table(docs)).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_long_text_and_many_null_ids(table):
    words = [f"w{i % 5_000}" for i in range(300_000)]
    docs = [(1, " ".join(words)), (2, " ".join(words[:290_000]))] + [(None, f"row {i} holds five words or more {i}") for i in range(3_000)]
    rows = M.near_duplicates(table(docs)).collect()
    assert len(rows) == len(docs) and {(r.doc_id, r.component_id) for r in rows} == {(1, 1), (2, 1), (None, None)}
    assert all(r.kept for r in rows if r.doc_id is None)
