import itertools
import random
import time
import zlib

import numpy as np
import pyarrow as pa

from moodlens.llm import crf as C


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(0)
    off = np.array([0, 3, 3, 7, 8])
    emit, pair = rng.standard_normal(8), rng.standard_normal((2, 2))
    p, pairs = C.marginals(emit, pair, off, True)
    want, want_pairs = np.zeros(8), np.zeros((2, 2))
    for a, b in zip(off[:-1], off[1:]):
        n, z, part, count = b - a, 0.0, np.zeros(b - a), np.zeros((2, 2))
        for y in itertools.product((0, 1), repeat=int(n)):
            w = np.exp(sum(e * v for e, v in zip(emit[a:b], y)) + sum(pair[i, j] for i, j in zip(y, y[1:])))
            z += w
            part += w * np.array(y)
            for i, j in zip(y, y[1:]):
                count[i, j] += w
        if n:
            want[a:b] = part / z
            want_pairs += count / z
    assert np.allclose(p, want) and np.allclose(pairs, want_pairs)


def test_line_features():
    x, size, off = C.line_features(pa.array(["Good line here.\n\nGO!! GO!! NOW!!", None, "", "a | b |\na | b |"]))
    assert off.tolist() == [0, 2, 2, 2, 4] and size.tolist() == [13, 13, 4, 4]
    names = C.OWN_FEATURES
    assert x[0, 7] == 0 and x[1, 7] == 1  # words that end in two signs
    assert x[2, 5] == 0.5 and x[2, 11] == 0 and x[3, 11] == 1  # bare signs; a line seen before
    assert (x[0, 2 * names :] == x[1, :names]).all() and (x[1, names : 2 * names] == x[0, :names]).all() and not x[0, names : 2 * names].any()


def _corpus(n=300):
    rnd = random.Random(4)
    vocab = ["the", "of", "that", "Thering", "andes", "is", "therly", "ÉOU", "x"]

    def line(bad):
        w = rnd.choices(vocab, k=rnd.randint(1, 12))
        return rnd.choice([" ".join(x.upper() + "!!" for x in w), " | ".join(w), " ".join([w[0]] * 12)]) if bad else " ".join(w).capitalize() + "."

    docs, labels = [], []
    for i in range(n):
        bad = i % 4 == 0
        docs.append((i, "\n".join(line(bad and rnd.random() < 0.9) for _ in range(rnd.randint(1, 30)))))
        labels.append((i, int(not bad)))
    return docs, labels


def test_held_out_accuracy(spark, table):
    docs, labels = _corpus()
    lab = spark.createDataFrame(labels + [(1, None), (None, 1), (4, 1)], "doc_id long, quality int").selectExpr("*", "'c' AS text")
    rows = C.quality(table(docs), lab).collect()
    assert len(rows) == len(docs) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    want = dict(labels)
    assert np.mean([r.predicted == want[r.doc_id] for r in rows if r.held_out]) >= 0.95


def test_labels_of_held_out_rows_are_not_used(spark, table):
    docs, labels = _corpus(120)
    flipped = [(i, 1 - q if zlib.crc32(str(i).encode()) % 4 == 2 else q) for i, q in labels]
    a, b = ({r.doc_id: r.score for r in C.quality(table(docs), spark.createDataFrame(x, "doc_id long, quality int")).collect()} for x in (labels, flipped))
    assert a == b


def test_held_out_accuracy_of_table(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    rows = C.quality(docs, labels).join(labels, "doc_id").where("held_out").collect()
    assert np.mean([r.predicted == r.quality for r in rows]) >= 0.95


def test_odd_rows(spark, table, odd_rows):
    _, labels = _corpus(40)
    lab = spark.createDataFrame(labels, "doc_id long, quality int")
    rows = C.quality(table(odd_rows), lab).collect()
    assert len(rows) == len(odd_rows) and not any(r.held_out for r in rows if r.doc_id is None)
    assert {r.score for r in C.quality(table(odd_rows), lab.limit(0)).collect()} == {1.0}
    assert C.quality(table(odd_rows).limit(0), lab).count() == 0


def test_long_documents_and_a_hot_id_bound_the_fit(spark, table):
    docs, labels = _corpus(80)
    long = "\n".join(t for _, t in docs if t) * 60
    hot = [(i, t) for i, t in docs if i % 4 != 2] + [(0, long), (1, long)] + [(5, f"Row {i}.\nMore.") for i in range(2_000)]
    lab = spark.createDataFrame(labels, "doc_id long, quality int")
    assert long.count("\n") > 20_000
    t0 = time.perf_counter()
    rows = C.quality(table(hot), lab).collect()
    assert len(rows) == len(hot) and time.perf_counter() - t0 < 60
    cut = C.segments(100_000)
    assert sum(b - a for a, b in cut) == C.FIT_LINES and cut[0][0] == 0 and cut[-1][1] == 100_000
    assert C.segments(7) == [(0, 7)] and C.segments(0) == [(0, 0)]
