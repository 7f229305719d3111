"""The relational forest equals trees grown row by row, and keeps its invariants."""

import math
import random
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from moodlens.operators import features as FE
from moodlens.operators import forest as RF
from moodlens.plans.classic_job import classic_job


def _bin(x):
    return math.floor(math.log2(x) * RF.OCTAVE + RF.OFFSET)


def _hash(tree, node, idx, seed):
    k = (node + tree * 64) * 7919 + (104_729 + 15_485_863 * (seed % 1000))
    a = (idx + k) % RF.PRIME
    return ((a * a) % RF.PRIME * 48_271 + k) % RF.PRIME


def brute(rows, n_terms, labels, weights, max_depth, seed=0):
    """{(tree, node): (counts, split)}, each split found by trying every cut of every drawn term."""
    drawn = int(RF.PRIME * max(1, math.isqrt(n_terms)) / n_terms)
    out = {}

    def grow(tree, node, here, depth):
        counts = [sum(w for y, _, w in here if y == lab) for lab in labels]
        out[tree, node] = [counts, None]
        if depth == max_depth or sum(c > 0 for c in counts) <= 1:
            return
        held = {}
        for y, bins, w in here:
            for i, b in bins.items():
                held.setdefault(i, []).append((b, y, w))

        def cuts(i):
            for b in {b for b, _, _ in held[i]}:
                right = Counter()
                for c, y, w in held[i]:
                    if c >= b:
                        right[y] += w
                r = [right[lab] for lab in labels]
                rest = [t - x for t, x in zip(counts, r)]
                if sum(r) and sum(rest):
                    yield -(sum(x * x for x in r) / sum(r) + sum(x * x for x in rest) / sum(rest)), i, b

        found = [c for i in held if _hash(tree, node, i, seed) < drawn for c in cuts(i)]
        if not found:
            for i in sorted(held, key=lambda i: _hash(tree, node, i, seed)):
                found = list(cuts(i))
                if found:
                    break
        if found:
            _, i, b = min(found)
            out[tree, node][1] = (i, b)
            grow(tree, 2 * node, [r for r in here if r[1].get(i, -math.inf) < b], depth + 1)
            grow(tree, 2 * node + 1, [r for r in here if r[1].get(i, -math.inf) >= b], depth + 1)

    for tree in range(len(weights[0])):
        grow(tree, 1, [(y, bins, w[tree]) for (y, bins), w in zip(rows, weights) if w[tree]], 0)
    return out


def _compare(forest, train):
    trees = range(forest.num_trees)
    got = train.select("label", "ids", "x", *[RF.draw_weight("doc_id", t, forest.seed).alias(f"w{t}") for t in trees]).collect()
    rows = [(r["label"], {i: _bin(x) for i, x in zip(r["ids"], r["x"])}) for r in got]
    want = brute(rows, forest.n_terms, forest.labels, [[r[f"w{t}"] for t in trees] for r in got], forest.max_depth, forest.seed)
    assert {k: (v.counts, v.split) for k, v in forest.nodes.items()} == {k: (c, s) for k, (c, s) in want.items()}


def test_equals_brute_force_on_the_small_tables(spark):
    job = classic_job(spark, "/root/testdata/sf0.001")
    train = job.train_rows()
    forest = RF.fit_forest(train, job.n_terms)
    _compare(forest, train)
    assert any(v.split and k[1] > 1 for k, v in forest.nodes.items())
    pred = forest.transform(RF.binned(job.test_rows(), "doc_id", "label")).collect()
    assert len(pred) == job.test_rows().count()
    for r in pred:
        assert abs(sum(r["probability"]) - 1) < 1e-9 and r["prediction"] == forest.labels[int(np.argmax(r["probability"]))]


def test_few_terms_deep_trees_three_classes(spark):
    rnd = random.Random(5)
    data = [(i, rnd.randrange(3), sorted(rnd.sample(range(12), rnd.randrange(0, 6)))) for i in range(300)]
    df = spark.createDataFrame([(i, y, t, [rnd.random() + 0.01 for _ in t]) for i, y, t in data], "doc_id long, label int, ids array<int>, x array<double>")
    for seed in (0, 4):
        forest = RF.fit_forest(df.repartition(3), 12, num_trees=3, max_depth=6, seed=seed)
        _compare(forest, df)
    table = forest.table(spark)
    assert table.where("idx is null and size(counts) = 3").count() > 8


def test_one_class_and_no_terms(spark):
    one = spark.createDataFrame([(1, 0, [1], [0.5]), (2, 0, [], [])], "doc_id long, label int, ids array<int>, x array<double>")
    assert {r["prediction"] for r in RF.fit_forest(one, 2).transform(RF.binned(one, "doc_id")).collect()} == {0.0}
    bare = spark.createDataFrame([(i, i % 2, [], []) for i in range(9)], "doc_id long, label int, ids array<int>, x array<double>")
    assert all(v.split is None for v in RF.fit_forest(bare, 2).nodes.values())


def test_poisson_weights(spark):
    n = 20_000
    got = spark.range(n).select(RF.draw_weight("id", 0, 0).alias("w")).agg(F.avg("w").alias("m"), F.var_pop("w").alias("v")).first()
    assert abs(got["m"] - 1) < 0.03 and abs(got["v"] - 1) < 0.06


def test_sparse_rows_keep_documents_without_terms(spark):
    feats = spark.createDataFrame([(1, 4, 0.5), (1, 2, 0.25)], "doc_id long, idx int, x double")
    docs = spark.createDataFrame([(1, "a"), (2, "b")], "doc_id long, label string")
    assert sorted(map(tuple, FE.sparse_rows(feats, docs).collect())) == [(1, "a", [2, 4], [0.25, 0.5]), (2, "b", [], [])]
