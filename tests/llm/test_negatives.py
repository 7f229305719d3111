import math

import duckdb
import numpy as np
import pytest

from moodlens.llm import bond


def brute(rows, every=100, n_pos=5, n_neg=10):
    """Rows (id, label, vector); anchor ids are unique."""
    rows = [(i, l, v) for i, l, v in rows if None not in (i, l, v) and all(x is not None and math.isfinite(x) for x in v)]
    rows = [(i, (l + 1) % 10 if i % 7 == 0 else l, [math.floor(256 * x) for x in v]) for i, l, v in rows]
    out = []
    for a, la, va in rows:
        if a % every:
            continue
        scored = [(sum(x * y for x, y in zip(va, v)), i, l) for i, l, v in rows if i != a and len(v) == len(va)]
        scored.sort(key=lambda r: (-r[0], r[1]))
        for p, i, _ in [r for r in scored if r[2] == la][:n_pos]:
            fit = [r for r in scored if r[2] != la and 30 * p <= 100 * r[0] <= 90 * p][:n_neg]
            out += [(a, i, n, j, p, s) for n, (s, j, _) in enumerate(fit, 1)]
    return sorted(out)


def frame(spark, rows):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(i, l, v) for i, l, v in rows], "vec_id long, label int, embedding array<float>")
    for c in ("place", "score", "vec", "v", "rank", "part", "anchor_id"):
        df = df.withColumn(c, F.lit("x"))
    return df


def got(df):
    return sorted(tuple(r) for r in df.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())


def test_equal_to_brute_force_with_a_hot_vector(spark):
    rng = np.random.default_rng(2)
    x = rng.standard_normal((900, 24)).astype(np.float32)
    x[::3] = x[3]  # a third of all rows is one vector: ties
    rows = [(i, int(i % 10 if i % 4 else 3), v.tolist()) for i, v in enumerate(x)]
    want = brute(rows)
    assert len({r[0] for r in want}) == 9
    df = frame(spark, rows).repartition(5)
    assert got(bond.hard_negatives(df)) == want
    assert got(bond.hard_negatives(df, block_rows=3, share=2)) == want


def test_large_components_use_whole_numbers(spark):
    rng = np.random.default_rng(6)
    rows = [(i, i % 2, (rng.integers(-(2**20), 2**20, 8) + 0.5).tolist()) for i in range(250)]
    rows = [(i, l, [float(np.float32(x)) for x in v]) for i, l, v in rows]
    assert got(bond.hard_negatives(frame(spark, rows))) == brute(rows)


def test_odd_rows(spark):
    rows = [(0, 1, [1.0, 0.5]), (1, 1, [1.0, None]), (2, 1, None), (3, None, [1.0, 1.0]), (None, 1, [1.0, 1.0]), (4, 1, [float("nan"), 1.0]), (5, 1, [float("inf"), 1.0]),
            (6, 2, [2.0, 0.0]), (8, 2, [-3.0, -1.0]), (9, 2, [2.0, 0.0]), (10, 2, [2.5, 0.0]), (11, 1, [0.5, 0.0]), (12, 3, [1.0, 0.0]), (12, 3, [1.0, 0.0]), (13, 3, [0.5, 1.0]), (14, 9, []), (100, 0, []), (200, 2, [1.0]), (15, 2, [1.0])]
    assert got(bond.hard_negatives(frame(spark, rows))) == brute(rows)
    df = frame(spark, rows)
    assert bond.hard_negatives(df.limit(0)).count() == 0
    assert bond.hard_negatives(df.where("vec_id = 0")).count() == 0
    # An anchor id with several rows is its smallest (label, vector); its rows are not its own candidates.
    twice = [(0, 5, [1.0, 2.0]), (0, 4, [2.0, 1.0]), (0, 4, [2.0, 1.0]), (1, 4, [3.0, 1.0]), (2, 8, [1.0, 0.0]), (3, 8, [1.5, 0.5])]
    rest = [(0, 4, [2.0, 1.0])] + twice[3:]
    assert got(bond.hard_negatives(frame(spark, twice))) == brute(rest)


def test_scan_drops_rows_early_and_keeps_the_best():
    rng = np.random.default_rng(1)
    columns = rng.integers(-100, 100, (64, 3000)).astype(float)
    anchor = rng.integers(-100, 100, 64).astype(float) * np.linspace(0, 1, 64) ** 3
    anchor = np.floor(anchor)
    score = anchor @ columns
    low, high = columns.min(axis=1), columns.max(axis=1)
    near, s = bond.scan(columns, low, high, anchor, [(bond.LEAST, bond.MOST)], [bond.LEAST], 5)
    assert set(np.argsort(-score)[:5]) <= set(near) and (s == score[near]).all() and len(near) < 50
    top = score.max()
    near, s = bond.scan(columns, low, high, anchor, [(0.3 * top, 0.9 * top)], [bond.LEAST], 10)
    fit = np.flatnonzero((score >= 0.3 * top) & (score <= 0.9 * top))
    assert set(fit[np.argsort(-score[fit])[:10]]) <= set(near) and len(near) < 300


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.01", "/root/testdata/sf0.1"])
def test_oracle(spark, sf):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{sf}/embeddings.parquet')")
    want = con.sql(f"SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM ({bond.ORACLE_SQL})").fetchall()
    assert got(bond.hard_negatives(spark.read.parquet(f"{sf}/embeddings.parquet"))) == sorted(want)
