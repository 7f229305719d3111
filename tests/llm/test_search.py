import numpy as np
import pytest

from moodlens.llm import ann


def _exact(ids, x, every, k):
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    out = {}
    for i in np.flatnonzero(ids % every == 0):
        s = x @ x[i]
        order = np.lexsort((ids, -np.round(s, 12)))
        out[int(ids[i])] = [int(ids[j]) for j in order if ids[j] != ids[i]][:k]
    return out


def test_recall_with_hot_vector(spark):
    rng = np.random.default_rng(1)
    x = rng.standard_normal((3000, 32))
    x[::3] = x[1]  # a third of all rows is one vector
    x[5::50] = x[4::50] + 0.05 * rng.standard_normal(x[4::50].shape)
    ids = np.arange(3000)
    df = spark.createDataFrame([(int(i), v.tolist(), "c", 1) for i, v in zip(ids, x)], "vec_id long, embedding array<double>, list string, block int")
    rows = ann.nearest(df, block_rows=256).collect()
    want = _exact(ids, x, 50, 5)
    got = {q: [r.vec_id for r in sorted((r for r in rows if r.query_id == q), key=lambda r: r.rank)] for q in want}
    assert np.mean([len(set(got[q]) & set(w)) / 5 for q, w in want.items()]) >= 0.9
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    for r in rows:
        assert abs(r.score - unit[r.query_id] @ unit[r.vec_id]) < 1e-12
    assert got[0] == want[0]  # ties go to the smaller ids


def test_odd_rows(spark):
    rows = [(0, [1.0, 0.0]), (50, [1.0, None]), (1, [0.0, 0.0]), (2, None), (3, [2.0, 0.0]), (3, [1.0, 1.0]), (4, [float("nan"), 1.0]), (7, [float("inf"), 1.0]), (None, [1.0, 1.0]), (5, [3.0, 0.0]), (100, [0.0, 1.0]), (6, [1.0]), (8, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted((r.query_id, r.rank, r.vec_id, round(r.score, 6)) for r in ann.nearest(df).collect())
    assert got == [(0, 1, 3, 1.0), (0, 2, 5, 1.0), (0, 3, 100, 0.0), (100, 1, 3, 0.707107), (100, 2, 0, 0.0), (100, 3, 5, 0.0)]
    assert ann.nearest(df.limit(0)).count() == 0
    assert ann.nearest(df.where("vec_id = 0")).count() == 0


def test_scan_keeps_the_nearest():
    rng = np.random.default_rng(3)
    turn = ann.rotation(64)
    assert np.allclose(turn @ turn.T, np.eye(64))
    x = ann._unit(np.repeat(rng.standard_normal((200, 64)), 10, axis=0) + 0.3 * rng.standard_normal((2000, 64))) @ turn
    lost = 0
    for q in x[:50]:
        true = np.argsort(((x - q) ** 2).sum(axis=1))[:6]
        near = ann.scan(q, np.ascontiguousarray(x.T), np.inf, 6)
        assert len(near) < 400  # most candidates are abandoned
        lost += len(set(true) - set(near))
    assert lost <= 3


def test_repeated_ids_push_no_candidate_out(spark):
    rng = np.random.default_rng(5)
    x = rng.standard_normal((400, 64))
    near = x[0] + 0.1 * rng.standard_normal((8, 64))
    rows = [(i, v) for i, v in enumerate(x)] + [(0, x[0])] * 10 + [(1000 + i, v) for i, v in enumerate(near)]
    rows += [(1000, near[0])] * 10 + [(1001, near[1] + 0.001 * rng.standard_normal(64)) for _ in range(40)]  # equal and other vectors of an id
    df = spark.createDataFrame([(i, v.tolist()) for i, v in rows], "vec_id long, embedding array<double>")
    unit = np.array([v for _, v in rows])
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    top = {}
    for (i, _), s in zip(rows, unit @ unit[0]):
        top[i] = max(top.get(i, -1), s)
    want = sorted((i for i in top if i), key=lambda i: (-top[i], i))[:5]
    for block in (4_096, 16):
        got = sorted((r.rank, r.vec_id) for r in ann.nearest(df, block_rows=block, recall=1.0).collect() if r.query_id == 0)
        assert got == list(enumerate(want, 1))
    hot = [(0, x[0])] * 20 + [(1, x[1])] * 20 + [(2, x[2]), (3, x[3])]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in hot], "vec_id long, embedding array<double>")
    assert sorted(r.vec_id for r in ann.nearest(df).collect()) == [1, 2, 3]  # all candidates
    q, columns, ids = unit[0], np.ascontiguousarray(unit.T), np.array([i for i, _ in rows])
    assert set(want) <= set(ids[ann.scan(q, columns, np.inf, 5, ids, 0)].tolist())


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_recall_on_all_queries_of_the_table(spark, sf):
    df = spark.read.parquet(f"/root/testdata/{sf}/embeddings.parquet")
    table = df.toPandas()
    want = _exact(table.vec_id.to_numpy(), np.array(table.embedding.tolist(), np.float64), 50, 5)
    rows = ann.nearest(df).collect()
    got = {q: {r.vec_id for r in rows if r.query_id == q} for q in want}
    assert len(rows) == 5 * len(want) and np.mean([len(got[q] & set(w)) / 5 for q, w in want.items()]) >= 0.9


def test_queries_of_a_list_in_parts(spark):
    rng = np.random.default_rng(9)
    x = rng.standard_normal((600, 16))
    df = spark.createDataFrame([(int(i), v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    rows = ann.nearest(df, every=2, block_rows=20, recall=1.0).collect()  # 300 queries, lists probed by more than 20
    want = _exact(np.arange(600), x, 2, 5)
    got = {q: [r.vec_id for r in sorted((r for r in rows if r.query_id == q), key=lambda r: r.rank)] for q in want}
    assert len(rows) == 1_500 and np.mean([got[q] == w for q, w in want.items()]) >= 0.95
