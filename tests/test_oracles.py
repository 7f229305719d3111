"""Every query with an oracle returns the same rows as its DuckDB SQL (sf0.001); fitted models, which
have none, keep their invariants."""

import math
import re

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as E
from moodlens.sources.tables import TABLES, table_path

from .conftest import SF_SMALL

#: The queries of the optional package have their own tests.
OWN = [n for n in E.queries() if not re.match(r"op\d+_|pipeline$", n)]
ORACLES = {n: s for n, s in E.oracle_sql().items() if n in OWN}
#: Logistic regression runs up to 1000 passes; these three fit one each.
SLOW = {"logistic_regression", "eval_curve", "model_comparison"}


def _norm(v):
    if v is None or v is pd.NA:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 5)
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def _rows(pdf):
    cols = sorted(pdf.columns)
    return cols, sorted((tuple(_norm(x) for x in r) for r in pdf[cols].itertuples(index=False)), key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(SF_SMALL, t)}')")
    yield c
    c.close()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle(spark, con, name):
    got = E.queries()[name](spark, SF_SMALL).toPandas()
    want = con.execute(ORACLES[name]).df()
    gc, gr = _rows(got)
    wc, wr = _rows(want)
    assert gc == wc
    assert len(gr) == len(wr)
    assert gr == wr


def _rows_of(spark, name):
    rows = E.queries()[name](spark, SF_SMALL).collect()
    assert rows
    return rows


def _held_out(spark, id_col, pct):
    """Ids of labelled rows outside the training share, by the SQL of the split."""
    sql = f"""SELECT doc_id FROM documents JOIN labels USING (doc_id)
              WHERE CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 8) AS BIGINT) % 100 >= {pct}"""
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(SF_SMALL, t)}')")
    return {r[0] for r in con.execute(sql).fetchall()}


@pytest.mark.parametrize("name,classes,pct", [("mlp_ternary", 3, 70), ("mlp_binary", 2, 80)])
def test_mlp_predictions(spark, name, classes, pct):
    rows = _rows_of(spark, name)
    assert {r.TweetID for r in rows} == _held_out(spark, "TweetID", pct)
    for r in rows:
        p = list(r.probability)
        assert len(p) == classes and abs(sum(p) - 1) < 1e-6 and r.prediction == max(range(classes), key=p.__getitem__)
        assert r.label in range(classes)


def test_selected_predictions(spark):
    assert all(abs(sum(r.probability) - 1) < 1e-6 and r.TweetText for r in _rows_of(spark, "select_predictions"))


def test_mlp_metrics_are_shares(spark):
    (row,) = _rows_of(spark, "mlp_metrics")
    assert all(0 <= v <= 1 for v in row) and row.accuracy == pytest.approx(row.weighted_recall)


def test_embeddings(spark):
    assert all(r.dims == 100 == len(r.features) for r in _rows_of(spark, "word2vec_embed"))
    rows = _rows_of(spark, "nb_on_embeddings")
    assert {r.TweetID for r in rows} == _held_out(spark, "TweetID", 80) and {r.prediction for r in rows} <= {0.0, 1.0}


def test_random_split_is_a_partition(spark):
    rows = _rows_of(spark, "random_split")
    assert {r.split for r in rows} == {"train", "test"} and len({r.TweetID for r in rows}) == len(rows)
    assert {r.TweetID for r in rows} == _held_out(spark, "TweetID", 0)


@pytest.mark.parametrize("name,labels", [("random_forest", {0.0, 1.0, 2.0}), ("linear_svc", {0.0, 1.0, 2.0})])
def test_classic_models(spark, name, labels):
    rows = _rows_of(spark, name)
    assert {r.doc_id for r in rows} == {r.doc_id for r in _rows_of(spark, "predict")}
    assert {r.prediction for r in rows} | {r.label for r in rows} <= labels


def test_stems_keep_the_token_counts(spark):
    stems = {r.TweetID: (r.n_tokens, r.out) for r in _rows_of(spark, "stem_vocabulary")}
    tokens = {r.TweetID: (r.n_tokens, r.out) for r in _rows_of(spark, "clean_social")}
    assert {k: v[0] for k, v in stems.items()} == {k: v[0] for k, v in tokens.items()}
    assert any(stems[k][1] != tokens[k][1] for k in tokens)


def test_fit_history_falls_to_the_tolerance(spark):
    rows = sorted(_rows_of(spark, "fit_history"))
    assert [r.iteration for r in rows] == list(range(len(rows))) and rows[-1].passes < 30
    assert rows[-1].gradient_norm <= 1e-4 * rows[0].gradient_norm
    assert all(b.objective < a.objective for a, b in zip(rows, rows[1:]))


def test_tags_and_vectors(spark):
    tokens = {r.TweetID: r.n_tokens for r in _rows_of(spark, "tokenize_regex")}
    tags = _rows_of(spark, "hmm_tags")
    assert {r.TweetID: r.n_tokens for r in tags} == tokens
    assert {t for r in tags for t in r.out.split("|")} <= {"", "JJ", "RB", "VB", "VBZ", "DT", "CC", "IN", "TO", "PRP"}
    rows = _rows_of(spark, "ppmi_embed")
    assert all(len(r.vector) == 100 for r in rows) and any(any(r.vector) for r in rows)


def test_every_query_is_checked():
    rows_only = {
        "mlp_ternary", "mlp_binary", "select_predictions", "mlp_metrics", "word2vec_embed", "nb_on_embeddings", "random_split", "linear_svc",
        "stem_vocabulary", "fit_history", "hmm_tags", "ppmi_embed",
    }
    assert set(OWN) == set(ORACLES) | rows_only | SLOW


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["label", "rank", "term", "cnt", "rel"]
    assert df.count() > 0
