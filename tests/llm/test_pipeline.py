"""The stages against brute force, and the registered queries against their SQL."""

import duckdb
import pytest

import __spark_entry__ as E
import corpus_pipeline
from moodlens.llm import queries as Q
from moodlens.sources.tables import TABLES, table_path
from tests.test_oracles import _rows

from .brute import exact_rows, near_rows, sha, substring_rows, words

SF = "/root/testdata/sf0.001"


def test_registered():
    names = E.queries()
    assert [n for n in range(1, 14) if sum(k.startswith(f"op{n}_") for k in names) != 1] == []
    assert "pipeline" in names and len(corpus_pipeline.STAGES) == 5


@pytest.mark.parametrize("name", sorted(Q.ORACLES))
def test_oracle(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(SF, t)}')")
    want = con.execute(Q.ORACLES[name]).df()
    assert _rows(E.queries()[name](spark, SF).toPandas()) == _rows(want)


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    rows = {r.doc_id: r.text for r in docs.collect()}
    stages = dict(corpus_pipeline.STAGES)

    docs = stages["quality"](spark, docs, SF).cache()
    kept = {r.doc_id: r.text for r in docs.collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert all(rows[d] == t for d, t in kept.items()) and docs.columns == columns
    assert sum((d in kept) != bool(q) for d, q in labels.items() if d in rows) <= 0.05 * len(labels)

    docs = stages["exact_dedup"](spark, docs, SF).cache()
    left = {r.doc_id: r.text for r in docs.collect()}
    assert left == {d: kept[d] for d, v in exact_rows(list(kept.items())).items() if v[2]} and docs.columns == columns

    docs = stages["near_dedup"](spark, docs, SF).cache()
    near = {r.doc_id: r.text for r in docs.collect()}
    assert near == {d: left[d] for d, v in near_rows(list(left.items())).items() if v[2]} and docs.columns == columns

    docs = stages["substring_dedup"](spark, docs, SF).cache()
    cut = docs.collect()
    want = substring_rows(list(near.items()), 20)
    assert docs.columns == columns and len(cut) == len(near)
    for r in cut:
        assert sha(" ".join(words(r.text))) == want[r.doc_id][2] and r.n_chars == len(r.text)
        assert want[r.doc_id][1] or r.text == near[r.doc_id]

    pieces = stages["packing"](spark, docs, SF).collect()
    assert {p.doc_id for p in pieces} == set(near)


def test_run_returns_the_last_stage(spark):
    got = corpus_pipeline.run(spark, SF)
    assert got.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] and got.count() > 0


def test_stages_on_odd_rows(spark):
    rows = [(1, "A b c", "en", None, 3), (1, "A b c", "en", "s", 3), (1, "a b c", None, "s", 3), (2, None, None, None, None), (None, "", "x", "y", 0), (None, "a", "x", "y", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    counts = [stage(spark, docs, SF).count() for _, stage in corpus_pipeline.STAGES]
    assert counts[:4] == [6, 3, 6, 6]
    assert all(stage(spark, docs.limit(0), SF).count() == 0 for _, stage in corpus_pipeline.STAGES)


def _sent_texts(df):
    """How often a text column goes to Python in the plan's first step there."""
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    step = plan[max(plan.rfind(x) for x in ("MapInArrow", "FlatMapGroupsInArrow")) :].split("\n", 2)[1]
    return step.count("text")


def test_quality_and_passages_send_a_text_once(spark):
    docs = spark.createDataFrame([(1, "A b c", "en", 5)], "doc_id long, text string, lang string, n_chars long")
    model = {"prior": 0.9, "weights": None, "pair": None}
    sent = []

    def seen(docs, *args, carry=(), **more):
        sent.append(tuple(carry))
        return substring_dedup(docs, *args, carry=carry, **more)

    from moodlens.llm import crf
    from moodlens.llm.substring_dedup import substring_dedup

    made = crf.score(docs, model, carry=("doc_id", "text", "lang"))
    assert made.columns == ["doc_id", "held_out", "score", "predicted", "carried_0", "carried_1", "carried_2"]
    assert [tuple(r) for r in made.collect()] == [(1, False, 0.9, 1, 1, "A b c", "en")]
    assert _sent_texts(made) == 1
    # A text of another type is cast for the score and carried as it is.
    made = crf.score(docs.withColumn("text", docs.n_chars), model, carry=("text",))
    assert [tuple(r) for r in made.collect()] == [(1, False, 0.9, 1, 5)]
    old, corpus_pipeline.substring_dedup = corpus_pipeline.substring_dedup, seen
    try:
        out = corpus_pipeline.repeated_passages(spark, docs, SF)
        assert sent == [("doc_id", "lang", "n_chars")]
        assert out.columns == docs.columns and [tuple(r) for r in out.collect()] == [(1, "A b c", "en", 5)]
    finally:
        corpus_pipeline.substring_dedup = old


def test_steps_let_a_worker_s_tokenizer_go():
    import pyarrow as pa

    from moodlens.llm import bpe, minhash, substring_dedup
    from moodlens.llm.queries import vocabulary

    docs = {"doc_id": pa.array([1]), "h": pa.array([1]), "text": pa.array(["a b c"])}
    chunk = pa.table({"chunk": pa.array([0], pa.int32()), "doc_id": docs["doc_id"], "text": docs["text"]})
    for step in (lambda: list(minhash._sketch_batches(iter([pa.RecordBatch.from_pydict(docs)]))), lambda: substring_dedup._name_blocks(20, 2)(chunk)):
        bpe.loaded(vocabulary())
        step()
        assert not bpe._LOADED


def test_columns_of_documents_with_any_name(spark):
    from pyspark.sql import functions as F

    stages = dict(corpus_pipeline.STAGES)
    text = " ".join(f"word{i}" for i in range(30))
    rows = [(1, text), (2, text.upper()), (3, text + " more"), (None, "a b"), (None, "a b"), (4, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for c in ("gone_id", "gone_sha", "pipeline_sha", "Gone_ID_", "any", "n", "kept", "h"):
        docs = docs.withColumn(c, F.concat(F.lit(f"{c} of "), F.col("doc_id").cast("string")))
    left = stages["exact_dedup"](spark, docs, SF)
    assert left.columns == docs.columns
    assert sorted((r.doc_id or 0, r.text, r.gone_id, r.pipeline_sha) for r in left.collect() if r.doc_id != 4) == [
        (0, "a b", None, None), (2, text.upper(), "gone_id of 2", "pipeline_sha of 2"), (3, text + " more", "gone_id of 3", "pipeline_sha of 3"),
    ]
    near = stages["near_dedup"](spark, left, SF)
    assert near.columns == docs.columns and sorted(r.doc_id or 0 for r in near.collect()) == [0, 2, 4]
