import random

from moodlens.llm.exact_dedup import directory, exact_dedup

from .brute import exact_rows


def _got(df):
    return {r.doc_id: (r.keep_id, r.group_size, r.kept, r.text_sha256) for r in df.collect()}


def test_groups(table):
    rnd = random.Random(3)
    texts = ["", "Ab", "aB", "É", "é", "x\ny", "straße", "STRASSE", "K", "k"] + [f"t{i}" for i in range(30)]
    docs = [(i, rnd.choice(texts) if rnd.random() < 0.6 else "Hot Copy") for i in range(300)]
    assert _got(exact_dedup(table(docs), capacity=8, max_depth=6)) == exact_rows(docs)


def test_depth_follows_the_number_of_records(table):
    from pyspark.sql import functions as F

    docs = [(i, f"text {i % 900}" if i % 3 else "hot") for i in range(1_500)]
    assert _got(exact_dedup(table(docs), capacity=16)) == exact_rows(docs)
    records = table([(i, str(i)) for i in range(4_096)]).select(F.shiftrightunsigned(F.xxhash64("text"), 55).alias("slot"))
    sizes = {r["bucket"]: r["n"] for r in records.join(directory(records, 32, 9), "slot").groupBy("bucket").agg(F.count("*").alias("n")).collect()}
    assert sum(sizes.values()) == 4_096 and max(sizes.values()) <= 32 and len(sizes) > 128


def test_odd_rows(table, odd_rows):
    rows = exact_dedup(table(odd_rows)).collect()
    assert len(rows) == len(odd_rows)
    assert sum(r.kept for r in rows) == 4  # blank, empty, "a b c" and the long text
    assert all(r.keep_id == 4 and r.group_size == 3 for r in rows if r.doc_id == 4)
    assert {r.keep_id for r in rows if r.doc_id in (1, 2)} == {2}
    assert exact_dedup(table(odd_rows).limit(0)).count() == 0
