"""Exact cuts and numbering without a one-task sort."""

import random

import pytest
from pyspark.sql import functions as F

from moodlens.operators import selection as SEL


@pytest.mark.parametrize("k", [0, 1, 9, 10, 11, 500, 2_999, 3_000, 4_000])
def test_top_k_with_ties_and_small_buckets(spark, k):
    rnd = random.Random(1)
    # Texts that are prefixes of others, of many lengths, and characters of several bytes.
    words = sorted({"".join(rnd.choices("aabé€z ", k=rnd.randint(1, 9))) for _ in range(6_000)})[:3_000]
    rows = [(w, 50 if i < 10 else 1) for i, w in enumerate(rnd.sample(words, len(words)))]
    df = spark.createDataFrame(rows, "term string, cf long").repartition(5)
    want = sorted(rows, key=lambda r: (-r[1], r[0].encode()))[:k]
    got = [tuple(r) for r in SEL.top_k(df, k, "cf", "term", bucket_rows=7).collect()]
    assert sorted(got, key=lambda r: (-r[1], r[0].encode())) == want


def test_a_million_ties(spark):
    n, k = 1_000_000, 400_001
    df = spark.range(n).select(F.concat(F.lit("term "), F.lpad(F.col("id").cast("string"), 7, "0")).alias("term"), F.when(F.col("id") % 250_000 == 3, 9).otherwise(1).cast("long").alias("cf"))
    got = SEL.top_k(df, k, "cf", "term")
    row = got.agg(F.count("*").alias("n"), F.sum((F.col("cf") == 9).cast("int")).alias("hot"), F.max(F.when(F.col("cf") == 1, F.col("term"))).alias("last")).first()
    # Four terms count 9, of them 3 and 250 003 lie before the cut: 399 997 ties are taken.
    assert (row["n"], row["hot"], row["last"]) == (k, 4, "term 0399998")


@pytest.mark.parametrize("parts", [1, 7])
def test_numbered_is_the_place_in_order(spark, parts):
    rows = [(f"t{i:04d}", 1 if i % 3 else 5) for i in range(1_000)]
    df = spark.createDataFrame(rows, "term string, cf long").repartition(4)
    got = {r["term"]: r["at"] for r in SEL.numbered(df, [F.desc("cf"), F.asc("term")], "at", start=0, partitions=parts).collect()}
    want = {t: i for i, (t, _) in enumerate(sorted(rows, key=lambda r: (-r[1], r[0])))}
    assert got == want
    assert SEL.numbered(df.limit(0), [F.asc("term")], "at").count() == 0


def test_no_single_task_sort_in_the_vocabulary_cut(spark):
    df = spark.createDataFrame([(f"t{i}", 1) for i in range(100)], "term string, cf long")
    plan = SEL.top_k(df, 40, "cf", "term")._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrdered" not in plan and "Sort" not in plan and "SinglePartition" not in plan
