"""The distributed top-k equals a brute-force sort, and broadcast guards measure rows and bytes."""

import random

import pytest
from pyspark.sql import functions as F

from moodlens.operators import features as FE
from moodlens.operators import sizing


def _stats(spark, n=3000, seed=7):
    rnd = random.Random(seed)
    # Zipf-like counts with many ties, so the k-th place usually falls inside a tie group.
    rows = [(f"t{i:05d}", max(1, int(2000 / (1 + rnd.randrange(400))))) for i in range(n)]
    return rows, spark.createDataFrame(rows, "term string, cf long").repartition(7)


@pytest.mark.parametrize("k", [1, 5, 37, 400, 2999, 3000, 5000])
def test_top_k_matches_sort(spark, k):
    rows, df = _stats(spark)
    want = sorted(rows, key=lambda r: (-r[1], r[0]))[:k]
    got = [tuple(r) for r in FE.top_k(df, k, "cf", "term").collect()]
    assert sorted(got, key=lambda r: (-r[1], r[0])) == want


def test_top_vocabulary_unbounded_is_identity(spark):
    _, df = _stats(spark, n=50)
    assert FE.top_vocabulary(df, None).count() == 50


def test_broadcast_guard_rows_and_bytes(spark):
    small = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    assert sizing.is_small(small)
    assert not sizing.is_small(small, max_rows=1)
    wide = spark.range(100).select(F.repeat(F.lit("x"), 1000).alias("s"))
    n, b = sizing.measure(wide)
    assert n == 100 and b >= 100 * 1000
    assert not sizing.is_small(wide, max_bytes=50_000)
    assert sizing.is_small(wide, max_bytes=10_000_000)


def test_fit_partitions_only_lowers(spark):
    df = spark.range(1000).repartition(8)
    assert sizing.fit_partitions(df, 10_000).rdd.getNumPartitions() == 1
    assert sizing.fit_partitions(df, 3 * sizing.TARGET_PARTITION_BYTES).rdd.getNumPartitions() == 3
    assert sizing.fit_partitions(df, 100 * sizing.TARGET_PARTITION_BYTES).rdd.getNumPartitions() == 8
    assert sizing.fit_partitions(df, 10_000).count() == 1000


def test_total_bytes_counts_strings(spark):
    df = spark.createDataFrame([("abc", ["de", "f"]), (None, None)], "s string, a array<string>")
    # "abc" + 8, plus array "def" + 2 * 8 + 16; the null row counts the fixed overheads only.
    assert sizing.total_bytes(df) == (3 + 8) + (3 + 16 + 16) + 8 + 16
