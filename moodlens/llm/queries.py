"""The registered queries of this package: each applies one operator to its whole table."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession

from ..sources.tables import read_table
from . import best_position, bond
from . import exact_dedup as exact
from . import license_scan as licences
from . import warc
from .ann import nearest
from .bpe import encode_decode
from .crf import quality
from .html_text import main_text
from .minhash import near_duplicates
from .packing import pack
from .substring_dedup import substring_dedup
from .url_filter import url_verdicts

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def vocabulary() -> str:
    """The vocabulary file of the public tokenizers package, at one place on all workers."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query
def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(read_table(spark, sf_dir, "documents"), window=20, with_text=False).drop("kept_text")


@query
def op3_harmonic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read_table(spark, sf_dir, "documents"), vocabulary(), capacity=2048)


@query
def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_dedup(read_table(spark, sf_dir, "documents"))


ORACLES["op4_exact_dedup"] = exact.ORACLE_SQL


@query
def op5_bpe_encode_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_decode(read_table(spark, sf_dir, "documents"), vocabulary(), with_ids=False)


@query
def op9_warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_round_trip(read_table(spark, sf_dir, "pages"), min_bytes=0)


ORACLES["op9_warc_archive"] = warc.ORACLE_SQL


@query
def op8_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(read_table(spark, sf_dir, "embeddings"), every=50, k=5)


@query
def op6_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "documents"), percent=75)


@query
def op7_html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(read_table(spark, sf_dir, "pages"))


@query
def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.license_scan(read_table(spark, sf_dir, "documents"))


ORACLES["op2_license_scan"] = licences.oracle_sql()


@query
def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


@query
def op11_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_verdicts(read_table(spark, sf_dir, "pages"))


@query
def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_position.ranked_search(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"), k=50)


ORACLES["op12_ranked_search"] = best_position.ORACLE_SQL


@query
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bond.hard_negatives(read_table(spark, sf_dir, "embeddings"), every=100)


ORACLES["op13_hard_negatives"] = bond.ORACLE_SQL
