"""The query catalog behind ``__spark_entry__``: one Spark query and, where SQL can say the same
thing, one DuckDB oracle per operator of the inventory.

Every query reads the driver tables (whole tables, whole texts) through ``tweet_view`` or a scan.
Column names and types are aligned with the oracle; doubles are rounded to 6 places on both sides.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise KeyError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return deco


# Importing the query modules fills the two registries.
from . import q_clean, q_ml, q_model, q_profile, q_tokens  # noqa: E402,F401
