"""Polarity → label maps, as plain ``CASE WHEN`` columns (no Python UDF)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import _col


def label_ternary(polarity="Polarity") -> Column:
    """4 → 2.0 (positive), 2 → 1.0 (neutral), anything else, NULL included → 0.0."""
    p = _col(polarity)
    return F.when(p == 4, F.lit(2.0)).when(p == 2, F.lit(1.0)).otherwise(F.lit(0.0))


def label_binary(polarity="Polarity") -> Column:
    """4 → 1.0, anything else, NULL included → 0.0."""
    p = _col(polarity)
    return F.when(p == 4, F.lit(1.0)).otherwise(F.lit(0.0))


def label_replace(label="label", mapping: dict | None = None) -> Column:
    """Value replacement that leaves unmapped values (and NULL) unchanged: 4 → 1, 2 stays 2."""
    mapping = {4: 1} if mapping is None else mapping
    c = _col(label)
    out = None
    for k, v in mapping.items():
        out = (F.when(c == k, F.lit(v)) if out is None else out.when(c == k, F.lit(v)))
    return c if out is None else out.otherwise(c)


def class_name(label="label", names=("Negative", "Positive")) -> Column:
    c = _col(label).cast("int")
    out = None
    for i, n in enumerate(names):
        out = F.when(c == i, F.lit(n)) if out is None else out.when(c == i, F.lit(n))
    return out
