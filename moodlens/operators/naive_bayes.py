"""Naive Bayes as relational aggregation over long-form features ``(doc_id, term, x)``.

Fitting is two grouped sums (per class and term, per class); scoring is one join of the test
features with the per-term class statistics and one grouped sum per document.  The model is a
DataFrame (one row per term), never a matrix on the driver; only the per-class constants (one
value per class, bounded by ``MAX_CLASSES``) are collected.  Smoothing follows Spark ML's
``NaiveBayes``: priors ``ln(n_c + λ) − ln(N + Cλ)``.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .sizing import broadcast_if_small

MAX_CLASSES = 1000


def _class_rows(docs: DataFrame, label_col: str) -> list:
    rows = docs.groupBy(label_col).agg(F.count(F.lit(1)).alias("n")).orderBy(label_col).limit(MAX_CLASSES + 1).collect()
    if len(rows) > MAX_CLASSES:
        raise ValueError(f"more than {MAX_CLASSES} classes")
    return [(r[label_col], r["n"]) for r in rows]


def _argmax(scores: list[tuple[float, Column]]) -> Column:
    """Label of the largest score; ties go to the smaller label (like ``argmax``)."""
    best = F.array_max(F.array(*[F.struct(s.alias("s"), F.lit(-float(lab)).alias("neg")) for lab, s in scores]))
    return -best["neg"]


@dataclass
class NaiveBayesModel:
    kind: str
    smoothing: float
    classes: list  # [(label, n_docs)]
    term_stats: DataFrame  # (term, s_<i> ...) one column per class
    log_prior: dict
    consts: dict  # per class constants used at scoring
    vocab_size: int
    bounded: bool

    def _per_doc(self, features: DataFrame) -> DataFrame:
        side = broadcast_if_small(self.term_stats) if self.bounded else self.term_stats
        j = features.join(side, "term")
        lam = self.smoothing
        aggs = []
        for i, _ in enumerate(self.classes):
            s = F.coalesce(F.col(f"s_{i}"), F.lit(0.0))
            if self.kind == "multinomial":
                aggs.append(F.sum(F.col("x") * F.log(s + lam)).alias(f"S_{i}"))
            else:
                n_c = float(self.classes[i][1])
                # log p − log(1 − p) for a term present in the document
                aggs.append(F.sum(F.log(s + lam) - F.log(n_c - s + lam)).alias(f"S_{i}"))
        aggs.append(F.sum("x").alias("X"))
        return j.groupBy("doc_id").agg(*aggs)

    def transform(self, features: DataFrame, docs: DataFrame) -> DataFrame:
        """Score every row of ``docs`` (``doc_id`` plus any columns); documents without known terms
        get the prior only.  Adds ``prediction`` (double) and one ``score_<label>`` per class."""
        if self.kind == "bernoulli":
            features = features.withColumn("x", F.when(F.col("x") > 0, F.lit(1.0)).otherwise(F.lit(0.0))).filter("x > 0")
        per_doc = self._per_doc(features)
        out = docs.join(per_doc, "doc_id", "left")
        scores = []
        for i, (lab, _) in enumerate(self.classes):
            S = F.coalesce(F.col(f"S_{i}"), F.lit(0.0))
            X = F.coalesce(F.col("X"), F.lit(0.0))
            if self.kind == "multinomial":
                sc = F.lit(self.log_prior[lab]) + S - X * F.lit(self.consts[lab])
            else:
                sc = F.lit(self.log_prior[lab] + self.consts[lab]) + S
            scores.append((lab, sc))
        cols = [sc.alias(f"score_{int(lab)}") for lab, sc in scores]
        pred = _argmax(scores).cast("double").alias("prediction")
        drop = [c for c in out.columns if c.startswith("S_") or c == "X"]
        return out.select(*[c for c in out.columns if c not in drop], *cols, pred)


def fit_naive_bayes(features: DataFrame, docs: DataFrame, label_col: str = "label", kind: str = "multinomial",
                    smoothing: float = 1.0, vocab_size: int | None = None, bounded: bool = False) -> NaiveBayesModel:
    """Fit on training features ``(doc_id, term, x)`` and training docs ``(doc_id, label)``; features that
    carry their document's ``label`` need no join.

    ``vocab_size`` is the number of features (defaults to the distinct training terms).
    """
    classes = _class_rows(docs, label_col)
    labs = [lab for lab, _ in classes]
    n_total = sum(n for _, n in classes)
    lam = float(smoothing)
    log_prior = {lab: math.log(n + lam) - math.log(n_total + lam * len(classes)) for lab, n in classes}
    feats = features if "label" in features.columns else features.join(docs.select("doc_id", F.col(label_col).alias("label")), "doc_id")
    if kind == "bernoulli":
        feats = feats.filter(F.col("x") > 0).withColumn("x", F.lit(1.0))
    elif kind != "multinomial":
        raise ValueError(kind)
    per_class_term = feats.groupBy("term").pivot("label", labs).agg(F.sum("x"))
    # The model table (one row per term) is read by the constants below, the size check and every
    # scoring pass: written once.
    term_stats = materialize(per_class_term.toDF("term", *[f"s_{i}" for i in range(len(labs))]))
    if vocab_size is None:
        vocab_size = features.select("term").distinct().count()
    consts = {}
    if kind == "multinomial":
        totals = term_stats.agg(*[F.coalesce(F.sum(f"s_{i}"), F.lit(0.0)) for i in range(len(labs))]).first()
        for lab, total in zip(labs, totals):
            consts[lab] = math.log(float(total) + lam * vocab_size)
    else:
        # Σ over the whole vocabulary of log(1 − p_ct): seen terms from the statistics, the rest
        # share one value.
        # Each summand is log(1 − p) itself (small), not log(n − s + λ) and log(n + 2λ) apart: two
        # large sums over the vocabulary would cancel and lose digits.
        aggs = []
        for i, (lab, n) in enumerate(classes):
            s = F.col(f"s_{i}")
            denom = math.log(n + 2 * lam)
            aggs += [
                F.sum(F.when(s.isNotNull(), F.log(F.lit(float(n)) - s + lam) - F.lit(denom))).alias(f"q{i}"),
                F.count(s).alias(f"k{i}"),
            ]
        row = term_stats.agg(*aggs).collect()[0]
        for i, (lab, n) in enumerate(classes):
            seen_sum = row[f"q{i}"] or 0.0
            seen = row[f"k{i}"]
            consts[lab] = seen_sum + (vocab_size - seen) * (math.log(n + lam) - math.log(n + 2 * lam))
            # present terms: log p − log q = [log(s+λ) − denom] − [log(n−s+λ) − denom]
    return NaiveBayesModel(kind, lam, classes, term_stats, log_prior, consts, vocab_size, bounded)
