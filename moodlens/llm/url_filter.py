"""URL verdicts: rules first, then gradient-boosted trees on lexical features.

URLs that a rule decides are the labelled ones.  Trees are fitted (``pyspark.ml``) on all of them, from lengths,
depth, ratios, entropy and parameter counts of the URL and from statistics of its host suffixes: how often URLs of
that suffix were blocked.  For the labelled URLs themselves these statistics leave out the URL's own fold of hosts,
so that a suffix does not tell a row its own label.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.sizing import broadcast_if_small
from ..session import materialize

RULES = (("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block"))
LEXICAL = ("length", "host_length", "path_length", "depth", "labels", "digits", "host_digits", "entropy", "parameters", "hyphens", "escapes", "secure", "fragment")
FOLDS = 5
PRIOR_ROWS = 10.0


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    lower = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.coalesce(lower, F.lit("")), F.coalesce(path, F.lit(""))


def with_rules(urls: DataFrame, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    """Adds host, path, rule and rule_verdict (null where no rule fits) to a table with ``url``."""
    urls = urls.select("*", *[c.alias(n) for c, n in zip(host_and_path(F.col("url")), ("host", "path"))])
    rule = said = None
    # The longest rule first; of equally long ones, that with the longer host.
    for host, path, verdict in sorted(rules, key=lambda r: (-len(r[0] + r[1]), -len(r[0]), r)):
        fits = ((F.col("host") == host) | F.endswith(F.col("host"), F.lit("." + host))) & F.startswith(F.col("path"), F.lit(path))
        rule = F.when(fits, F.lit(host + path)) if rule is None else rule.when(fits, F.lit(host + path))
        said = F.when(fits, F.lit(verdict)) if said is None else said.when(fits, F.lit(verdict))
    none = F.lit(None).cast("string")
    return urls.select("*", (none if rule is None else rule).alias("rule"), (none if said is None else said).alias("rule_verdict"))


def lexical(url: str, host: str, path: str) -> list[float]:
    data = np.frombuffer(url.encode("utf-8", "surrogatepass"), np.uint8)
    n = len(data)
    share = np.bincount(data, minlength=1)[np.bincount(data, minlength=1) > 0] / max(n, 1)
    tail = url.split("#", 1)
    query = tail[0].split("?", 1)[1] if "?" in tail[0] else ""
    digit = (data >= 48) & (data <= 57)
    return [
        float(n), float(len(host)), float(len(path)), float(sum(1 for p in path.split("/") if p)), float(len(host.split(".")) if host else 0),
        float(digit.mean()) if n else 0.0, sum(c in "0123456789" for c in host) / max(len(host), 1), float(-(share * np.log2(share)).sum()) if n else 0.0,
        float(sum(1 for p in query.split("&") if p)), float(host.count("-")), float(url.count("%")), float(url[:6].lower() == "https:"), float(len(tail) > 1),
    ]


def lexical_features(urls: DataFrame) -> DataFrame:
    """Adds ``lexical`` (array of double) to a table with url, host, path."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in urls.schema) + ", lexical array<double>"

    def run(batches):
        for b in batches:
            rows = [lexical(u or "", h, p) for u, h, p in zip(*(b.column(c).to_pylist() for c in ("url", "host", "path")))]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(rows, pa.list_(pa.float64()))], names=[*b.schema.names, "lexical"])

    return urls.mapInArrow(run, schema)


SUFFIXES = {"last": 1, "last_two": 2}  # host labels in a suffix


def _suffix(n: int) -> Column:
    return F.substring_index("host", ".", -n)


class UrlModel:
    """Trees and suffix statistics fitted on all labelled URLs (``label``: 1 is blocked), about ``task_rows`` a task."""

    def __init__(self, labelled: DataFrame, task_rows: int, trees: int, depth: int):
        known = materialize(labelled.select("page_id", "url", "host", "path", "label", F.pmod(F.xxhash64("host"), F.lit(FOLDS)).alias("fold")))
        seen = known.agg(F.count("*").alias("n"), F.sum("label").alias("blocked")).first()
        self.rows, self.blocked = int(seen["n"]), int(seen["blocked"] or 0)
        self.trees = None
        if 0 < self.blocked < self.rows:
            self.rate = self.blocked / self.rows
            self.stats = {name: materialize(known.groupBy(_suffix(n).alias(name)).agg(F.count("*").alias("n"), F.sum("label").alias("b"))) for name, n in SUFFIXES.items()}
            train = known
            for name, n in SUFFIXES.items():
                own = known.groupBy(_suffix(n).alias(name), "fold").agg(F.count("*").alias("own_n"), F.sum("label").alias("own_b"))
                out = self.stats[name].join(own, name).select(name, "fold", (F.col("n") - F.col("own_n")).alias("n"), (F.col("b") - F.col("own_b")).alias("b"))
                train = self._rates(train.withColumn(name, _suffix(n)).join(broadcast_if_small(out), [name, "fold"], "left"), name)
            # Rows lie in their tasks by a hash and in order, so that a fit can be repeated.
            order = [F.xxhash64("page_id", "url"), "page_id", "url"]
            train = train.repartition(max(1, -(-self.rows // task_rows)), *order).sortWithinPartitions(*order)
            train = self._vector(lexical_features(train)).select("features", "label")
            self.trees = GBTClassifier(featuresCol="features", labelCol="label", maxIter=trees, maxDepth=depth, stepSize=0.3, seed=11).fit(train)

    def _rates(self, rows: DataFrame, name: str) -> DataFrame:
        n, b = F.coalesce("n", F.lit(0)), F.coalesce("b", F.lit(0))
        return rows.select(*[c for c in rows.columns if c not in (name, "n", "b")], ((b + PRIOR_ROWS * self.rate) / (n + PRIOR_ROWS)).alias(f"{name}_rate"), F.log1p(n.cast("double")).alias(f"{name}_rows"))

    def _vector(self, rows: DataFrame) -> DataFrame:
        own = F.array(*[f"{name}_{kind}" for name in SUFFIXES for kind in ("rate", "rows")])
        return rows.withColumn("features", array_to_vector(F.concat("lexical", own)))

    def score(self, urls: DataFrame) -> DataFrame:
        """Adds ``score``, the probability of a block, to a table with url, host, path."""
        if self.trees is None:  # labels of one kind, or none
            return urls.withColumn("score", F.lit(1.0 if self.rows and self.blocked == self.rows else 0.0))
        keep = urls.columns
        for name, n in SUFFIXES.items():
            urls = self._rates(urls.withColumn(name, _suffix(n)).join(broadcast_if_small(self.stats[name]), name, "left"), name)
        scored = self.trees.transform(self._vector(lexical_features(urls)))
        return scored.select(*keep, vector_to_array("probability")[1].alias("score"))


def url_verdicts(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, task_rows: int = 20_000, trees: int = 10, depth: int = 4) -> DataFrame:
    """Verdict ``allow`` or ``block`` for every row of ``pages``: that of the longest rule that fits, else the trees'.

    Input: ``page_id``, ``url`` (others are ignored, whatever their names).  Result: page_id, host, path, rule
    (null if none fits), verdict, score (of the trees, also where a rule decides).  ``rules``: (host, path,
    verdict), meant for some hundreds.  The trees learn from all URLs that a rule decides, so a URL counts as
    often as it occurs; ``task_rows`` sets how many of them a task of the fit holds.

    A null url, or one without ``://``, has an empty host and path and gets the trees' verdict, as empty text if
    null.  Each row is judged by itself, repeated ones alike; very long urls are read whole.  If no row, or only
    one kind, is labelled, the trees' verdict is that kind (none: allow).  An empty table gives an empty table.
    """
    rows = with_rules(pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url")), rules)
    labelled = rows.where(F.col("rule").isNotNull()).withColumn("label", (F.col("rule_verdict") == "block").cast("int"))
    model = UrlModel(labelled, task_rows, trees, depth)
    verdict = F.coalesce("rule_verdict", F.when(F.col("score") > 0.5, F.lit("block")).otherwise(F.lit("allow")))
    return model.score(rows).select("page_id", "host", "path", "rule", verdict.alias("verdict"), "score")
