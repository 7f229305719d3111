"""Random forest on sparse rows, grown level by level from relational histograms.

A document is its non-zero terms; a weight counts as a bin of a fixed geometric grid (eight to an octave).  Each
level is one pass over all trees at once: documents find their nodes by the splits so far (a nested expression),
the terms drawn for a node are counted by (tree, node, term, bin) and class, and what a node's documents without
the term hold follows by subtracting from the node's totals.  So only non-zeros of drawn terms are aggregated,
no row or histogram is dense, and the vocabulary needs no bound.  The driver holds the splits and class counts
of the trees, at most ``num_trees * 2 ** (max_depth + 1)`` rows.

Drawing a document is a Poisson(1) weight by the hash of its id (the distributed form of a bootstrap); drawing
terms for a node takes each term with probability ``sqrt(n) / n`` by an integer hash, and where none of these can
split the node, the first term by that hash which can.  Results do not depend on partitions.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .features import hash_bucket

OCTAVE, OFFSET = 8, 0.37  # the offset keeps common weights such as 1 / sqrt(2) off the edges of bins
PRIME = 2_147_483_647
# Cumulative Poisson(1) probabilities, in millionths: 0, at most 1, ... documents.
POISSON = [round(1e6 * math.exp(-1) * sum(1 / math.factorial(i) for i in range(k + 1))) for k in range(8)]


def weight_bin(x) -> Column:
    return F.floor(F.log2(x) * OCTAVE + OFFSET).cast("int")


def bin_edge(b: int) -> float:
    """The smallest weight of a bin."""
    return 2.0 ** ((b - OFFSET) / OCTAVE)


def draw_weight(key: str, tree: int, seed: int) -> Column:
    """How often a tree draws a document: Poisson(1) by hash."""
    u = hash_bucket(F.concat(F.col(key).cast("string"), F.lit(f"|{seed}|{tree}")), 1_000_000)
    return sum((F.when(u >= t, 1).otherwise(0) for t in POISSON[1:]), F.when(u >= POISSON[0], 1).otherwise(0))


def term_hash(tree, node, idx, seed: int) -> Column:
    """A number below ``PRIME`` for (tree, node, term), in 64-bit integers."""
    k = (node + tree * 64) * 7919 + (104_729 + 15_485_863 * (seed % 1000))
    a = (idx.cast("long") + k) % PRIME
    return ((a * a) % PRIME * 48_271 + k) % PRIME


@dataclass
class Node:
    counts: list[int]
    split: tuple[int, int] | None = None  # (term id, bin): documents with the term in that bin or above go right

    @property
    def pure(self) -> bool:
        return sum(c > 0 for c in self.counts) <= 1


@dataclass
class Forest:
    labels: list
    n_terms: int
    num_trees: int = 2
    max_depth: int = 5
    seed: int = 0
    nodes: dict = field(default_factory=dict)  # (tree, node) -> Node; children of i are 2 i and 2 i + 1

    def _leaf(self, tree: int, node: int, leaf) -> Column:
        """The node where a document ends, by nested conditions; ``leaf`` makes a column of it."""
        split = self.nodes[tree, node].split if (tree, node) in self.nodes else None
        if split is None:
            return leaf(tree, node)
        right = F.coalesce(F.try_element_at("bins", F.lit(split[0])) >= split[1], F.lit(False))
        return F.when(right, self._leaf(tree, 2 * node + 1, leaf)).otherwise(self._leaf(tree, 2 * node, leaf))

    def _histograms(self, train: DataFrame, chosen) -> DataFrame:
        """(tree, node, idx, bin, one weight per class) of the open nodes' non-zeros."""
        at = [F.struct(F.lit(t).alias("tree"), self._leaf(t, 1, lambda _, n: F.lit(n)).alias("node"), F.col(f"w{t}").alias("w")) for t in range(self.num_trees)]
        rows = train.select("label", "bins", F.explode(F.array(*at)).alias("_a")).where("_a.w > 0")
        rows = rows.select("label", "bins", "_a.*").where(chosen.nodes(F.col("tree"), F.col("node")))
        terms = rows.select("label", "tree", "node", "w", F.explode("bins").alias("idx", "bin")).where(chosen.terms())
        sums = [F.sum(F.when(F.col("label") == lab, F.col("w")).otherwise(0)).alias(f"c{i}") for i, lab in enumerate(self.labels)]
        return terms.groupBy("tree", "node", "idx", "bin").agg(*sums)

    def _best(self, hist: DataFrame, first: Column) -> list:
        """The best split of each node: (tree, node, idx, bin, right counts); ``first`` goes before the score."""
        n = range(len(self.labels))
        spark = hist.sparkSession
        open_nodes = [(t, i, *v.counts) for (t, i), v in self.nodes.items() if v.split is None]
        totals = spark.createDataFrame(open_nodes, "tree int, node int, " + ", ".join(f"t{i} long" for i in n))  # at most the nodes of a level
        upward = Window.partitionBy("tree", "node", "idx").orderBy(F.desc("bin"))
        right = hist.select("tree", "node", "idx", "bin", *[F.sum(f"c{i}").over(upward).alias(f"r{i}") for i in n])
        both = right.join(F.broadcast(totals), ["tree", "node"])
        r, left = sum(F.col(f"r{i}") for i in n), sum(F.col(f"t{i}") - F.col(f"r{i}") for i in n)
        both = both.withColumn("r", r).withColumn("l", left).where("r > 0 and l > 0")
        score = sum(F.col(f"r{i}") * F.col(f"r{i}") for i in n) / F.col("r") + sum((F.col(f"t{i}") - F.col(f"r{i}")) * (F.col(f"t{i}") - F.col(f"r{i}")) for i in n) / F.col("l")
        key = F.struct(first.alias("first"), (-score).alias("score"), "idx", "bin", *[f"r{i}" for i in n])
        return both.groupBy("tree", "node").agg(F.min(key).alias("b")).collect()

    def fit(self, rows: DataFrame) -> "Forest":
        """``rows``: (doc_id, label, bins map<int,int>)."""
        weights = [draw_weight("doc_id", t, self.seed).alias(f"w{t}") for t in range(self.num_trees)]
        train = materialize(rows.select("label", "bins", *weights))
        sums = [F.sum(F.when(F.col("label") == lab, F.col(f"w{t}")).otherwise(0)) for t in range(self.num_trees) for lab in self.labels]
        root = [int(v or 0) for v in train.agg(*sums).first()]
        for t in range(self.num_trees):
            self.nodes[t, 1] = Node(root[t * len(self.labels) : (t + 1) * len(self.labels)])
        for depth in range(self.max_depth):
            level = [k for k, v in self.nodes.items() if k[1] >> depth == 1 and not v.pure]
            if not level:
                break
            for drawn in (True, False):  # terms drawn for the node; failing that, all of them
                todo = [k for k in level if self.nodes[k].split is None]
                if not todo:
                    break
                chosen = _Chosen(todo, self.n_terms if drawn else None, self.seed)
                first = F.lit(0).cast("long") if drawn else term_hash(F.col("tree"), F.col("node"), F.col("idx"), self.seed)
                for b in self._best(self._histograms(train, chosen), first):
                    self._split(b["tree"], b["node"], b["b"])
        return self

    def _split(self, tree: int, node: int, b) -> None:
        here = self.nodes[tree, node]
        right = [int(b[f"r{i}"]) for i in range(len(self.labels))]
        here.split = (b["idx"], b["bin"])
        self.nodes[tree, 2 * node] = Node([t - r for t, r in zip(here.counts, right)])
        self.nodes[tree, 2 * node + 1] = Node(right)

    def transform(self, rows: DataFrame) -> DataFrame:
        """Adds ``probability`` (mean of the leaves' class shares) and ``prediction`` (ties: the smaller label)."""

        def share(tree: int, node: int) -> Column:
            counts = self.nodes[tree, node].counts
            return F.array(*[F.lit(c / max(sum(counts), 1)) for c in counts])

        leaves = [self._leaf(t, 1, share) for t in range(self.num_trees)]
        p = rows.select("*", *[leaf.alias(f"_p{t}") for t, leaf in enumerate(leaves)])
        mean = F.array(*[sum(F.col(f"_p{t}")[i] for t in range(self.num_trees)) / self.num_trees for i in range(len(self.labels))])
        p = p.select(*rows.columns, mean.alias("probability"))
        best = F.array_position("probability", F.array_max("probability")).cast("int")
        return p.withColumn("prediction", F.element_at(F.array(*[F.lit(float(lab)) for lab in self.labels]), best))

    def table(self, spark) -> DataFrame:
        """The trees as rows: tree, node, idx, bin, threshold (nulls at a leaf), counts."""
        out = [(t, n, *(v.split or (None, None)), bin_edge(v.split[1]) if v.split else None, v.counts) for (t, n), v in sorted(self.nodes.items())]
        return spark.createDataFrame(out, "tree int, node int, idx int, bin int, threshold double, counts array<long>")


class _Chosen:
    """Which nodes and terms a pass counts."""

    def __init__(self, todo: list, n_terms: int | None, seed: int):
        self.todo, self.n_terms, self.seed = todo, n_terms, seed

    def nodes(self, tree: Column, node: Column) -> Column:
        return F.concat_ws(":", tree, node).isin([f"{t}:{n}" for t, n in self.todo])

    def terms(self) -> Column:
        if self.n_terms is None:
            return F.lit(True)
        drawn = int(PRIME * max(1, math.isqrt(self.n_terms)) / self.n_terms)
        return term_hash(F.col("tree"), F.col("node"), F.col("idx"), self.seed) < drawn


def binned(rows: DataFrame, *keep: str) -> DataFrame:
    """Sparse rows (ids, x) with their non-zeros as ``bins`` (term id to bin)."""
    return rows.select(*keep, F.map_from_arrays("ids", F.transform("x", weight_bin)).alias("bins"))


def fit_forest(rows: DataFrame, n_terms: int, num_trees: int = 2, max_depth: int = 5, seed: int = 0) -> Forest:
    """Forest of training ``rows`` (doc_id, label, ids, x); ``n_terms`` is the size of the vocabulary."""
    labels = [r["label"] for r in rows.groupBy("label").count().orderBy("label").limit(1001).collect()]
    if len(labels) > 1000:
        raise ValueError("more than 1000 classes")
    return Forest(labels, max(n_terms, 1), num_trees, max_depth, seed).fit(binned(rows, "doc_id", "label"))
