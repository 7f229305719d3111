"""Connected components of a link table by joins: minimum labels, hooked to roots, with pointer jumping."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.sizing import broadcast_if_small
from ..session import ensure_checkpoint_dir


def connected_components(links: DataFrame) -> DataFrame:
    """``links`` (a long, b long), any direction, repeats allowed.  Returns (node, comp) for each linked node,
    comp being the smallest node of its component.  Each round is written as a table, so a lost executor costs
    one round; what is read back is a few numbers."""
    spark = links.sparkSession
    base = os.path.join(ensure_checkpoint_dir(spark), "components", uuid.uuid4().hex)

    def written(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{base}/{name}")
        return spark.read.parquet(f"{base}/{name}")

    links = links.where("a <> b")
    edges = written(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = written(edges.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("comp")), "labels-0")
    step = 0
    while True:
        step += 1
        # The smallest label among the neighbours is offered to the node and to the root of its own label.
        seen = edges.join(labels, F.col("b") == F.col("node")).groupBy("a").agg(F.min("comp").alias("offer"))
        at = labels.join(seen, F.col("node") == F.col("a"))
        better = at.where("offer < comp").select("node", "comp", "offer")
        roots = better.groupBy(F.col("comp").alias("root")).agg(F.min("offer").alias("hook"))
        now = at.select("node", "comp", "offer").join(roots, F.col("node") == F.col("root"), "left")
        now = now.select("node", F.least("comp", "offer", "hook").alias("comp"))
        # Pointer jumping over the distinct roots that themselves have moved: a component of any size is one row.
        now = written(now, f"hooked-{step}")
        jump = now.where("comp < node").select(F.col("node").alias("up"), F.col("comp").alias("up_comp"))
        moved = now.select(F.col("comp").alias("up")).distinct().join(jump, "up")
        now = now.join(broadcast_if_small(written(moved, f"moved-{step}")), F.col("comp") == F.col("up"), "left")
        now = written(now.select("node", F.least("comp", "up_comp").alias("comp")), f"labels-{step}")
        changed = now.join(labels.withColumnRenamed("comp", "old"), "node").where("comp <> old").limit(1).count()
        labels = now
        if not changed:
            return labels
