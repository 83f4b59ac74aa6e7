"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandlens.session import materialize

MAX_ROUNDS = 60


def connected(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, label): every node of ``links`` with the smallest node that it reaches.

    Each round lowers every node's label, and the label's own label, to the smallest one
    among its neighbours, and then follows the label one step. Rounds are written tables, so
    a lost executor costs no earlier round. Nodes and labels are BIGINT."""
    ends = materialize(links.where(F.col(a) != F.col(b)).select(F.col(a).alias("u"), F.col(b).alias("v")).distinct(), "cc_links")
    edges = ends.union(ends.select(F.col("v").alias("u"), F.col("u").alias("v")))
    state = materialize(edges.groupBy(F.col("u").alias("node")).agg(F.least(F.col("u"), F.min("v")).alias("label")), "cc_labels")
    for _ in range(MAX_ROUNDS):
        near = edges.join(state.select(F.col("node").alias("v"), F.col("label").alias("m")), "v").groupBy("u").agg(F.min("m").alias("m"))
        own = state.join(near.withColumnRenamed("u", "node"), "node")
        hooks = own.select("node", F.least("label", "m").alias("label")).union(own.select(F.col("label").alias("node"), F.least("label", "m").alias("label")))
        lower = hooks.groupBy("node").agg(F.min("label").alias("label"))
        above = lower.select(F.col("node").alias("label"), F.col("label").alias("top"))
        moved = lower.join(above, "label").select("node", F.least("label", "top").alias("label"))
        following = materialize(moved, "cc_labels")
        changed = following.join(state.withColumnRenamed("label", "was"), "node").where("label <> was").limit(1).count()
        state = following
        if not changed:
            return state
    raise RuntimeError(f"no fixed point after {MAX_ROUNDS} rounds")
