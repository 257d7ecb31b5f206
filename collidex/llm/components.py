"""Connected components by joins: neighbours' smallest label, then a jump to the label's label."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from collidex.llm.common import saved


def components(edges: DataFrame) -> DataFrame:
    """``node, label`` for the ends of ``edges (a, b)``: the smallest id in the node's component.

    Each round is written, so lineage stays short; labels fall by neighbours and by
    doubling, so long chains take a logarithmic number of rounds.
    """
    both = saved(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "edges")
    lab = saved(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("label")), "labels")
    while True:
        near = both.join(lab.select(F.col("node").alias("b"), "label"), "b").groupBy("a").agg(F.min("label").alias("m"))
        nxt = lab.join(near, lab["node"] == near["a"]).select("node", F.col("label").alias("was"), F.least("label", "m").alias("label"))
        jump = lab.select(F.col("node").alias("label"), F.col("label").alias("next"))
        nxt = saved(nxt.join(jump, "label", "left").select(
            "node", "was", F.least("label", F.coalesce("next", "label")).alias("label")), "labels")
        lab = nxt.select("node", "label")
        if nxt.filter("label < was").isEmpty():
            return lab
