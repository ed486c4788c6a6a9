"""Connected components of a link table, by hooking to the smallest neighbour, pointer jumping and contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from minutewise.llm.common import store


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root): for each node of a link the smallest node that it reaches.

    Each round hooks every node to its smallest neighbour, follows the hooks to their ends by doubling, and keeps
    the links between different ends. A round at least halves the nodes that are not alone, so rounds grow with the
    logarithm of the longest chain. Only minima are gathered by node, with map-side combining; nothing is collected.
    """
    ends = links.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a <> b")
    edges = store(ends.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    total = None
    while True:
        both = edges.select(F.col("a").alias("node"), F.col("b").alias("to")).unionByName(
            edges.select(F.col("b").alias("node"), F.col("a").alias("to")))
        hooks = store(both.groupBy("node").agg(F.min("to").alias("to")).select(
            "node", F.least("node", "to").alias("root")), "hooks")
        while True:
            up = hooks.select(F.col("node").alias("root"), F.col("root").alias("next"))
            jumped = store(hooks.join(up, "root", "left").select(
                "node", F.coalesce("next", "root").alias("root"), (F.coalesce("next", "root") != F.col("root")).alias("moved")), "jumps")
            hooks = jumped.select("node", "root")
            if jumped.where("moved").isEmpty():
                break
        if total is None:
            total = hooks
        else:
            step = hooks.select(F.col("node").alias("root"), F.col("root").alias("next"))
            total = store(total.join(step, "root", "left").select("node", F.coalesce("next", "root").alias("root")),
                          "roots")
        ra = hooks.select(F.col("node").alias("a"), F.col("root").alias("ra"))
        rb = hooks.select(F.col("node").alias("b"), F.col("root").alias("rb"))
        left = edges.join(ra, "a").join(rb, "b").where("ra <> rb")
        edges = store(left.select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct(), "links")
        if edges.isEmpty():
            return total
