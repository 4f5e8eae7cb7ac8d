"""Connected components of a graph given by its edges, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.staging import Stages


def connected_components(edges: DataFrame, stages: Stages, label: str = "components") -> DataFrame:
    """``node, root`` for every node of ``edges`` (columns ``a``, ``b``), root the smallest node.

    Each round hooks every node to its smallest neighbour, shortens the chains that result
    and contracts the edges; what is left shrinks by at least half. All tables are stage
    tables, so that no round repeats another's work. No edge and no label leaves the executors.
    """
    left = stages(edges.select("a", "b").filter("a <> b").distinct(), f"{label}-edges")
    nodes = left.select(F.col("a").alias("node")).union(left.select("b")).distinct()
    roots = stages(nodes.withColumn("root", F.col("node")), f"{label}-roots")
    while not left.isEmpty():
        both = left.union(left.select("b", "a"))
        hooks = both.groupBy("a").agg(F.min("b").alias("b"))
        parents = stages(
            hooks.select(F.col("a").alias("node"), F.least("a", "b").alias("parent")),
            f"{label}-parents",
        )
        while True:
            upper = parents.select(F.col("node").alias("parent"), F.col("parent").alias("top"))
            jumped = stages(
                parents.join(upper, "parent").select(
                    "node", F.col("top").alias("parent"), (F.col("top") < F.col("parent")).alias("moved")
                ),
                f"{label}-parents",
            )
            parents = jumped.select("node", "parent")
            if jumped.filter("moved").isEmpty():
                break
        above = parents.select(F.col("node").alias("root"), "parent")
        roots = stages(
            roots.join(above, "root", "left").select(
                "node", F.coalesce("parent", "root").alias("root")
            ),
            f"{label}-roots",
        )
        tops = {end: parents.select(F.col("node").alias(end), F.col("parent").alias(f"top_{end}")) for end in "ab"}
        left = stages(
            left.join(tops["a"], "a")
            .join(tops["b"], "b")
            .select(F.col("top_a").alias("a"), F.col("top_b").alias("b"))
            .filter("a <> b")
            .distinct(),
            f"{label}-edges",
        )
    return roots
