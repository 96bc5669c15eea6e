"""Connected components by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cuadre.llm.common import written


def connected(edges: DataFrame) -> DataFrame:
    """(node, component) of each node of `edges` (a, b: longs); the component is its smallest node.

    In each round every node points to its smallest neighbour or to itself, pointers are doubled until all point
    to roots, and the graph of the roots is the next round's. A smallest node is a root in every round. Edges shrink
    from round to round, and minima are taken before rows are exchanged, so a node with many edges costs no task
    more than others.
    """
    left = written(edges.select("a", "b").where("a <> b").distinct(), "edges")
    assigned = left.select(F.col("a").alias("node"), F.col("a").alias("component")).limit(0)
    first = True
    while left.limit(1).count():
        roots = _roots(left)
        if first:
            assigned, first = roots, False
        else:
            moved = roots.select(F.col("node").alias("was"), F.col("component").alias("now"))
            assigned = assigned.join(moved, F.col("component") == F.col("was"), "left")
            assigned = written(assigned.select("node", F.coalesce("now", "component").alias("component")), "components")
        for end in ("a", "b"):
            root = roots.select(F.col("node").alias(end), F.col("component").alias(f"root_{end}"))
            left = left.join(root, end)
        left = left.select(F.col("root_a").alias("a"), F.col("root_b").alias("b"))
        left = written(left.where("a <> b").distinct(), "edges")
    return assigned


def _roots(edges: DataFrame) -> DataFrame:
    """(node, component): where the pointers to smallest neighbours lead."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    pointers = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least"))
    pointers = written(pointers.select("node", F.least("node", "least").alias("component")), "pointers")
    while True:
        above = pointers.select(F.col("node").alias("of"), F.col("component").alias("next"))
        doubled = pointers.join(above, F.col("component") == F.col("of")).select(
            "node", F.col("next").alias("component"), (F.col("next") != F.col("component")).alias("moved")
        )
        doubled = written(doubled, "pointers")
        pointers = doubled.select("node", "component")
        if not doubled.where("moved").limit(1).count():
            return pointers
