"""Connected components with the smallest node as label.

Each round hooks every node to its smallest neighbour, flattens the resulting forest by pointer
jumping and contracts the graph to the forest's roots.  At most half of the nodes that still have an
edge stay roots, so the rounds grow with the logarithm of the graph.  Components without edges to others leave the
rounds.  All steps are equi-joins and min-aggregates with
partial sums, so a node with very many edges is neither collected nor squared; a join with many rows for one root
has one row on its other side, which adaptive execution splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from propweave.plans.lineage import cut


def _counted(df: DataFrame, what: str, condition: str = "true", tidy: bool = False) -> tuple[DataFrame, int]:
    """df cut, and how many of its rows meet a condition, counted as they are written."""
    seen = Observation()
    out = cut(df.observe(seen, F.count_if(F.expr(condition)).alias("n")), what, tidy)
    return out, seen.get["n"]


def _roots(parent: DataFrame) -> DataFrame:
    """(node, p) with p the root of the node's tree; parent is (node, p), a root its own parent."""
    while True:
        up = parent.select(F.col("node").alias("p"), F.col("p").alias("pp"))
        jumped, moved = _counted(parent.join(up, "p").select("node", F.col("pp").alias("p"), (F.col("pp") != F.col("p")).alias("moved")), "parents", "moved")
        parent = jumped.select("node", "p")
        if not moved:
            return parent


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """(node, component) for every node with an edge; edges with a null end are dropped, a loop keeps
    its node as a component of its own, and repeated edges count once."""
    e = edges.select(F.col(src).alias("u"), F.col(dst).alias("v")).where("u is not null and v is not null")
    rest, left = _counted(e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges", "u <> v")
    labels = None
    while True:
        both = rest.select("u", "v").unionAll(rest.select(F.col("v").alias("u"), F.col("u").alias("v")))
        parent = cut(both.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("p")).select("node", F.least("node", "p").alias("p")), "parents", False)
        parent = _roots(parent) if left else parent
        if labels is None:
            labels = parent
        else:
            to = parent.select(F.col("node").alias("p"), F.col("p").alias("root"))
            labels = cut(labels.join(to, "p", "left").select("node", F.coalesce("root", "p").alias("p")), "labels", False)
        if not left:
            return labels.select("node", F.col("p").alias("component"))
        a = parent.select(F.col("node").alias("u"), F.col("p").alias("a"))
        b = parent.select(F.col("node").alias("v"), F.col("p").alias("b"))
        ends = rest.where("u <> v").join(a, "u").join(b, "v").where("a <> b")
        rest, left = _counted(ends.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges", tidy=True)
        if not left:
            return labels.select("node", F.col("p").alias("component"))
