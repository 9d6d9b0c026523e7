"""Connected components of a table of edges by contraction, without ever gathering a component."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sedimenta.session import materialize, materialize_counting


def _parents(edges: DataFrame) -> DataFrame:
    """``node, parent``: every node that has a lesser neighbour under its least one, and then under the last of such parents.

    Least neighbours are combined in the tasks before the shuffle, so a node with very many edges is one row per task. A
    parent is less than its child, so there are no rounds; looking up the parent's parent doubles what is known.
    """
    known = materialize(edges.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("parent")), "parents")
    moved = 1
    while moved:
        further = known.select(F.col("node").alias("parent"), F.col("parent").alias("beyond"))
        step = known.join(further, "parent", "left").select(
            "node", F.coalesce("beyond", "parent").alias("parent"), F.col("beyond").isNotNull().alias("moved")
        )
        step, moved = materialize_counting(step, F.count_if("moved"), "parents")
        known = step.drop("moved")
    return known


def _contracted(edges: DataFrame, parents: DataFrame) -> DataFrame:
    """The distinct edges between parents, the greater end first."""
    ends = edges
    for end in ("u", "v"):
        over = parents.select(F.col("node").alias(end), F.col("parent").alias("_parent"))
        ends = ends.join(over, end, "left").withColumn(end, F.coalesce("_parent", end)).drop("_parent")
    return ends.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def component_roots(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, root``: the least node of its component, for all nodes but the roots.

    In each round every node goes under the least node that a falling path of least neighbours leads to, and the
    parents' edges remain. At least half of the nodes that have edges go, so rounds grow with the logarithm of the
    nodes; each is a few tables in the shared folder.
    """
    pairs = edges.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    left, n = materialize_counting(pairs, F.count(F.lit(1)), "edges")
    roots = left.select(F.col("u").alias("node"), F.col("u").alias("root")).limit(0)
    while n:
        parents = _parents(left)
        beyond = parents.select(F.col("node").alias("root"), F.col("parent").alias("_parent"))
        moved = roots.join(beyond, "root", "left").select("node", F.coalesce("_parent", "root").alias("root"))
        # a node goes under a parent once, so the two parts have no node in common
        roots = materialize(moved.unionByName(parents.withColumnRenamed("parent", "root")), "roots")
        left, n = materialize_counting(_contracted(left, parents), F.count(F.lit(1)), "edges")
    return roots
