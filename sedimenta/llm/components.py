"""Connected components of an edge table, without ever gathering a component anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from sedimenta.session import materialize


def _written(edges: DataFrame, label: str) -> tuple[DataFrame, tuple[int, int]]:
    """The distinct edges as a table in the shared folder, and a fingerprint of the set."""
    seen = Observation()
    mix = F.xxhash64("u", "v") % F.lit(1 << 40)
    stamped = edges.distinct().observe(
        seen, F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(mix), F.lit(0)).alias("mix")
    )
    table = materialize(stamped, label)
    return table, (seen.get["n"], seen.get["mix"])


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node hands its larger neighbours over to its smallest neighbour or itself."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    return both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node hands its smaller neighbours and itself over to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    handed = edges.join(least, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return handed.union(least.select("u", F.col("m").alias("v")))


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root``, the least node of its component, for all nodes but the roots.

    ``edges`` has comparable columns ``a`` and ``b``. Large and small stars alternate until nothing
    changes, in a number of rounds that grows with the logarithm of the nodes. Each round is one
    table in the shared folder, so a lost executor repeats one round at most.
    """
    pairs = edges.filter("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    table, stamp = _written(pairs, "edges")
    while stamp[0]:
        table, after = _written(_small_star(_large_star(table)), "stars")
        if after == stamp:
            break
        stamp = after
    return table.select(F.col("u").alias("node"), F.col("v").alias("root"))
