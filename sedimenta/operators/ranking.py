"""Positions in a global order without bringing all rows into one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sedimenta.session import materialize


def with_running_total(df: DataFrame, order: Sequence[str], weight: Column, out: str) -> DataFrame:
    """Add the sum of ``weight`` over all rows strictly before each row in ``order``.

    ``order`` must identify rows. Rows are range-partitioned and summed per range first; the only
    unpartitioned step runs over one row per range.
    """
    parts = materialize(
        df.repartitionByRange(*order)
        .withColumn("_range", F.spark_partition_id())
        .withColumn("_weight", weight.cast("long")),
        "ranges",
    )
    sums = parts.groupBy("_range").agg(F.sum("_weight").alias("_sum"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("_range", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_offset"))
    within = (
        Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        parts.withColumn("_inside", F.coalesce(F.sum("_weight").over(within), F.lit(0)))
        .join(F.broadcast(offsets), "_range")  # one row per range
        .withColumn(out, F.col("_offset") + F.col("_inside"))
        .drop("_range", "_weight", "_offset", "_inside")
    )


def with_ordinal(df: DataFrame, order: Sequence[str], out: str = "ordinal") -> DataFrame:
    """Number rows 1, 2, 3 ... in ``order``."""
    return with_running_total(df, order, F.lit(1), out).withColumn(out, (F.col(out) + 1).cast("int"))
