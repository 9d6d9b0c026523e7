"""Grouped means over the silver table, as DataFrames and as SQL text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sedimenta.functions.numbers import mean_of_parts, mean_parts, rounded_mean, rounded_mean_sql
from sedimenta.sources.lake import quoted

# Output names of the two means.
MONTHLY = "media_valor_arrecadado"
HOURLY = "media_passageiros"
DAY = "dia"
HOUR = "hora"


def monthly_mean(
    df: DataFrame, keys: Sequence[str], value: str, digits: int = 2, out: str = MONTHLY, scale: int | None = None
) -> DataFrame:
    """Rounded mean of ``value`` per ``keys``, sorted; see ``rounded_mean`` for ``scale``.

    Partial sums are built before the shuffle, so a month that holds a third of all rows still sends
    one row per task.
    """
    return df.groupBy(*keys).agg(rounded_mean(F.col(value), digits, scale).alias(out)).orderBy(*keys)


def hourly_mean(
    df: DataFrame, ts: str, value: str, digits: int = 2, out: str = HOURLY, scale: int | None = None
) -> DataFrame:
    """Rounded mean of ``value`` per day and hour of ``ts``, sorted."""
    return (
        df.groupBy(F.to_date(ts).alias(DAY), F.hour(ts).alias(HOUR))
        .agg(rounded_mean(F.col(value), digits, scale).alias(out))
        .orderBy(DAY, HOUR)
    )


def monthly_mean_sql(
    view: str, keys: Sequence[str], value: str, digits: int = 2, out: str = MONTHLY, scale: int | None = None
) -> str:
    """The monthly mean as SQL text over a table or view; see ``rounded_mean`` for ``scale``."""
    names = ", ".join(quoted(k) for k in keys)
    return (
        f"SELECT {names}, {rounded_mean_sql(quoted(value), digits, scale)} AS {quoted(out)} "
        f"FROM {quoted(view)} GROUP BY {names} ORDER BY {names}"
    )


def hourly_mean_sql(
    view: str, ts: str, value: str, digits: int = 2, out: str = HOURLY, scale: int | None = None
) -> str:
    """The hourly mean as SQL text; grouping uses the select list's names."""
    return (
        f"SELECT DATE({quoted(ts)}) AS {DAY}, HOUR({quoted(ts)}) AS {HOUR}, "
        f"{rounded_mean_sql(quoted(value), digits, scale)} AS {quoted(out)} "
        f"FROM {quoted(view)} GROUP BY {DAY}, {HOUR} ORDER BY {DAY}, {HOUR}"
    )


def mean_parts_table(
    df: DataFrame, keys: Sequence[str], amount: str, ts: str, passengers: str, scale: int = 2
) -> DataFrame:
    """Exact sums and counts per partition, day and hour, from which both means follow.

    A few hundred rows per month, however many trips it has; parts of different partitions add up.
    """
    columns = [
        column.alias(f"{name}_{part}")
        for name, value in (("amount", amount), ("passengers", passengers))
        for part, column in mean_parts(F.col(value), scale).items()
    ]
    return df.groupBy(*keys, F.to_date(ts).alias(DAY), F.hour(ts).alias(HOUR)).agg(*columns)


def monthly_mean_of_parts(
    parts: DataFrame, keys: Sequence[str], digits: int = 2, out: str = MONTHLY, scale: int = 2
) -> DataFrame:
    """``monthly_mean`` from the parts of all partitions."""
    return parts.groupBy(*keys).agg(mean_of_parts("amount", digits, scale).alias(out)).orderBy(*keys)


def hourly_mean_of_parts(parts: DataFrame, digits: int = 2, out: str = HOURLY, scale: int = 2) -> DataFrame:
    """``hourly_mean`` from the parts of all partitions."""
    return parts.groupBy(DAY, HOUR).agg(mean_of_parts("passengers", digits, scale).alias(out)).orderBy(DAY, HOUR)


def query_view(spark: SparkSession, df: DataFrame, view: str, text: str) -> DataFrame:
    """Run SQL text with ``df`` registered under ``view``."""
    df.createOrReplaceTempView(view)
    return spark.sql(text)
