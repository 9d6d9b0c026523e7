"""Data-quality expectations, evaluated together in one aggregation, and column profiles."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DateType,
    DoubleType,
    FloatType,
    FractionalType,
    NumericType,
    StringType,
    StructType,
    TimestampNTZType,
    TimestampType,
)

from sedimenta.operators.ranking import with_running_total
from sedimenta.session import materialize

REPORT_SCHEMA = "expectation string, column string, evaluated long, violations long, success boolean"
QUANTILES = (0.25, 0.5, 0.75)


class QualityError(Exception):
    """At least one expectation failed."""


@dataclass(frozen=True)
class Expectation:
    """One check on one column.

    Bounds are inclusive unless ``hi_exclusive``; range and set checks skip nulls, which ``not_null``
    reports. ``mostly`` is the share of evaluated rows that must pass.
    """

    kind: str
    column: str
    lo: Any = None
    hi: Any = None
    hi_exclusive: bool = False
    values: tuple[str, ...] = ()
    mostly: float = 1.0


def exists(column: str) -> Expectation:
    return Expectation("exists", column)


def not_null(column: str, mostly: float = 1.0) -> Expectation:
    return Expectation("not_null", column, mostly=mostly)


def between(
    column: str, lo: Any = None, hi: Any = None, hi_exclusive: bool = False, mostly: float = 1.0
) -> Expectation:
    if lo is None and hi is None:
        raise ValueError("a range needs at least one bound")
    return Expectation("between", column, lo, hi, hi_exclusive, mostly=mostly)


def in_set(column: str, values: Sequence[str], mostly: float = 1.0) -> Expectation:
    return Expectation("in_set", column, values=tuple(values), mostly=mostly)


def _bad(e: Expectation, schema: StructType) -> Column:
    """True where a non-null value breaks the expectation."""
    value = F.col(f"`{e.column}`")
    if e.kind == "in_set":
        return ~value.cast("string").isin(*e.values)
    declared = schema[e.column].dataType
    # bounds take the column's type, so that a float meets a bound that is written like it; a whole
    # number keeps a bound with a fraction as it is
    typed = isinstance(declared, (DateType, TimestampType, TimestampNTZType, FractionalType))

    def bound(x: Any) -> Column:
        return F.lit(x).cast(declared) if typed or isinstance(x, str) else F.lit(x)

    tests = []
    if e.lo is not None:
        tests.append(value < bound(e.lo))
    if e.hi is not None:
        tests.append(value >= bound(e.hi) if e.hi_exclusive else value > bound(e.hi))
    return tests[0] if len(tests) == 1 else tests[0] | tests[1]


def suite_metrics(suite: Sequence[Expectation], schema: StructType) -> list[Column]:
    """Aggregates ``e0, v0, e1, v1 ...``: evaluated and violating rows per expectation.

    They can be computed by ``agg`` or observed during a write, without a scan of their own.
    """
    columns = []
    for i, e in enumerate(suite):
        if e.column not in schema.names:
            evaluated, violations = F.count(F.lit(1)) * 0, F.count(F.lit(1)) * 0 + 1
        elif e.kind == "exists":
            evaluated = violations = F.count(F.lit(1)) * 0
        elif e.kind == "not_null":
            evaluated = F.count(F.lit(1))
            violations = F.count_if(F.col(f"`{e.column}`").isNull())
        elif e.kind in ("between", "in_set"):
            evaluated = F.count(f"`{e.column}`")
            violations = F.count_if(_bad(e, schema))
        else:
            raise ValueError(f"unknown expectation {e.kind!r}")
        columns += [evaluated.alias(f"e{i}"), violations.alias(f"v{i}")]
    return columns


def passed(e: Expectation, evaluated: Any, violations: Any) -> Any:
    """Whether enough rows meet ``e``; for numbers and for columns."""
    if e.mostly >= 1.0:
        return violations == 0
    return evaluated - violations >= evaluated * e.mostly - 1e-9


def quality_report(df: DataFrame, suite: Sequence[Expectation]) -> DataFrame:
    """Report ``expectation, column, evaluated, violations, success`` of the suite, in one pass."""
    if not suite:
        return df.sparkSession.createDataFrame([], REPORT_SCHEMA)
    counted = df.agg(*suite_metrics(suite, df.schema))
    rows = [
        F.struct(
            F.lit(e.kind).alias("expectation"),
            F.lit(e.column).alias("column"),
            F.col(f"e{i}").alias("evaluated"),
            F.col(f"v{i}").alias("violations"),
            passed(e, F.col(f"e{i}"), F.col(f"v{i}")).alias("success"),
        )
        for i, e in enumerate(suite)
    ]
    return counted.select(F.inline(F.array(*rows)))


def label(e: Expectation) -> str:
    """A check by its kind, column and settings, as in ``between(fare, 0.01, None)``."""
    settings = {"between": (e.lo, e.hi), "in_set": e.values}.get(e.kind, ())
    end = " exclusive" if e.hi_exclusive else ""
    return f"{e.kind}({', '.join(map(str, (e.column, *settings)))}{end})"


def failed_checks(suite: Sequence[Expectation], schema: StructType) -> Column:
    """The labels of the checks that a row fails, in the order of the suite.

    What only the table as a whole can fail (a column that is not there, a share of rows) has no row, and is
    in the report; a check with ``mostly`` names each row that breaks it.
    """
    # no label is empty; taking out an empty text is compiled, taking out nulls calls a function for each element
    tests = [F.when(bad, F.lit(label(e))).otherwise(F.lit("")) for e, bad in _row_checks(suite, schema)]
    return F.array_remove(F.array(*tests), "") if tests else F.array().cast("array<string>")


def _row_checks(suite: Sequence[Expectation], schema: StructType) -> list[tuple[Expectation, Column]]:
    """The checks that a row can fail, each with whether it does; never null."""
    return [
        (e, F.col(f"`{e.column}`").isNull() if e.kind == "not_null" else F.coalesce(_bad(e, schema), F.lit(False)))
        for e in suite
        if e.column in schema.names and e.kind != "exists"
    ]


def violations(df: DataFrame, suite: Sequence[Expectation], out: str = "failed") -> DataFrame:
    """The rows that fail a check, with the array of all checks they fail; built-in expressions, no shuffle.

    Rows are chosen by the checks themselves, so the array is made once, and for the rows that fail only.
    """
    fails = reduce(lambda a, b: a | b, [bad for _, bad in _row_checks(suite, df.schema)], F.lit(False))
    return df.where(fails).withColumn(out, failed_checks(suite, df.schema))


def audit(df: DataFrame, suite: Sequence[Expectation], path: str, out: str = "failed") -> DataFrame:
    """Write the violating rows to ``path`` and return the report, both from one scan.

    The report's counts are observed below the filter, in the job that writes the rows.
    """
    if not suite:
        violations(df, suite, out).write.mode("overwrite").parquet(path)
        return quality_report(df, suite)
    seen = Observation()
    observed = df.observe(seen, *suite_metrics(suite, df.schema))
    violations(observed, suite, out).write.mode("overwrite").parquet(path)
    return report_from_metrics(df.sparkSession, suite, seen.get)


def report_from_metrics(spark: SparkSession, suite: Sequence[Expectation], metrics: dict[str, int]) -> DataFrame:
    """The same report from observed aggregates."""
    rows = [
        (e.kind, e.column, metrics[f"e{i}"], metrics[f"v{i}"], bool(passed(e, metrics[f"e{i}"], metrics[f"v{i}"])))
        for i, e in enumerate(suite)
    ]
    return spark.createDataFrame(rows, REPORT_SCHEMA)


def check(report: DataFrame) -> DataFrame:
    """One row ``success``: did every expectation hold; an empty report holds."""
    return report.agg(F.coalesce(F.every("success"), F.lit(True)).alias("success"))


def enforce(report: DataFrame) -> None:
    """Raise ``QualityError`` unless the whole report holds."""
    if not check(report).first().success:
        failed = [f"{r.expectation}({r.column})" for r in report.where(~F.col("success")).collect()]
        raise QualityError(", ".join(failed))


def validate(df: DataFrame, suite: Sequence[Expectation], on_fail: str = "warn") -> tuple[DataFrame, DataFrame]:
    """The unchanged ``df`` and its report; with ``on_fail="raise"`` a failed check stops the caller."""
    if on_fail not in ("warn", "raise"):
        raise ValueError(f"unknown reaction {on_fail!r}")
    report = quality_report(df, suite)
    if on_fail == "raise":
        enforce(report)
    return df, report


def write_report(report: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Store a report as Parquet or JSON."""
    report.write.mode("overwrite").format(fmt).save(path)


def _profiled(df: DataFrame) -> list:
    kinds = (NumericType, StringType, DateType, TimestampType, TimestampNTZType)
    return [f for f in df.schema if isinstance(f.dataType, kinds)]


def _number(field) -> Column:
    kind = NumericType
    return F.col(f"`{field.name}`").cast("double") if isinstance(field.dataType, kind) else F.lit(None).cast("double")


def _base_rows(df: DataFrame, extra: dict[str, dict[str, Column]]) -> DataFrame:
    """Counts, bounds and means of all columns in one aggregation, one output row per column."""
    fields = _profiled(df)
    aggregates = [F.count(F.lit(1)).alias("n")]
    rows = []
    for i, f in enumerate(fields):
        c = F.col(f"`{f.name}`")
        aggregates += [
            F.count(c).alias(f"c{i}"),
            F.min(c).cast("string").alias(f"lo{i}"),
            F.max(c).cast("string").alias(f"hi{i}"),
            F.round(F.avg(_number(f)), 6).alias(f"m{i}"),
            *[column.alias(f"{name}{i}") for name, column in extra.get(f.name, {}).items()],
        ]
        rows.append(
            F.struct(
                F.lit(f.name).alias("column"),
                F.lit(f.dataType.simpleString()).alias("type"),
                F.col("n"),
                (F.col("n") - F.col(f"c{i}")).alias("nulls"),
                F.col(f"lo{i}").alias("min"),
                F.col(f"hi{i}").alias("max"),
                F.col(f"m{i}").alias("mean"),
                *[F.col(f"{name}{i}").alias(name) for name in extra.get(f.name, {})],
            )
        )
    return df.agg(*aggregates).select(F.inline(F.array(*rows)))


def value_counts(df: DataFrame, digests: bool = False) -> DataFrame:
    """``column, txt, num, weight``: each distinct non-null value of each column and its count.

    Equal values are added up before the shuffle, and a value held by a third of all rows is one row
    afterwards. With ``digests`` the SHA-256 of a text stands for it, which is enough to tell
    texts apart and keeps whole documents out of the shuffle.
    """
    pieces = []
    for f in _profiled(df):
        approximate = isinstance(f.dataType, (FloatType, DoubleType))
        text = F.lit(None).cast("string") if approximate else F.col(f"`{f.name}`").cast("string")
        if digests and isinstance(f.dataType, StringType):
            text = F.sha2(text, 256)
        pieces.append(F.struct(F.lit(f.name).alias("column"), text.alias("txt"), _number(f).alias("num")))
    long = df.select(F.inline(F.array(*pieces)))
    return (
        long.where(F.col("txt").isNotNull() | F.col("num").isNotNull())
        .groupBy("column", "txt", "num")
        .agg(F.count("*").alias("weight"))
    )


def _exact_quantiles(counts: DataFrame, quantiles: Sequence[float]) -> DataFrame:
    """Interpolated quantiles per column from value counts, without sorting a column in one task."""
    numbers = counts.where(F.col("num").isNotNull()).groupBy("column", "num").agg(F.sum("weight").alias("weight"))
    ranked = materialize(with_running_total(numbers, ["column", "num"], F.col("weight"), "before"), "ranked")
    spans = ranked.groupBy("column").agg(F.min("before").alias("start"), F.sum("weight").alias("n"))
    # spans hold one row per column
    placed = ranked.join(F.broadcast(spans), "column").withColumn("first", F.col("before") - F.col("start"))
    last = F.col("first") + F.col("weight") - 1

    def at(rank: Column) -> Column:
        return F.max(F.when(rank.between(F.col("first"), last), F.col("num")))

    values = []
    for p in quantiles:
        place = F.lit(float(p)) * (F.col("n") - 1)
        below, above = at(F.floor(place)), at(F.ceil(place))
        share = F.max(place - F.floor(place))
        values.append(F.round(below + (above - below) * share, 6).alias(f"q{round(p * 100)}"))
    return placed.groupBy("column").agg(*values)


PROFILE_COLUMNS = ("column", "type", "n", "nulls", "distinct", "min", "max", "mean", "q25", "q50", "q75")


def profile(df: DataFrame, exact: bool = False) -> DataFrame:
    """One row per column: ``column, type, n, nulls, distinct, min, max, mean, q25, q50, q75``.

    The default uses sketches for distinct counts and quantiles: one scan, one small aggregation.
    ``exact`` counts every value with a shuffle of the distinct values.
    """
    if not exact:
        sketches = {}
        for f in _profiled(df):
            c = F.col(f"`{f.name}`")
            # one digest answers all quantiles
            if isinstance(f.dataType, NumericType):
                points = F.percentile_approx(_number(f), QUANTILES)
            else:
                points = F.first(F.lit(None).cast("array<double>"))
            sketches[f.name] = {"distinct": F.approx_count_distinct(c), "points": points}
        quantiles = {q: F.col("points")[i] for i, q in enumerate(PROFILE_COLUMNS[-3:])}
        return _base_rows(df, sketches).withColumns(quantiles).select(*PROFILE_COLUMNS)
    counts = materialize(value_counts(df, digests=True), "values")
    distinct = counts.groupBy("column").agg(F.count("*").alias("distinct"))
    return (
        _base_rows(df, {})
        .join(distinct, "column", "left")
        .join(_exact_quantiles(counts, QUANTILES), "column", "left")
        .withColumn("distinct", F.coalesce("distinct", F.lit(0)))
        .select(*PROFILE_COLUMNS)
    )


#: Size of the stored sketches, as the logarithm of a distinct-count sketch's registers and the number of a quantile sketch's points.
HLL_LOG_SIZE = 12
KLL_SIZE = 400


def profile_parts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per partition: ``_rows``, and for each profiled column its counts, bounds, sum and two sketches.

    Sketches of several partitions merge to those of all, so a profile of the table needs no rows again. A part is a
    few kilobytes a column, however many rows the partition has.
    """
    columns = []
    for f in _profiled(df.drop(*keys)):
        c, number = F.col(f"`{f.name}`"), isinstance(f.dataType, NumericType)
        # sketches know whole numbers, doubles, texts and bytes
        sketched = c if isinstance(f.dataType, StringType) else c.cast("string")
        columns.append(
            F.struct(
                F.count(c).alias("values"),
                F.min(c).alias("min"),
                F.max(c).alias("max"),
                (F.sum(_number(f)) if number else F.first(_number(f))).alias("sum"),
                F.hll_sketch_agg(sketched, F.lit(HLL_LOG_SIZE)).alias("distinct"),
                F.kll_sketch_agg_double(_number(f), F.lit(KLL_SIZE)).alias("points"),
            ).alias(f.name)
        )
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"), *columns)


def merged_profile(parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The profile of all rows from the parts of all partitions, in the form of ``profile``.

    Counts, bounds and means are exact. With these sizes a distinct count is off by 1.6 % in one standard deviation, and
    the rank of a quantile by 0.8 % at most, at a confidence of 99 %; merging adds nothing to either.
    """
    aggregates, rows = [F.sum("_rows").alias("n")], []
    for i, f in enumerate(f for f in parts.schema if f.name not in (*keys, "_rows")):
        kind = f.dataType["min"].dataType

        def part(name: str, field: str = f.name) -> Column:
            return F.col(f"`{field}`")[name]

        values = F.sum(part("values"))
        points = F.kll_merge_agg_double(part("points"))
        aggregates += [
            values.alias(f"c{i}"),
            F.min(part("min")).cast("string").alias(f"lo{i}"),
            F.max(part("max")).cast("string").alias(f"hi{i}"),
            F.round(F.sum(part("sum")) / F.nullif(values, F.lit(0)), 6).alias(f"m{i}"),
            F.hll_sketch_estimate(F.hll_union_agg(part("distinct"))).alias(f"d{i}"),
            points.alias(f"p{i}"),
        ]
        known = F.col(f"c{i}") > 0 if isinstance(kind, NumericType) else F.lit(False)
        quantiles = [
            F.when(known, F.kll_sketch_get_quantile_double(F.col(f"p{i}"), F.lit(q))).alias(name)
            for q, name in zip(QUANTILES, PROFILE_COLUMNS[-3:], strict=True)
        ]
        rows.append(
            F.struct(
                F.lit(f.name).alias("column"), F.lit(kind.simpleString()).alias("type"), F.col("n"),
                (F.col("n") - F.col(f"c{i}")).alias("nulls"), F.col(f"d{i}").alias("distinct"),
                F.col(f"lo{i}").alias("min"), F.col(f"hi{i}").alias("max"), F.col(f"m{i}").alias("mean"), *quantiles,
            )
        )
    return parts.agg(*aggregates).select(F.inline(F.array(*rows)))


def value_sets(df: DataFrame, limit: int) -> DataFrame:
    """``column, values`` of the text columns; ``values`` is null where there are more than ``limit``.

    A sketch first rules out columns with clearly more values, so that only short lists are counted
    exactly. A column that is ruled out still has its row.
    """
    names = [f.name for f in df.schema if isinstance(f.dataType, StringType)]
    sizes = df.agg(*[F.approx_count_distinct(f"`{n}`").alias(n) for n in names]).first() if names else ()
    few = [n for n, size in zip(names, sizes, strict=True) if size <= 2 * limit]
    every = df.sparkSession.createDataFrame([(n,) for n in names], "column string")
    if not few:
        return every.withColumn("values", F.lit(None).cast("array<string>"))
    counts = value_counts(df.select(*[f"`{n}`" for n in few]))
    short = counts.groupBy("column").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") <= limit).select("column")
    lists = counts.join(short, "column").groupBy("column").agg(F.array_sort(F.collect_list("txt")).alias("values"))
    return every.join(lists, "column", "left")


def suite_from_profile(profiled: DataFrame, sets: DataFrame | None = None) -> DataFrame:
    """Expectations that the profiled data meets: ``expectation, column, lo, hi, values``.

    Every column must exist; it must not be null if it never was; numbers and times stay within the
    seen range; columns in ``sets`` keep to the seen values.
    """
    nothing = F.lit(None).cast("string")
    no_set = F.lit(None).cast("array<string>")
    ranged = F.col("mean").isNotNull() | F.col("type").isin("date", "timestamp", "timestamp_ntz")

    def rule(kind: str, lo: Column = nothing, hi: Column = nothing) -> Column:
        return F.struct(F.lit(kind).alias("expectation"), "column", lo.alias("lo"), hi.alias("hi"), no_set.alias("values"))

    rules = F.array(
        rule("exists"),
        F.when((F.col("nulls") == 0) & (F.col("n") > 0), rule("not_null")),
        F.when(ranged & F.col("min").isNotNull(), rule("between", F.col("min"), F.col("max"))),
    )
    suite = profiled.select(F.inline(F.filter(rules, lambda r: r.isNotNull())))
    if sets is None:
        return suite
    return suite.unionByName(
        sets.where(F.col("values").isNotNull()).select(
            F.lit("in_set").alias("expectation"), "column", nothing.alias("lo"), nothing.alias("hi"), "values"
        )
    )


def save_suite(suite: DataFrame, path: str) -> None:
    """Store a suite as JSON lines."""
    suite.write.mode("overwrite").json(path)


def load_suite(spark: SparkSession, path: str) -> list[Expectation]:
    """Stored suite as expectations; a few rows per column of the checked table."""
    schema = "expectation string, column string, lo string, hi string, values array<string>"
    return as_expectations(spark.read.schema(schema).json(path))


def as_expectations(suite: DataFrame) -> list[Expectation]:
    """Suite rows as expectations; bounds that are numbers become numbers."""

    def bound(text: str | None) -> Any:
        try:
            value = json.loads(text) if text is not None else None
        except ValueError:
            return text
        # a number with more digits than a double has stays text, and takes the column's type when compared
        exact = isinstance(value, int) or isinstance(value, float) and len(text.strip("-0").replace(".", "")) <= 15
        return value if exact else text

    return [
        Expectation(r.expectation, r["column"], bound(r.lo), bound(r.hi), values=tuple(r["values"] or ()))
        for r in suite.collect()
    ]
