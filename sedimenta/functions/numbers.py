"""Casts, null-safe sums and rounded means."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


# Bits of the whole-number types, by each of their names.
WHOLE = {
    "tinyint": 8, "byte": 8, "smallint": 16, "short": 16, "int": 32, "integer": 32, "bigint": 64, "long": 64,
}


def lenient_cast(column: Column, to: str) -> Column:
    """Cast that yields null for bad input.

    Text such as ``1.0`` is a valid whole number, so whole-number targets are read as a fractional number
    first and then cut off; a direct ``try_cast`` of that text would give null. Up to 32 bits that is a
    double, which holds all their values; 64 bits take a decimal. The range is tested before the cut
    because a failing ``try_cast`` of a number builds an error for every such row.
    """
    bits = WHOLE.get(to.strip().lower())
    if bits is None:
        return column.try_cast(to)
    if bits == 64:
        number, end = column.try_cast("decimal(38,18)"), F.lit(2**63 - 1).cast("decimal(20,0)")
        return F.when((number > -end - 2) & (number < end + 1), number.cast(to))
    number = column.try_cast("double")
    end = float(2 ** (bits - 1))
    return F.when((number > -end - 1) & (number < end), number.cast(to))


def null_as_zero_sum(columns: Iterable[Column]) -> Column:
    """Left-to-right double sum with nulls as 0.0; an empty list sums to 0.0."""
    terms = [F.coalesce(c, F.lit(0.0)) for c in columns]
    return reduce(lambda total, term: total + term, terms) if terms else F.lit(0.0)


def rounded_mean(value: Column, digits: int = 2, scale: int | None = None) -> Column:
    """``round(avg(value), digits)`` as a double.

    A double sum depends on the order in which partitions arrive, which can move a mean that lies
    on a rounding tie. With ``scale`` the values are fixed-point numbers with that many decimals:
    they are summed as whole units and rounded half away from zero by integer arithmetic, so the
    result is the same on any number of executors. A group with a value that is no number of units
    (NaN, infinite, or 2^63 units and more) has the plain mean.
    """
    if scale is None:
        return F.round(F.avg(value), digits)
    parts = mean_parts(value, scale)
    return _mean_of(parts["total"], parts["units"], parts["values"], F.avg(value), digits, scale)


def mean_parts(value: Column, scale: int) -> dict[str, Column]:
    """Aggregates from which ``rounded_mean`` follows, also after they are added up over parts of a table.

    ``total`` and ``units``: exact sum and number of the values that are whole units; ``values``: number of all values;
    ``plain``: their sum as a double, for groups with other values.
    """
    scaled = F.rint(value * F.lit(float(10**scale)))
    units = F.when(F.abs(scaled) < F.lit(float(2**63)), scaled.cast("long"))
    # two sums of longs, upper and lower bits, cannot overflow and are cheaper than one of decimals
    upper = F.sum(F.shiftright(units, 20)).cast("decimal(20,0)")
    lower = F.sum(units.bitwiseAND(F.lit(2**20 - 1)))
    return {
        "total": upper * F.lit(2**20) + lower,
        "units": F.count(units),
        "values": F.count(value),
        "plain": F.sum(value.cast("double")),
    }


def _mean_of(total: Column, n: Column, values: Column, mean: Column, digits: int, scale: int) -> Column:
    if digits > scale:
        raise ValueError("digits may not exceed scale")
    step = F.lit(10 ** (scale - digits))
    # floor((2*|total| + n*step) / (2*n*step)), with the sign put back
    rounded = F.call_function("div", F.lit(2) * F.abs(total) + n * step, F.lit(2) * n * step)
    exact = F.when(n > 0, F.signum(total) * rounded / F.lit(float(10**digits)))
    return F.when(n == values, exact).otherwise(F.round(mean, digits))


def mean_of_parts(name: str, digits: int = 2, scale: int = 2) -> Column:
    """``rounded_mean`` from stored parts: columns ``{name}_total``, ``{name}_units``, ``{name}_values`` and ``{name}_plain``."""
    total, units, values, plain = (F.sum(f"{name}_{part}") for part in ("total", "units", "values", "plain"))
    return _mean_of(total.cast("decimal(30,0)"), units, values, plain / F.nullif(values, F.lit(0)), digits, scale)


def rounded_mean_sql(value: str, digits: int = 2, scale: int | None = None) -> str:
    """``rounded_mean`` as SQL text; ``value`` is an SQL expression."""
    plain = f"ROUND(AVG({value}), {int(digits)})"
    if scale is None:
        return plain
    if digits > scale:
        raise ValueError("digits may not exceed scale")
    scaled = f"RINT({value} * {10**scale}D)"
    units = f"IF(ABS({scaled}) < {float(2**63)!r}D, CAST({scaled} AS DECIMAL(20,0)), NULL)"
    step = 10 ** (scale - digits)
    total, n = f"SUM({units})", f"COUNT({units})"
    rounded = f"((2 * ABS({total}) + {n} * {step}) DIV (2 * {n} * {step}))"
    return (
        f"CASE WHEN COUNT({value}) = 0 THEN NULL WHEN {n} = COUNT({value}) "
        f"THEN SIGNUM({total}) * {rounded} / {10**digits}D ELSE {plain} END"
    )
