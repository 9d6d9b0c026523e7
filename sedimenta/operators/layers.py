"""Row-wise steps of the bronze and silver layers."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from sedimenta.functions.numbers import lenient_cast, null_as_zero_sum


@dataclass(frozen=True)
class CastSpec:
    """Cast the first present column of ``sources`` to ``type`` under the name ``target``.

    An optional target without any source is left out.
    """

    sources: tuple[str, ...]
    target: str
    type: str
    optional: bool = False


def require(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Return ``df``; raise ``ValueError`` when a column is missing."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"required columns not found: {', '.join(missing)}")
    return df


def with_year_month(df: DataFrame, ts_col: str) -> DataFrame:
    """Add text columns ``year`` (4 digits) and ``month`` (2 digits) for partitioning."""
    require(df, [ts_col])
    ts = F.col(ts_col)
    if isinstance(df.schema[ts_col].dataType, StringType):
        return df.withColumns({"year": ts.substr(1, 4), "month": ts.substr(6, 2)})
    year, month = F.year(ts).cast("string"), F.month(ts).cast("string")
    return df.withColumns({"year": F.lpad(year, 4, "0"), "month": F.lpad(month, 2, "0")})


def cast_columns(df: DataFrame, specs: Sequence[CastSpec]) -> DataFrame:
    """Apply all casts in one projection; bad values become null, source columns stay."""
    exact = set(df.columns)
    casts = {}
    for spec in specs:
        source = next((s for s in spec.sources if s in exact), None)
        if source is not None:
            casts[spec.target] = lenient_cast(F.col(source), spec.type)
        elif not spec.optional:
            raise ValueError(f"no source for {spec.target}: {', '.join(spec.sources)}")
    return df.withColumns(casts)


def null_safe_sum(df: DataFrame, columns: Sequence[str], out: str, amount_type: str | None = None) -> DataFrame:
    """Add the row sum of ``columns``; nulls and absent columns count as 0.0, so it is never null.

    Single-precision inputs keep their own precision inside the double sum. ``amount_type`` casts
    them first.
    """
    present = [F.col(c) for c in columns if c in df.columns]
    terms = [c.try_cast(amount_type) for c in present] if amount_type else present
    return df.withColumn(out, null_as_zero_sum(terms))


def select_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Ordered projection."""
    return require(df, names).select(*names)
