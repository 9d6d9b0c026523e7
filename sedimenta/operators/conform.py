"""Bring files with different schemas to one schema and union them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sedimenta.functions.dates import base_name, date_ref
from sedimenta.functions.numbers import lenient_cast
from sedimenta.sources.catalog import SchemaGroup

# Names of the metadata columns, tag of unknown sources.
METADATA = ("source_file", "source_type", "ingestion_date", "date_ref")
UNKNOWN_SOURCE = "desconhecido"

#: Files whose tags and dates are broadcast; with more of them each row works out its own.
FILES_LOOKED_UP = 200_000


@dataclass(frozen=True)
class ConformSpec:
    """Settings of ``conform``.

    ``rules`` are (text in the base name, tag) pairs, tried in order. ``types`` gives the declared
    type of standard columns, ``default_type`` that of all others. ``columns`` restricts and orders
    the output. With ``merge_variants`` several variants in one file are coalesced instead of
    only the first being used. ``run_ts`` replaces the current time.
    """

    rules: tuple[tuple[str, str], ...] = ()
    unknown: str = UNKNOWN_SOURCE
    types: Mapping[str, str] = field(default_factory=dict)
    default_type: str = "string"
    columns: tuple[str, ...] | None = None
    merge_variants: bool = False
    run_ts: datetime | None = None

    def type_of(self, standard: str) -> str:
        return self.types.get(standard, self.default_type)


def present_variants(columns: Sequence[str], mapping: Mapping[str, Sequence[str]]) -> dict[str, list[str]]:
    """Per standard name the variants among ``columns``, in mapping order; exact spelling."""
    have = set(columns)
    found = {std: [v for v in variants if v in have] for std, variants in mapping.items()}
    return {std: variants for std, variants in found.items() if variants}


def rename_first_present(
    df: DataFrame,
    mapping: Mapping[str, Sequence[str]],
    types: Mapping[str, str] | None = None,
    merge_variants: bool = False,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Project to the standard columns that ``df`` has; unmapped columns are dropped.

    ``keep`` names further columns to carry along unchanged.
    """
    chosen = []
    for std, variants in present_variants(df.columns, mapping).items():
        used = variants if merge_variants else variants[:1]
        columns = [_typed(F.col(_exact(v)), (types or {}).get(std)) for v in used]
        chosen.append((columns[0] if len(columns) == 1 else F.coalesce(*columns)).alias(std))
    return df.select(*chosen, *[F.col(_exact(k)) for k in keep])


def _exact(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _typed(column: Column, to: str | None) -> Column:
    return column if to is None else lenient_cast(column, to)


def tag_source(path: Column | str, rules: Sequence[tuple[str, str]], default: str = UNKNOWN_SOURCE) -> Column:
    """Tag of the first rule whose text occurs in the base name of ``path``."""
    name = base_name(F.col(path) if isinstance(path, str) else path)
    if not rules:
        return F.lit(default)
    (text, tag), *others = rules
    chain = F.when(name.contains(text), tag)
    for text, tag in others:
        chain = chain.when(name.contains(text), tag)
    return chain.otherwise(default)


def with_provenance(df: DataFrame, path: Column | str, run_ts: datetime | None = None) -> DataFrame:
    """Add where each row came from and when it was read."""
    source = F.col(path) if isinstance(path, str) else path
    stamp = F.current_timestamp() if run_ts is None else F.lit(run_ts).cast("timestamp")
    return df.withColumns({"source_file": source, "ingestion_date": stamp})


def fill_missing(df: DataFrame, schema: Mapping[str, str]) -> DataFrame:
    """Add absent columns as nulls of their declared type."""
    have = set(df.columns)
    return df.withColumns({c: F.lit(None).cast(t) for c, t in schema.items() if c not in have})


def source_facts(files: DataFrame, spec: ConformSpec) -> DataFrame:
    """``_path, _tag, _date``: what ``conform`` says of each file in ``files`` (column ``path``), one row per file."""
    tag, date = tag_source("path", spec.rules, spec.unknown), date_ref("path")
    return files.select("path").distinct().select(F.col("path").alias("_path"), tag.alias("_tag"), date.alias("_date"))


def conform(
    df: DataFrame,
    mapping: Mapping[str, Sequence[str]],
    spec: ConformSpec,
    path: Column | str = "_metadata.file_path",
    facts: DataFrame | None = None,
) -> DataFrame | None:
    """One schema group in the common schema, or None when no column of it is mapped.

    All steps work on single rows, so this also applies to a streaming DataFrame. ``facts`` are the ``source_facts`` of
    the files, looked up in a broadcast instead of being worked out for each row; a path that they lack, such as
    one whose address has codes for some characters, is worked out.
    """
    if not present_variants(df.columns, mapping):
        return None
    standards = list(mapping) if spec.columns is None else [c for c in spec.columns if c not in METADATA]
    wanted = {s: mapping[s] for s in standards if s in mapping}
    types = {s: spec.type_of(s) for s in standards}
    source = F.col(path) if isinstance(path, str) else path
    carried = df.withColumn("_source", source)
    renamed = rename_first_present(carried, wanted, types, spec.merge_variants, keep=["_source"])
    tag, date = tag_source("_source", spec.rules, spec.unknown), date_ref("_source")
    if facts is not None:
        renamed = renamed.join(F.broadcast(facts), F.col("_source") == F.col("_path"), "left")
        tag, date = F.coalesce("_tag", tag), F.coalesce("_date", date)
    tagged = (
        with_provenance(renamed, "_source", spec.run_ts)
        .withColumns({"source_type": tag, "date_ref": date})
        .drop("_source", "_path", "_tag", "_date")
    )
    metadata = METADATA if spec.columns is None else [c for c in spec.columns if c in METADATA]
    order = [*standards, *metadata] if spec.columns is None else list(spec.columns)
    return fill_missing(tagged, types).select(*[_exact(c) for c in order])


def conform_union(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by column name, keeping all rows; columns that a frame lacks become null."""
    if not frames:
        raise ValueError("no input has a mapped column")
    level = list(frames)
    while len(level) > 1:
        pairs = [level[i : i + 2] for i in range(0, len(level), 2)]
        level = [p[0] if len(p) == 1 else p[0].unionByName(p[1], allowMissingColumns=True) for p in pairs]
    return level[0]


def conform_groups(
    groups: Sequence[SchemaGroup], mapping: Mapping[str, Sequence[str]], spec: ConformSpec, files: DataFrame | None = None
) -> tuple[DataFrame, list[str]]:
    """Union of all conformed schema groups, and the fingerprints of groups without a mapped column.

    With ``files`` (column ``path``) tags and dates are worked out once per file, if there are no more than
    ``FILES_LOOKED_UP``.
    """
    known = files is not None and files.count() <= FILES_LOOKED_UP
    facts = source_facts(files, spec) if known else None
    done = [(g.fingerprint, conform(g.df, mapping, spec, facts=facts)) for g in groups]
    return conform_union([df for _, df in done if df is not None]), [f for f, df in done if df is None]
