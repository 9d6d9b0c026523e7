"""Bronze, silver, mart and quality jobs."""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterable, Sequence
from contextlib import nullcontext
from functools import wraps

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sedimenta.operators import mapping as m
from sedimenta.operators.conform import conform_groups
from sedimenta.operators.layers import cast_columns, null_safe_sum, require, select_columns, with_year_month
from sedimenta.operators.marts import (
    hourly_mean_of_parts,
    hourly_mean_sql,
    mean_parts_table,
    monthly_mean_of_parts,
    monthly_mean_sql,
)
from sedimenta.operators.quality import (
    Expectation,
    audit,
    check,
    enforce,
    load_suite,
    passed,
    profile,
    profile_parts,
    quality_report,
    report_from_metrics,
    save_suite,
    suite_from_profile,
    suite_metrics,
    value_sets,
    violations,
    write_report,
)
from sedimenta.plans.specs import BronzePolicy, MappingPolicy, MartSpec, RunConfig, RunReport, SilverSpec
from sedimenta.session import materialize, scratch_path, scratch_scope
from sedimenta.sources import manifest
from sedimenta.sources.catalog import (
    SourceMissing,
    file_catalog,
    occurrences,
    scan_groups,
    schema_catalog,
    split_quarantine,
)
from sedimenta.sources.lake import (
    bounded_sample,
    is_empty,
    named_nulls,
    preview,
    read_parquet,
    register_table,
    repair_table,
    repartition_for_write,
    write_partitioned,
)
from sedimenta.sources.published import (
    Staged,
    current,
    is_published,
    publish,
    read_folders,
    read_layer,
    read_published,
    stage,
    sync_table,
)

log = logging.getLogger("sedimenta")


def _reported(job: str, scoped: bool = True) -> Callable:
    """Turn failures of a job into its report; a ``scoped`` job leaves no intermediate tables."""

    def wrap(run: Callable[..., RunReport]) -> Callable[..., RunReport]:
        @wraps(run)
        def reported(spark: SparkSession, *args, **kwargs) -> RunReport:
            try:
                with scratch_scope(spark) if scoped else nullcontext():
                    return run(spark, *args, **kwargs)
            except SourceMissing as error:
                log.error("%s: input does not exist: %s", job, error)
                return RunReport(job, "missing", error=error)
            except Exception as error:
                log.exception("%s failed", job)
                return RunReport(job, "failed", error=error)

        return reported

    return wrap


def harvest(
    spark: SparkSession, roots: str | Iterable[str], glob: str = "*.parquet", manifest_path: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """Readable and quarantined parts of the schema catalog; each footer is read once, with a manifest once ever."""
    if manifest_path:
        found = manifest.refresh(spark, roots, manifest_path, glob)
        log.info("catalog: %d files, %d opened, %d gone", found.listed, found.opened, found.gone)
        return split_quarantine(materialize(manifest.catalog(spark, manifest_path), "catalog"))
    return split_quarantine(materialize(schema_catalog(file_catalog(spark, roots, glob)), "catalog"))


def mapping_from_catalog(good: DataFrame, policy: MappingPolicy) -> DataFrame:
    """Group, name, split and complete the column names of a catalog."""
    groups = m.group_columns(
        cooccur=occurrences(good),
        veto=policy.veto,
        exclusive=policy.exclusive,
        cutoff=policy.cutoff,
        top_n=policy.top_n,
    )
    named = m.name_groups(groups, policy.manual, policy.prefix)
    # used several times below
    split = materialize(m.split_exclusive(named, policy.split), "split")
    return m.require_columns(split, policy.required)


def build_mapping(
    spark: SparkSession, roots: str | Iterable[str], policy: MappingPolicy, export: str | None = None
) -> DataFrame:
    """Mapping of all files below ``roots``; ``export`` also writes it as JSON and CSV."""
    good, _ = harvest(spark, roots)
    mapping = materialize(mapping_from_catalog(good, policy), "mapping")
    if export:
        m.write_mapping(mapping, f"{export.rstrip('/')}/json", "json")
        m.write_mapping(mapping, f"{export.rstrip('/')}/csv", "csv")
    return mapping


def _observed_write(
    df: DataFrame, path: str, keys: Sequence[str], mode: str, suite: Sequence[Expectation] = (), on_fail: str = "warn"
) -> tuple[dict[str, int], Staged | None]:
    """Write and count, and check the suite, in the same pass; in publish mode also what was staged.

    The observation sits directly below the write, after any shuffle, so a task that is run again
    is counted once.
    """
    metrics = suite_metrics(suite, df.schema)
    if mode == "publish":
        staged = stage(df, path, keys, metrics)
        if on_fail == "raise":
            enforce(report_from_metrics(df.sparkSession, suite, staged.metrics))
        publish(df.sparkSession, staged)
        return staged.metrics, staged
    seen = Observation()
    write_partitioned(df.observe(seen, F.count(F.lit(1)).alias("rows"), *metrics), path, keys, mode)
    return seen.get, None


def _input_bytes(spark: SparkSession, src: str | Iterable[str], policy: BronzePolicy) -> int:
    """Bytes of all raw files, from the manifest if one is kept, else from a listing."""
    files = manifest.files(spark, policy.manifest_path) if policy.manifest_path else file_catalog(spark, src, policy.glob)
    return files.agg(F.sum("length")).first()[0] or 0


def _files_bytes(spark: SparkSession, df: DataFrame) -> int:
    """Bytes of the files that a plain scan reads."""
    return df.select("_metadata.file_path", "_metadata.file_size").distinct().agg(F.sum("file_size")).first()[0] or 0


def _previews(spark: SparkSession, path: str, keys: Sequence[str], n: int) -> dict[str, DataFrame]:
    return {"preview": preview(read_layer(spark, path, keys), n)} if n else {}


@_reported("bronze")
def run_bronze(spark: SparkSession, src: str | Iterable[str], dst: str, policy: BronzePolicy) -> RunReport:
    """Raw files to a conformed table partitioned by ``policy.keys``."""
    good, quarantine = harvest(spark, src, policy.glob, policy.manifest_path)
    if policy.quarantine_path:
        quarantine.write.mode("overwrite").parquet(policy.quarantine_path)
    if is_empty(good):
        return RunReport("bronze", "no_data")
    mapping = materialize(mapping_from_catalog(good, policy.mapping), "mapping")
    if policy.mapping_path:
        m.write_mapping(mapping, f"{policy.mapping_path.rstrip('/')}/json", "json")
        m.write_mapping(mapping, f"{policy.mapping_path.rstrip('/')}/csv", "csv")
    files = good.where("pos = 0").select("path")
    df, skipped = conform_groups(scan_groups(spark, good), m.mapping_dict(mapping), policy.conform, files)
    # only a static overwrite without rows would lose what is there; the others replace nothing
    if policy.mode == "static" and is_empty(df):
        return RunReport("bronze", "no_data", skipped=skipped)
    keyed = named_nulls(require(with_year_month(df, policy.ts_col), policy.keys), policy.keys)
    size = _input_bytes(spark, src, policy) if policy.layout == "sized" else None
    arranged = repartition_for_write(keyed, policy.layout, policy.keys, size)
    seen, _ = _observed_write(arranged, dst, policy.keys, policy.mode)
    if not seen["rows"]:
        return RunReport("bronze", "no_data", skipped=skipped)
    frames = _previews(spark, dst, policy.keys, policy.preview)
    return RunReport("bronze", "ok", rows=seen["rows"], skipped=skipped, frames=frames)


def silver(bronze: DataFrame, spec: SilverSpec) -> DataFrame:
    """Typed, totalled and projected rows."""
    typed = cast_columns(bronze, spec.casts)
    return select_columns(null_safe_sum(typed, spec.amounts, spec.total, spec.amount_type), spec.output)


@_reported("silver")
def run_silver(spark: SparkSession, src: str, dst: str, spec: SilverSpec) -> RunReport:
    """Bronze table to silver table, checked against ``spec.suite``."""
    bronze = read_layer(spark, src, spec.source_keys, **spec.where)
    if is_empty(bronze):
        return RunReport("silver", "no_data")
    df = silver(bronze, spec)
    if spec.on_fail == "raise" and spec.mode != "publish":
        enforce(quality_report(df, spec.suite))
    # silver is about as large as the partitions of bronze that it comes from
    size = _files_bytes(spark, bronze) if spec.layout == "sized" else None
    arranged = repartition_for_write(df, spec.layout, spec.keys, size)
    seen, staged = _observed_write(arranged, dst, spec.keys, spec.mode, spec.suite, spec.on_fail)
    report = report_from_metrics(spark, spec.suite, seen)
    failed = [e.kind + " " + e.column for i, e in enumerate(spec.suite) if not passed(e, seen[f"e{i}"], seen[f"v{i}"])]
    if failed:
        log.warning("silver: rows violate %s", ", ".join(failed))
    if spec.violations_path and any(seen[f"v{i}"] for i in range(len(spec.suite))):
        # what was just written is cheaper to read again than its input
        written = df if staged is None else read_folders(spark, dst, spec.keys, [(staged.run, f) for f in staged.folders])
        violations(written, spec.suite).write.mode("overwrite").parquet(spec.violations_path)
    if spec.report_path:
        write_report(report, spec.report_path)
    frames = _previews(spark, dst, spec.keys, spec.preview)
    return RunReport("silver", "ok", rows=seen["rows"], quality=report, frames=frames)


def refresh_parts(
    spark: SparkSession, src: str, dst: str, keys: Sequence[str], made: Callable[[DataFrame], DataFrame]
) -> list[str]:
    """Bring a table of parts to the published table ``src``; returns the partitions that were read.

    ``made`` makes the parts of some partitions from their rows, and keeps ``keys``. Each partition of the parts remembers
    the run that its rows come from, so only partitions that another run has published since are read, and
    those that left the table leave the parts.
    """
    runs = {r.folder: r.run for r in current(spark, src).collect()}
    known = {r.folder: r.source for r in current(spark, dst).collect()} if is_published(spark, dst) else {}
    touched = sorted(f for f, run in runs.items() if known.get(f) != run)
    gone = sorted(f for f in known if f not in runs)
    if touched:
        rows = read_folders(spark, src, keys, [(runs[f], f) for f in touched])
        publish(spark, stage(made(rows), dst, keys), runs, drop=gone)
    elif gone:
        publish(spark, Staged(dst, "", ()), drop=gone)
    return touched


def refresh_means(spark: SparkSession, src: str, parts: str, spec: MartSpec) -> list[str]:
    """Bring the stored parts of both means to the published table ``src``; returns the partitions that were read."""
    return refresh_parts(
        spark, src, parts, spec.keys,
        lambda rows: mean_parts_table(rows, spec.keys, spec.amount, spec.ts, spec.passengers, spec.scale),
    )


def refresh_profile(spark: SparkSession, src: str, parts: str, keys: Sequence[str]) -> list[str]:
    """Bring the stored sketches of a published table up to date; see ``merged_profile``."""
    return refresh_parts(spark, src, parts, keys, lambda rows: profile_parts(rows, keys))


@_reported("marts")
def run_marts(spark: SparkSession, table: str, path: str, spec: MartSpec, schema: StructType | None = None) -> RunReport:
    """Register the silver table and define both means over it, or over its parts where those are kept."""
    if schema is None:
        schema = read_layer(spark, path, spec.keys).schema
    if is_published(spark, path):
        sync_table(spark, table, schema, path, spec.keys)
    else:
        register_table(spark, table, schema, path, spec.keys)
        repair_table(spark, table)
    if spec.parts_path:
        refresh_means(spark, path, spec.parts_path, spec)
        parts = read_published(spark, spec.parts_path, spec.keys)
        frames = {
            "monthly": monthly_mean_of_parts(parts, spec.keys, spec.digits, scale=spec.scale),
            "hourly": hourly_mean_of_parts(parts, spec.digits, scale=spec.scale),
        }
        return RunReport("marts", "ok", frames=frames)
    frames = {
        "monthly": spark.sql(monthly_mean_sql(table, spec.keys, spec.amount, spec.digits, scale=spec.scale)),
        "hourly": spark.sql(hourly_mean_sql(table, spec.ts, spec.passengers, spec.digits, scale=spec.scale)),
    }
    return RunReport("marts", "ok", frames=frames)


@_reported("quality", scoped=False)
def run_quality(
    spark: SparkSession,
    path: str,
    suite: Sequence[Expectation] | None = None,
    n: int = 10_000,
    view: str = "sample_df",
    report_path: str | None = None,
    suite_path: str | None = None,
    on_fail: str = "warn",
    set_limit: int = 20,
    profiled: bool = False,
    violations_path: str | None = None,
) -> RunReport:
    """Check a bounded sample of a table on its own; the sample stays visible as a view.

    Without a ``suite`` the sample is profiled and the suite made from the profile. ``suite_path``
    stores that suite, and the check runs with the stored one, as a later run would. With
    ``on_fail="raise"`` a failed check fails the job. ``profiled`` adds the profile to the report beside a
    given suite; rows that fail a check go to ``violations_path``, written in the scan that counts them.
    """
    source = read_published(spark, path) if is_published(spark, path) else read_parquet(spark, path)
    sample = bounded_sample(source, n)
    sample.createOrReplaceTempView(view)
    frames = {}
    if suite is None or profiled:
        frames["profile"] = materialize(profile(sample), "profile")
    if suite is None:
        made = suite_from_profile(frames["profile"], value_sets(sample, set_limit))
        where = suite_path or scratch_path(spark, "suite")
        save_suite(made, where)
        suite = load_suite(spark, where)
    report = audit(sample, suite, violations_path) if violations_path else quality_report(sample, suite)
    report = materialize(report, "report")
    if report_path:
        write_report(report, report_path)
    if on_fail == "raise":
        enforce(report)
    status = "ok" if check(report).first().success else "failed"
    return RunReport("quality", status, quality=report, frames=frames)


def run_all(spark: SparkSession, cfg: RunConfig) -> list[RunReport]:
    """Bronze, silver, marts in order; stops at the first job that is not ok.

    With dynamic overwrite a repeated run replaces the same partitions and leaves others alone. With ``mode="publish"``
    in both settings a job that fails leaves its table as it was, and readers see a run's partitions all or not at all.
    """
    steps = (
        lambda: run_bronze(spark, cfg.raw, cfg.bronze, cfg.bronze_policy),
        lambda: run_silver(spark, cfg.bronze, cfg.silver, cfg.silver_spec),
        lambda: run_marts(spark, cfg.table, cfg.silver, cfg.mart_spec),
    )
    reports = []
    for step in steps:
        reports.append(step())
        if not reports[-1].ok:
            break
    return reports
