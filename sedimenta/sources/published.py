"""Tables that change by publishing: a run writes its partitions aside, and one small file makes them current.

``base/_runs/run=.../key=.../`` holds what runs have written, ``base/_published`` one JSON file per publication, with a row
for each partition that it replaced. A reader takes each partition from the run that published it last. A run that fails
leaves files that nobody reads; the rename of the one JSON file is the moment all its partitions change at once.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import UTC, datetime, timedelta
from typing import Any
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from sedimenta.sources.lake import (
    NULL_VALUE,
    SourceMissing,
    clean_path,
    escaped,
    literal_path,
    open_partitions,
    partition_folders,
    path_exists,
    quoted,
    read_partition,
    register_table,
)

RUNS = "_runs"
LOG = "_published"
LOG_SCHEMA = "folder string, run string, at string, source string"
#: Partitions named in one statement.
STATEMENT = 100
_SYNCED = "published.at"


@dataclass(frozen=True)
class Staged:
    """What a run has written: the folders of its partitions, and what was observed on the way."""

    base: str
    run: str
    folders: tuple[str, ...]
    metrics: dict[str, Any] = field(default_factory=dict)


def _folder(keys: Sequence[str], values: Row) -> str:
    # an empty text is written like a null
    return "/".join(f"{escaped(k)}={escaped(str(v)) if v not in (None, '') else NULL_VALUE}" for k, v in zip(keys, values, strict=True))


def stage(df: DataFrame, base: str, keys: Sequence[str] = (), metrics: Sequence[Column] = ()) -> Staged:
    """Write the rows of one run aside; ``metrics`` are observed in the same job.

    The observation is directly below the write, so a task that runs again counts once. The partitions are those that the
    finished job has left in the run's own folder; to collect their values from all rows would cost a set lookup a row. Without
    ``keys`` the table is one partition.
    """
    run = f"{datetime.now(UTC):%Y%m%dT%H%M%S}-{uuid.uuid4().hex}"
    path = clean_path(base, RUNS, f"run={run}")
    seen = Observation()
    writer = df.observe(seen, F.count(F.lit(1)).alias("rows"), *metrics).write.mode("errorifexists")
    with open_partitions(df.sparkSession):
        (writer.partitionBy(*keys) if keys else writer).parquet(path)
    folders = partition_folders(df.sparkSession, path, keys) if keys else [""]
    return Staged(base, run, tuple(folders), dict(seen.get))


def publish(
    spark: SparkSession, staged: Staged, source: str | Mapping[str, str] | None = None, drop: Sequence[str] = ()
) -> None:
    """Make all partitions of a run current at once; partitions in ``drop`` leave the table with the same step.

    ``source`` is kept with each partition, to tell what it was made from: one text, or one by folder.
    """
    at = datetime.now(UTC).replace(tzinfo=None).isoformat(timespec="microseconds")
    gone = [f for f in drop if f not in staged.folders]
    made_from = source if isinstance(source, Mapping) else dict.fromkeys([*staged.folders, *gone], source)
    rows = [(f, staged.run, at, made_from.get(f)) for f in staged.folders] + [(f, None, at, made_from.get(f)) for f in gone]
    if rows:
        entry = spark.createDataFrame(rows, LOG_SCHEMA)
        # one task writes one file, and the commit of the job renames it into place
        entry.coalesce(1).write.mode("append").json(clean_path(staged.base, LOG))


def is_published(spark: SparkSession, base: str) -> bool:
    """Whether anything has ever been published below ``base``."""
    return path_exists(spark, clean_path(base, LOG)) and not _log(spark, base).isEmpty()


def _log(spark: SparkSession, base: str) -> DataFrame:
    if not path_exists(spark, clean_path(base, LOG)):
        raise SourceMissing(base)
    return spark.read.schema(LOG_SCHEMA).json(literal_path(clean_path(base, LOG)))


def current(spark: SparkSession, base: str) -> DataFrame:
    """``folder, run, at, source`` of the partitions that are current, one row each."""
    log = _log(spark, base)
    last = Window.partitionBy("folder").orderBy(F.desc("at"), F.desc("run"))
    return log.withColumn("_n", F.row_number().over(last)).where("_n = 1 and run is not null").drop("_n")


def _values(folder: str) -> dict[str, str | None]:
    pairs = [part.split("=", 1) for part in folder.split("/")] if folder else []
    return {unquote(k): None if v == NULL_VALUE else unquote(v) for k, v in pairs}


def read_published(
    spark: SparkSession, base: str, keys: Sequence[str] | None = None, schema: StructType | None = None, **equal: str
) -> DataFrame:
    """The current rows of a published table, restricted to the given partition values.

    Without ``keys`` its folders name them. Only the folders of the partitions asked for are listed. The driver holds a line per partition, as a plan does.
    """
    rows = current(spark, base).collect()
    if not rows:
        raise SourceMissing(base)
    keys = list(_values(rows[0].folder)) if keys is None else keys
    for key in equal:
        if key not in keys:
            raise ValueError(f"{key} is not a partition column")
    wanted = [r for r in rows if all(_values(r.folder)[k] == str(v) for k, v in equal.items())]
    df = read_folders(spark, base, keys, [(r.run, r.folder) for r in wanted or rows[:1]], schema)
    return df if wanted else df.limit(0)


def read_layer(spark: SparkSession, base: str, keys: Sequence[str], **equal: str) -> DataFrame:
    """A partitioned table in either form: what is published below ``base``, or else the files that lie there."""
    return (read_published if is_published(spark, base) else read_partition)(spark, base, keys, **equal)


def read_folders(
    spark: SparkSession, base: str, keys: Sequence[str], folders: Sequence[tuple[str, str]], schema: StructType | None = None
) -> DataFrame:
    """Rows of the given ``(run, folder)`` pairs; partition columns are text."""
    root = clean_path(base, RUNS)
    # a base may have brackets in its name; those of partition values are written as codes
    paths = [clean_path(literal_path(root), f"run={run}", folder) for run, folder in folders]
    if schema is None:
        schema = spark.read.option("basePath", root).parquet(paths[0]).schema
    text = [StructField(k, StringType()) for k in ("run", *keys)]
    whole = StructType([f for f in schema if f.name not in ("run", *keys)] + text)
    return spark.read.schema(whole).option("basePath", root).parquet(*paths).drop("run")


def _spec(folder: str) -> str:
    def literal(value: str | None) -> str:
        return "NULL" if value is None else "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"

    return "PARTITION (" + ", ".join(f"{quoted(k)} = {literal(v)}" for k, v in _values(folder).items()) + ")"


def sync_table(spark: SparkSession, name: str, schema: StructType, base: str, keys: Sequence[str]) -> int:
    """Bring an external table over ``base`` to what is published; returns how many partitions changed.

    Locations come from the publications since the table was last brought up to date, which it keeps as a
    property, so no folder is listed. New partitions are added by the hundred, replaced ones get their new location.
    """
    register_table(spark, name, schema, base, keys)
    table = quoted(name)
    properties = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}
    since = properties.get(_SYNCED, "")
    log = _log(spark, base).where(F.col("at") > since)
    touched = {r.folder: r.at for r in log.groupBy("folder").agg(F.max("at").alias("at")).collect()}
    if not touched:
        return 0
    runs = {r.folder: r.run for r in current(spark, base).collect() if r.folder in touched}
    known = {r.partition for r in spark.sql(f"SHOW PARTITIONS {table}").collect()} if keys else set()

    def location(folder: str) -> str:
        return "LOCATION '" + clean_path(base, RUNS, f"run={runs[folder]}", folder).replace("\\", "\\\\").replace("'", "\\'") + "'"

    new = sorted(f for f in runs if f not in known)
    for at in range(0, len(new), STATEMENT):
        added = " ".join(f"{_spec(f)} {location(f)}" for f in new[at : at + STATEMENT])
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {added}")
    for folder in sorted(touched):
        if folder in runs and folder in known:
            spark.sql(f"ALTER TABLE {table} {_spec(folder)} SET {location(folder)}")
        elif folder in known:
            spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {_spec(folder)}")
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{_SYNCED}' = '{max(touched.values())}')")
    spark.catalog.refreshTable(name)
    return len(touched)


def drop_superseded(spark: SparkSession, base: str, age: timedelta) -> list[str]:
    """Delete what runs wrote that no partition is read from, and that is older than ``age``; returns their names.

    The age spares runs that are still being written, and readers that have planned on older ones.
    """
    hadoop = spark._jvm.org.apache.hadoop.fs  # noqa: SLF001 - Spark deletes no files
    root = hadoop.Path(clean_path(base, RUNS))
    system = root.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())  # noqa: SLF001
    used = {r.run for r in current(spark, base).select("run").distinct().collect()}
    before = f"{datetime.now(UTC) - age:%Y%m%dT%H%M%S}"
    dropped = []
    for entry in system.listStatus(root):
        run = entry.getPath().getName().removeprefix("run=")
        if re.match(r"\d{8}T\d{6}-", run) and run not in used and run < before:
            system.delete(entry.getPath(), True)
            dropped.append(run)
    return sorted(dropped)
