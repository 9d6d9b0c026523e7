"""The schema catalog as a table that is kept up to date: only new and changed files are opened again.

``base/files`` holds a row per file with its identity (path, length, time) and the fingerprint of its columns or the
reason why it cannot be read, ``base/schemas`` the columns of each fingerprint, once however many files have them. Both
are published tables, so a refresh that fails leaves the catalog as it was. Schemas are published first: a
fingerprint follows from the columns, so a schema without files does no harm.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass
from typing import BinaryIO

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType

from sedimenta.session import materialize
from sedimenta.sources.catalog import file_catalog, open_with_arrow, schema_catalog
from sedimenta.sources.lake import SourceMissing, clean_path
from sedimenta.sources.published import publish, read_published, stage

FILES = "path string, length bigint, modified timestamp, fingerprint string, error string"
SCHEMAS = "fingerprint string, pos int, name string, type string, sql_type string"
IDENTITY = ("path", "length", "modified")


@dataclass(frozen=True)
class Refresh:
    """What a refresh found: files listed, opened (new or changed), kept as they were, and gone."""

    listed: int
    opened: int
    kept: int
    gone: int


def _stored(spark: SparkSession, base: str, columns: str) -> DataFrame:
    try:
        return read_published(spark, base, schema=StructType(DataType.fromDDL(columns).fields))
    except SourceMissing:
        return spark.createDataFrame([], columns)


def _tables(base: str) -> tuple[str, str]:
    return clean_path(base, "files"), clean_path(base, "schemas")


def _same(left: DataFrame, right: DataFrame, names: Iterable[str] = IDENTITY) -> Column:
    """A file is the same if path, length and time are; the time of an empty file is null."""
    tests = [left[n].eqNullSafe(right[n]) for n in names]
    whole = tests[0]
    for test in tests[1:]:
        whole = whole & test
    return whole


def refresh(
    spark: SparkSession,
    roots: str | Iterable[str],
    base: str,
    glob: str = "*.parquet",
    opener: Callable[[str], BinaryIO] = open_with_arrow,
) -> Refresh:
    """Bring the manifest at ``base`` to the files below ``roots``.

    Footers are read of files that are new or have another length or time; files that are no longer listed
    leave the manifest. A file that cannot be read is opened again only after it has changed.
    """
    files_at, schemas_at = _tables(base)
    listing = materialize(file_catalog(spark, roots, glob).distinct(), "listing")
    old = _stored(spark, files_at, FILES)
    fresh = listing.join(old, _same(listing, old), "left_anti")
    opened = materialize(schema_catalog(fresh, opener), "footers")

    schemas = _stored(spark, schemas_at, SCHEMAS).unionByName(
        opened.where("fingerprint is not null").select("fingerprint", "pos", "name", "type", "sql_type")
    )
    publish(spark, stage(schemas.dropDuplicates(["fingerprint", "pos"]).coalesce(1), schemas_at))

    one_each = opened.where("error is not null or pos = 0").select("path", "fingerprint", "error")
    new = fresh.join(one_each, "path").select(*IDENTITY, "fingerprint", "error", F.lit(True).alias("opened"))
    kept = old.join(listing, _same(old, listing), "left_semi").withColumn("opened", F.lit(False))
    now = materialize(kept.unionByName(new), "files")
    counts = now.agg(F.count(F.lit(1)).alias("listed"), F.count_if("opened").alias("opened")).first()
    gone = old.join(listing, _same(old, listing, ["path"]), "left_anti").count()
    publish(spark, stage(now.drop("opened"), files_at))
    return Refresh(counts.listed, counts.opened, counts.listed - counts.opened, gone)


def files(spark: SparkSession, base: str) -> DataFrame:
    """``path, length, modified, fingerprint, error`` of all files."""
    return _stored(spark, _tables(base)[0], FILES)


def catalog(spark: SparkSession, base: str) -> DataFrame:
    """The manifest as ``schema_catalog`` gives it: one row per file and column, or one with the ``error``."""
    columns = _stored(spark, _tables(base)[1], SCHEMAS)
    return files(spark, base).join(columns, "fingerprint", "left").select("path", "fingerprint", "pos", "name", "type", "sql_type", "error")
