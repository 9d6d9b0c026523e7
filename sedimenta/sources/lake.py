"""Partitioned tables: reading, writing, registering, sampling."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from sedimenta.session import materialize


class SourceMissing(Exception):
    """The input path does not exist."""


#: Tasks whose best rows one other task merges.
MERGED_AT_ONCE = 16


def is_empty(df: DataFrame) -> bool:
    """True when there is no row; looks for one row instead of counting all."""
    return df.isEmpty()


def clean_path(*parts: str) -> str:
    """Join path parts with single slashes, keeping a scheme's ``//``."""
    head, *rest = [p for p in parts if p]
    return "/".join([head.rstrip("/"), *[p.strip("/") for p in rest]]) if rest else head.rstrip("/") or "/"


def literal_path(path: str) -> str:
    """A path whose name is taken as it stands where a pattern may be given."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder of that name."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)  # noqa: SLF001 - Spark has no test for a path
    return place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(place)  # noqa: SLF001


def partition_folders(spark: SparkSession, base: str, keys: Sequence[str]) -> list[str]:
    """The folders ``key=.../key=...`` below ``base``, by name; one listing of the levels above the last key, no file is listed."""
    pattern = "/".join(literal_path(escaped(k)) + "=*" for k in keys)
    hadoop, place = spark._jvm.org.apache.hadoop.fs, clean_path(literal_path(base), pattern)  # noqa: SLF001 - Spark lists files only
    found = hadoop.Path(place).getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).globStatus(hadoop.Path(place))  # noqa: SLF001
    if not found:
        return []
    # all names cross from the JVM as one text
    names = spark._jvm.scala.collection.immutable.ArraySeq.unsafeWrapArray(hadoop.FileUtil.stat2Paths(found)).mkString("\0")  # noqa: SLF001
    return sorted("/".join(name.split("/")[-len(keys) :]) for name in names.split("\0"))


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Read a table; a path that does not exist raises ``SourceMissing``."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise SourceMissing(path) from error
        raise


def read_partition(
    spark: SparkSession, base: str, keys: Sequence[str], schema: StructType | None = None, **equal: str
) -> DataFrame:
    """Read a partitioned table, restricted to the given partition values.

    Partition columns stay text, so month ``01`` does not turn into the number 1. Values of the
    leading keys name a folder, and only that folder is listed; values of other keys filter on
    partition columns. The columns remain. A known ``schema`` saves reading it from the files.
    """
    for key in equal:
        if key not in keys:
            raise ValueError(f"{key} is not a partition column")
    leading = []
    for key in keys:
        if key not in equal:
            break
        leading.append(f"{key}={escaped(str(equal[key]))}")
    folder = clean_path(base, *leading)
    text = [StructField(k, StringType()) for k in keys]
    try:
        if schema is None:
            schema = spark.read.option("basePath", base).parquet(folder).schema
        df = (
            spark.read.schema(StructType([f for f in schema if f.name not in keys] + text))
            .option("basePath", base)
            .parquet(folder)
        )
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        # no such partition: the table without rows, if there is a table
        return read_parquet(spark, base).limit(0) if leading else _missing(base, error)
    for key, value in equal.items():
        df = df.where(F.col(key) == value)
    return df


def _missing(path: str, error: Exception) -> DataFrame:
    raise SourceMissing(path) from error


def escaped(value: str) -> str:
    """A partition value as it stands in a folder's name."""
    special = set("\"#%'*/:=?\\{[]^\x7f") | {chr(c) for c in range(1, 32)}
    return "".join(f"%{ord(c):02X}" if c in special else c for c in value)


#: Folder name of a null partition value.
NULL_VALUE = "__HIVE_DEFAULT_PARTITION__"


def named_nulls(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Text keys with the folder name of null in place of null and empty text, which the writer puts there anyhow.

    Before the shuffle of a layout this costs little; for keys that may be null the writer copies each row once more.
    """
    named = {k: F.coalesce(F.nullif(F.col(k), F.lit("")), F.lit(NULL_VALUE)) for k in keys if df.schema[k].dataType == StringType()}
    return df.withColumns(named)


#: Bytes of a file that a sized layout aims at.
FILE_BYTES = 128 << 20


def repartition_for_write(
    df: DataFrame,
    layout: str | int = "none",
    keys: Sequence[str] = (),
    input_bytes: int | None = None,
    file_bytes: int = FILE_BYTES,
) -> DataFrame:
    """Arrange rows before a partitioned write.

    ``none``       no shuffle; right when each input file already covers few partitions.
    ``rebalance``  shuffle by ``keys``; adaptive execution splits a hot key over several tasks and
                   merges small ones, so no task has to hold a whole large partition.
    ``sized``      as many files for a partition as its share of ``input_bytes`` makes files of ``file_bytes``; the rows
                   of a partition are counted first, which reads the columns that ``keys`` come from.
    a number       round-robin into that many tasks.
    """
    if layout == "none":
        return df
    if layout == "rebalance":
        return df.hint("rebalance", *[F.col(k) for k in keys])
    if layout == "sized":
        return _sized(df, keys, input_bytes, file_bytes)
    return df.repartition(int(layout))


def file_counts(counts: DataFrame, input_bytes: int, file_bytes: int = FILE_BYTES) -> DataFrame:
    """``_files`` for each partition from its ``_rows``: its share of all bytes in files of at most ``file_bytes``."""
    total = counts.agg(F.sum("_rows")).first()[0] or 1
    share = F.col("_rows") * F.lit(input_bytes / total / file_bytes)
    return counts.withColumn("_files", F.greatest(F.ceil(share), F.lit(1)).cast("int"))


def _sized(df: DataFrame, keys: Sequence[str], input_bytes: int | None, file_bytes: int) -> DataFrame:
    if input_bytes is None:
        raise ValueError("a sized layout needs the bytes of its input")
    counts = df.groupBy(*[F.col(k) for k in keys]).agg(F.count(F.lit(1)).alias("_rows"))
    files = materialize(file_counts(materialize(counts, "rows"), input_bytes, file_bytes).drop("_rows"), "layout")
    tasks = int(files.agg(F.sum("_files")).first()[0] or 1)
    same = [df[k].eqNullSafe(files[k]) for k in keys]
    # one row per partition of the table; the number of a row within its task spreads a partition's rows evenly
    spread = (
        df.withColumn("_place", F.monotonically_increasing_id())
        .join(F.broadcast(files), reduce(lambda a, b: a & b, same))
        .select(*[df[c] for c in df.columns], F.pmod("_place", "_files").alias("_file"))
    )
    return spread.repartition(tasks, *keys, "_file").drop("_file")


#: Partitions that a task keeps open while it writes; only the rows of further ones are sorted first.
OPEN_PARTITIONS = 16


@contextmanager
def open_partitions(spark: SparkSession) -> Iterator[None]:
    """Let the tasks of a write keep ``OPEN_PARTITIONS`` partitions open, or more where the session says so.

    A sort by partition would hold the whole rows of a task and compare their keys; open files hold encoded columns.
    """
    setting = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(setting)
    spark.conf.set(setting, str(max(OPEN_PARTITIONS, int(before))))
    try:
        yield
    finally:
        spark.conf.set(setting, before)


def write_partitioned(df: DataFrame, path: str, keys: Sequence[str], mode: str = "dynamic") -> None:
    """Overwrite as partitioned Parquet; failures are raised.

    ``dynamic`` replaces only the partitions that ``df`` contains, which makes a re-run of one month
    repeatable; ``static`` replaces the whole table.
    """
    if mode not in ("dynamic", "static"):
        raise ValueError(f"unknown overwrite mode {mode!r}")
    with open_partitions(df.sparkSession):
        df.write.mode("overwrite").option("partitionOverwriteMode", mode).partitionBy(*keys).parquet(path)


def bounded_sample(df: DataFrame, n: int, order_by: Sequence[str] | None = None, seed: int = 0) -> DataFrame:
    """``n`` rows as a small table of its own: the first ones if an order is named, else a uniform choice.

    The choice takes the rows whose numbers have the least hashes, so it is the same each time while the files and
    their splits stay as they are. The row count gives a bound that only a few more than ``n`` hashes are below. The best
    rows of each task are merged in groups of tasks and then once more, so no task merges those of all others. The
    rows are written by the tasks and never pass through the driver; every use of the sample sees the same ones.
    """
    if order_by:
        return materialize(_first_rows(df, n, [F.col(c) for c in order_by]).drop("_group"), "sample")
    total = df.count()
    # five standard deviations above n
    bound = min(1.0, (n + 5 * n**0.5 + 25) / max(total, 1))
    hashed = df.withColumn("_hash", F.xxhash64(F.monotonically_increasing_id(), F.lit(seed)))
    if bound < 1:
        hashed = hashed.where(F.col("_hash") <= min(int((2 * bound - 1) * 2**63), 2**63 - 1))
    return materialize(_first_rows(hashed, n, [F.col("_hash")]).drop("_hash", "_group"), "sample")


def _first_rows(df: DataFrame, n: int, order: Sequence[Column]) -> DataFrame:
    tasks = df.rdd.getNumPartitions()
    groups = int(tasks**0.5)
    if groups > MERGED_AT_ONCE:
        grouped = df.withColumn("_group", F.pmod(F.spark_partition_id(), F.lit(groups)))
        best = Window.partitionBy("_group").orderBy(*order)
        df = grouped.withColumn("_nth", F.row_number().over(best)).where(F.col("_nth") <= n).drop("_nth")
    return df.orderBy(*order).limit(n)


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    """The first rows, to look at."""
    return df.limit(n)


def quoted(name: str) -> str:
    return ".".join(f"`{part.replace('`', '``')}`" for part in name.split("."))


def register_table(spark: SparkSession, name: str, schema: StructType, path: str, keys: Sequence[str]) -> None:
    """Create an external Parquet table over ``path`` unless it exists.

    ``schema`` holds all columns; those in ``keys`` become the partition columns.
    """
    columns = [f for f in schema if f.name not in keys] + [schema[k] for k in keys]
    ddl = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in columns)
    by = f"PARTITIONED BY ({', '.join(quoted(k) for k in keys)})" if keys else ""
    location = path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {quoted(name)} ({ddl}) USING parquet {by} LOCATION '{location}'")


def repair_table(spark: SparkSession, name: str) -> None:
    """Let the catalog find partitions that were written to the table's path."""
    spark.sql(f"MSCK REPAIR TABLE {quoted(name)}")
