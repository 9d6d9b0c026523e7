"""Which files there are, which columns they hold, and which of them cannot be read."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from functools import reduce
from typing import Any, BinaryIO
from urllib.parse import unquote

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructField, StructType

from sedimenta.sources.lake import SourceMissing, literal_path

CATALOG_SCHEMA = "path string, fingerprint string, pos int, name string, type string, sql_type string, error string"


@dataclass(frozen=True)
class SchemaGroup:
    """All files that share one schema, as a single scan."""

    fingerprint: str
    columns: tuple[str, ...]
    df: DataFrame


def _tops(spark: SparkSession, root: str) -> list[str]:
    """What a root stands for: itself, or the folders and files that it is a pattern of."""
    hadoop = spark._jvm.org.apache.hadoop.fs  # noqa: SLF001 - Spark has no test for a path
    path = hadoop.Path(root)
    system = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())  # noqa: SLF001
    # a folder may have brackets in its name, so the name as it stands comes first
    tops = system.globStatus(hadoop.Path(literal_path(root))) or system.globStatus(path)
    if not tops:
        raise SourceMissing(root)
    return [t.getPath().toString() + ("/" if t.isDirectory() else "") for t in tops]


def _sequence(spark: SparkSession, array: object) -> object:
    """A JVM array as a sequence there; its elements never become calls of their own."""
    return spark._jvm.scala.collection.immutable.ArraySeq.unsafeWrapArray(array)  # noqa: SLF001


def _listing(spark: SparkSession, top: str, glob: str) -> DataFrame | None:
    """The files of one root.

    Spark matches the names, lists the folders among them in parallel, and reads length and time of each
    file in a task; the contents are not asked for. Scans leave out files of length zero, so those come from the
    names of the same listing.
    """
    jvm = spark._jvm  # noqa: SLF001
    inside = top.endswith("/")
    if not inside and not jvm.org.apache.hadoop.fs.GlobFilter(glob).accept(jvm.org.apache.hadoop.fs.Path(top)):
        return None
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    try:
        listed = reader.load(literal_path(top) + glob if inside else literal_path(top))
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    files = listed.select("path", "length", F.col("modificationTime").alias("modified"))
    names = unquote(_sequence(spark, listed._jdf.inputFiles()).mkString("\0"))  # noqa: SLF001
    every = spark.createDataFrame(pd.DataFrame({"path": names.split("\0") if names else []}), "path string")
    # an address of a local file has an empty host, its path has none
    every = every.select(F.regexp_replace("path", "^file:///", "file:/").alias("path"))
    blank = every.join(files, "path", "left_anti").select(
        "path", F.lit(0).cast("long").alias("length"), F.lit(None).cast("timestamp").alias("modified")
    )
    # folders like _temporary are skipped by the listing, marker files of a dataset here
    below = F.split(F.substring("path", F.lit(len(top) + 1), F.length("path")), "/")
    hidden = F.exists(F.slice(below, 2, 1 << 30), lambda part: part.rlike("^[._]"))
    found = files.unionByName(blank)
    return found.where(~hidden) if inside else found


def file_catalog(spark: SparkSession, roots: str | Iterable[str], glob: str = "*.parquet") -> DataFrame:
    """Files directly below each root whose name matches ``glob``: ``path, length, modified``.

    A directory whose name matches is a dataset: all files in it count, at any depth. Hidden and marker files do
    not count, and other subdirectories are not entered. A root may be a relative path, a glob that stands for
    several folders, or a file. File contents are never read. ``modified`` is null for files of length zero.
    """
    tops = [top for root in ([roots] if isinstance(roots, str) else roots) for top in _tops(spark, root)]
    found = [df for top in tops if (df := _listing(spark, top, glob)) is not None]
    if not found:
        return spark.createDataFrame([], "path string, length long, modified timestamp")
    # Spark deals files out by size, as if it were to read them; a listing needs few tasks
    return reduce(DataFrame.unionByName, found).coalesce(4 * spark.sparkContext.defaultParallelism)


def open_with_arrow(path: str) -> BinaryIO:
    """Open a local or object-store path with Arrow's own file systems."""
    from pyarrow import fs

    uri = re.sub("^s3[an]:", "s3:", path)
    if uri.startswith("file:"):
        uri = "file:///" + uri[len("file:") :].lstrip("/")
    if "://" not in uri or uri.startswith("file:"):
        return fs.LocalFileSystem().open_input_file(re.sub("^file://", "", uri))
    system, name = fs.FileSystem.from_uri(uri)
    return system.open_input_file(name)


def _footer(handle: BinaryIO) -> bytes:
    """The footer of a Parquet file as a minimal file of its own; may raise ``ValueError``."""
    size = handle.seek(0, 2) or handle.tell()
    if size < 12:
        raise ValueError("too short for a Parquet file")
    handle.seek(size - 8)
    end = handle.read(8)
    length = int.from_bytes(end[:4], "little")
    if end[4:] != b"PAR1":
        raise ValueError("no Parquet magic bytes at the end")
    if length > size - 12:
        raise ValueError("footer longer than the file")
    handle.seek(size - 8 - length)
    return b"PAR1" + handle.read(length) + end


def _sql_type(kind: Any) -> str:
    """The Spark type in which Spark's reader gives an Arrow type; raises ``ValueError`` where it gives none."""
    import pyarrow.types as t

    plain = {
        "bool": "boolean", "int8": "tinyint", "int16": "smallint", "int32": "int", "int64": "bigint",
        "uint8": "smallint", "uint16": "int", "uint32": "bigint", "uint64": "decimal(20,0)",
        "float": "float", "double": "double", "string": "string", "large_string": "string",
        "binary": "binary", "large_binary": "binary", "date32[day]": "date",
    }
    if str(kind) in plain:
        return plain[str(kind)]
    if t.is_timestamp(kind) and kind.unit != "ns":
        return "timestamp" if kind.tz else "timestamp_ntz"
    if t.is_timestamp(kind):
        raise ValueError("timestamps in nanoseconds")
    if t.is_decimal(kind) and kind.precision <= 38:
        return f"decimal({kind.precision},{kind.scale})"
    if t.is_fixed_size_binary(kind):
        return "binary"
    if t.is_dictionary(kind):
        return _sql_type(kind.value_type)
    if t.is_map(kind):
        return f"map<{_sql_type(kind.key_type)},{_sql_type(kind.item_type)}>"
    if t.is_list(kind) or t.is_large_list(kind) or t.is_fixed_size_list(kind):
        return f"array<{_sql_type(kind.value_type)}>"
    if t.is_struct(kind):
        names = [f"`{f.name.replace('`', '``')}`:{_sql_type(f.type)}" for f in kind]
        return f"struct<{','.join(names)}>"
    raise ValueError(f"type {kind}")


def _fields(footer: bytes, case_sensitive: bool) -> list[tuple[str, str, str]]:
    """Name, Arrow type and Spark type of each column; raises for what Spark cannot read."""
    import pyarrow as pa
    import pyarrow.parquet as pq

    file = pq.ParquetFile(pa.BufferReader(footer))
    leaves = file.metadata.schema
    # Arrow shows these old 96-bit timestamps as nanoseconds; Spark reads them
    old = {leaves.column(i).path.split(".")[0] for i in range(len(leaves)) if leaves.column(i).physical_type == "INT96"}
    fields = []
    for field in file.schema_arrow:
        try:
            fields.append((field.name, str(field.type), "timestamp" if field.name in old else _sql_type(field.type)))
        except ValueError as error:
            raise ValueError(f"column {field.name}: Spark does not read {error}") from error
    seen: dict[str, str] = {}
    for name, _, _ in fields:
        other = seen.setdefault(name if case_sensitive else name.lower(), name)
        if other is not name:
            raise ValueError(f"columns {other} and {name} differ by case only")
    return fields


def _columns_of(path: str, opener: Callable[[str], BinaryIO], case_sensitive: bool) -> list[dict]:
    """Catalog rows of one file.

    Reading bytes may raise: a lost connection fails the task and Spark tries again. Only bytes
    that are no Parquet footer, or columns that Spark cannot read, make the file unreadable.
    """
    blank = dict.fromkeys(("fingerprint", "pos", "name", "type", "sql_type", "error"))
    with opener(path) as handle:
        try:
            footer = _footer(handle)
        except ValueError as error:
            return [{**blank, "path": path, "error": str(error)}]
    try:
        fields = _fields(footer, case_sensitive)
    except Exception as error:  # noqa: BLE001 - any decoding failure means a damaged footer
        return [{**blank, "path": path, "error": str(error).strip() or type(error).__name__}]
    if not fields:
        return [{**blank, "path": path, "error": "no columns"}]
    spelled = sorted(f"{name}:{kind}:{sql}" for name, kind, sql in fields)
    fingerprint = hashlib.sha256("\n".join(spelled).encode()).hexdigest()
    return [
        {"path": path, "fingerprint": fingerprint, "pos": i, "name": name, "type": kind, "sql_type": sql, "error": None}
        for i, (name, kind, sql) in enumerate(fields)
    ]


def schema_catalog(files: DataFrame, opener: Callable[[str], BinaryIO] = open_with_arrow) -> DataFrame:
    """One row per file and column, read from the footers on the executors.

    An unreadable file gives one row with ``error``: no Parquet footer, or columns that Spark cannot
    read. ``opener`` may be replaced for file systems that Arrow does not know. The paths are spread
    over as many tasks as there are cores.
    """
    cores = files.sparkSession.sparkContext.defaultParallelism
    case_sensitive = files.sparkSession.conf.get("spark.sql.caseSensitive") == "true"

    def harvest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [row for path in batch["path"] for row in _columns_of(path, opener, case_sensitive)]
            names = ["path", "fingerprint", "pos", "name", "type", "sql_type", "error"]
            frame = pd.DataFrame(rows, columns=names)
            yield frame.astype({"pos": "Int32"})

    return files.select("path").repartition(cores).mapInPandas(harvest, CATALOG_SCHEMA)


def split_quarantine(catalog: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Catalog rows of readable files, and ``path, error`` of the others."""
    good = catalog.where(F.col("error").isNull()).drop("error")
    return good, catalog.where(F.col("error").isNotNull()).select("path", "error")


def occurrences(good: DataFrame) -> DataFrame:
    """Distinct ``source, name``: which column names occur together.

    Files with equal schemas count once, so the size follows the number of schemas.
    """
    return good.select(F.col("fingerprint").alias("source"), "name").distinct()


def _read_files(spark: SparkSession, schema: StructType, paths: list[str]) -> DataFrame:
    """One scan of many files. The paths go to Spark as one text, not with a call for each of them."""
    names = spark._jvm.org.apache.commons.lang3.StringUtils.split("\0".join(paths), "\0")  # noqa: SLF001
    return DataFrame(spark.read.schema(schema)._jreader.parquet(_sequence(spark, names)), spark)  # noqa: SLF001


def scan_groups(spark: SparkSession, good: DataFrame) -> list[SchemaGroup]:
    """One scan per distinct schema, so the plan grows with the schemas and not with the files.

    Column types can differ between files, which a single scan cannot read. The schema comes from the
    catalog, so no footer is read again to infer it. The paths reach the driver, one string per
    file, because Spark's own file listing is kept there too.
    """
    schemas: dict[str, list[StructField]] = {}
    paths: dict[str, list[str]] = {}
    columns = good.groupBy("fingerprint", "pos").agg(F.first("name").alias("name"), F.first("sql_type").alias("sql_type"))
    for row in columns.orderBy("fingerprint", "pos").collect():
        schemas.setdefault(row.fingerprint, []).append(StructField(row.name, DataType.fromDDL(row.sql_type)))
    for row in good.select("fingerprint", "path").where("pos = 0").toLocalIterator():
        paths.setdefault(row.fingerprint, []).append(literal_path(row.path))
    return [
        SchemaGroup(f, tuple(x.name for x in fields), _read_files(spark, StructType(fields), sorted(paths[f])))
        for f, fields in schemas.items()
    ]
