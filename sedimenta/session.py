"""Where intermediate tables live and how lineage is cut."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from functools import lru_cache
from pathlib import Path

from pyspark.sql import Column, DataFrame, Observation, SparkSession


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Hand this package to the executors, once per application."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        home = Path(__file__).resolve().parent
        folder = tempfile.mkdtemp(prefix="package-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        archive = f"{folder}/{home.name}"
        context.addPyFile(shutil.make_archive(archive, "zip", home.parent, home.name))
        _shipped.add(context.applicationId)


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach, taken from ``spark.checkpoint.dir``.

    Only a local-mode session may fall back to a temporary folder, which goes when Python ends: on a
    cluster such a folder would vanish with the machine that holds it.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    return _local_root(spark.sparkContext.applicationId)


@lru_cache
def _local_root(application: str) -> str:
    folder = tempfile.mkdtemp(prefix="sedimenta-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


#: Paths handed out since the innermost ``scratch_scope`` began.
_handed_out: ContextVar[list[str] | None] = ContextVar("handed_out", default=None)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, never reused path below the shared root."""
    path = f"{shared_root(spark)}/{label}-{uuid.uuid4().hex}"
    made = _handed_out.get()
    if made is not None:
        made.append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Delete the intermediate tables of a piece of work when it ends, well or not.

    For work whose results do not read them any more.
    """
    token = _handed_out.set([])
    try:
        yield
    finally:
        made = _handed_out.get()
        _handed_out.reset(token)
        hadoop = spark._jvm.org.apache.hadoop.fs  # noqa: SLF001 - Spark deletes no files
        conf = spark._jsparkSession.sessionState().newHadoopConf()  # noqa: SLF001
        for path in made:
            place = hadoop.Path(path)
            place.getFileSystem(conf).delete(place, True)


def materialize(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    The result has no lineage to recompute when an executor is lost, is evaluated once however
    often it is used, and carries file sizes, so join strategies are picked from real sizes.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def materialize_counting(df: DataFrame, count: Column, label: str = "stage") -> tuple[DataFrame, int]:
    """``materialize`` plus an aggregate over the written rows, observed during the same job."""
    seen = Observation()
    return materialize(df.observe(seen, count.alias("count")), label), seen.get["count"]
