import os
from datetime import timedelta

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from sedimenta.sources import lake, manifest
from sedimenta.sources import published as p
from sedimenta.sources.catalog import open_with_arrow

KEYS = ["year", "month"]


def months(spark, n=60, sign=1):
    year = F.when(F.col("id") % 7 == 0, F.lit(None)).otherwise(F.concat(F.lit("20"), (F.col("id") % 2 + 23).cast("string")))
    month = F.when(F.col("id") % 5 == 0, F.lit("a/b=c'd ü")).otherwise(F.lpad((F.col("id") % 3 + 1).cast("string"), 2, "0"))
    return spark.range(n).select("id", (F.col("id") * sign).alias("v"), year.alias("year"), month.alias("month"))


def rows(df):
    return sorted(tuple(r) for r in df.select("id", "v", F.coalesce("year", F.lit("-")), "month").collect())


def test_round_trip_and_replacement(spark, tmp_path):
    base = str(tmp_path / "orders [1]")
    assert not p.is_published(spark, base)
    with pytest.raises(lake.SourceMissing):
        p.read_published(spark, base, KEYS)
    df = months(spark)
    staged = p.stage(df, base, KEYS, [F.max("id").alias("last")])
    assert staged.metrics == {"rows": 60, "last": 59}
    with pytest.raises(lake.SourceMissing):
        p.read_published(spark, base, KEYS)  # written, not yet published
    p.publish(spark, staged)
    assert p.is_published(spark, base) and rows(p.read_published(spark, base, KEYS)) == rows(df)
    part = p.read_published(spark, base, KEYS, year="2023", month="02")
    assert rows(part) == rows(df.where("year = '2023' and month = '02'")) and part.columns == ["id", "v", "year", "month"]
    assert all("year=2023/month=02" in f for f in part.inputFiles())
    assert p.read_published(spark, base, KEYS, month="77").count() == 0
    with pytest.raises(ValueError):
        p.read_published(spark, base, KEYS, id="1")

    again = months(spark, 200, -1).where("year = '2023' and month = '02'")
    gone = staged.folders[0]
    p.publish(spark, p.stage(again, base, KEYS), "second run", drop=[gone])
    want = rows(df.where("not (year <=> '2023' and month = '02')").unionByName(again))
    lost = {r for r in want if p._folder(KEYS, ("" if r[2] == "-" else r[2], r[3])) == gone}
    assert lost and rows(p.read_published(spark, base, KEYS)) == [r for r in want if r not in lost]
    assert [r.source for r in p.current(spark, base).collect() if r.source] == ["second run"]


def test_a_write_that_fails_changes_nothing(spark, tmp_path):
    base = str(tmp_path / "t")
    df = months(spark)
    p.publish(spark, p.stage(df, base, KEYS))
    # other partitions are complete on disk when the last one fails
    late = F.when(F.col("id") == 59, F.raise_error(F.lit("lost"))).otherwise(-F.col("v"))
    with pytest.raises(Exception, match="lost"):
        p.stage(df.repartition(6, "id").withColumn("v", late.cast("long")), base, KEYS)
    assert rows(p.read_published(spark, base, KEYS)) == rows(df)
    p.publish(spark, p.stage(df.withColumn("v", -F.col("v")), base, KEYS))
    assert rows(p.read_published(spark, base, KEYS)) == rows(months(spark, 60, -1))


def test_nothing_to_publish(spark, tmp_path):
    base = str(tmp_path / "t")
    staged = p.stage(months(spark).limit(0), base, KEYS)
    assert staged.folders == () and staged.metrics["rows"] == 0
    p.publish(spark, staged)
    assert not p.is_published(spark, base)


def test_partitions_come_from_the_folders_written(spark, tmp_path, monkeypatch):
    observed = []
    plain = type(months(spark)).observe
    monkeypatch.setattr(type(months(spark)), "observe", lambda self, seen, *columns: observed.append(len(columns)) or plain(self, seen, *columns))
    df = months(spark).withColumn("month", F.when(F.col("id") % 11 == 0, F.lit("")).otherwise(F.col("month")))
    staged = p.stage(df, str(tmp_path / "t [1]"), KEYS)
    # a set of partition values would be looked up for each row
    assert observed == [1] and staged.metrics == {"rows": 60}
    assert list(staged.folders) == sorted({p._folder(KEYS, r) for r in df.select(*KEYS).collect()})
    assert lake.partition_folders(spark, str(tmp_path / "t [1]"), KEYS) == []


def test_table_follows_publications_without_listing(spark, tmp_path, monkeypatch):
    base = str(tmp_path / "t")
    df = months(spark)
    p.publish(spark, p.stage(df, base, KEYS))
    statements = []
    plain = spark.sql
    monkeypatch.setattr(type(spark), "sql", lambda self, text, *a, **b: statements.append(text) or plain(text, *a, **b))
    p.sync_table(spark, "followed", df.schema, base, KEYS)
    assert rows(spark.table("followed")) == rows(df)
    assert not [s for s in statements if "REPAIR" in s or "RECOVER" in s]
    assert sum(s.startswith("ALTER TABLE `followed` ADD") for s in statements) == 1
    statements.clear()
    assert p.sync_table(spark, "followed", df.schema, base, KEYS) == 0
    assert not [s for s in statements if s.startswith("ALTER")]
    again = months(spark, 200, -1).where("month like 'a%' or year is null")
    dropped = "year=2023/month=02"
    p.publish(spark, p.stage(again, base, KEYS), drop=[dropped])
    assert p.sync_table(spark, "followed", df.schema, base, KEYS) == len({(r[2], r[3]) for r in rows(again)}) + 1
    want = df.where("not (month like 'a%' or year is null) and not (year = '2023' and month = '02')").unionByName(again)
    assert rows(spark.table("followed")) == rows(want) == rows(p.read_published(spark, base, KEYS))


def test_superseded_runs_are_dropped(spark, tmp_path):
    base = str(tmp_path / "t")
    for sign in (1, -1):
        p.publish(spark, p.stage(months(spark, 60, sign), base, KEYS))
    p.stage(months(spark), base, KEYS)  # never published
    assert p.drop_superseded(spark, base, timedelta(days=1)) == []
    assert len(p.drop_superseded(spark, base, timedelta(seconds=-5))) == 2
    assert rows(p.read_published(spark, base, KEYS)) == rows(months(spark, 60, -1))


def write(path, **columns):
    pq.write_table(pa.table(columns), path)


def test_refresh_opens_new_and_changed_files_only(spark, tmp_path):
    raw, base, seen = tmp_path / "raw", str(tmp_path / "manifest"), tmp_path / "seen"
    for folder in (raw, seen):
        folder.mkdir()

    def opener(path):
        with open(f"{seen}/{os.path.basename(path)}", "a") as mark:
            mark.write("x")
        return open_with_arrow(path)

    def opened():
        found = {name: (seen / name).read_text() for name in os.listdir(seen)}
        for name in found:
            (seen / name).write_text("")
        return sorted(name for name, marks in found.items() if marks)

    def state():
        out = {}
        for r in manifest.catalog(spark, base).collect():
            out.setdefault(os.path.basename(r.path), set()).add(r.name if r.error is None else "error")
        return out

    write(raw / "a.parquet", x=[1], y=[2])
    write(raw / "b.parquet", x=[3], y=[4])
    (raw / "bad.parquet").write_text("no table")
    (raw / "none.parquet").write_bytes(b"")
    assert manifest.refresh(spark, str(raw), base, opener=opener) == manifest.Refresh(4, 4, 0, 0)
    assert opened() == ["a.parquet", "b.parquet", "bad.parquet", "none.parquet"]
    assert state() == {"a.parquet": {"x", "y"}, "b.parquet": {"x", "y"}, "bad.parquet": {"error"}, "none.parquet": {"error"}}
    assert manifest.refresh(spark, str(raw), base, opener=opener) == manifest.Refresh(4, 0, 4, 0)
    assert opened() == []

    write(raw / "b.parquet", x=[3], z=["other"])
    write(raw / "c.parquet", x=[5])
    (raw / "a.parquet").rename(tmp_path / "elsewhere")
    assert manifest.refresh(spark, str(raw), base, opener=opener) == manifest.Refresh(4, 2, 2, 1)
    assert opened() == ["b.parquet", "c.parquet"]
    assert state() == {"b.parquet": {"x", "z"}, "c.parquet": {"x"}, "bad.parquet": {"error"}, "none.parquet": {"error"}}


def test_a_refresh_that_fails_keeps_the_catalog(spark, tmp_path):
    raw, base = tmp_path / "raw", str(tmp_path / "manifest")
    raw.mkdir()
    write(raw / "a.parquet", x=[1])
    manifest.refresh(spark, str(raw), base)
    write(raw / "b.parquet", x=[1])

    def lost(path):
        raise OSError("connection reset")

    with pytest.raises(Exception, match="connection reset"):
        manifest.refresh(spark, str(raw), base, opener=lost)
    assert [os.path.basename(r.path) for r in manifest.catalog(spark, base).collect()] == ["a.parquet"]
    assert manifest.refresh(spark, str(raw), base).opened == 1
