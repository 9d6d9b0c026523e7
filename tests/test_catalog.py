import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from sedimenta.sources import catalog as c


def write(path, **columns):
    pq.write_table(pa.table(columns), path)


@pytest.fixture
def raw(tmp_path):
    write(tmp_path / "a.parquet", VendorID=[1], fare=[1.5])
    write(tmp_path / "b [1] x.parquet", fare=[2.5], VendorID=[2])
    write(tmp_path / "c.parquet", vendorid=["3"], fare=[3])
    (tmp_path / "text.parquet").write_text("this is no table at all")
    (tmp_path / "empty.parquet").write_bytes(b"")
    (tmp_path / "short.parquet").write_bytes(b"PAR1")
    good = (tmp_path / "a.parquet").read_bytes()
    (tmp_path / "cut.parquet").write_bytes(good[: len(good) // 2])
    damaged = bytearray(good)
    length = int.from_bytes(good[-8:-4], "little")
    damaged[-8 - length : -8] = b"\xff" * length
    (tmp_path / "damaged.parquet").write_bytes(bytes(damaged))
    write(tmp_path / "UPPER.PARQUET", x=[1])
    write(tmp_path / "notes.txt", x=[1])
    (tmp_path / "deep").mkdir()
    write(tmp_path / "deep" / "below.parquet", x=[1])
    (tmp_path / "set.parquet").mkdir()
    write(tmp_path / "set.parquet" / "part-0.parquet", VendorID=[4], fare=[4.5])
    return str(tmp_path)


def base(path):
    return path.rsplit("/", 1)[1]


def test_file_catalog_is_flat_and_case_sensitive(spark, raw):
    rows = c.file_catalog(spark, raw).collect()
    assert sorted(base(r.path) for r in rows) == sorted(
        ["a.parquet", "b [1] x.parquet", "c.parquet", "text.parquet", "short.parquet", "cut.parquet", "damaged.parquet", "empty.parquet", "part-0.parquet"]
    )
    sizes = {base(r.path): r.length for r in rows}
    assert sizes["a.parquet"] == os.path.getsize(f"{raw}/a.parquet")


def test_file_catalog_of_several_roots(spark, raw):
    rows = c.file_catalog(spark, [raw, f"{raw}/deep"]).collect()
    assert "below.parquet" in {base(r.path) for r in rows}


def test_missing_root(spark, tmp_path):
    with pytest.raises(c.SourceMissing):
        c.file_catalog(spark, str(tmp_path / "nowhere"))


def test_schema_catalog_and_quarantine(spark, raw):
    good, bad = c.split_quarantine(c.schema_catalog(c.file_catalog(spark, raw)))
    assert {base(r.path) for r in bad.collect()} == {"text.parquet", "short.parquet", "cut.parquet", "damaged.parquet", "empty.parquet"}
    assert all(r.error for r in bad.collect())
    rows = good.collect()
    assert {(base(r.path), r.pos, r.name, r.type) for r in rows} >= {
        ("a.parquet", 0, "VendorID", "int64"),
        ("a.parquet", 1, "fare", "double"),
        ("c.parquet", 0, "vendorid", "string"),
    }
    prints = {base(r.path): r.fingerprint for r in rows}
    assert prints["a.parquet"] == prints["b [1] x.parquet"] == prints["part-0.parquet"] != prints["c.parquet"]
    assert c.occurrences(good).count() == 4


def test_lost_connection_is_not_a_bad_file(spark, raw):
    def unreachable(path):
        raise OSError("connection reset")

    with pytest.raises(Exception, match="connection reset"):
        c.schema_catalog(c.file_catalog(spark, raw), unreachable).collect()


def test_scan_groups_read_each_schema_once(spark, raw):
    good, _ = c.split_quarantine(c.schema_catalog(c.file_catalog(spark, raw)))
    groups = c.scan_groups(spark, good)
    assert len(groups) == 2
    by_columns = {g.columns: sorted(r.fare for r in g.df.collect()) for g in groups}
    assert sorted(map(tuple, by_columns.values())) == [(1.5, 2.5, 4.5), (3,)]


def test_roots_of_every_spelling(spark, tmp_path, monkeypatch):
    for folder in ("draw/raw", "other/raw"):
        (tmp_path / folder).mkdir(parents=True)
        write(tmp_path / folder / "a.parquet", x=[1])
        write(tmp_path / folder / "b.pq", x=[1])
    (tmp_path / "draw" / "raw [1]").mkdir()
    write(tmp_path / "draw" / "raw [1]" / "c.parquet", x=[1])

    def found(root, glob="*.parquet"):
        return sorted(r.path.split(str(tmp_path))[1] for r in c.file_catalog(spark, root, glob).collect())

    assert found(f"{tmp_path}/draw/../draw/raw") == ["/draw/raw/a.parquet"]
    assert found(f"{tmp_path}/*/raw") == ["/draw/raw/a.parquet", "/other/raw/a.parquet"]
    assert found(f"file://{tmp_path}/{{draw,other}}/raw/", "*.{parquet,pq}") == [
        "/draw/raw/a.parquet", "/draw/raw/b.pq", "/other/raw/a.parquet", "/other/raw/b.pq",
    ]
    assert found(f"{tmp_path}/draw/raw [1]") == ["/draw/raw [1]/c.parquet"]
    assert found(f"{tmp_path}/draw/raw/a.parquet") == ["/draw/raw/a.parquet"]
    relative = os.path.relpath(tmp_path / "draw" / "raw")
    assert found(relative) == ["/draw/raw/a.parquet"]


def test_nested_dataset_folders(spark, tmp_path):
    (tmp_path / "z.parquet" / "y=0").mkdir(parents=True)
    write(tmp_path / "z.parquet" / "y=0" / "part-0.parquet", x=[1])
    (tmp_path / "z.parquet" / "_temporary").mkdir()
    write(tmp_path / "z.parquet" / "_temporary" / "part-9.parquet", x=[1])
    (tmp_path / "z.parquet" / "_SUCCESS").write_bytes(b"")
    assert [base(r.path) for r in c.file_catalog(spark, str(tmp_path)).collect()] == ["part-0.parquet"]


def test_files_that_spark_cannot_read_are_quarantined(spark, tmp_path):
    write(tmp_path / "good.parquet", x=[1], t=pa.array([1], pa.timestamp("us")), u=pa.array([1], pa.uint64()))
    write(tmp_path / "nanos.parquet", x=[1], t=pa.array([1], pa.timestamp("ns")))
    write(tmp_path / "time.parquet", x=[1], t=pa.array([1], pa.time64("ns")))
    write(tmp_path / "case.parquet", vendorid=[1], VendorID=[2])
    pq.write_table(pa.table({"t": pa.array([1], pa.timestamp("ns"))}), tmp_path / "old.parquet", use_deprecated_int96_timestamps=True)
    nested = pa.array([{"a": [1, 2], "b": "x"}])
    pq.write_table(pa.table({"s": nested, "d": pa.array(["x"]).dictionary_encode()}), tmp_path / "nested.parquet")
    good, bad = c.split_quarantine(c.schema_catalog(c.file_catalog(spark, str(tmp_path))))
    reasons = {base(r.path): r.error for r in bad.collect()}
    assert set(reasons) == {"nanos.parquet", "time.parquet", "case.parquet"}
    assert "nanoseconds" in reasons["nanos.parquet"] and "VendorID" in reasons["case.parquet"]
    groups = c.scan_groups(spark, good)
    assert sorted(len(g.df.collect()) for g in groups) == [1, 1, 1]
    for g in groups:  # the catalog's schema is the one Spark would infer
        assert g.df.schema == spark.read.parquet(*g.df.inputFiles()).schema


def test_only_the_named_partition_is_listed(spark, tmp_path):
    from pyspark.sql import functions as F

    from sedimenta.sources import lake

    path = str(tmp_path / "table")
    lake.write_partitioned(spark.range(6).select("id", F.lit("a b").alias("k"), (F.col("id") % 3).cast("string").alias("m")), path, ["k", "m"])
    (tmp_path / "table" / "k=other" / "m=0").mkdir(parents=True)
    (tmp_path / "table" / "k=other" / "m=0" / "part-0.parquet").write_text("not to be opened")
    df = lake.read_partition(spark, path, ["k", "m"], k="a b")
    assert df.columns == ["id", "k", "m"] and df.count() == 6
    assert lake.read_partition(spark, path, ["k", "m"], k="a b", m="1").count() == 2
    assert lake.read_partition(spark, path, ["k", "m"], df.schema, m="1", k="a b").count() == 2
    assert lake.read_partition(spark, path, ["k", "m"], df.schema, k="none").count() == 0
    with pytest.raises(c.SourceMissing):
        lake.read_partition(spark, str(tmp_path / "nowhere"), ["k"], k="1")


@pytest.mark.parametrize("name", ["q_file_catalog", "q_schema_catalog", "q_quarantine"])
def test_tables_in_several_files(spark, tmp_path, name):
    import duckdb

    from checks import compare

    source = "/root/testdata/sf0.001"
    if not os.path.isdir(source):
        pytest.skip("benchmark tables are not here")
    db = duckdb.connect()
    for table in compare.TABLES:
        rows = pq.read_table(f"{source}/{table}.parquet")
        if table in ("documents", "embeddings", "labels"):
            (tmp_path / f"{table}.parquet").mkdir()
            for i in range(3):
                pq.write_table(rows.slice(i * rows.num_rows // 3, 5), tmp_path / f"{table}.parquet" / f"part-{i:04}.parquet")
        else:
            pq.write_table(rows, tmp_path / f"{table}.parquet")
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{source}/{table}.parquet'")
    assert compare.differences(spark, db, str(tmp_path), name) == []
