import dataclasses

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from sedimenta import presets
from sedimenta.__main__ import run
from sedimenta.operators import marts
from sedimenta.operators.quality import between
from sedimenta.plans import jobs
from sedimenta.plans.specs import RunConfig
from sedimenta.sources import lake, published
from sedimenta.sources.catalog import SourceMissing


def trips(day, n, **names):
    base = {
        "VendorID": [1] * n,
        "tpep_pickup_datetime": [f"{day} {h % 24:02d}:15:00" for h in range(n)],
        "dropoff_datetime": [f"{day} {h % 24:02d}:45:00" for h in range(n)],
        "passenger_count": [float(1 + h % 3) for h in range(n)],
        "fare_amount": [10.0] * n,
        "tip_amount": [None if h % 2 else 2.5 for h in range(n)],
    }
    return pa.table({names.get(k, k): v for k, v in base.items()})


@pytest.fixture
def folders(tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    pq.write_table(trips("2023-01-10", 6), raw / "yellow_tripdata_2023-01.parquet")
    pq.write_table(trips("2023-02-10", 4, VendorID="vendor_id", passenger_count="PassengerCount"), raw / "yellow_tripdata_2023-02.parquet")
    pq.write_table(trips("2023-02-11", 3, VendorID="vendorid"), raw / "green_tripdata_2023-02.parquet")
    (raw / "broken.parquet").write_text("broken")
    pq.write_table(pa.table({"zzz": [1]}), raw / "other.parquet")
    return {"raw": str(raw), "bronze": str(tmp_path / "bronze"), "silver": str(tmp_path / "silver"), "root": tmp_path}


def config(folders, table, **silver):
    return RunConfig(
        folders["raw"], folders["bronze"], folders["silver"], table,
        presets.TRIP_BRONZE, dataclasses.replace(presets.TRIP_SILVER, **silver), presets.TRIP_MARTS,
    )


def test_full_run_twice(spark, folders):
    for name in ("first_run", "second_run"):
        bronze, silver, marts = jobs.run_all(spark, config(folders, name))
        assert (bronze.status, bronze.rows, silver.status, silver.rows, marts.status) == ("ok", 14, "ok", 10, "ok")
        monthly = {(r.year, r.month): r.media_valor_arrecadado for r in marts.frames["monthly"].collect()}
        assert monthly == {("2023", "01"): 11.25, ("2023", "02"): 11.25}
        assert marts.frames["hourly"].count() == 10
    assert spark.read.parquet(folders["bronze"]).count() == 14
    kept = lake.read_partition(spark, folders["bronze"], presets.BRONZE_KEYS, source_type="green")
    assert (kept.count(), kept.first().month) == (3, "02")
    report = {(r.expectation, r["column"]): r.violations for r in silver.quality.collect()}
    assert report["between", "total_amount"] == 0 and report["not_null", "vendorid"] == 0


def test_new_month_leaves_others_alone(spark, folders):
    jobs.run_bronze(spark, folders["raw"], folders["bronze"], presets.TRIP_BRONZE)
    later = folders["root"] / "later"
    later.mkdir()
    pq.write_table(trips("2023-02-20", 2), later / "yellow_tripdata_2023-02.parquet")
    again = jobs.run_bronze(spark, str(later), folders["bronze"], presets.TRIP_BRONZE)
    assert again.rows == 2
    df = lake.read_partition(spark, folders["bronze"], presets.BRONZE_KEYS, source_type="yellow")
    assert {r.month: r.n for r in df.groupBy("month").agg(F.count("*").alias("n")).collect()} == {"01": 6, "02": 2}
    static = dataclasses.replace(presets.TRIP_BRONZE, mode="static", layout=3)
    jobs.run_bronze(spark, str(later), folders["bronze"], static)
    assert spark.read.parquet(folders["bronze"]).count() == 2


def test_side_outputs_of_bronze(spark, folders):
    policy = dataclasses.replace(
        presets.TRIP_BRONZE, quarantine_path=str(folders["root"] / "q"), mapping_path=str(folders["root"] / "m"), layout="rebalance"
    )
    assert jobs.run_bronze(spark, folders["raw"], folders["bronze"], policy).rows == 14
    assert [r.path.rsplit("/", 1)[1] for r in spark.read.parquet(str(folders["root"] / "q")).collect()] == ["broken.parquet"]
    names = {r.nome_padrao: r.colunas_equivalentes for r in spark.read.option("header", True).csv(str(folders["root"] / "m/csv")).collect()}
    assert names["vendorid"] == "VendorID, vendor_id, vendorid"
    assert names["passenger_count"] == "PassengerCount, passenger_count"


def test_unmapped_file_is_reported(spark, folders):
    policy = dataclasses.replace(presets.TRIP_BRONZE)
    good, _ = jobs.harvest(spark, folders["raw"])
    groups = jobs.scan_groups(spark, good)
    names = {"vendorid": ("VendorID", "vendor_id", "vendorid"), "tpep_pickup_datetime": ("tpep_pickup_datetime",)}
    df, skipped = jobs.conform_groups(groups, names, policy.conform)
    assert df.count() == 13 and len(skipped) == 1


def test_missing_empty_and_failing_inputs(spark, folders):
    root = folders["root"]
    missing = jobs.run_bronze(spark, str(root / "nowhere"), folders["bronze"], presets.TRIP_BRONZE)
    assert (missing.status, missing.ok, missing.exit_code) == ("missing", False, 1)
    assert isinstance(missing.error, SourceMissing)
    nothing = root / "nothing"
    nothing.mkdir()
    assert jobs.run_bronze(spark, str(nothing), folders["bronze"], presets.TRIP_BRONZE).status == "no_data"
    pq.write_table(trips("2023-01-01", 0), nothing / "yellow_2023-01.parquet")
    assert jobs.run_bronze(spark, str(nothing), folders["bronze"], presets.TRIP_BRONZE).status == "no_data"
    assert jobs.run_silver(spark, str(root / "nowhere"), folders["silver"], presets.TRIP_SILVER).status == "missing"
    no_key = dataclasses.replace(presets.TRIP_BRONZE, ts_col="absent")
    failed = jobs.run_bronze(spark, folders["raw"], folders["bronze"], no_key)
    assert failed.status == "failed" and isinstance(failed.error, ValueError)
    assert [r.job for r in jobs.run_all(spark, dataclasses.replace(config(folders, "never"), raw=str(root / "nowhere")))] == ["bronze"]


def test_hard_gate_stops_before_writing(spark, folders):
    reports = jobs.run_all(spark, config(folders, "never_made", suite=(between("passenger_count", 1, 1),), on_fail="raise"))
    assert [r.status for r in reports] == ["ok", "failed"]
    with pytest.raises(SourceMissing):
        lake.read_parquet(spark, folders["silver"])


def test_failed_write_is_reported(spark, folders):
    blocked = folders["root"] / "file"
    blocked.write_text("in the way")
    report = jobs.run_bronze(spark, folders["raw"], str(blocked / "below"), presets.TRIP_BRONZE)
    assert report.status == "failed" and report.error is not None


def test_command_line_and_quality_job(spark, folders):
    (bronze,) = run(spark, ["bronze", folders["raw"], folders["bronze"]])
    (silver,) = run(spark, ["silver", folders["bronze"], folders["silver"]])
    (marts,) = run(spark, ["marts", "cli_table", folders["silver"]])
    (quality,) = run(spark, ["quality", folders["silver"], "--rows", "5"])
    assert [r.exit_code for r in (bronze, silver, marts, quality)] == [0, 0, 0, 0]
    assert spark.table("sample_df").count() == 5
    assert {r.evaluated for r in quality.quality.where("expectation = 'not_null'").collect()} == {5}
    reports = run(spark, ["all", folders["raw"], folders["bronze"], folders["silver"], "cli_all"])
    assert [r.job for r in reports] == ["bronze", "silver", "marts"]
    root = folders["root"]
    options = ["--publish", "--preview", "2", "--manifest", str(root / "manifest")]
    reports = run(spark, ["all", folders["raw"], str(root / "b2"), str(root / "s2"), "cli_published", *options])
    assert [r.exit_code for r in reports] == [0, 0, 0] and reports[1].frames["preview"].count() == 2
    checked = jobs.run_quality(spark, str(root / "s2"), presets.trip_suite(), profiled=True, violations_path=str(root / "bad"))
    assert checked.ok and checked.quality.count() == 10 and "total_amount" in {r["column"] for r in checked.frames["profile"].collect()}
    assert spark.read.parquet(str(root / "bad")).count() == 0


def test_partition_values_stay_text_and_prune(spark, folders):
    jobs.run_bronze(spark, folders["raw"], folders["bronze"], presets.TRIP_BRONZE)
    df = lake.read_partition(spark, folders["bronze"] + "/", presets.BRONZE_KEYS, month="02", source_type="yellow")
    assert {(r.year, r.month) for r in df.collect()} == {("2023", "02")}
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(" in plan and "month" in plan.split("PartitionFilters")[1].split("]")[0]
    with pytest.raises(ValueError):
        lake.read_partition(spark, folders["bronze"], presets.BRONZE_KEYS, vendorid="1")


def test_hot_partition_is_split_on_write(spark, tmp_path):
    hot = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 7)
    df = spark.range(300_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("text"), hot.cast("string").alias("month"))
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(size)
    spark.conf.set(size, "1MB")
    try:
        lake.write_partitioned(lake.repartition_for_write(df, "rebalance", ["month"]), str(tmp_path / "t"), ["month"])
    finally:
        spark.conf.set(size, before)
    assert len(list((tmp_path / "t" / "month=0").glob("*.parquet"))) > 1
    assert lake.read_partition(spark, str(tmp_path / "t"), ["month"]).count() == 300_000


def test_writes_keep_partitions_open(spark, tmp_path):
    setting = "spark.sql.maxConcurrentOutputFileWriters"

    def seen(batches):
        from pyspark import TaskContext

        for batch in batches:
            yield batch.assign(open=TaskContext.get().getLocalProperty(setting) or "0")

    # more partitions than stay open, in one task, with a null and an empty value
    part = F.when(F.col("id") % 40 == 0, "").when(F.col("id") % 40 > 1, (F.col("id") % 40).cast("string"))
    df = spark.range(2000).select("id", part.alias("part")).coalesce(1).mapInPandas(seen, "id long, part string, open string")
    before = spark.conf.get(setting)
    lake.write_partitioned(df, str(tmp_path / "t"), ["part"])
    published.publish(spark, published.stage(df, str(tmp_path / "p"), ["part"]))
    assert spark.conf.get(setting) == before
    for back in (lake.read_partition(spark, str(tmp_path / "t"), ["part"]), published.read_published(spark, str(tmp_path / "p"), ["part"])):
        rows = back.collect()
        assert {r.open for r in rows} == {str(lake.OPEN_PARTITIONS)}
        assert {r.id: r.part for r in rows} == {i: str(i % 40) if i % 40 > 1 else None for i in range(2000)} and len(rows) == 2000
    spark.conf.set(setting, "50")
    try:
        with lake.open_partitions(spark):
            assert spark.conf.get(setting) == "50"
        assert spark.conf.get(setting) == "50"
    finally:
        spark.conf.set(setting, before)


def test_rows_without_a_month_need_no_second_copy(spark, folders, monkeypatch):
    day = trips("2023-02-12", 3)
    pq.write_table(day.set_column(1, "tpep_pickup_datetime", pa.array([None, "", "2023-02-12 01:15:00"])), folders["root"] / "raw/green_tripdata_2023-03.parquet")
    arranged = []
    plain = jobs.repartition_for_write
    monkeypatch.setattr(jobs, "repartition_for_write", lambda df, *a: arranged.append(df) or plain(df, *a))
    assert jobs.run_bronze(spark, folders["raw"], folders["bronze"], presets.TRIP_BRONZE).rows == 17
    kept = lake.read_partition(spark, folders["bronze"], presets.BRONZE_KEYS, source_type="green")
    assert sorted((r.year or "-", r.month or "-", r["count"]) for r in kept.groupBy("year", "month").count().collect()) == [("-", "-", 2), ("2023", "02", 4)]
    # the writer replaces null and empty text, row by row, in keys that may be null
    assert not any(arranged[0].schema[k].nullable for k in presets.BRONZE_KEYS)


def published_config(folders, table, **silver):
    root = folders["root"]
    return RunConfig(
        folders["raw"], folders["bronze"], folders["silver"], table,
        dataclasses.replace(presets.TRIP_BRONZE, mode="publish", manifest_path=str(root / "manifest"), preview=3),
        dataclasses.replace(presets.TRIP_SILVER, mode="publish", **silver),
        dataclasses.replace(presets.TRIP_MARTS, parts_path=str(root / "parts")),
    )


def test_published_runs(spark, folders):
    config = published_config(folders, "published_run", violations_path=str(folders["root"] / "bad"))
    for _ in range(2):
        bronze, silver, marts = jobs.run_all(spark, config)
        assert (bronze.rows, silver.rows, bronze.frames["preview"].count()) == (14, 10, 3)
        assert published.read_published(spark, folders["bronze"]).count() == 14
        assert {(r.year, r.month): r.media_valor_arrecadado for r in marts.frames["monthly"].collect()} == {
            ("2023", "01"): 11.25, ("2023", "02"): 11.25,
        }
        assert marts.frames["hourly"].count() == 10 and spark.table("published_run").count() == 10
    assert not (folders["root"] / "bad").exists()  # no row fails a check
    assert not list((folders["root"] / "bronze").glob("source_type=*"))

    # a month comes anew, with a row that fails
    pq.write_table(trips("2023-02-10", 5, VendorID="vendor_id", passenger_count="PassengerCount"), folders["root"] / "raw/yellow_tripdata_2023-02.parquet")
    strict = dataclasses.replace(config.silver_spec, suite=(between("passenger_count", 1, 2),))
    bronze, silver, marts = jobs.run_all(spark, dataclasses.replace(config, silver_spec=strict))
    assert (bronze.rows, silver.rows, spark.table("published_run").count()) == (15, 11, 11)
    bad = spark.read.parquet(str(folders["root"] / "bad")).collect()
    assert len(bad) == silver.quality.first().violations == 3
    assert all(r.passenger_count == 3 and r.failed == ["between(passenger_count, 1, 2)"] for r in bad)


def test_a_failed_gate_publishes_nothing(spark, folders):
    config = published_config(folders, "gated")
    assert [r.status for r in jobs.run_all(spark, config)] == ["ok"] * 3
    gated = dataclasses.replace(config.silver_spec, suite=(between("passenger_count", 1, 1),), on_fail="raise", where={"source_type": "green"})
    assert jobs.run_silver(spark, folders["bronze"], folders["silver"], gated).status == "failed"
    assert published.read_published(spark, folders["silver"]).count() == 10


def test_maintained_means_read_touched_partitions_only(spark, tmp_path):
    spec, keys = presets.TRIP_MARTS, list(presets.SILVER_KEYS)
    src, parts = str(tmp_path / "silver"), str(tmp_path / "parts")
    odd = F.when(F.col("id") == 5, F.lit(float("nan"))).when(F.col("id") % 11 == 0, F.lit(None)).otherwise(F.col("id") * 0.37 - 40)

    def rows(n, factor):
        at = F.timestamp_seconds(F.lit(1672531200) + F.col("id") * 7000)
        trip = spark.range(n).select(at.alias("tpep_pickup_datetime"), (odd * factor).alias("total_amount"), (F.col("id") % 5).cast("int").alias("passenger_count"))
        return jobs.with_year_month(trip, "tpep_pickup_datetime")

    def means(table):
        return (
            marts.monthly_mean(table, keys, "total_amount", scale=2).collect(),
            marts.hourly_mean(table, "tpep_pickup_datetime", "passenger_count", scale=2).collect(),
        )

    def stored():
        df = published.read_published(spark, parts, keys)
        return marts.monthly_mean_of_parts(df, keys).collect(), marts.hourly_mean_of_parts(df).collect()

    first = rows(1500, 1.0)
    published.publish(spark, published.stage(first, src, keys))
    assert jobs.refresh_means(spark, src, parts, spec) == ["year=2023/month=01", "year=2023/month=02", "year=2023/month=03", "year=2023/month=04", "year=2023/month=05"]
    assert str(stored()) == str(means(first))
    assert jobs.refresh_means(spark, src, parts, spec) == []

    again = rows(3000, -3.0).where("month = '02'")
    gone = "year=2023/month=05"
    published.publish(spark, published.stage(again, src, keys), drop=[gone])
    assert jobs.refresh_means(spark, src, parts, spec) == ["year=2023/month=02"]
    whole = first.where("month not in ('02', '05')").unionByName(again)
    assert str(stored()) == str(means(whole)) == str(means(published.read_published(spark, src, keys)))


def test_small_helpers(spark):
    assert lake.clean_path("s3a://bucket/x/", "/source_type=yellow/") == "s3a://bucket/x/source_type=yellow"
    df = spark.range(100)
    assert [r.id for r in lake.bounded_sample(df.repartition(5), 3, ["id"]).collect()] == [0, 1, 2]
    assert lake.bounded_sample(df, 7).count() == 7 and lake.preview(df).count() == 5
    assert lake.is_empty(df.where("id < 0")) and not lake.is_empty(df)
    assert lake.repartition_for_write(df, 6).rdd.getNumPartitions() == 6
    with pytest.raises(ValueError):
        lake.write_partitioned(df, "/nowhere", ["id"], "append")
