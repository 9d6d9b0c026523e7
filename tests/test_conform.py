from datetime import datetime

import pytest
from pyspark.sql import functions as F

from sedimenta.functions.dates import date_ref, period
from sedimenta.operators import conform as c
from sedimenta.sources.catalog import SchemaGroup

RULES = (("yellow", "yellow"), ("green", "green"), ("fhvhv", "fhvhv"))
PATHS = {
    "/d/yellow_tripdata_2023-01.parquet": ("yellow", datetime(2023, 1, 1)),
    "/d/green_2023_02.parquet": ("green", datetime(2023, 2, 1)),
    "/d/fhvhv_2023-13.parquet": ("fhvhv", datetime(1900, 1, 1)),
    "/d/other.parquet": ("desconhecido", datetime(1900, 1, 1)),
    "/d/yellow_2020-01/green_2023-03.parquet": ("green", datetime(2023, 3, 1)),
    "/d/yellow_2023-04.parquet/part-0001.snappy.parquet": ("yellow", datetime(2023, 4, 1)),
    "/d/x_0000-05.parquet": ("desconhecido", datetime(1900, 1, 1)),
    "/d/green_yellow_12345-0678.parquet": ("yellow", datetime(2345, 6, 1)),
}


def test_tag_and_date_of_paths(spark):
    df = spark.createDataFrame([(p,) for p in PATHS], "path string")
    rows = df.select("path", c.tag_source("path", RULES).alias("t"), date_ref("path").alias("d")).collect()
    assert {r.path: (r.t, r.d) for r in rows} == PATHS
    assert df.select(c.tag_source("path", ()).alias("t")).first().t == "desconhecido"


def test_period(spark):
    hrefs = {"a_2023-05.parquet": "2023-05", "a_2023-13_2023-01.parquet": None, "2023_05": None, "x": None, "0000-01": None}
    df = spark.createDataFrame([(h,) for h in hrefs], "href string")
    assert {r.href: r.p for r in df.select("href", period("href").alias("p")).collect()} == hrefs


MAPPING = {
    "vendorid": ("VendorID", "vendorid", "vendor_id"),
    "pickup": ("pickup_datetime", "PickupDatetime", "pickup_date_time"),
    "fare": ("fare", "fare_amount"),
    "fee": ("Airport_fee", "airport_fee"),
}
SPEC = c.ConformSpec(rules=RULES, types={"vendorid": "long", "fare": "double"}, run_ts=datetime(2024, 1, 2))


def drift(spark):
    a = spark.createDataFrame(
        [(1, datetime(2023, 1, 1, 10), 5.0, 1.25)], "VendorID long, pickup_datetime timestamp, fare double, Airport_fee double"
    )
    b = spark.createDataFrame([("2", "2023-01-02", 6.0, 7)], "vendorid string, PickupDatetime string, fare_amount double, airport_fee int")
    d = spark.createDataFrame([(3, "2023-01-03")], "vendor_id int, pickup_date_time string")
    none = spark.createDataFrame([(1,)], "unrelated int")
    return a, b, d, none


def conformed(spark, df, spec=SPEC):
    return c.conform(df, MAPPING, spec, path=F.lit("/d/yellow_2023-01.parquet"))


def test_conform_and_union_of_drifted_frames(spark):
    a, b, d, none = drift(spark)
    assert conformed(spark, none) is None
    union = c.conform_union([conformed(spark, x) for x in (a, b, d)])
    assert union.columns == ["vendorid", "pickup", "fare", "fee", "source_file", "source_type", "ingestion_date", "date_ref"]
    assert dict(union.dtypes)["vendorid"] == "bigint" and dict(union.dtypes)["fee"] == "string"
    rows = union.orderBy("vendorid").select("vendorid", "pickup", "fare", "fee", "source_type").collect()
    assert [tuple(r) for r in rows] == [
        (1, "2023-01-01 10:00:00", 5.0, "1.25", "yellow"),
        (2, "2023-01-02", 6.0, "7", "yellow"),
        (3, "2023-01-03", None, None, "yellow"),
    ]
    assert union.first().ingestion_date == datetime(2024, 1, 2)


def test_union_keeps_duplicates(spark):
    a, *_ = drift(spark)
    one = conformed(spark, a)
    assert c.conform_union([one, one, one]).count() == 3


def test_nothing_compatible(spark):
    *_, none = drift(spark)
    with pytest.raises(ValueError):
        c.conform_groups([SchemaGroup("f", ("unrelated",), none)], MAPPING, SPEC)
    with pytest.raises(ValueError):
        c.conform_union([])


def test_first_present_variant_by_exact_spelling(spark):
    df = spark.createDataFrame([(1, None, 3)], "`A` int, `b.c` int, d int")
    got = c.rename_first_present(df, {"x": ("a", "b.c", "d"), "y": ("A",), "z": ("q",)})
    assert got.columns == ["x", "y"] and tuple(got.first()) == (None, 1)
    merged = c.rename_first_present(df, {"x": ("b.c", "d")}, merge_variants=True)
    assert merged.first().x == 3


def test_fill_and_final_columns(spark):
    a, *_ = drift(spark)
    filled = c.fill_missing(a.select("fare"), {"fare": "string", "note": "string", "n": "int"})
    assert filled.dtypes == [("fare", "double"), ("note", "string"), ("n", "int")]
    spec = c.ConformSpec(rules=RULES, columns=("fare", "source_type", "absent"))
    assert conformed(spark, a, spec).columns == ["fare", "source_type", "absent"]


def test_row_wise_steps_apply_to_a_stream(spark, tmp_path):
    a, *_ = drift(spark)
    a.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(a.schema).parquet(str(tmp_path / "in"))
    out = c.conform(stream, MAPPING, SPEC, path=F.lit("/d/green_2023-01.parquet"))
    query = (
        out.writeStream.format("parquet")
        .option("checkpointLocation", str(tmp_path / "state"))
        .trigger(availableNow=True)
        .start(str(tmp_path / "out"))
    )
    query.awaitTermination()
    assert [r.source_type for r in spark.read.parquet(str(tmp_path / "out")).collect()] == ["green"]


def test_tags_and_dates_once_per_file(spark, tmp_path):
    # the address of a name with a space differs from its path, so its rows work out their own
    names = ("yellow_2023-01.parquet", "green 2023_02.parquet", "other.parquet")
    for i, name in enumerate(names):
        spark.range(i, i + 1).select(F.col("id").alias("vendorid")).write.parquet(str(tmp_path / name))
    df = spark.read.parquet(*[str(tmp_path / name) for name in names])
    paths = [(f.removeprefix("file://").replace("%20", " "),) for f in df.inputFiles()]
    files = spark.createDataFrame([(f"file:{p}",) for (p,) in paths] * 2, "path string")
    spec = c.ConformSpec(rules=RULES, run_ts=datetime(2024, 1, 2))
    group = SchemaGroup("f", ("vendorid",), df)
    plain, _ = c.conform_groups([group], {"vendorid": ("vendorid",)}, spec)
    found, _ = c.conform_groups([group], {"vendorid": ("vendorid",)}, spec, files)
    assert found.columns == plain.columns and sorted(found.collect()) == sorted(plain.collect())
    assert {r.vendorid: (r.source_type, r.date_ref) for r in found.collect()} == {
        "0": ("yellow", datetime(2023, 1, 1)), "1": ("green", datetime(2023, 2, 1)), "2": ("desconhecido", datetime(1900, 1, 1)),
    }
    # the lookup is what gives the rows their tags
    told = c.source_facts(files, spec).withColumn("_tag", F.lit("told"))
    assert {r.source_type for r in c.conform(df, {"vendorid": ("vendorid",)}, spec, facts=told).collect()} == {"told", "green"}
