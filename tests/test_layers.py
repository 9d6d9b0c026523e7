from datetime import datetime

import pytest
from pyspark.sql import functions as F

from sedimenta import presets
from sedimenta.functions.numbers import lenient_cast, rounded_mean
from sedimenta.operators import layers, marts
from sedimenta.plans.jobs import silver

BRONZE = (
    "vendorid string, passenger_count string, tpep_pickup_datetime string, dropoff_datetime string, fare_amount string, "
    "extra string, mta_tax string, tip_amount string, tolls string, year string, month string"
)
TRIPS = [
    (" 7 ", "3.0", "2022-11-30 23:59:59", "2022-12-01 00:20:00", "10.25", "1.5", None, "0.25", "-2.0", "2022", "11"),
    ("x", None, "2022-12-02 08:00:00", "no time", "-4.5", "", "0.5", None, "6.0", "2022", "12"),
]


def test_year_and_month_of_text_and_timestamp(spark):
    df = spark.createDataFrame([("2023-01-15 12:30:45",), (None,)], "t string")
    assert [tuple(r) for r in layers.with_year_month(df, "t").select("year", "month").collect()] == [("2023", "01"), (None, None)]
    stamped = df.select(F.col("t").cast("timestamp").alias("t"))
    assert tuple(layers.with_year_month(stamped, "t").select("year", "month").first()) == ("2023", "01")


def test_missing_required_column(spark):
    df = spark.createDataFrame([("1", "2")], "vendorid string, passenger_count string")
    with pytest.raises(ValueError):
        layers.with_year_month(df, "tpep_pickup_datetime")


def test_lenient_casts(spark):
    texts = {"1.0": 1, "1.9": 1, " 2 ": 2, "abc": None, "": None, "3e9": None, "NaN": None, None: None, "-7": -7}
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert {r.t: r.v for r in df.select("t", lenient_cast(F.col("t"), "int").alias("v")).collect()} == texts
    bad = spark.createDataFrame([("2023-02-30 00:00:00",)], "t string")
    assert bad.select(lenient_cast(F.col("t"), "timestamp").alias("v")).first().v is None


def test_silver_rows(spark):
    df = silver(spark.createDataFrame(TRIPS, BRONZE), presets.TRIP_SILVER)
    assert df.dtypes == [
        ("year", "string"), ("month", "string"), ("vendorid", "int"), ("passenger_count", "int"),
        ("tpep_pickup_datetime", "timestamp"), ("tpep_dropoff_datetime", "timestamp"), ("total_amount", "double"),
    ]
    assert [tuple(r) for r in df.collect()] == [
        ("2022", "11", 7, 3, datetime(2022, 11, 30, 23, 59, 59), datetime(2022, 12, 1, 0, 20), 10.0),
        ("2022", "12", None, None, datetime(2022, 12, 2, 8), None, 2.0),
    ]


def test_cast_sources(spark):
    df = spark.createDataFrame(TRIPS, BRONZE)
    typed = layers.cast_columns(df, presets.CASTS)
    assert {"dropoff_datetime", "tolls", "tpep_dropoff_datetime", "tolls_amount"} <= set(typed.columns)
    other = layers.cast_columns(df.withColumnRenamed("tolls", "tolls_amount"), presets.CASTS)
    assert [r.tolls_amount for r in other.collect()] == [-2.0, 6.0]
    with pytest.raises(ValueError):
        layers.cast_columns(df.drop("vendorid"), presets.CASTS)


def test_null_safe_sum(spark):
    df = spark.createDataFrame(
        [(None, None), (1.5, None), (-2.0, 0.5), (0.0, 0.0)], "a float, b float"
    )
    assert [r.t for r in layers.null_safe_sum(df, ["a", "absent", "b"], "t").collect()] == [0.0, 1.5, -1.5, 0.0]
    assert [r.t for r in layers.null_safe_sum(df, ["absent"], "t").collect()] == [0.0] * 4
    noisy = spark.createDataFrame([(15.1,)], "a float")
    assert layers.null_safe_sum(noisy, ["a"], "t").first().t == 15.100000381469727
    text = spark.createDataFrame([("15.1",)], "a string")
    assert layers.null_safe_sum(text, ["a"], "t", "double").first().t == 15.1


def test_select_columns(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert layers.select_columns(df, ["b", "a"]).columns == ["b", "a"]
    with pytest.raises(ValueError):
        layers.select_columns(df, ["c"])


def test_exact_mean_rounds_ties_away_from_zero(spark):
    rows = [("tie", 0.01), ("tie", 0.02), ("minus", -0.01), ("minus", -0.02), ("null", None), ("gap", 1.0), ("gap", None)]
    df = spark.createDataFrame(rows, "k string, v double")
    got = df.groupBy("k").agg(rounded_mean(F.col("v"), 2, 2).alias("m"), rounded_mean(F.col("v"), 1, 2).alias("d")).collect()
    assert {r.k: (r.m, r.d) for r in got} == {"tie": (0.02, 0.0), "minus": (-0.02, 0.0), "null": (None, None), "gap": (1.0, 1.0)}
    with pytest.raises(ValueError):
        rounded_mean(F.col("v"), 3, 2)


def test_exact_mean_ignores_partitioning(spark):
    df = spark.range(100_000).select((F.col("id") % 7).alias("k"), (F.pmod(F.hash("id"), F.lit(10_001)) / 100).alias("v"))
    one = df.repartition(1).groupBy("k").agg(rounded_mean(F.col("v"), 2, 2).alias("m"))
    many = df.repartition(37).groupBy("k").agg(rounded_mean(F.col("v"), 2, 2).alias("m"))
    assert sorted(one.collect()) == sorted(many.collect())


def test_means_as_frames_and_as_sql(spark):
    df = silver(spark.createDataFrame(TRIPS, BRONZE), presets.TRIP_SILVER)
    monthly = marts.monthly_mean(df, ["year", "month"], "total_amount")
    assert [tuple(r) for r in monthly.collect()] == [("2022", "11", 10.0), ("2022", "12", 2.0)]
    text = marts.monthly_mean_sql("trips", ["year", "month"], "total_amount")
    assert marts.query_view(spark, df, "trips", text).collect() == monthly.collect()
    hourly = marts.hourly_mean(df, "tpep_pickup_datetime", "passenger_count")
    text = marts.hourly_mean_sql("trips", "tpep_pickup_datetime", "passenger_count")
    assert marts.query_view(spark, df, "trips", text).collect() == hourly.collect()
    assert [(str(r.dia), r.hora, r.media_passageiros) for r in hourly.collect()] == [("2022-11-30", 23, 3.0), ("2022-12-02", 8, None)]
