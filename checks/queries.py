"""One query per operator over the benchmark tables.

Each callable takes ``(spark, sf_dir)`` and reads whole tables. Where an operator needs input that
the tables do not have (raw files with drifting schemas, texts that are no numbers), the query first
lets Spark derive it from a whole table.
"""

from __future__ import annotations

import dataclasses
import string
import uuid
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sedimenta import presets
from sedimenta.functions.dates import date_ref
from sedimenta.functions.names import norm_name
from sedimenta.functions.numbers import lenient_cast, rounded_mean
from sedimenta.operators import conform as c
from sedimenta.operators import layers, links, mapping, marts, quality
from sedimenta.operators.ranking import with_ordinal
from sedimenta.plans import jobs
from sedimenta.plans.specs import RunConfig
from sedimenta.session import scratch_path
from sedimenta.sources import catalog, lake, manifest, published

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# --- means -----------------------------------------------------------------------------------


def hourly_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.hourly_mean(table(spark, sf_dir, "events"), "ts", "value", scale=2)


def _orders_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layers.with_year_month(table(spark, sf_dir, "orders"), "o_orderdate")


def monthly_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.monthly_mean(_orders_by_month(spark, sf_dir), ["year", "month"], "o_totalprice", scale=2)


def sql_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    view = f"orders_{uuid.uuid4().hex}"
    priced = _orders_by_month(spark, sf_dir).select(
        "year", "month", F.col("o_totalprice").cast("decimal(18,2)").alias("total_amount")
    )
    text = marts.monthly_mean_sql(view, ["year", "month"], "total_amount")
    return marts.query_view(spark, priced, view, text).withColumn(
        marts.MONTHLY, F.col(marts.MONTHLY).cast("double")
    )


def year_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    stamped = layers.with_year_month(table(spark, sf_dir, "events"), "ts")
    return stamped.select("event_id", "year", "month")


# --- silver ----------------------------------------------------------------------------------


def bronze_like(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trip-like rows from lineitem, all text, with some values that are no numbers or dates."""
    line = F.col("l_linenumber")
    items = table(spark, sf_dir, "lineitem")
    day = F.col("l_shipdate").cast("string")
    passengers = F.col("l_quantity").cast("string")
    return layers.with_year_month(
        items.select(
            "l_orderkey",
            "l_linenumber",
            F.when(line == 6, F.concat(F.lit("x"), F.col("l_suppkey").cast("string")))
            .otherwise(F.concat(F.lit(" "), F.col("l_suppkey").cast("string"), F.lit(" ")))
            .alias("vendorid"),
            F.when(line == 5, F.lit("")).when(line == 3, F.concat(passengers, F.lit("e9"))).otherwise(passengers)
            .alias("passenger_count"),
            day.alias("tpep_pickup_datetime"),
            F.when(line == 4, F.concat(F.lit("no "), day)).otherwise(day).alias("dropoff_datetime"),
            F.when(line == 2, F.lit(None)).otherwise(F.col("l_extendedprice").cast("string")).alias("fare_amount"),
            F.col("l_discount").cast("string").alias("extra"),
            F.col("l_tax").cast("string").alias("mta_tax"),
            F.lit(None).cast("string").alias("tip_amount"),
            F.when(line == 1, F.col("l_quantity").cast("string")).alias("tolls"),
        ),
        "tpep_pickup_datetime",
    )


def _ntz(df: DataFrame) -> DataFrame:
    """Zone-free timestamps, as the benchmark tables have them."""
    stamps = [f.name for f in df.schema if f.dataType.typeName() == "timestamp"]
    return df.withColumns({s: F.col(s).cast("timestamp_ntz") for s in stamps})


def cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed = layers.cast_columns(bronze_like(spark, sf_dir), presets.CASTS)
    return _ntz(
        typed.select(
            "l_orderkey", "l_linenumber", "vendorid", "passenger_count",
            "tpep_pickup_datetime", "tpep_dropoff_datetime", "fare_amount", "tolls_amount",
        )
    )


def total_amount(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed = layers.cast_columns(bronze_like(spark, sf_dir), presets.CASTS)
    return layers.null_safe_sum(typed, presets.AMOUNTS, "total_amount").select(
        "l_orderkey", "l_linenumber", "total_amount"
    )


def total_missing_col(spark: SparkSession, sf_dir: str) -> DataFrame:
    fewer = bronze_like(spark, sf_dir).drop("tip_amount", "tolls")
    typed = layers.cast_columns(fewer, presets.CASTS)
    return layers.null_safe_sum(typed, presets.AMOUNTS, "total_amount").select(
        "l_orderkey", "l_linenumber", "total_amount"
    )


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    df, _ = quality.validate(
        jobs.silver(bronze_like(spark, sf_dir), presets.TRIP_SILVER), presets.TRIP_SILVER.suite
    )
    return _ntz(df)


# --- quality ---------------------------------------------------------------------------------

SUITE = presets.trip_suite("1996-01-01", "1999-01-01")


def trip_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(jobs.silver(bronze_like(spark, sf_dir), presets.TRIP_SILVER), SUITE)


def _gappy_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").withColumn(
        "value", F.when(F.col("event_type") != "error", F.col("value"))
    )


def quality_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    suite = [quality.not_null("value"), quality.not_null("ts"), quality.exists("absent"), quality.not_null("value", mostly=0.5)]
    return quality.quality_report(_gappy_events(spark, sf_dir), suite)


def quality_between(spark: SparkSession, sf_dir: str) -> DataFrame:
    suite = [quality.between("l_quantity", 1, 8), quality.between("l_quantity", 1, 50), quality.between("l_tax", 0.0, 0.08)]
    return quality.quality_report(table(spark, sf_dir, "lineitem"), suite)


def quality_min(spark: SparkSession, sf_dir: str) -> DataFrame:
    suite = [quality.between("value", lo=0.01), quality.between("value", lo=5.0), quality.between("value", hi=100.0)]
    return quality.quality_report(_gappy_events(spark, sf_dir), suite)


def quality_ts_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    suite = [
        quality.between("ts", "2024-01-05", "2024-01-20"),
        quality.between("ts", "2024-01-01", "2025-01-01"),
        quality.between("ts", lo="2024-01-02", hi="2024-01-03", hi_exclusive=True),
    ]
    return quality.quality_report(table(spark, sf_dir, "events"), suite)


def quality_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.check(trip_quality(spark, sf_dir))


def quality_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stand-alone quality job, on a bounded sample."""
    suite = [quality.exists("o_orderkey"), quality.not_null("o_custkey"), quality.between("o_totalprice", lo=0.01)]
    report = jobs.run_quality(spark, f"{sf_dir.rstrip('/')}/orders.parquet", suite, view=f"sample_{uuid.uuid4().hex}")
    return report.quality


def profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.profile(table(spark, sf_dir, "orders"), exact=True)


def _held_against_rows(df: DataFrame, sketch: DataFrame, share: float) -> DataFrame:
    """A profile's exact columns, and whether its approximate ones are as near to all rows as their errors allow.

    A quantile is near if the share of rows up to it, with those equal to it or without, is within ``share`` of its own.
    """
    found = sketch.collect()
    counts, distincts = [], []
    for i, r in enumerate(found):
        # a column at a time: counted together, a task would hold the values of all columns, each as wide as a row
        values = df.select(F.col(f"`{r['column']}`").alias("value")).distinct()
        distincts.append(values.agg(F.count("value").alias("d")).select(F.lit(r["column"]).alias("column"), "d"))
        for name, q in zip(quality.PROFILE_COLUMNS[-3:], quality.QUANTILES, strict=True):
            column = F.col(f"`{r['column']}`")
            if r[name] is not None:
                below, upto = (F.count_if(test) / F.count(column) for test in (column < r[name], column <= r[name]))
                counts.append(((below <= q + share) & (upto >= q - share)).alias(f"{name}_{i}"))
            else:
                counts.append(F.lit(True).alias(f"{name}_{i}"))
    near = df.agg(*counts)
    rows = [
        F.struct(
            F.lit(r["column"]).alias("column"),
            F.lit(r["distinct"]).alias("estimate"),
            (F.col(f"q25_{i}") & F.col(f"q50_{i}") & F.col(f"q75_{i}")).alias("quantiles_near"),
        )
        for i, r in enumerate(found)
    ]
    held = near.select(F.inline(F.array(*rows))).join(reduce(DataFrame.unionByName, distincts), "column")
    exact = sketch.select("column", "type", "n", "nulls", "min", "max", "mean")
    return exact.join(
        held.select("column", (F.abs(F.col("d") - F.col("estimate")) <= F.col("d") * 0.1).alias("distinct_near"), "quantiles_near"), "column"
    )


def profile_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The default profile in one scan; its approximate columns are held against all rows."""
    orders = table(spark, sf_dir, "orders")
    return _held_against_rows(orders, quality.profile(orders), 0.01)


def profile_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The profile from stored sketches of the months, after January was published anew with other prices."""
    keys = ["year", "month"]
    src, parts = scratch_path(spark, "orders"), scratch_path(spark, "sketches")
    monthly = _orders_by_month(spark, sf_dir)
    published.publish(spark, published.stage(lake.repartition_for_write(monthly, "rebalance", keys), src, keys))
    jobs.refresh_profile(spark, src, parts, keys)
    again = monthly.where("month = '01'").withColumn("o_totalprice", -F.col("o_totalprice"))
    published.publish(spark, published.stage(again, src, keys))
    jobs.refresh_profile(spark, src, parts, keys)
    merged = quality.merged_profile(published.read_published(spark, parts, keys), keys)
    return _held_against_rows(published.read_published(spark, src, keys).drop(*keys), merged, 0.02)


def suite_from_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    suite = quality.suite_from_profile(quality.profile(orders), quality.value_sets(orders, limit=20))
    return suite.withColumn("values", F.array_join("values", "|"))


# --- names and mappings ----------------------------------------------------------------------


#: Letters of another script for the small letters a to z.
CYRILLIC = "абвгдежзийклмнопрстуфхцчшщ"


def norm_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names in ASCII, in another script only, and in both."""
    other = F.translate(F.lower("p_name"), string.ascii_lowercase, CYRILLIC)
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        norm_name("p_name").alias("name_norm"),
        norm_name("p_brand").alias("brand_norm"),
        norm_name(F.concat_ws("_", "p_type", "p_brand")).alias("type_norm"),
        norm_name(F.concat(F.lit(" "), F.upper(other), F.lit("_"))).alias("other_norm"),
        norm_name(F.concat_ws("é ", other, "p_brand")).alias("mixed_norm"),
    )


def link_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``source, name``: pages play the files, their link targets the column names."""
    found = links.extract_links(table(spark, sf_dir, "pages"))
    return found.select(F.col("page_id").cast("string").alias("source"), F.expr("substring(href, 2)").alias("name"))


def _vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = link_names(spark, sf_dir).select(norm_name("name").alias("norm"))
    parts = table(spark, sf_dir, "part").select(norm_name("p_name").alias("norm"))
    return named.unionByName(parts)


def similar_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mapping.similar_pairs(_vocabulary(spark, sf_dir), "norm")


def similar_names_top3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mapping.top_similar(similar_names(spark, sf_dir)).select("head", "candidate", "ratio", "place")


def group_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mapping.group_columns(cooccur=link_names(spark, sf_dir), exclusive=["the", "and"])


def group_columns_no_veto(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mapping.group_columns(link_names(spark, sf_dir).select("name"), veto=False)


def _spelling_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of link names that differ in spelling only."""
    raw = link_names(spark, sf_dir).select(F.col("name").alias("raw"), norm_name("name").alias("head")).distinct()
    return raw.join(with_ordinal(raw.select("head").distinct(), ["head"]), "head")


MANUAL_NAMES = {"the": "article", "und": "conjunction"}


def _spelling_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mapping.name_groups(_spelling_groups(spark, sf_dir), MANUAL_NAMES)


def _joined(df: DataFrame) -> DataFrame:
    return df.select("standard", F.array_join("variants", "|").alias("variants"))


def name_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _joined(_spelling_mapping(spark, sf_dir))


def split_exclusive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _joined(mapping.split_exclusive(_spelling_mapping(spark, sf_dir), ["The", "of"]))


def require_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _joined(mapping.require_columns(_spelling_mapping(spark, sf_dir), ["vendorid", "article"]))


def standard_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = link_names(spark, sf_dir)
    return mapping.standard_of(names, "name", _spelling_mapping(spark, sf_dir)).select("source", "name", "standard")


def mapping_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "mapping-csv")
    mapping.write_mapping(_spelling_mapping(spark, sf_dir), path, "csv")
    return spark.read.option("header", True).csv(path)


# --- raw files -------------------------------------------------------------------------------


def _yellow_files(spark: SparkSession, sf_dir: str, root: str, more: Column | None = None) -> None:
    """A third of the years as one raw dataset, with ``more`` passengers where given."""
    day = F.col("l_shipdate")
    passengers = F.col("l_quantity") if more is None else F.col("l_quantity") + more
    table(spark, sf_dir, "lineitem").where(F.year("l_shipdate") % 3 == 0).select(
        F.col("l_suppkey").alias("VendorID"),
        day.alias("tpep_pickup_datetime"),
        F.date_add(F.to_date(day), 1).cast("timestamp_ntz").alias("dropoff_datetime"),
        passengers.alias("passenger_count"),
        F.col("l_extendedprice").alias("fare_amount"),
        F.col("l_discount").alias("extra"),
        F.col("l_tax").alias("mta_tax"),
        F.col("l_linenumber").cast("double").alias("tolls"),
        F.col("l_orderkey").alias("PULocationID"),
        F.col("l_partkey").alias("DOLocationID"),
    ).write.mode("overwrite").parquet(f"{root}/yellow_tripdata_1996-01.parquet")


def drifted_files(spark: SparkSession, sf_dir: str) -> str:
    """Lineitem as three raw datasets with different column names and types; their folder."""
    root = scratch_path(spark, "raw")
    _yellow_files(spark, sf_dir, root)
    items = table(spark, sf_dir, "lineitem")
    year = F.year("l_shipdate") % 3
    day = F.col("l_shipdate")
    items.where(year == 1).select(
        F.col("l_suppkey").cast("string").alias("vendor_id"),
        day.cast("string").alias("tpep_pickup_datetime"),
        day.cast("string").alias("Dropoff_Datetime"),
        F.col("l_quantity").cast("int").alias("Passenger_Count"),
        F.col("l_extendedprice").cast("string").alias("fare_amount"),
        F.col("l_discount").alias("tip_amount"),
        F.col("l_orderkey").alias("PUlocationID"),
    ).write.parquet(f"{root}/green_tripdata_1997_02.parquet")
    items.where(year == 2).select(
        F.col("l_suppkey").cast("int").alias("vendorid"),
        day.alias("tpep_pickup_datetime"),
        F.col("l_orderkey").alias("DOlocationID"),
    ).write.parquet(f"{root}/fhvhv_tripdata_1998-13.parquet")
    return root


def build_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _joined(jobs.build_mapping(spark, drifted_files(spark, sf_dir), presets.TRIP_MAPPING))


def _dataset() -> Column:
    """The table of a file: its own name, or that of the folder directly below the root that holds the table's parts."""
    return F.regexp_extract("path", r"([^/]+)\.parquet(?:/|$)", 1)


def file_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each table, and whether all its files hold bytes."""
    files = catalog.file_catalog(spark, sf_dir)
    return files.groupBy(_dataset().alias("name")).agg(F.every(F.col("length") > 0).alias("filled"))


def schema_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of each table; those that its files do not have in common each have a row."""
    columns = catalog.schema_catalog(catalog.file_catalog(spark, sf_dir))
    return columns.select(_dataset().alias("file"), "pos", "name", "type").distinct()


def quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tables' files, and text files that are no Parquet under the same kind of name."""
    root = scratch_path(spark, "texts")
    table(spark, sf_dir, "documents").select("text").write.text(f"{root}/notes.parquet.txt")
    files = catalog.file_catalog(spark, sf_dir).unionByName(catalog.file_catalog(spark, root, "*.txt"))
    good, bad = catalog.split_quarantine(catalog.schema_catalog(files))
    return (
        good.select(F.lit("good").alias("state"), _dataset().alias("file"))
        .unionByName(bad.select(F.lit("bad").alias("state"), F.regexp_extract("path", r"(notes)\.parquet\.txt/", 1).alias("file")))
        .distinct()
    )


# --- conforming ------------------------------------------------------------------------------

ORDER_NAMES = {
    "order_key": ("orderkey", "o_orderkey"),
    "price": ("o_totalprice", "total"),
    "status": ("o_status", "o_orderstatus", "o_orderpriority"),
    "note": ("o_note",),
}


def rename_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return c.rename_first_present(table(spark, sf_dir, "orders"), ORDER_NAMES)


def fill_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    renamed = c.rename_first_present(table(spark, sf_dir, "orders"), ORDER_NAMES)
    return c.fill_missing(renamed, {"note": "string", "rank": "int", "price": "double"})


def _file_path() -> Column:
    """A raw file's path for each order."""
    prefix = (
        F.when(F.col("o_orderstatus") == "F", "yellow_tripdata_")
        .when(F.col("o_orderstatus") == "O", "green_tripdata_")
        .otherwise("other_")
    )
    mark = F.when(F.col("o_orderpriority").startswith("1"), "_").otherwise("-")
    month = F.when(F.col("o_orderpriority").startswith("2"), "13").otherwise(F.date_format("o_orderdate", "MM"))
    return F.concat(F.lit("/raw/yellow_2020-05/"), prefix, F.date_format("o_orderdate", "yyyy"), mark, month, F.lit(".parquet"))


def final_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = c.ConformSpec(rules=presets.SOURCES, types={"order_key": "long", "price": "double"}, columns=("price", "source_type", "order_key", "note"))
    return c.conform(table(spark, sf_dir, "orders"), ORDER_NAMES, spec, path=_file_path())


def tag_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", c.tag_source(_file_path(), presets.SOURCES).alias("source_type")
    )


def file_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", date_ref(_file_path()).cast("timestamp_ntz").alias("date_ref")
    )


def provenance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each order with the file it was read from."""
    files = table(spark, sf_dir, "orders")
    stamped = c.with_provenance(files, F.col("_metadata.file_path"), datetime(2024, 1, 2))
    return _ntz(
        stamped.select("o_orderkey", F.regexp_extract("source_file", "([^/]+)$", 1).alias("source_file"), "ingestion_date")
    )


RUN_TS = datetime(2024, 1, 2)
BRONZE = dataclasses.replace(
    presets.TRIP_BRONZE,
    conform=dataclasses.replace(presets.TRIP_BRONZE.conform, run_ts=RUN_TS),
    layout="rebalance",
)
SILVER = dataclasses.replace(presets.TRIP_SILVER, suite=SUITE, layout="rebalance")


def conform_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three drifted datasets, scanned by schema and brought together."""
    good, _ = jobs.harvest(spark, drifted_files(spark, sf_dir))
    names = {
        "vendorid": ("VendorID", "vendor_id", "vendorid"),
        "pickup": ("tpep_pickup_datetime",),
        "fare": ("fare_amount",),
        "tip": ("tip_amount",),
    }
    spec = c.ConformSpec(rules=presets.SOURCES, types={"vendorid": "long", "pickup": "timestamp_ntz", "fare": "double", "tip": "double"})
    df, _ = c.conform_groups(catalog.scan_groups(spark, good), names, spec)
    return _ntz(df.select("vendorid", "pickup", "fare", "tip", "source_type", "date_ref"))


# --- lake and jobs ---------------------------------------------------------------------------


def _orders_table(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, str]:
    keys = ["year", "month"]
    monthly = _orders_by_month(spark, sf_dir).select("o_orderkey", "o_totalprice", *keys)
    path = scratch_path(spark, "orders")
    lake.write_partitioned(lake.repartition_for_write(monthly, "rebalance", keys), path, keys, "static")
    return monthly, path


def write_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write all months, then run January again with another price: other months must stay."""
    keys = ["year", "month"]
    monthly, path = _orders_table(spark, sf_dir)
    again = monthly.where(F.col("month") == "01").withColumn("o_totalprice", -F.col("o_totalprice"))
    lake.write_partitioned(lake.repartition_for_write(again, "rebalance", keys), path, keys)
    return lake.read_partition(spark, path, keys)


def partition_prune(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, path = _orders_table(spark, sf_dir)
    return lake.read_partition(spark, path, ["year", "month"], year="1998", month="03")


def table_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    monthly, path = _orders_table(spark, sf_dir)
    name = f"orders_{uuid.uuid4().hex}"
    lake.register_table(spark, name, monthly.schema, path, ["year", "month"])
    lake.repair_table(spark, name)
    return spark.table(name).where(F.col("month").between("03", "10"))


def bounded_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lake.bounded_sample(table(spark, sf_dir, "orders"), 10_000, ["o_orderkey"])


def sample_repeated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A uniform choice of rows: its size, that it is the same twice, of the table, and near the table in its mean."""
    orders = table(spark, sf_dir, "orders")
    n = 1000
    first, second = (lake.bounded_sample(orders, n) for _ in range(2))
    other = lake.bounded_sample(orders, n, seed=1)
    whole = orders.agg(F.avg("o_totalprice").alias("mean"), F.stddev_pop("o_totalprice").alias("spread")).first()
    near = first.agg(F.avg("o_totalprice").alias("mean"), F.count(F.lit(1)).alias("k"))
    # a mean of k rows is within five of its standard deviations
    close = F.abs(F.col("mean") - (whole.mean or 0.0)) <= 5 * (whole.spread or 0.0) / F.sqrt("k")

    def answer(name: str, df: DataFrame, value: Column) -> DataFrame:
        return df.agg(value.alias("n")).select(F.lit(name).alias("fact"), F.col("n").cast("long").alias("n"))

    rows = F.count(F.lit(1))
    return (
        answer("rows", first, rows)
        .unionByName(answer("of the table", first.join(orders, orders.columns, "left_semi"), rows))
        .unionByName(answer("distinct", first.select("o_orderkey").distinct(), rows))
        .unionByName(answer("not in the second", first.exceptAll(second), rows))
        .unionByName(answer("other seed is another choice", first.exceptAll(other), F.least(rows, F.lit(1))))
        .unionByName(answer("mean is near", near, F.count_if(close)))
    )


def sized_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with a third of all rows in one month, written in files of a tenth of the input each: files per month, none far over."""
    orders = table(spark, sf_dir, "orders")
    hot = F.when(F.col("o_orderkey") % 3 == 0, F.lit("00")).otherwise(F.date_format("o_orderdate", "MM"))
    monthly = orders.withColumn("month", hot)
    path = scratch_path(spark, "sized")
    # a row counts as a hundred bytes, so that the numbers do not depend on how well the rows compress
    total = orders.count()
    lake.write_partitioned(lake.repartition_for_write(monthly, "sized", ["month"], total * 100, total * 10), path, ["month"])
    files = lake.read_partition(spark, path, ["month"]).groupBy("month", F.col("_metadata.file_path").alias("file")).agg(F.count(F.lit(1)).alias("n"))
    return files.groupBy("month").agg(
        F.count(F.lit(1)).alias("n_files"), F.sum("n").alias("n_rows"), (F.max("n") <= total * 0.105 + 1).alias("none_far_over")
    )


def _done(report):
    if not report.ok:
        raise RuntimeError(f"{report.job}: {report.status}") from report.error
    return report


def bronze_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "bronze")
    _done(jobs.run_bronze(spark, drifted_files(spark, sf_dir), path, BRONZE))
    df = lake.read_partition(spark, path, BRONZE.keys)
    return _ntz(
        df.select(
            "source_type", "year", "month", "vendorid", "passenger_count", "tpep_pickup_datetime",
            "dropoff_datetime", "fare_amount", "tip_amount", "tolls", "pulocationid", "dolocationid",
            "ingestion_date", "date_ref",
        )
    )


def _silver_table(spark: SparkSession, sf_dir: str):
    bronze, path = scratch_path(spark, "bronze"), scratch_path(spark, "silver")
    _done(jobs.run_bronze(spark, drifted_files(spark, sf_dir), bronze, BRONZE))
    return path, _done(jobs.run_silver(spark, bronze, path, SILVER))


def silver_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, _ = _silver_table(spark, sf_dir)
    return _ntz(lake.read_partition(spark, path, SILVER.keys))


def silver_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality report that the silver job takes during its write."""
    _, report = _silver_table(spark, sf_dir)
    return report.quality


def marts_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both means over the registered silver table."""
    path, _ = _silver_table(spark, sf_dir)
    frames = _done(jobs.run_marts(spark, f"silver_{uuid.uuid4().hex}", path, presets.TRIP_MARTS)).frames
    return _both_means(frames["monthly"], frames["hourly"])


def _both_means(monthly: DataFrame, hourly: DataFrame) -> DataFrame:
    return monthly.select(
        F.lit("monthly").alias("mart"), F.concat_ws("-", "year", "month").alias("key"), F.col(marts.MONTHLY).alias("mean")
    ).unionByName(
        hourly.select(F.lit("hourly").alias("mart"), F.concat_ws(" ", "dia", "hora").alias("key"), F.col(marts.HOURLY).alias("mean"))
    )


def run_all_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All jobs with publishing, and again after the yellow files came anew with more passengers in January."""
    raw, base = drifted_files(spark, sf_dir), scratch_path(spark, "lake")
    config = RunConfig(
        raw, f"{base}/bronze", f"{base}/silver", f"silver_{uuid.uuid4().hex}",
        dataclasses.replace(BRONZE, mode="publish", manifest_path=f"{base}/manifest"),
        dataclasses.replace(SILVER, mode="publish", violations_path=f"{base}/violations"),
        dataclasses.replace(presets.TRIP_MARTS, parts_path=f"{base}/parts"),
    )
    for report in jobs.run_all(spark, config):
        _done(report)
    _yellow_files(spark, sf_dir, raw, F.when(F.month("l_shipdate") == 1, 1.0).otherwise(0.0))
    reports = [_done(report) for report in jobs.run_all(spark, config)]
    return _both_means(reports[-1].frames["monthly"], reports[-1].frames["hourly"])


def publish_failed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run that fails in its last rows, when other months are written already, leaves the table as it was."""
    keys = ["year", "month"]
    monthly = _orders_by_month(spark, sf_dir).select("o_orderkey", "o_totalprice", *keys)
    base = scratch_path(spark, "published")
    published.publish(spark, published.stage(lake.repartition_for_write(monthly, "rebalance", keys), base, keys))
    price = F.when(F.col("o_orderkey") % 1000 == 7, F.raise_error(F.lit("lost"))).otherwise(-F.col("o_totalprice"))
    try:
        published.publish(spark, published.stage(monthly.withColumn("o_totalprice", price.cast("double")), base, keys))
    except Exception as error:  # noqa: BLE001 - Spark reports the failure in several classes
        if "lost" not in str(error):
            raise
    again = monthly.where("month = '01'").withColumn("o_totalprice", -F.col("o_totalprice"))
    published.publish(spark, published.stage(again, base, keys))
    return published.read_published(spark, base, keys)


def maintained_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both means from stored parts, after one month was published anew with double amounts and one passenger more."""
    spec, keys = presets.TRIP_MARTS, list(presets.SILVER_KEYS)
    src, parts = scratch_path(spark, "silver"), scratch_path(spark, "parts")
    rows = jobs.silver(bronze_like(spark, sf_dir), presets.TRIP_SILVER)
    published.publish(spark, published.stage(lake.repartition_for_write(rows, "rebalance", keys), src, keys))
    jobs.refresh_means(spark, src, parts, spec)
    again = rows.where("month = '03'").withColumns(
        {"total_amount": F.col("total_amount") * 2, "passenger_count": F.col("passenger_count") + 1}
    )
    published.publish(spark, published.stage(lake.repartition_for_write(again, "rebalance", keys), src, keys))
    jobs.refresh_means(spark, src, parts, spec)
    stored = published.read_published(spark, parts, keys)
    return _both_means(marts.monthly_mean_of_parts(stored, keys), marts.hourly_mean_of_parts(stored))


def _typed_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed = layers.cast_columns(bronze_like(spark, sf_dir), presets.CASTS)
    return layers.null_safe_sum(typed, presets.AMOUNTS, "total_amount")


def violating_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each trip that fails a check, with all checks that it fails."""
    bad = quality.violations(_typed_trips(spark, sf_dir), SUITE)
    return bad.select("l_orderkey", "l_linenumber", F.array_join("failed", "; ").alias("failed"))


def violations_counted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per check: violations in the report, and rows that name it, both from one scan."""
    path = scratch_path(spark, "violations")
    report = quality.audit(_typed_trips(spark, sf_dir), SUITE, path)
    rows = spark.read.parquet(path).select(F.explode("failed").alias("check")).groupBy("check").agg(F.count(F.lit(1)).alias("n_rows"))
    names = spark.createDataFrame([(e.kind, e.column, quality.label(e)) for e in SUITE], "expectation string, column string, check string")
    counted = report.where("expectation <> 'exists'").join(names, ["expectation", "column"]).join(rows, "check", "left")
    return counted.select("check", "violations", F.coalesce("n_rows", F.lit(0)).alias("n_rows"))


def catalog_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The kept catalog after one dataset stayed, one was written anew, one came and one left: its columns, and which were opened."""
    raw, base = scratch_path(spark, "raw"), scratch_path(spark, "manifest")
    orders = table(spark, sf_dir, "orders")
    for status in "FOP":
        orders.where(F.col("o_orderstatus") == status).write.parquet(f"{raw}/{status}.parquet")
    glob = "{F,O,P}.parquet"
    manifest.refresh(spark, raw, base, glob)
    orders.select("o_orderkey", F.col("o_totalprice").cast("string").alias("price")).write.mode("overwrite").parquet(f"{raw}/O.parquet")
    orders.select("o_orderdate").write.parquet(f"{raw}/N.parquet")
    before = published.current(spark, f"{base}/files").first().run
    found = manifest.refresh(spark, raw, base, "{F,O,N}.parquet")
    old = published.read_folders(spark, f"{base}/files", [], [(before, "")]).select("path", "modified", F.lit(True).alias("known"))
    files = published.read_published(spark, f"{base}/files").join(old, ["path", "modified"], "left")
    if found.opened != files.where("known is null").count():
        raise RuntimeError("a file was opened again")
    dataset = F.regexp_extract("path", "([A-Z])[.]parquet", 1)
    columns = manifest.catalog(spark, base).select(dataset.alias("dataset"), "pos", "name", "type").distinct()
    return columns.join(files.groupBy(dataset.alias("dataset")).agg(F.every(F.col("known").isNull()).alias("opened")), "dataset")


# --- links -----------------------------------------------------------------------------------


def all_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return links.extract_links(table(spark, sf_dir, "pages")).select("page_id", "pos", "href")


def links_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = links.extract_links(table(spark, sf_dir, "pages"))
    return links.with_suffix(found, "ON").select("page_id", "pos", "href")


def _dated_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages whose links name data files by month; months 00 and 13 are no months."""
    folder = F.concat(
        F.lit('<a href="/data/'),
        F.lit("trips_2023-"),
        F.lpad((F.col("page_id") % 14).cast("string"), 2, "0"),
        F.lit('/$1.parquet"'),
    )
    return table(spark, sf_dir, "pages").withColumn("html", F.regexp_replace("html", F.lit('<a href="/([^"]*)"'), folder))


def links_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    return links.data_links(_dated_pages(spark, sf_dir))


def links_abs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = links.extract_links(table(spark, sf_dir, "pages"))
    return found.select("page_id", "pos", "abs_url", "period")


#: Hrefs of every kind that an address can be taken from, by the page's number modulo their count.
FORMS = ("x/y", "../up", "./here", "?q=1", "#frag", "//other.example.org/z", "https://z.example/a?b#c", "/a/../b", "mailto:a@b.example")


def links_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Absolute addresses of relative, query, fragment and host links, on a base below a folder."""
    form = F.element_at(F.array(*map(F.lit, FORMS)), (F.col("page_id") % len(FORMS) + 1).cast("int"))
    pages = table(spark, sf_dir, "pages").select(
        "page_id",
        F.concat(F.regexp_extract("url", "^https?://[^/?#]*", 0), F.lit("/d/e/f?old=1")).alias("url"),
        F.concat(F.lit('<p><a href="'), form, F.lit('">')).alias("html"),
    )
    return links.extract_links(pages).select("page_id", "href", "abs_url")


def links_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links whose addresses hold long numeric and named character references."""
    zeros = F.repeat(F.lit("0"), (F.col("page_id") % 12).cast("int"))
    letter = F.col("page_id") % 1000 + 256
    pages = table(spark, sf_dir, "pages").select(
        "page_id",
        "url",
        F.concat(
            F.lit('<a href="/i?a&#'), zeros, F.lit("38;b=&#x"), zeros, F.hex(letter), F.lit(";&eacute;&amp;&#x1F600;&#xD800;&bogus;"),
            F.lit('">x</a>'),
        ).alias("html"),
    )
    return links.extract_links(pages).select("page_id", "href")


def cast_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole numbers written with a fraction, in every whole-number type."""
    items = table(spark, sf_dir, "lineitem")
    key, line = F.concat("l_orderkey", F.lit(".0")), F.concat("l_linenumber", F.lit(".5"))
    far = F.concat(F.lit("9223372036854775"), F.lpad((F.col("l_linenumber") + 803).cast("string"), 3, "0"))
    casts = {f"as_{kind}": lenient_cast(line, kind) for kind in ("tinyint", "smallint", "int", "bigint")}
    return items.select("l_orderkey", "l_linenumber").withColumns(
        casts | {"key_long": lenient_cast(key, "long"), "near_end": lenient_cast(far, "bigint")}
    )


def mean_odd_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Means of groups with NaN, infinite and huge values next to plain ones."""
    value = (
        F.when((F.col("user_id") % 5 == 0) & (F.col("event_id") % 97 == 0), F.lit(float("nan")))
        .when((F.col("user_id") % 5 == 1) & (F.col("event_id") % 89 == 0), F.lit(float("inf")))
        .otherwise(F.col("value"))
    )
    events = table(spark, sf_dir, "events").select((F.col("user_id") % 5).alias("g"), value.alias("v"))
    mean = events.groupBy("g").agg(rounded_mean(F.col("v"), 2, 2).alias("mean"))
    return mean.select("g", F.when(F.isnan("mean"), "nan").when(F.col("mean") == F.lit(float("inf")), "inf").otherwise("number").alias("kind"))


def float_suite_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Data meets the suite made from its own profile, also in single precision and decimals."""
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_totalprice").cast("float").alias("single"),
        F.col("o_totalprice").cast("decimal(20,4)").alias("exact"),
        F.col("o_orderkey").cast("int").alias("whole"),
    )
    suite = quality.as_expectations(quality.suite_from_profile(quality.profile(orders)))
    return quality.quality_report(orders, suite).select("expectation", "column", "violations", "success")


def sample_checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A suite with computed violations, in one aggregation over all orders."""
    suite = [quality.between("o_totalprice", hi=100_000.0), quality.not_null("o_custkey")]
    return quality.quality_report(table(spark, sf_dir, "orders"), suite)


def profile_sketch_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per column: is the sketch within its stated error of the exact profile?"""
    orders = table(spark, sf_dir, "orders")
    sketch, exact = quality.profile(orders), quality.profile(orders, exact=True)
    near = sketch.alias("s").join(exact.alias("e"), "column")
    apart = F.abs(F.col("s.distinct") - F.col("e.distinct"))
    spread = F.col("e.max").try_cast("double") - F.col("e.min").try_cast("double")
    close = [F.abs(F.col(f"s.{q}") - F.col(f"e.{q}")) <= spread * 0.01 for q in quality.PROFILE_COLUMNS[-3:]]
    return near.select(
        "column",
        ((F.col("s.n") == F.col("e.n")) & (F.col("s.nulls") == F.col("e.nulls"))).alias("counts_equal"),
        (apart <= F.col("e.distinct") * 0.15).alias("distinct_near"),
        F.coalesce(close[0] & close[1] & close[2], F.lit(True)).alias("quantiles_near"),
    )


def mapping_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mapping written as JSON and read back."""
    path = scratch_path(spark, "mapping-json")
    mapping.write_mapping(_spelling_mapping(spark, sf_dir), path, "json")
    return spark.read.json(path).select("standard", F.array_join("variants", "|").alias("variants"))


def report_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quality report written as JSON and read back."""
    path = scratch_path(spark, "report")
    suite = [quality.exists("o_orderkey"), quality.between("o_totalprice", hi=100_000.0)]
    quality.write_report(quality.quality_report(table(spark, sf_dir, "orders"), suite), path, "json")
    return spark.read.schema(quality.REPORT_SCHEMA).json(path)


def guards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the guards say about the given tables: empty input, missing path, nothing mapped, missing column."""
    orders = table(spark, sf_dir, "orders")

    def raises(kind: type[Exception], call) -> bool:  # noqa: ANN001
        try:
            call()
        except kind:
            return True
        return False

    missing = f"{sf_dir.rstrip('/')}/no_such_table.parquet"
    rows = [
        ("empty: all orders", lake.is_empty(orders)),
        ("empty: orders below zero", lake.is_empty(orders.where("o_totalprice < 0"))),
        ("missing: orders", raises(catalog.SourceMissing, lambda: lake.read_parquet(spark, f"{sf_dir.rstrip('/')}/orders.parquet"))),
        ("missing: other", raises(catalog.SourceMissing, lambda: lake.read_parquet(spark, missing))),
        ("nothing mapped", raises(ValueError, lambda: c.conform_union([]))),
        ("column not there", raises(ValueError, lambda: layers.require(orders, ["o_orderkey", "pickup"]))),
    ]
    return spark.createDataFrame(rows, "guard string, answer boolean")


def skipped_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Schemas without a mapped column are skipped, and named by their columns; the others are conformed."""
    good, _ = jobs.harvest(spark, sf_dir, "{orders,nation,region}.parquet")
    groups = catalog.scan_groups(spark, good)
    df, skipped = c.conform_groups(groups, {"order_key": ("o_orderkey",)}, c.ConformSpec())
    names = [(g.columns[0], "skipped", 0) for g in groups if g.fingerprint in skipped]
    done = df.select(F.lit("o_orderkey").alias("first_column"), F.lit("conformed").alias("state"), "order_key")
    counted = done.groupBy("first_column", "state").agg(F.count("order_key").alias("n"))
    return counted.unionByName(spark.createDataFrame(names, "first_column string, state string, n long"))


def preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first rows of an ordered table."""
    return lake.preview(table(spark, sf_dir, "orders").orderBy(F.desc("o_totalprice"), "o_orderkey"))


QUERIES = {
    "q_hourly_mean": hourly_mean,
    "q_monthly_mean": monthly_mean,
    "q_sql_view": sql_view,
    "q_year_month": year_month,
    "q_cast": cast,
    "q_total_amount": total_amount,
    "q_total_missing_col": total_missing_col,
    "q_silver": silver,
    "q_quality": trip_quality,
    "q_quality_not_null": quality_not_null,
    "q_quality_between": quality_between,
    "q_quality_min": quality_min,
    "q_quality_ts_range": quality_ts_range,
    "q_quality_gate": quality_gate,
    "q_quality_sample": quality_sample,
    "q_profile": profile,
    "q_profile_sketch": profile_sketch,
    "q_profile_merged": profile_merged,
    "q_suite_from_profile": suite_from_profile,
    "q_norm_name": norm_names,
    "q_similar_names": similar_names,
    "q_similar_names_top3": similar_names_top3,
    "q_group_columns": group_columns,
    "q_group_columns_no_veto": group_columns_no_veto,
    "q_name_groups": name_groups,
    "q_split_exclusive": split_exclusive,
    "q_require_columns": require_columns,
    "q_standard_of": standard_of,
    "q_mapping_csv": mapping_csv,
    "q_build_mapping": build_mapping,
    "q_file_catalog": file_catalog,
    "q_schema_catalog": schema_catalog,
    "q_quarantine": quarantine,
    "q_rename_first": rename_first,
    "q_fill_missing": fill_missing,
    "q_final_columns": final_columns,
    "q_tag_source": tag_source,
    "q_date_ref": file_date,
    "q_provenance": provenance,
    "q_conform_union": conform_union,
    "q_write_roundtrip": write_roundtrip,
    "q_partition_prune": partition_prune,
    "q_table_scan": table_scan,
    "q_bounded_sample": bounded_sample,
    "q_sample_repeated": sample_repeated,
    "q_sized_layout": sized_layout,
    "q_bronze": bronze_job,
    "q_silver_job": silver_job,
    "q_silver_report": silver_report,
    "q_marts": marts_job,
    "q_run_all": run_all_twice,
    "q_publish_failed": publish_failed,
    "q_maintained_means": maintained_means,
    "q_violations": violating_rows,
    "q_violations_counted": violations_counted,
    "q_catalog_refresh": catalog_refresh,
    "q_links": all_links,
    "q_links_suffix": links_suffix,
    "q_links_period": links_period,
    "q_links_abs": links_abs,
    "q_links_forms": links_forms,
    "q_links_references": links_references,
    "q_cast_whole": cast_whole,
    "q_mean_odd_values": mean_odd_values,
    "q_float_suite_gate": float_suite_gate,
    "q_sample_checked": sample_checked,
    "q_profile_sketch_bounds": profile_sketch_bounds,
    "q_mapping_json": mapping_json,
    "q_report_roundtrip": report_roundtrip,
    "q_guards": guards,
    "q_skipped_groups": skipped_groups,
    "q_preview": preview,
}
