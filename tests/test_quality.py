from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from sedimenta.operators import quality as q
from sedimenta.operators.ranking import with_ordinal, with_running_total

LO, HI = datetime(2023, 1, 1), datetime(2023, 5, 1)


@pytest.fixture
def trips(spark):
    rows = [
        (0, LO, "a"),
        (1, HI, "b"),
        (8, HI + timedelta(microseconds=1), "a"),
        (9, LO - timedelta(microseconds=1), None),
        (None, None, "c"),
    ]
    return spark.createDataFrame(rows, "passengers int, at timestamp, kind string")


def counted(report):
    return [(r.expectation, r["column"], r.evaluated, r.violations, r.success) for r in report.collect()]


SUITE = [
    q.exists("passengers"),
    q.exists("absent"),
    q.not_null("passengers"),
    q.not_null("passengers", mostly=0.8),
    q.not_null("absent"),
    q.between("passengers", 1, 8),
    q.between("passengers", lo=1),
    q.between("passengers", hi=8),
    q.between("at", "2023-01-01", "2023-05-01"),
    q.between("at", "2023-01-01", "2023-05-01", hi_exclusive=True),
    q.in_set("kind", ["a", "b"]),
    q.in_set("kind", ["a", "b", "c"]),
]
EXPECTED = [
    ("exists", "passengers", 0, 0, True),
    ("exists", "absent", 0, 1, False),
    ("not_null", "passengers", 5, 1, False),
    ("not_null", "passengers", 5, 1, True),
    ("not_null", "absent", 0, 1, False),
    ("between", "passengers", 4, 2, False),
    ("between", "passengers", 4, 1, False),
    ("between", "passengers", 4, 1, False),
    ("between", "at", 4, 2, False),
    ("between", "at", 4, 3, False),
    ("in_set", "kind", 4, 1, False),
    ("in_set", "kind", 4, 0, True),
]


def test_report(trips):
    assert counted(q.quality_report(trips, SUITE)) == EXPECTED


def test_report_is_one_aggregation(trips):
    plan = q.quality_report(trips, SUITE)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


def test_observed_report_equals_aggregated_one(spark, trips):
    seen = Observation()
    trips.observe(seen, *q.suite_metrics(SUITE, trips.schema)).collect()
    assert counted(q.report_from_metrics(spark, SUITE, seen.get)) == EXPECTED


def test_empty_table_passes(spark, trips):
    suite = [e for e in SUITE if e.column != "absent"]
    report = q.quality_report(trips.limit(0), suite)
    assert q.check(report).first().success and all(r.violations == 0 for r in report.collect())
    assert q.check(q.quality_report(trips, [])).first().success


def test_gate(trips):
    df, report = q.validate(trips, SUITE)
    assert df is trips and not q.check(report).first().success
    with pytest.raises(q.QualityError, match="exists\\(absent\\)"):
        q.validate(trips, SUITE, on_fail="raise")
    with pytest.raises(ValueError):
        q.validate(trips, SUITE, on_fail="ignore")
    with pytest.raises(ValueError):
        q.between("passengers")


def test_report_round_trip(spark, trips, tmp_path):
    report = q.quality_report(trips, SUITE)
    for fmt in ("parquet", "json"):
        q.write_report(report, str(tmp_path / fmt), fmt)
        assert sorted(counted(spark.read.schema(q.REPORT_SCHEMA).format(fmt).load(str(tmp_path / fmt)))) == sorted(EXPECTED)


def test_profile_against_pandas(spark):
    rng = np.random.default_rng(4)
    pdf = pd.DataFrame({"x": rng.integers(0, 50, 999), "y": rng.normal(size=999).round(3), "s": rng.choice(list("abc"), 999)})
    pdf.loc[::10, "y"] = np.nan
    df = spark.createDataFrame(pdf).withColumn("y", F.when(~F.isnan("y"), F.col("y")))
    for exact in (True, False):
        rows = {r["column"]: r for r in q.profile(df.repartition(7), exact=exact).collect()}
        for name in ("x", "y"):
            series, row = pdf[name].dropna(), rows[name]
            assert (row.n, row.nulls) == (999, 999 - len(series))
            assert row["mean"] == pytest.approx(series.mean(), abs=1e-6)
            assert float(row["min"]) == series.min() and float(row["max"]) == series.max()
            assert row["distinct"] == pytest.approx(series.nunique(), rel=0 if exact else 0.1)
            for quantile, got in ((0.25, row.q25), (0.5, row.q50), (0.75, row.q75)):
                assert got == pytest.approx(series.quantile(quantile), abs=1e-6 if exact else 0.1)
        assert (rows["s"]["min"], rows["s"]["max"], rows["s"]["distinct"], rows["s"]["mean"]) == ("a", "c", 3, None)


def test_profile_of_empty_table(spark, trips):
    for exact in (True, False):
        rows = q.profile(trips.limit(0), exact=exact).collect()
        assert len(rows) == 3 and all(r.n == 0 and r["distinct"] == 0 and r["min"] is None for r in rows)


def test_profile_with_one_hot_value(spark):
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("v"))
    row = q.profile(df, exact=True).first()
    values = pd.Series([7 if i % 3 == 0 else i for i in range(3000)])
    assert row["distinct"] == values.nunique()
    assert (row.q25, row.q50, row.q75) == tuple(values.quantile([0.25, 0.5, 0.75]))


def test_suite_from_profile_accepts_its_own_data(spark, trips, tmp_path):
    df = trips.withColumn("full", F.lit("same"))
    q.save_suite(q.suite_from_profile(q.profile(df), q.value_sets(df, limit=20)), str(tmp_path / "suite"))
    suite = q.load_suite(spark, str(tmp_path / "suite"))
    assert {(e.kind, e.column) for e in suite} == {
        *{("exists", x) for x in df.columns},
        ("not_null", "full"),
        ("between", "passengers"),
        ("between", "at"),
        ("in_set", "kind"),
        ("in_set", "full"),
    }
    assert q.check(q.quality_report(df, suite)).first().success
    worse = df.withColumn("passengers", F.lit(99))
    assert not q.check(q.quality_report(worse, suite)).first().success


def test_long_texts_are_counted_as_wholes(spark):
    texts = ["x" * 500 + end for end in "aabbc"] + ["short", "short", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    row = q.profile(df, exact=True).first()
    assert (row.n, row.nulls, row["distinct"], row["max"]) == (8, 1, 4, "x" * 500 + "c")
    assert [r["values"] for r in q.value_sets(df, limit=3).collect()] == [None]
    assert q.value_sets(df, limit=4).first()["values"] == sorted(set(t for t in texts if t))
    assert q.value_sets(spark.range(3), limit=20).count() == 0


def test_running_total_and_ordinal(spark):
    df = spark.range(1000).select(F.col("id"), (F.col("id") % 5).alias("w")).repartition(9)
    got = {r.id: r.t for r in with_running_total(df, ["id"], F.col("w"), "t").collect()}
    total, want = 0, {}
    for i in range(1000):
        want[i] = total
        total += i % 5
    assert got == want
    ranked = with_ordinal(df.select("id"), ["id"]).collect()
    assert {r.id: r.ordinal for r in ranked} == {i: i + 1 for i in range(1000)}


def test_violating_rows_and_report_come_from_one_scan(spark, tmp_path):
    rows = [(1, 5, "a"), (2, None, "b"), (3, 50, None), (4, -1, "z"), (5, 3, "a"), (6, None, "z")]
    df = spark.createDataFrame(rows, "id int, n int, `k.x` string").repartition(3)
    suite = [
        q.exists("n"), q.exists("absent"), q.not_null("n", mostly=0.5), q.between("n", 0, 40), q.in_set("k.x", ["a", "b"]),
        q.between("absent", 1, 2), q.not_null("k.x"),
    ]
    report = q.audit(df, suite, str(tmp_path / "bad"))
    found = {r.id: r.failed for r in spark.read.parquet(str(tmp_path / "bad")).collect()}
    assert found == {
        2: ["not_null(n)"], 3: ["between(n, 0, 40)", "not_null(k.x)"], 4: ["between(n, 0, 40)", "in_set(k.x, a, b)"],
        6: ["not_null(n)", "in_set(k.x, a, b)"],
    }
    assert [tuple(r) for r in report.collect()] == [tuple(r) for r in q.quality_report(df, suite).collect()]
    counts = {}
    for labels in found.values():
        for text in labels:
            counts[text] = counts.get(text, 0) + 1
    by_label = {q.label(e): r.violations for e, r in zip(suite, report.collect(), strict=True) if e.column != "absent" and e.kind != "exists"}
    assert by_label == counts
    assert q.violations(df, []).count() == 0 and q.audit(df, [], str(tmp_path / "none")).count() == 0
    plan = q.violations(df, suite)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan


def test_violations_make_their_array_once(spark):
    df = spark.range(20).select("id", F.when(F.col("id") % 3 > 0, F.col("id")).alias("n"))
    bad = q.violations(df, [q.not_null("n"), q.between("n", 4, 15), q.not_null("n")])
    found = {r.id: r.failed for r in bad.collect()}
    assert found == {i: ["not_null(n)"] * 2 if i % 3 == 0 else ["between(n, 4, 15)"] for i in range(20) if i % 3 == 0 or not 4 <= i <= 15}
    # no function is called for each element, and the rows are chosen without the array
    plan = bad._jdf.queryExecution().executedPlan().toString()
    assert "lambda" not in plan and plan.count("array(") == 1


def test_distinct_values_are_counted_a_column_at_a_time(spark):
    from checks.queries import _held_against_rows

    rows = spark.range(200).select("id", (F.col("id") % 3).alias("few"), F.when(F.col("id") > 9, F.col("id").cast("string")).alias("text"))
    held = _held_against_rows(rows, q.profile(rows), 0.01)
    assert {(r["column"], r.distinct_near, r.quantiles_near) for r in held.collect()} == {(c, True, True) for c in ("id", "few", "text")}
    wrong = _held_against_rows(rows, q.profile(rows).withColumn("distinct", F.col("distinct") * 2), 0.01)
    assert not any(r.distinct_near for r in wrong.collect())
    # expanded rows would put the values of all columns into each task's memory
    assert "Expand" not in held._jdf.queryExecution().executedPlan().toString()
