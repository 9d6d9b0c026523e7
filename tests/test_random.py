"""Native expressions against plain Python on many random inputs, one Spark job each."""

import random
import re
from datetime import datetime
from urllib.parse import urljoin

from pyspark.sql import functions as F

from sedimenta.functions.dates import date_ref, period
from sedimenta.functions.names import norm_name
from sedimenta.functions.numbers import lenient_cast, rounded_mean
from sedimenta.functions.urls import resolve_url


def texts(seed, pieces, count, longest):
    rng = random.Random(seed)
    return sorted({"".join(rng.choice(pieces) for _ in range(rng.randint(0, longest))) for _ in range(count)})


def by_text(spark, values, column):
    df = spark.createDataFrame([(v,) for v in values], "t string")
    return {r.t: r.v for r in df.select("t", column(F.col("t")).alias("v")).collect()}


def first_month(text, pattern):
    match = re.search(pattern, text)
    try:
        return datetime(int(match[1]), int(match[2]), 1) if match else None
    except ValueError:
        return None


def test_dates_in_names(spark):
    names = texts(1, ["2023", "0000", "19", "7", "_", "-", "00", "01", "12", "13", "x", " "], 3000, 7)
    got = by_text(spark, [f"/d_2020-02/{n}.parquet" for n in names], date_ref)
    want = {f"/d_2020-02/{n}.parquet": first_month(n, r"(\d{4})[_-](\d{2})") or datetime(1900, 1, 1) for n in names}
    assert got == want
    months = {n: first_month(n, r"(\d{4})-(\d{2})") for n in names}
    assert by_text(spark, names, period) == {n: m and f"{m.year:04d}-{m.month:02d}" for n, m in months.items()}


def test_normalised_names(spark):
    names = texts(2, ["A", "b", "_", " ", "9", "é", "Ü", "ß", "\t", ".", "Z"], 2000, 9)
    # a name without any of the letters and digits stays itself, in lower case
    want = {n: re.sub("[^a-zA-Z0-9]", "", n.lower()) or n.strip(" ").lower() for n in names}
    assert by_text(spark, names, norm_name) == want


def test_addresses(spark):
    paths = texts(3, ["a", "b", "/", "/", ".", "..", "/../", "/./", "//"], 1500, 6)
    tails = ["", "?q", "?q=/x", "#f", "?a#b"]
    rng = random.Random(4)
    rows = [
        (f"http://h.example{'/' + b if b and not b.startswith('/') else b}{rng.choice(tails)}", h + rng.choice(tails))
        for b, h in zip(paths, rng.sample(paths, len(paths)), strict=True)
    ]
    df = spark.createDataFrame(rows, "base string, href string")
    got = df.select("base", "href", resolve_url("base", "href").alias("u")).collect()
    wrong = [(r.base, r.href, r.u, urljoin(r.base, r.href)) for r in got if r.u != urljoin(r.base, r.href)]
    assert not wrong, wrong[:10]


def test_whole_numbers(spark):
    values = texts(5, ["1", "2", "9", "0", ".", "-", "+", "e", " ", "x"], 3000, 6)

    def whole(text):
        try:
            number = float(text)
        except ValueError:
            return None
        return int(number) if abs(number) < 2**31 else None

    plain = [v for v in values if re.fullmatch(r" *[+-]?(\d+\.?\d*|\.\d+)(e[+-]?\d+)? *", v) or not re.search(r"\d", v)]
    assert by_text(spark, plain, lambda c: lenient_cast(c, "int")) == {v: whole(v) for v in plain}


def test_exact_means(spark):
    rng = random.Random(6)
    groups = {k: [rng.randint(-500, 500) for _ in range(rng.randint(1, 40))] for k in range(400)}
    rows = [(k, cents / 100) for k, values in groups.items() for cents in values]
    df = spark.createDataFrame(rows, "k int, v double").repartition(6)
    got = {r.k: r.m for r in df.groupBy("k").agg(rounded_mean(F.col("v"), 1, 2).alias("m")).collect()}

    def half_up(values):
        total, step = sum(values), len(values) * 10
        return (1 if total >= 0 else -1) * ((2 * abs(total) + step) // (2 * step)) / 10

    assert got == {k: half_up(values) for k, values in groups.items()}
