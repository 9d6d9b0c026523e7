import random
from difflib import SequenceMatcher, get_close_matches

import pytest
from pyspark.sql import functions as F

from sedimenta.functions.names import norm_name, norm_text
from sedimenta.operators import components
from sedimenta.operators import mapping as m


def names_frame(spark, names):
    return spark.createDataFrame([(n,) for n in names], "name string")


def brute_pairs(names, cutoff):
    found = {}
    for head in names:
        for candidate in names:
            if head != candidate:
                ratio = SequenceMatcher(None, candidate, head).ratio()
                if ratio >= cutoff:
                    found[head, candidate] = ratio
    return found


def random_names(seed, count, alphabet="abcdef0", lo=1, hi=14):
    rng = random.Random(seed)
    base = ["".join(rng.choice(alphabet) for _ in range(rng.randint(lo, hi))) for _ in range(count // 3)]
    out = set(base)
    while len(out) < count:
        letters = list(rng.choice(base))
        for _ in range(rng.randint(1, 4)):
            at = rng.randrange(len(letters) + 1)
            if rng.random() < 0.5 or not letters:
                letters.insert(at, rng.choice(alphabet))
            else:
                letters.pop(min(at, len(letters) - 1))
        if letters:
            out.add("".join(letters))
    return sorted(out)


def test_norm_name(spark):
    raw = [" VendorID ", "vendor_id", "PickupDatetime", "pickup_date_time", "___", "Ärger1", " Ürün ", "Имя", "  "]
    df = names_frame(spark, raw)
    got = [r.n for r in df.select(norm_name("name").alias("n")).collect()]
    assert got == ["vendorid", "vendorid", "pickupdatetime", "pickupdatetime", "___", "rger1", "rn", "имя", ""]
    assert [norm_text(r) for r in raw] == got


@pytest.mark.parametrize("cutoff", [0.5, 0.7, 0.8, 0.95, 1.0])
def test_similar_pairs_equal_brute_force(spark, cutoff):
    names = random_names(int(cutoff * 100), 150)
    got = {(r.head, r.candidate): r.ratio for r in m.similar_pairs(names_frame(spark, names), "name", cutoff).collect()}
    assert got == brute_pairs(names, cutoff)


def test_similar_pairs_long_names_in_one_hot_family(spark):
    names = [f"passenger_reading_{i:03d}".replace("_", "") for i in range(60)] + ["unrelated", "pass", ""]
    got = {(r.head, r.candidate): r.ratio for r in m.similar_pairs(names_frame(spark, names), "name").collect()}
    assert got == brute_pairs([n for n in names if n], 0.8)


def test_candidates_come_from_an_equi_join(spark):
    pairs = m.candidate_pairs(names_frame(spark, random_names(1, 30)), 0.8)
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan and "Cartesian" not in plan


def test_top_similar_matches_library_choice(spark):
    names = random_names(5, 120, alphabet="abc", lo=4, hi=8)
    pairs = m.similar_pairs(names_frame(spark, names), "name")
    got = {}
    for r in m.top_similar(pairs).collect():
        got.setdefault(r.head, set()).add(r.candidate)
    want = {n: set(get_close_matches(n, names, cutoff=0.8)) - {n} for n in names}
    assert got == {n: s for n, s in want.items() if s}


def greedy(names, cutoff, top_n=None):
    """The sequential rule on sorted normalised names."""
    order = sorted({norm_text(n) for n in names})
    alike = brute_pairs([n for n in order if n], cutoff)
    if top_n is not None:
        best = {}
        for h in order:
            ranked = sorted(((r, c) for (x, c), r in alike.items() if x == h), reverse=True)
            best[h] = {c for _, c in ranked[: top_n - 1]}
        alike = {(h, c): r for (h, c), r in alike.items() if c in best[h] or h in best[c]}
    taken, groups = set(), {}
    for head in order:
        if head in taken:
            continue
        members = [n for n in order if n not in taken and (n == head or ((head, n) in alike))]
        taken.update(members)
        groups[head] = members
    return groups


@pytest.mark.parametrize("top_n", [None, 3])
def test_group_columns_equals_sequential_greedy(spark, top_n):
    names = random_names(11, 200)
    groups = m.group_columns(names_frame(spark, names), veto=False, top_n=top_n)
    got = {}
    for r in groups.orderBy("ordinal", "raw").collect():
        got.setdefault((r.ordinal, r["head"]), []).append(r.raw)
    want = greedy(names, 0.8, top_n)
    assert got == {(i, h): members for i, (h, members) in enumerate(sorted(want.items()), 1)}


def test_veto_keeps_cooccurring_names_apart(spark):
    together = ["PULocationID", "DOLocationID", "total_amount", "tolls_amount", "VendorID"]
    other = ["PUlocation_id", "total_amounts", "vendor_id"]
    seen = spark.createDataFrame([("a", n) for n in together] + [("b", n) for n in other], "source string, name string")
    names = seen.select("name").distinct()
    merged = {frozenset(g) for g in grouped(m.group_columns(names, cooccur=seen, veto=False))}
    assert any({"PULocationID", "DOLocationID"} <= g for g in merged)
    kept = {frozenset(g) for g in grouped(m.group_columns(names, cooccur=seen))}
    assert kept == {
        frozenset({"VendorID", "vendor_id"}),
        frozenset({"PULocationID", "PUlocation_id"}),
        frozenset({"DOLocationID"}),
        frozenset({"total_amount", "total_amounts"}),
        frozenset({"tolls_amount"}),
    }


def grouped(groups):
    out = {}
    for r in groups.collect():
        out.setdefault(r.ordinal, []).append(r.raw)
    return out.values()


def test_no_group_shares_a_source_on_random_catalogs(spark):
    rng = random.Random(3)
    names = random_names(21, 90, alphabet="abcd", lo=5, hi=8)
    rows = [(f"s{s}", n) for s in range(12) for n in rng.sample(names, 12)]
    rows += [("both", "x_y1z"), ("both", "XY1Z"), ("both", "xy1z")]
    seen = spark.createDataFrame(rows, "source string, name string")
    with pytest.raises(ValueError):
        m.group_columns(seen)
    with pytest.raises(ValueError):
        m.group_columns(veto=False)
    groups = m.group_columns(cooccur=seen).collect()
    assert sorted(g.raw for g in groups) == sorted({n for _, n in rows})
    home = {g.raw: g.ordinal for g in groups}
    per_source = {}
    for source, name in rows:
        per_source.setdefault((source, home[name]), set()).add(name)
    assert all(len(v) == 1 for v in per_source.values())
    assert sorted(set(home.values())) == list(range(1, len(set(home.values())) + 1))


def to_dict(mapping):
    return {r.standard: list(r.variants) for r in mapping.collect()}


def test_name_groups(spark):
    groups = spark.createDataFrame(
        [(1, "VendorID"), (1, "vendor_id"), (2, "fare"), (3, "a_x"), (3, "ax"), (4, "FARE"), (5, "v1"), (5, "v_1")],
        "ordinal int, raw string",
    )
    got = to_dict(m.name_groups(groups, {"vendorid": "VendorID", "V1": "VendorID"}))
    assert got == {
        "VendorID": ["VendorID", "vendor_id"],
        "fare": ["fare"],
        "coluna_3": ["a_x", "ax"],
        "coluna_4": ["FARE"],
        "coluna_5": ["v1", "v_1"],
    }
    assert to_dict(m.name_groups(groups))["coluna_1"] == ["VendorID", "vendor_id"]


MAPPING = [
    ("coluna_1", ["PULocationID", "DOLocationID", "loc"], 1),
    ("VendorID", ["VendorID"], 2),
    ("coluna_3", ["pickup_datetime", "tpep_pickup_datetime"], 3),
]


def mapping_frame(spark, rows=MAPPING):
    return spark.createDataFrame(rows, "standard string, variants array<string>, ordinal int")


def test_split_exclusive(spark):
    got = to_dict(m.split_exclusive(mapping_frame(spark), ["PUlocationID", "vendorid"]))
    assert got == {
        "coluna_1": ["DOLocationID", "loc"],
        "pulocationid": ["PULocationID"],
        "vendorid": ["VendorID"],
        "coluna_3": ["pickup_datetime", "tpep_pickup_datetime"],
    }


def test_require_columns(spark):
    got = m.require_columns(mapping_frame(spark), ["vendorid", "tpep_pickup_datetime", "fare", "coluna_1"])
    assert to_dict(got) == {
        "coluna_1": ["PULocationID", "DOLocationID", "loc"],
        "vendorid": ["VendorID"],
        "tpep_pickup_datetime": ["pickup_datetime", "tpep_pickup_datetime"],
        "fare": ["fare"],
    }
    assert m.mapping_dict(got)["fare"] == ("fare",)


def test_mapping_dict_rejects_double_use(spark):
    with pytest.raises(ValueError):
        m.mapping_dict(mapping_frame(spark, [("a", ["x"], 1), ("b", ["x"], 2)]))


def test_standard_of(spark):
    rows = [("first", ["Fare"], 1), ("second", ["FARE", "tip"], 2)]
    df = names_frame(spark, ["fare", "TIP", "none", None])
    got = [tuple(r) for r in m.standard_of(df, "name", mapping_frame(spark, rows)).collect()]
    assert sorted(got, key=str) == sorted([("fare", "first"), ("TIP", "second"), ("none", None), (None, None)], key=str)


def test_exports(spark, tmp_path):
    mapping = mapping_frame(spark)
    m.write_mapping(mapping, str(tmp_path / "json"))
    assert to_dict(m.read_mapping(spark, str(tmp_path / "json"))) == to_dict(mapping)
    m.write_mapping(mapping, str(tmp_path / "csv"), "csv")
    lines = spark.read.option("header", True).csv(str(tmp_path / "csv"))
    assert lines.columns == ["nome_padrao", "colunas_equivalentes"]
    assert {r[0]: r[1] for r in lines.collect()}["coluna_1"] == "PULocationID, DOLocationID, loc"
    with pytest.raises(ValueError):
        m.write_mapping(mapping, str(tmp_path / "x"), "xml")


def walked_names(pairs):
    """Free names in sorted order take their free neighbours."""
    covered = set()
    for head in sorted({h for h, _ in pairs}):
        if head not in covered:
            covered |= {c for h, c in pairs if h == head} - covered
    return covered


def taken(spark, pairs, walked, monkeypatch):
    monkeypatch.setattr(m, "WALKED", walked)
    edges = spark.createDataFrame(sorted(pairs), "head string, candidate string").withColumn("ratio", F.lit(0.9))
    rows = m._covered(edges.repartition(3), len(pairs)).collect()
    found = {r.norm for r in rows}
    assert len(found) == len(rows)
    return found


def random_edges(seed, names, edges):
    rng = random.Random(seed)
    drawn = {tuple(sorted((f"n{rng.randrange(names):03d}", f"n{rng.randrange(names):03d}"))) for _ in range(edges)}
    return {(a, b) for a, b in drawn if a != b}


@pytest.mark.parametrize("walked", [0, 12, 10**6])
def test_components_are_walked_or_decided_in_rounds_alike(spark, walked, monkeypatch):
    for seed, names, edges in ((1, 200, 120), (2, 60, 150), (3, 4, 6)):
        pairs = random_edges(seed, names, edges)
        assert taken(spark, pairs, walked, monkeypatch) == walked_names(pairs)


def test_a_chain_of_names_needs_few_jobs(spark, monkeypatch):
    names = [f"n{i:05d}" for i in range(10_000)]
    chain = set(zip(names, names[1:]))
    written = []
    plain = m.materialize
    monkeypatch.setattr(components, "materialize", lambda *a: written.append(a) or plain(*a))
    counting = components.materialize_counting
    monkeypatch.setattr(components, "materialize_counting", lambda *a: written.append(a) or counting(*a))
    assert taken(spark, chain, 9_999, monkeypatch) == set(names[1::2])
    monkeypatch.setattr(m, "_covered_by_rounds", lambda giant: giant.select(F.col("candidate").alias("norm")).limit(0))
    assert taken(spark, chain | {("a", "b")}, 9_999, monkeypatch) == {*names[1::2], "b"}
    assert 0 < len(written) < 40


def test_component_roots(spark):
    for seed, names, edges in ((4, 300, 260), (5, 50, 100), (6, 5, 3)):
        pairs = random_edges(seed, names, edges)
        root = {x: x for p in pairs for x in p}

        def find(x):
            while root[x] != x:
                x = root[x]
            return x

        for a, b in pairs:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
        rows = components.component_roots(spark.createDataFrame([(b, a) for a, b in pairs], "a string, b string")).collect()
        assert {r.node: r.root for r in rows} == {x: find(x) for x in root if find(x) != x} and len(rows) == len({r.node for r in rows})
    assert components.component_roots(spark.createDataFrame([("a", "a")], "a string, b string")).collect() == []
