import random

import numpy as np
import pytest

from sedimenta.llm import hard_negatives as hn

SCHEMA = "vec_id long, label int, embedding array<double>, id string, parts string, score int"
MINING = hn.Mining(anchor="id % 10 = 0")


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", 0) for r in rows], SCHEMA)


def plain(rows, positives=5, negatives=10):
    usable = {}
    for i, label, vector in rows:
        if i is None or label is None or vector is None or any(x is None or not np.isfinite(x) for x in vector):
            continue
        usable[i] = min(usable.get(i, (label, vector)), (label, vector))
    whole = {i: (label, [int(np.floor(256 * x)) for x in v]) for i, (label, v) in usable.items()}
    out = set()
    for a, (label, v) in whole.items():
        if a % 10:
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w)), i) for i, (_, w) in whole.items() if i != a)
        for less, p in [s for s in scored if whole[s[1]][0] == label][:positives]:
            fit = [s for s in scored if whole[s[1]][0] != label and 30 * -less <= 100 * -s[0] <= 90 * -less]
            out |= {(a, p, rank, n, -less, -s) for rank, (s, n) in enumerate(fit[:negatives], 1)}
    return out


def mined(df, **kwargs):
    rows = hn.mine(df, MINING, **kwargs).collect()
    found = {(r["anchor_id"], r["positive_id"], r["rank"], r["negative_id"], r["positive_score"], r["negative_score"]) for r in rows}
    assert len(found) == len(rows)
    return found


def test_scores_are_exact_inner_products():
    draw = np.random.default_rng(3)
    for width, largest in ((1, 5), (8, 256), (13, 70000), (64, 300), (24, hn.reach(24))):
        rows, anchors = draw.integers(-largest, largest, (50, width)), draw.integers(-largest, largest, (7, width))
        rows[0], anchors[0] = -largest, largest
        wide = -(-width // 8) * 8
        padded = [np.pad(m, ((0, 0), (0, wide - width))).astype(np.int32) for m in (rows, anchors)]
        found = hn.scores(hn.bit_planes(padded[0]), hn.subset_tables(padded[1]))
        assert (found.astype(object) == rows.astype(object) @ anchors.astype(object).T).all()


@pytest.mark.parametrize("tasks", [{}, {"slice_rows": 40, "group_rows": 4}])
def test_brute_force(spark, tasks):
    draw = random.Random(4)
    rows = [(i, draw.choice([0, 0, 0, 1, 2]), [draw.gauss(0, 0.3) for _ in range(12)]) for i in range(300)]
    # ties: many rows with one vector
    rows += [(i, i % 3, [0.5] * 12) for i in range(300, 400)]
    assert mined(frame(spark, rows).repartition(5), **tasks) == plain(rows) != set()


def test_rows_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, 1, [1.0, 0.0]), (1, 1, [0.5, 0.5]), (2, 2, [0.3, 0.0]), (3, 2, [0.2, 0.9]), (4, None, [0.3, 0.0]), (5, 2, None),
        (6, 2, [0.3, nan]), (7, 2, [inf, 0.0]), (8, 2, [0.3, None]), (None, 2, [0.3, 0.0]), (2, 2, [0.3, 0.0]),
        (9, 2, [0.25]), (10, 3, []), (11, 2, [1e300, 0.0]), (20, 7, [0.1, 0.1]),
    ]
    found = mined(frame(spark, rows))
    assert {r[:4] for r in found} == {(0, 1, 1, 2), (0, 1, 2, 9), (0, 1, 3, 3)}
    assert found == plain([r for r in rows if r[0] != 11])
    assert mined(frame(spark, rows).limit(0)) == set()
