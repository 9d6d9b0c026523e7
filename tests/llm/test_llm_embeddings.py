import numpy as np
import pytest

from sedimenta.llm import embedding_duplicates as ed

SCHEMA = "vec_id long, label int, embedding array<float>, leader string, unit string, `a.b` int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", 0) for r in rows], SCHEMA)


def plain(rows, cosine=ed.COSINE):
    """Links and components by comparing all pairs."""
    vectors = [None if v is None else np.array(v, dtype="f4").astype("f8") for _, _, v in rows]
    usable = [
        k for k, v in enumerate(vectors)
        if rows[k][1] is not None and v is not None and len(v) and np.isfinite(v).all() and v.any()
    ]
    links = {k: set() for k in range(len(rows))}
    for i, a in enumerate(usable):
        for b in usable[i + 1 :]:
            x, y = vectors[a], vectors[b]
            if rows[a][1] == rows[b][1] and len(x) == len(y) and x @ y >= cosine * np.linalg.norm(x) * np.linalg.norm(y):
                links[a].add(b)
                links[b].add(a)
    out = []
    for k, (i, _, _) in enumerate(rows):
        seen, todo = {k}, [k]
        while todo:
            new = links[todo.pop()] - seen
            seen |= new
            todo += new
        ids = [rows[m][0] for m in seen if rows[m][0] is not None]
        least = min(ids) if ids else None
        out.append((i, len(links[k]), least, i == least))
    return out


def found(df, **kwargs):
    return [tuple(r) for r in ed.near_duplicates(df, **kwargs).collect()]


def order(row):
    return tuple((x is None, x or 0) for x in row)


def crowds(width, draw):
    """Random vectors, tight and loose crowds around some of them, exact copies and scaled ones."""
    rows = []

    def put(label, v):
        rows.append((len(rows), label, [float(x) for x in v]))

    for label, size, noise in ((0, 150, 0.02), (0, 150, 0.12), (1, 80, 0.15), (1, 60, 0.3), (2, 5, 0.1), (2, 1, 0.0)):
        center = draw.standard_normal(width)
        center /= np.linalg.norm(center)
        for _ in range(size):
            turn = draw.standard_normal(width)
            put(label, center + turn / np.linalg.norm(turn) * noise * draw.random())
    for _ in range(150):
        put(int(draw.integers(3)), draw.standard_normal(width))
    copied = rows[:40:3]
    for _, label, v in copied:
        put(label, v)
        put(label, [2 * x for x in v])
        put((label + 1) % 3, v)
    return rows


@pytest.mark.parametrize(("width", "block"), [(64, 512), (16, 16), (3, 512), (100, 32)])
def test_recall_against_brute_force(spark, width, block):
    rows = crowds(width, np.random.default_rng(width))
    expected = {r[0]: r for r in plain(rows)}
    got = {r[0]: r for r in found(frame(spark, rows).repartition(4), block=block)}
    assert got.keys() == expected.keys()
    assert all(got[i][1] <= expected[i][1] for i in got)  # nothing below the threshold is linked
    recall = sum(r[1] for r in got.values()) / sum(r[1] for r in expected.values())
    assert recall >= 0.999
    if recall == 1:
        assert got == expected


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    v = [0.1, 0.9, -0.3]
    rows = [
        (1, 0, v), (1, 0, v), (2, 0, v), (3, 1, v), (4, None, v), (5, 0, None), (6, 0, []), (7, 0, [0.0, 0.0, 0.0]),
        (8, 0, [0.1, nan, 0.2]), (9, 0, [inf, 0.9, -0.3]), (10, 0, [1e-30 * x for x in v]), (11, 0, [1e30 * x for x in v]),
        (None, 0, v), (None, 2, v), (12, 0, [0.1, 0.9]), (13, 0, [-x for x in v]),
    ]
    got = sorted(found(frame(spark, rows)), key=order)
    expected = [r if r[0] is not None else (r[0], r[1], r[2], r[2] is None) for r in plain(rows)]
    assert got == sorted(expected, key=order)
    by_id = {r[0]: r for r in got}
    assert by_id[1][1] == 5 and by_id[10][2] == 1 and by_id[7] == (7, 0, 7, True)


def test_empty_table(spark):
    assert found(frame(spark, []).limit(0)) == []


def test_a_rotation_is_orthonormal_and_balances_bits():
    draw = np.random.default_rng(1)
    units = draw.standard_normal((2000, 20)) * np.linspace(3, 0.2, 20)
    units /= np.linalg.norm(units, axis=1, keepdims=True)
    center, axes = ed.learn_rotation(units)
    assert np.allclose(axes.T @ axes, np.eye(20))
    placed = (units - center) @ axes
    assert abs((placed >= 0).mean(axis=0) - 0.5).max() < 0.1

    def loss(coordinates):
        return ((np.where(coordinates >= 0, 1, -1) - coordinates) ** 2).sum()

    principal = np.linalg.eigh(np.cov((units - center).T))[1]
    assert loss(placed) < loss((units - center) @ principal)
