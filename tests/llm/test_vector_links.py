import math

import numpy as np
import pytest

from wayfield.llm import vector_links as V

SCHEMA = "vec_id long, embedding array<float>, label int, component string"


def usable(vec, label):
    return (label is not None and vec and all(x is not None and math.isfinite(x) for x in vec)
            and any(vec))


def brute(rows, threshold=0.98):
    """Links and smallest reachable id of every row, by all pairs."""
    n = len(rows)
    unit = [np.array(np.float32(r[1]), float) if usable(r[1], r[2]) else None for r in rows]
    unit = [u / math.sqrt((u * u).sum()) if u is not None else None for u in unit]
    near = [[j for j in range(n) if j != i and unit[i] is not None and unit[j] is not None and rows[i][2] == rows[j][2]
             and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= threshold] for i in range(n)]
    least = [r[0] if r[0] is not None else math.inf for r in rows]
    changed = True
    while changed:
        changed = False
        for i in range(n):
            m = min([least[i]] + [least[j] for j in near[i]])
            changed |= m < least[i]
            least[i] = m
    out = []
    for i, r in enumerate(rows):
        c = None if least[i] == math.inf else least[i]
        out.append((r[0], len(near[i]), c, r[0] == c))
    return sorted(out, key=repr)


def clusters(seed, sizes, dim, spread, labels=2, start=0):
    rng = np.random.default_rng(seed)
    rows = []
    for size in sizes:
        centre = rng.standard_normal(dim)
        label = int(rng.integers(labels))
        for _ in range(size):
            v = centre / np.linalg.norm(centre) + rng.standard_normal(dim) * spread / math.sqrt(dim)
            rows.append((start + len(rows), (v * rng.uniform(0.5, 3)).astype(np.float32).tolist(), label, "x"))
    return rows


def got(spark, rows, parts=3):
    df = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    return sorted((tuple(r) for r in V.near_vectors(df).collect()), key=repr)


@pytest.mark.parametrize("cell", [8192, 300])
def test_brute(spark, monkeypatch, cell):
    """Near copies, one group larger than a cell, halved labels and split cells; the distance
    of the copies is well within the threshold, so that none is missed."""
    monkeypatch.setattr(V, "CELL", cell)
    rows = clusters(1, [1] * 300 + [5] * 20 + [900] + [40], 24, 0.08)
    rows += [(7001, rows[3][1], rows[3][2], "a"), (7001, rows[3][1], rows[3][2], "b"), (None, rows[3][1], rows[3][2], "c"),
             (-5, rows[410][1], rows[410][2], "d")]
    assert got(spark, rows) == brute(rows)


def test_odd_rows(spark):
    v, w = [1.0, 2.0, 3.0], [1.0, 2.0, 3.01]
    rows = [(1, v, 1, ""), (2, w, 1, ""), (3, v, None, ""), (4, None, 1, ""), (5, [], 1, ""), (6, [0.0, 0.0, 0.0], 1, ""),
            (7, [0.0, 0.0, 0.0], 1, ""), (8, [1.0, None, 3.0], 1, ""), (9, [1.0, math.nan, 3.0], 1, ""),
            (10, [1.0, math.inf, 3.0], 1, ""), (11, [10.0, 20.0, 30.0], 2, ""), (None, [2.0, 4.0, 6.0], 2, ""),
            (None, [5.0, 1.0, 1.0], 2, ""), (12, [1.0, 2.0, 3.0, 0.0], 1, ""), (13, [-1.0, -2.0, -3.0], 1, ""),
            (14, [1e30, 2e30, 3e30], 1, ""), (15, [1e-30, 2e-30, 3e-30], 1, ""), (16, v, 1, ""), (16, v, 1, ""),
            (17, [-0.0, 1.0, 0.0], 3, ""), (18, [0.0, 1.0, 0.0], 3, "")]
    assert got(spark, rows) == brute(rows)


def test_empty(spark):
    assert got(spark, []) == []
    assert got(spark, [(1, None, None, "")]) == [(1, 0, 1, True)]


def test_doubles_and_other_labels(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0], "a"), (2, [1.0, 0.1], "a"), (3, [1.0, 0.0], "b")],
                               "id long, v array<double>, kind string")
    found = V.near_vectors(df, id_col="id", vector_col="v", label_col="kind").collect()
    assert sorted(map(tuple, found)) == [(1, 1, 1, True), (2, 1, 1, False), (3, 0, 3, True)]


def test_recall_at_the_threshold(spark):
    """Pairs at a cosine of 0.9805 are found as often as promised; none below 0.98 is linked."""
    rng = np.random.default_rng(3)
    rows = []
    for i in range(3000):
        a = rng.standard_normal(32)
        a /= np.linalg.norm(a)
        b = rng.standard_normal(32)
        b -= (b @ a) * a
        b /= np.linalg.norm(b)
        cos = 0.9805 if i % 3 else 0.9795
        c = cos * a + math.sqrt(1 - cos * cos) * b
        rows += [(2 * i, a.tolist(), 0, ""), (2 * i + 1, c.tolist(), 0, "")]
    links = {r[0]: r[1] for r in got(spark, rows)}
    found = sum(links[2 * i] for i in range(3000) if i % 3)
    assert found >= 0.985 * 2000
    assert not any(links[2 * i] for i in range(0, 3000, 3))


def test_calibration():
    for rows in (1, 5_000, 10 ** 6, 10 ** 10):
        w = V.calibrated(rows, 0.98, 0.995)
        assert V.passes(w.k, V.hit(w.width, 0.2)) >= 0.995
        assert rows * V.hit(w.width, math.sqrt(2)) ** w.k <= 1 or w.k == 24
