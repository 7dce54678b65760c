"""Existence join of trajectories against all pairs of points, and count windows in lots."""

import math
import random

import pytest
from pyspark.sql import functions as F

from wayfield.functions.windows import WindowSpec
from wayfield.operators import trajectory as T
from wayfield.streaming import state

WINDOW = WindowSpec("10 minutes", "5 minutes")


@pytest.fixture(scope="module")
def moves(spark):
    """Clusters (boxes that prove a pair), lone points, points on cell edges, equal rows."""
    rng = random.Random(21)
    out = []
    for i in range(240):
        cx, cy = rng.choice([(5, 5), (5.5, 5.2), (30, 40), (80, 10)])
        x, y = (rng.uniform(0, 100), rng.uniform(0, 100)) if i % 5 == 0 else (cx + rng.gauss(0, 1), cy + rng.gauss(0, 1))
        if i % 11 == 0:
            x, y = float(3 * (i % 7)), 6.0
        out.append((i, f"o{rng.randint(0, 12)}", 10 * i, x, y))
    out += [(500 + i, "same", 300, 9.0, 9.0) for i in range(3)] + [(600, "near", 300, 9.0, 12.0)]
    df = spark.createDataFrame(out, "event_id long, obj_id string, s long, x double, y double")
    return df.withColumn("ts", F.timestamp_seconds("s")).drop("s").cache()


def brute(a, b, d, exclude):
    def placed(df):
        return [(w, r.obj_id, r.x, r.y) for r in df.selectExpr("obj_id", "x", "y", "unix_seconds(ts) AS s").collect()
                for w in (r.s // 300 * 300, r.s // 300 * 300 - 300)]
    right = placed(b)
    return sorted({(w, p, q) for w, p, x, y in placed(a) for v, q, x2, y2 in right
                   if w == v and math.hypot(x - x2, y - y2) <= d and not (exclude and p == q)})


def got(pairs):
    rows = [tuple(r) for r in pairs.select(F.unix_seconds("window.start"), "a_obj_id", "b_obj_id").collect()]
    assert len(rows) == len(set(rows))
    return sorted(rows)


@pytest.mark.parametrize("d", [0.0, 3.0, 12.5])
@pytest.mark.parametrize("exclude", [True, False])
def test_self_join(moves, d, exclude):
    assert got(T.near_ids(moves, moves, d, WINDOW, exclude_same_id=exclude)) == brute(moves, moves, d, exclude)


def test_two_sides(moves):
    a, b = moves.filter("event_id % 2 = 0"), moves.filter("event_id % 2 = 1")
    assert got(T.near_ids(a, b, 3.0, WINDOW, exclude_same_id=True)) == brute(a, b, 3.0, True)
    assert got(T.near_ids(a, b.limit(0), 3.0, WINDOW)) == []


def test_proven_pairs_compare_no_points(spark):
    """Objects that share a cell for long: one box each, no point pair."""
    rows = [(f"o{i % 4}", 1.0 + 0.1 * (i % 3), 1.0) for i in range(400)]
    df = spark.createDataFrame(rows, "obj_id string, x double, y double").withColumn("ts", F.timestamp_seconds(F.lit(10)))
    pairs = T.near_ids(df, df, 5.0, WindowSpec("1 minute"), exclude_same_id=True)
    assert pairs.count() == 12
    plan = pairs._jdf.queryExecution().optimizedPlan().toString()
    assert "_proven" in plan


@pytest.mark.parametrize("size,slide", [(5, 2), (3, 4)])
def test_count_windows_in_lots(monkeypatch, size, slide):
    """The same windows, however many are looked at together."""
    import pandas as pd

    class State:
        exists, get = False, None

        def update(self, value):
            self.exists, self.get = True, value

    def run(places):
        monkeypatch.setattr(state, "PLACES", places)
        fn, kept, out = state._count_windows(size, slide), State(), []
        for part in range(3):
            frame = pd.DataFrame({"us": [1000 * (40 * part + i) for i in range(40)], "event_id": range(40),
                                  "obj_id": [f"o{i % 3}" for i in range(40)]})
            out += list(fn((1, 2), iter([frame[20:], frame[:20]]), kept))
        return pd.concat(out, ignore_index=True), len(out)

    (many, n_many), (one, n_one) = run(size), run(1 << 20)
    assert many.equals(one) and n_many > n_one
