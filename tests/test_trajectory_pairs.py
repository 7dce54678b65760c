"""Pairs of trajectories against all pairs of points: objects of few points, of many, and both."""

import math
import random

import pytest
from pyspark.sql import functions as F

from wayfield.functions.windows import WindowSpec
from wayfield.operators import trajectory as T

WINDOW = WindowSpec("10 minutes")


@pytest.fixture(scope="module")
def moves(spark):
    """Ids of 1 to about 30 points, equal rows, points of one object at one time, odd places and ids."""
    rng = random.Random(5)
    out = [(f"o{min(rng.randint(0, 40), rng.randint(0, 40))}", rng.randint(0, 60) * 20, rng.uniform(0, 12), rng.uniform(0, 12))
           for _ in range(220)]
    out += out[:20] + [("hot", 5 * (i // 2), 6 + 0.01 * i, 6.0) for i in range(60)]
    out += [("odd", 10, math.nan, 1.0), ("odd", 20, 5.0, None), ("odd", 30, 5.0, -0.0), ("odd", 30, 5.0, 0.0),
            (None, 40, 5.0, 0.5), (None, 50, 5.1, 0.5), ("late", None, 5.0, 5.0)]
    df = spark.createDataFrame(out, "obj_id string, s long, x double, y double")
    return df.withColumn("ts", F.timestamp_seconds("s")).drop("s").cache()


def points(df):
    return [(r.s, r.obj_id, r.x, r.y) for r in df.selectExpr("unix_seconds(ts) AS s", "obj_id", "x", "y").collect()
            if r.s is not None and r.x is not None and r.y is not None and not math.isnan(r.x + r.y)]


def brute(a, b, d, exclude):
    best = {}
    for s, p, x, y in points(a):
        for t, q, v, w in points(b):
            if s // 600 == t // 600 and not (exclude and (p == q or p is None or q is None)) and math.hypot(x - v, y - w) <= d:
                key = (s // 600 * 600, p or "", q or "")
                best[key] = max(best.get(key, ()), (t, s, v, w, x, y))
    return sorted((*k, *m) for k, m in best.items())


def got(pairs):
    rows = pairs.selectExpr("unix_seconds(window.start)", "coalesce(a_obj_id, '')", "coalesce(b_obj_id, '')", "unix_seconds(b_ts)",
                            "unix_seconds(a_ts)", "b_x", "b_y", "a_x", "a_y").collect()
    return sorted(tuple(r) for r in rows)


@pytest.mark.parametrize("few,exclude", [(2, True), (8, False)])
def test_any_share_of_large_objects(moves, few, exclude):
    got_rows = got(T.trajectory_pairs(moves, moves, 1.5, window=WINDOW, few=few, exclude_same_id=exclude))
    assert got_rows == brute(moves, moves, 1.5, exclude)


def test_leaves(moves):
    assert got(T.trajectory_pairs(moves, moves, 1.5, window=WINDOW, leaves=True)) == brute(moves, moves, 1.5, False)


def test_pairs_of_small_objects_are_not_shuffled(moves):
    small = moves.filter("obj_id <> 'hot'").limit(150)
    out = T.trajectory_pairs(small, small, 1.5, window=WINDOW, few=100, exclude_same_id=True)
    plan = out._jdf.queryExecution().executedPlan().toString()
    above = plan[:plan.index("Join")]
    assert "Exchange" not in above and "Aggregate" not in above
