"""Ordered computations give the same rows whether keys are cut into slices or not."""

import random

import pytest
from pyspark.sql import functions as F

from wayfield.functions import ordered
from wayfield.functions.grid import Grid
from wayfield.functions.windows import WindowSpec
from wayfield.operators import apps, cells
from wayfield.operators import trajectory as T


@pytest.fixture(scope="module")
def moves(spark):
    """One object holds most rows; timestamps repeat."""
    rng = random.Random(5)
    rows = [(i, "hot" if rng.random() < 0.7 else f"o{rng.randint(0, 5)}", rng.randint(0, 4000),
             rng.uniform(0, 100), rng.uniform(0, 100)) for i in range(600)]
    df = spark.createDataFrame(rows, "event_id long, obj_id string, s long, x double, y double")
    return df.withColumn("ts", F.timestamp_seconds("s")).drop("s").cache()


def same(rows_of, make, digits=6):
    def rounded(df):
        return sorted(tuple(round(v, digits) if isinstance(v, float) else v for v in r) for r in df.collect())
    cut, plain = make(20), make(10 ** 6)
    a, b = rounded(cut), rounded(plain)
    assert a == b and len(a) > 0


def test_slices_exist(moves):
    sliced = ordered.with_slices(moves, ["obj_id"], hot_rows=20)
    per = {r.obj_id: r.n for r in sliced.groupBy("obj_id").agg(
        F.countDistinct("_slice").alias("n")).collect()}
    assert per["hot"] > 20
    assert ordered.with_slices(moves, ["obj_id"], hot_rows=10 ** 6).filter("_slice <> 0").count() == 0


def test_previous(moves, rows_of):
    same(rows_of, lambda n: ordered.previous(moves, ["obj_id"], ["event_id"], tie=["event_id"], hot_rows=n)
         .select("event_id", "prev.event_id"))


def test_running(moves, rows_of):
    same(rows_of, lambda n: ordered.running(moves, ["obj_id"], {
        "s": ("sum", F.col("x")), "lo": ("min", F.col("x")), "hi": ("max", F.col("y"))},
        tie=["event_id"], hot_rows=n).select("event_id", "s", "lo", "hi"))


def test_null_keys_stay(spark):
    df = spark.range(50).selectExpr("string(null) AS obj_id", "timestamp_seconds(id) AS ts", "id")
    out = ordered.previous(df, ["obj_id"], ["id"], hot_rows=5)
    assert out.filter("prev.id = id - 1").count() == 49


@pytest.mark.parametrize("make", [
    lambda m, n: T.running_stats(m, hot_rows=n),
    lambda m, n: T.window_stats(m, WindowSpec("20 minutes"), hot_rows=n),
    lambda m, n: T.speed(m, tie=["event_id"], hot_rows=n),
    lambda m, n: apps.track_segments(m, 40.0, tie=["event_id"], hot_rows=n),
    lambda m, n: apps.stay_time(m, Grid.by_count(0, 0, 100, 100, 5), WindowSpec("1 hour"), tie=["event_id"], hot_rows=n),
    lambda m, n: cells.running_spans(m, Grid.by_count(0, 0, 100, 100, 2), tie=["event_id"], hot_rows=n),
    lambda m, n: cells.aggregate_counts(m, Grid.by_count(0, 0, 100, 100, 2), "SUM", 10, 5, tie=["event_id"], hot_rows=n),
    lambda m, n: T.line_summary(T.lines(m, WindowSpec("1 hour"), hot_rows=n)),
    lambda m, n: T.line_summary(T.trajectory_join_lines(m, m, 2.0, WindowSpec("1 hour"), exclude_same_id=True, hot_rows=n)),
], ids=["running_stats", "window_stats", "speed", "tracks", "stay_time", "running_spans", "count_windows", "lines", "join_lines"])
def test_operators_with_hot_keys(moves, rows_of, make):
    same(rows_of, lambda n: make(moves, n), digits=4)


def test_checkins_with_hot_users(moves, rows_of):
    events = moves.selectExpr("string(event_id) AS event_id", "obj_id AS user_id", "ts", "x", "y",
                              "concat('room', event_id % 2, IF(x > 50, '-in', '-out')) AS device_id")
    same(rows_of, lambda n: apps.fill_checkins(events, hot_rows=n))
    same(rows_of, lambda n: apps.room_occupancy(events, {"room0": 5}, hot_rows=n).select("event_id", "room", "count", "capacity"))


def test_split_lines_keep_every_vertex(moves):
    parts = T.lines(moves, hot_rows=20)
    assert parts.filter("obj_id = 'hot'").count() > 5
    assert parts.agg(F.sum("n_points")).first()[0] == moves.count()
    hot = [p for r in parts.filter("obj_id = 'hot'").orderBy("part").collect() for p in r.path]
    assert [p.ts for p in hot] == sorted(p.ts for p in hot)


@pytest.fixture(scope="module")
def odd_moves(spark):
    """All rows of the hot object at one instant, but for one far in the past and one far ahead."""
    rng = random.Random(6)
    rows = [(i, "hot", 1000, rng.uniform(0, 100), rng.uniform(0, 100)) for i in range(300)]
    rows += [(900, "hot", -10 ** 9, 1.0, 1.0), (901, "hot", 4 * 10 ** 9, 2.0, 2.0)]
    rows += [(1000 + i, "cold", 60 * i, rng.uniform(0, 100), rng.uniform(0, 100)) for i in range(9)]
    df = spark.createDataFrame(rows, "event_id long, obj_id string, s long, x double, y double")
    return df.withColumn("ts", F.timestamp_seconds("s")).drop("s").cache()


def test_one_instant_is_split(odd_moves):
    sizes = [r["count"] for r in ordered.with_slices(odd_moves, ["obj_id"], hot_rows=20, tie=["event_id"])
             .filter("_slice > 0").groupBy("_slice").count().collect()]
    assert sum(sizes) == 302 and max(sizes) <= 20
    plain = ordered.with_slices(odd_moves, ["obj_id"], hot_rows=20)
    assert plain.filter("_slice > 0").groupBy("_slice").count().agg(F.max("count")).first()[0] <= 20


@pytest.mark.parametrize("make", [
    lambda m, n: T.running_stats(m, hot_rows=n),
    lambda m, n: T.speed(m, tie=["event_id"], hot_rows=n),
    lambda m, n: ordered.running(m, ["obj_id"], {"n": ("sum", F.lit(1))}, tie=["event_id"], hot_rows=n).select("event_id", "n"),
    lambda m, n: T.line_summary(T.lines(m, tie=["event_id"], hot_rows=n)),
    lambda m, n: cells.aggregate_counts(m, Grid.by_count(0, 0, 100, 100, 2), "MAX", 10, 5, tie=["event_id"], hot_rows=n),
], ids=["running_stats", "speed", "numbers", "lines", "count_windows"])
def test_one_instant_and_outliers(odd_moves, rows_of, make):
    same(rows_of, lambda n: make(odd_moves, n), digits=4)


def test_hot_keys_by_join(moves, rows_of, monkeypatch):
    """More hot keys than are broadcast."""
    monkeypatch.setattr(ordered, "MAX_HOT_KEYS", 2)
    same(rows_of, lambda n: ordered.previous(moves, ["obj_id"], ["event_id"], tie=["event_id"], hot_rows=n)
         .select("event_id", "prev.event_id"))


def test_rows_carry_no_cuts(moves):
    """A row of a hot key takes a slice number along, nothing that grows with the key."""
    sliced = ordered.with_slices(moves, ["obj_id"], hot_rows=20)
    assert sliced.columns == [*moves.columns, "_slice"]
    assert ordered.with_slices(moves, ["obj_id"], hot_rows=550).columns == sliced.columns  # many rows, no hot key
