"""Hand-made cases for the rules on windows, ties, duplicates and missing values."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from wayfield.functions import geometry as G
from wayfield.functions.grid import Grid
from wayfield.functions.windows import WindowSpec
from wayfield.operators import apps, cells, joins, knn, ranges
from wayfield.operators import trajectory as T

MINUTE = WindowSpec("60 seconds")
SLIDE = WindowSpec("60 seconds", "20 seconds")


def track(spark, *rows):
    """(obj_id, second, x, y)"""
    df = spark.createDataFrame([(i, o, s, float(x), float(y)) for i, (o, s, x, y) in enumerate(rows)],
                               "event_id long, obj_id string, s long, x double, y double")
    return df.withColumn("ts", F.timestamp_seconds("s")).drop("s")


def test_sliding_window_emits_once_per_window(spark):
    df = track(spark, ("a", 65, 0, 0))
    out = ranges.range_query(df, [G.point(0, 0), G.point(1, 0)], 5.0, window=SLIDE)
    assert sorted(r.s for r in out.select(F.unix_seconds("window.start").alias("s")).collect()) == [20, 40, 60]


def test_one_row_per_pair(spark):
    """A polygon and a line that share many cells are one pair."""
    from shapes import table
    a = table(spark, [("polygon", [[(0, 0), (50, 0), (50, 50), (0, 50), (0, 0)]])])
    b = table(spark, [("line", [[(-10, 10), (60, 30)]])])
    assert joins.distance_join(a, b, 1.0, kinds=("polygon", "line"), max_extent=0.0).count() == 1


def test_join_only_within_a_window(spark):
    a = track(spark, ("a", 10, 0, 0))
    b = track(spark, ("b", 59, 0, 1), ("c", 61, 0, 1))
    assert [r.b_obj_id for r in joins.distance_join(a, b, 2.0, window=MINUTE).collect()] == ["b"]


def test_knn_has_distinct_objects_and_ties_by_id(spark):
    df = track(spark, ("b", 1, 1, 0), ("b", 2, 2, 0), ("a", 3, 1, 0), ("c", 4, 3, 0), ("d", 5, 99, 0))
    out = knn.knn(df, G.point(0, 0), 10.0, 3, window=MINUTE).orderBy("rank").collect()
    assert [(r.obj_id, r.dist) for r in out] == [("a", 1.0), ("b", 1.0), ("c", 3.0)]
    assert knn.knn(df, G.point(0, 0), None, 9, window=MINUTE).count() == 4
    assert knn.knn(df, G.point(0, 0), None, 2).count() == 2


def test_radius_applies_to_trajectory_knn_lines(spark):
    df = track(spark, ("a", 1, 1, 0), ("a", 2, 9, 0), ("b", 3, 50, 0), ("b", 4, 51, 0), ("c", 5, 1, 1))
    out = T.trajectory_knn_lines(df, G.point(0, 0), 5.0, 3, MINUTE).collect()
    assert [(r.obj_id, r.n_points) for r in out] == [("a", 2)]  # c has a single point


def test_single_point_statistics(spark):
    row = T.window_stats(track(spark, ("a", 1, 1, 0)), MINUTE).first()
    assert (row.spatial_length, row.temporal_length, row.speed) == (0.0, 0, None)
    assert T.running_stats(track(spark, ("a", 1, 1, 0))).count() == 0


def test_equal_timestamps_do_not_move(spark):
    df = track(spark, ("a", 1, 0, 0), ("a", 1, 9, 9), ("a", 2, 3, 4))
    out = T.running_stats(df).collect()
    assert [(r.spatial_length, r.temporal_length) for r in out] == [(5.0, 1000)]
    assert T.speed(df, tie=["event_id"]).count() == 1


def test_filter_by_ids(spark):
    df = track(spark, ("a", 1, 0, 0), ("b", 1, 0, 0))
    assert T.filter_ids(df, ["a"]).count() == 1 and T.filter_ids(df, []).count() == 2
    ids = spark.createDataFrame([("b",), ("b",)], "obj_id string")
    assert [r.obj_id for r in T.filter_ids(df, ids).collect()] == ["b"]


def test_long_id_table_is_joined(spark, monkeypatch):
    monkeypatch.setattr(T, "MAX_LITERAL_IDS", 1)
    df = track(spark, ("a", 1, 0, 0), ("b", 1, 0, 0), ("c", 1, 0, 0))
    ids = spark.createDataFrame([("b",), ("c",), ("b",)], "obj_id string")
    assert sorted(r.obj_id for r in T.filter_ids(df, ids).collect()) == ["b", "c"]


def test_trajectory_join_keeps_the_latest_point(spark):
    a = track(spark, ("a", 1, 0, 0), ("a", 2, 0, 1))
    b = track(spark, ("b", 3, 0, 0), ("b", 5, 0, 1), ("b", 9, 40, 0))
    row = T.trajectory_pairs(a, b, 2.0, window=MINUTE).select(
        F.unix_seconds("a_ts"), F.unix_seconds("b_ts"), "dist").collect()
    assert [tuple(r) for r in row] == [(2, 5, 0.0)]


def test_self_join_compares_ids_by_value(spark):
    df = track(spark, ("a", 1, 0, 0), ("a", 2, 0, 0), ("b", 3, 0, 0))
    pairs = T.trajectory_pairs(df, df, 1.0, window=MINUTE, exclude_same_id=True)
    assert sorted((r.a_obj_id, r.b_obj_id) for r in pairs.collect()) == [("a", "b"), ("b", "a")]


def test_trajectory_join_lines_need_two_points(spark):
    a = track(spark, ("a", 1, 0, 0), ("a", 2, 0, 1), ("s", 1, 0, 0))
    b = track(spark, ("b", 3, 0, 0), ("b", 5, 0, 1))
    out = T.trajectory_join_lines(a, b, 2.0, MINUTE).collect()
    assert sorted((r.a_obj_id, r.b_obj_id, r.side, r.n_points) for r in out) == [("a", "b", "a", 2), ("a", "b", "b", 2)]


def test_touching_lines_are_whole(spark):
    df = track(spark, ("a", 1, 5, 5), ("a", 2, 90, 90), ("b", 3, 90, 90))
    out = T.touching_lines(df, G.rectangle(0, 0, 10, 10), MINUTE).collect()
    assert [(r.obj_id, r.n_points) for r in out] == [("a", 2)]


GRID = Grid.by_count(0, 0, 100, 100, 10)


def test_cell_functions(spark):
    df = track(spark, ("a", 0, 1, 1), ("a", 4, 2, 2), ("b", 1, 3, 3), ("b", 2, 3, 3), ("c", 9, 3, 3))
    def at(f): return [tuple(r) for r in cells.aggregate_windows(df, GRID, f, MINUTE).drop("window").collect()]  # noqa: E704
    assert sorted(at("ALL")) == [(0, 0, "a", 4000, 3), (0, 0, "b", 1000, 3), (0, 0, "c", 0, 3)]
    assert at("SUM") == [(0, 0, 3, 5000)] and at("AVG") == [(0, 0, 3, 1667)]
    assert at("MIN") == [(0, 0, 3, "b", 1000)] and at("MAX") == [(0, 0, 3, "a", 4000)]
    lone = track(spark, ("a", 0, 1, 1))
    for f in ("SUM", "AVG", "MIN", "MAX"):
        assert cells.aggregate_windows(lone, GRID, f, MINUTE).count() == 0
    assert cells.aggregate_now(lone, GRID, "MIN").count() == 1


def test_idle_objects_are_forgotten(spark):
    df = track(spark, ("a", 0, 1, 1), ("a", 5, 1, 1), ("b", 100, 1, 1))
    assert cells.aggregate_now(df, GRID, "ALL", idle_ms=50_000).count() == 1
    assert cells.aggregate_now(df, GRID, "ALL", idle_ms=95_000).count() == 2


def test_rows_outside_the_grid_are_kept(spark):
    df = track(spark, ("a", 0, -50, 500))
    assert ranges.range_query(df, G.point(-50, 499), 2.0).count() == 1
    assert cells.count_per_cell(df, GRID).count() == 1
    assert GRID.with_cell(df, clip=True).count() == 0


def test_checkin_gap(spark):
    rows = [("1", "room1-in", "u", 10), ("2", "room1-in", "u", 20), ("3", "room1-out", "u", 30), ("4", "room2-out", "u", 41)]
    df = spark.createDataFrame(rows, "event_id string, device_id string, user_id string, s long").selectExpr(
        "event_id", "device_id", "user_id", "timestamp_seconds(s) AS ts", "0D AS x", "0D AS y")
    out = apps.fill_checkins(df).orderBy("ts").select("event_id", "device_id", F.unix_seconds("ts"), "synthetic")
    assert [tuple(r) for r in out.collect()] == [
        ("1", "room1-in", 10, False), ("2", "room1-out", 15, True), ("2", "room1-in", 20, False),
        ("3", "room1-out", 30, False), ("4", "room2-out", 41, False)]
    counts = apps.room_occupancy(apps.fill_checkins(df), {"room1": 7}).filter("room = 'room1'").orderBy("ts")
    assert [(r["count"], r.capacity) for r in counts.collect()] == [(1, 7), (0, 7), (1, 7), (0, 7)]


def test_stay_time_is_shared_by_cells(spark):
    df = track(spark, ("a", 0, 1, 1), ("a", 6, 21, 1), ("a", 8, 22, 2))
    out = {(r.cx, r.cy): r.stay_ms for r in apps.stay_time(df, GRID, MINUTE).collect()}
    assert out == {(0, 0): 2000.0, (1, 0): 2000.0, (2, 0): 4000.0}


def test_geofence_report(spark):
    df = track(spark, ("a", 7, 5, 5), ("a", 9, 11, 5), ("b", 9, 12, 5), ("a", 8, 99, 5))
    out = apps.geofence_report(apps.geofence(df, G.rectangle(0, 0, 10, 10)))
    assert [r.value for r in out.collect()] == ["Second 8: TRUE", "Second 9: TRUE"]


def test_tiles_overshoot_by_whole_columns(spark):
    bounds = spark.createDataFrame([(0.0, 0.0, 200.0, 100.0)], "xmin double, ymin double, xmax double, ymax double")
    out = apps.tiles(bounds, 150)
    assert out.count() == 200 and out.select("ti").distinct().count() == 2
    assert out.agg(F.max("xmax")).first()[0] == pytest.approx(2.0)


def test_centroid_by_area(spark):
    from shapes import table
    df = table(spark, [("polygon", [[(0, 0), (2, 0), (2, 2), (0, 2), (0, 0)]]),
                       ("polygon", [[(10, 0), (10, 4), (14, 4), (14, 0), (10, 0)]])])
    row = apps.centroid(df).first()
    assert (row.area, row.cx, row.cy) == (20.0, pytest.approx((4 * 1 + 16 * 12) / 20), pytest.approx((4 + 32) / 20))


def test_track_restarts_after_a_jump(spark):
    df = track(spark, ("a", 1, 0, 0), ("a", 2, 1, 0), ("a", 3, 50, 0), ("a", 4, 51, 0))
    assert [r.track for r in apps.track_segments(df, 5.0).orderBy("ts").collect()] == [0, 0, 1, 1]


def test_restamp_and_latency(spark):
    now = F.lit(dt.datetime(2024, 1, 1)).cast("timestamp")
    df = track(spark, ("a", 1, 0, 0))
    assert cells.restamp(df).filter(F.col("ts") > "2020-01-01").count() == 1
    assert ranges.with_latency(cells.restamp(df, now), now).first().latency_ms == 0


def test_stay_json(spark):
    df = track(spark, ("a", 0, 1, 1), ("a", 6, 2, 1)).selectExpr("*")
    out = apps.stay_time(df, GRID, MINUTE).withColumn("normalized", F.lit(0.5))
    assert apps.stay_time_json(out).first().value == \
        '{"cellID":"0000000000","window":[0,60000],"normalizedStayTime":0.5}'
