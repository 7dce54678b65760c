"""Registered streaming queries: the events table replayed as a stream.

Each runs to the end of what is available and returns the rows written. In append mode
a window appears once the watermark has passed its end; rows in the far future at the
end of the stream let all windows of the events close.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.geometry import LINE, POINT, POLYGON
from ..functions.windows import WindowSpec, watermark, with_window
from ..operators import apps, cells, joins, ranges
from ..operators import trajectory as T
from ..session import work_dir
from ..streaming import run, state
from . import cell_queries, join_queries, knn_queries, range_queries, sql
from . import fixtures as fx
from . import trajectory_queries as tq
from .registry import ORACLES, register, win_start

TUMBLING, SLIDING = WindowSpec(*fx.TUMBLING), WindowSpec(*fx.SLIDING)


def points(spark, sf_dir, lateness=0):
    return watermark(fx.points_from(fx.events_stream(spark, sf_dir)), lateness)


def closing(spark, sf_dir):
    """Points of a stream all of whose windows close."""
    return watermark(fx.points_from(fx.closing_stream(spark, sf_dir)), 0)


def _windowed_range(s, d):
    """Hits per sliding window and type."""
    hits = ranges.range_query(closing(s, d), fx.QUERY_POINTS, range_queries.R, window=SLIDING)
    out = hits.groupBy("window", "event_type").agg(F.count(F.lit(1)).alias("n"))
    return run.run_to_table(out, "range").select(win_start().alias("win_start"), "event_type", "n")


_hits = range_queries.within_sql(POINT, POINT, fx.QUERY_POINTS, range_queries.R, windowed=True)
register("str1_str3_range_sliding", _windowed_range, f"SELECT win_start, event_type, count(*) AS n FROM ({_hits}) JOIN "
    "(SELECT event_id, event_type FROM events) USING (event_id) GROUP BY ALL")


def _range_rows(s, d):
    out = ranges.range_query(points(s, d), fx.QUERY_POLYGONS, range_queries.R)
    return run.run_to_table(out, "range-rows").select(*range_queries._columns(POINT))


register("str_rng3_point_polygon", _range_rows,
         range_queries.within_sql(POINT, "polygon", fx.QUERY_POLYGONS, range_queries.R))


def _geofence(s, d):
    out = apps.geofence_windows(closing(s, d), cell_queries.FENCE)
    return run.run_to_table(out, "geofence").select(win_start().alias("win_start"), "n", "value")


register("str4_app6_geofence", _geofence,
         f"{cell_queries._OUT} SELECT ts_ms // 1000 AS win_start, count(*) AS n, 'TRUE' AS value FROM o GROUP BY ts_ms // 1000")


def _window_stats(s, d):
    celled = cells.has_cell(fx.GRID20.with_cell(closing(s, d)))
    spans = cells.spans(with_window(celled, TUMBLING), ["window"])
    rows = run.run_to_table(spans, "cell-windows", per_batch=lambda b: cells.roll_up(b, "SUM", ["window"]))
    return rows.select(win_start().alias("win_start"), "cx", "cy", "n_obj", "traj_ms")


register("str2_trj10_cell_window_sum", _window_stats, f"{sql.base()}, {tq._CELLED} SELECT * RENAME (ws AS win_start) FROM ("
    + tq.roll_up_sql(tq.spans_sql("c", ("ws",)), ("ws",), "SUM", False) + ")")


def _join(s, d):
    a, b = (points(s, d).filter(F.col("event_type") == t) for t in ("click", "error"))
    out = joins.distance_join(a, b, join_queries.R, window=TUMBLING)
    return run.run_to_table(join_queries._result(out, (POINT, POINT)), "join")


register("str11_jon1_point_point", _join, join_queries.join_sql((POINT, POINT), join_queries.R))


def _join_polygons(s, d):
    a = points(s, d).filter(F.col("event_type") == "click")
    out = joins.distance_join(a, fx.polys_from(points(s, d)), join_queries.R, kinds=(POINT, "polygon"),
                              window=TUMBLING, max_extent=8.0)
    return run.run_to_table(join_queries._result(out, (POINT, "polygon")), "join-polygons")


register("str11_jon3_point_polygon", _join_polygons, join_queries.join_sql((POINT, "polygon"), join_queries.R))


def _sized_join(kind, table, carried):
    """Polygons with polygons, or lines with lines: both sides hold every level and two salts."""
    def fn(s, d):
        rows = table(points(s, d)).select("obj_id", "ts", *carried)
        out = joins.distance_join(rows, rows, join_queries.R, kinds=(kind, kind), window=TUMBLING, max_extent=1.0,
                                  levels=(0, 1, 2), salts=(2, 2))
        return run.run_to_table(join_queries._result(out, (kind, kind)), f"join-{kind}")
    return fn


_BOXED = ("xmin", "ymin", "xmax", "ymax", "edges", "anchors")
register("str11_jon8_polygon_polygon", _sized_join(POLYGON, fx.polys_from, _BOXED), join_queries.join_sql((POLYGON, POLYGON), join_queries.R))
register("str11_jon12_line_line", _sized_join(LINE, fx.lines_from, _BOXED), join_queries.join_sql((LINE, LINE), join_queries.R))


def _knn(s, d):
    return knn_queries.result(run.nearest(closing(s, d), fx.QUERY_POINTS[0], knn_queries.R, knn_queries.K, TUMBLING))


register("str7_knn1_point_point", _knn,
         knn_queries.knn_sql(POINT, fx.QUERY_POINTS[0], knn_queries.R))


def _update(s, d):
    """Spans per cell and object in update mode, final state rolled up."""
    rows = run.run_to_table(run.cell_spans(points(s, d), fx.GRID20), "cell-spans", mode="update")
    return cells.roll_up(run.latest(rows, ["cx", "cy", "obj_id"]), "MAX", keep_idle=True)


register("str8_trj8_cell_update", _update,
         f"{sql.base()}, {tq._CELLED} " + tq.roll_up_sql(tq.spans_sql("c"), (), "MAX", True))


def _occupancy(s, d):
    events = fx.checkins_from(fx.events_stream(s, d))
    rows = run.run_to_table(run.occupancy(events, fx.ROOM_CAPACITY), "occupancy", mode="update")
    return run.latest(rows, ["room"]).select("room", "count", F.col("capacity").cast("long").alias("capacity"))


register("str8_app2_occupancy", _occupancy,
         f"{cell_queries.CHECKINS} SELECT split_part(device_id, '-', 1) AS room, CAST(sum(CASE WHEN device_id LIKE '%-in' THEN 1 ELSE -1 END) AS BIGINT) AS \"count\", "
         f"CAST(max(CASE split_part(device_id, '-', 1) {cell_queries._capacity} END) AS BIGINT) AS capacity FROM ci GROUP BY 1")

register("str9_trj6_running_stats",
         lambda s, d: run.run_to_table(state.running_stats(points(s, d)), "stats").selectExpr(
             "obj_id", "unix_micros(ts) AS ts_us", *tq._stat), ORACLES["trj6_running_stats"])
register("str9_trj20_speed",
         lambda s, d: run.run_to_table(state.speed(points(s, d)), "speed").selectExpr(
             "event_id", "obj_id", "unix_micros(ts) AS ts_us", "round(speed, 6) AS speed"),
         ORACLES["trj20_speed"])


def _count_windows(s, d):
    spans = state.count_window_spans(points(s, d), fx.GRID20, 10, 5)
    rows = run.run_to_table(spans, "count-windows", per_batch=lambda b: cells.roll_up(b, "AVG", ["last_n"]))
    return rows.drop("batch")


register("str6_trj11_count_window_avg", _count_windows, ORACLES["trj11_cell_count_window_avg"])


def _checkins(s, d):
    events = fx.checkins_from(fx.events_stream(s, d))
    return run.run_to_table(state.fill_checkins(events), "checkins").select(
        "event_id", "device_id", "user_id", F.unix_millis("ts").alias("ts_ms"), "synthetic")


register("str9_app1_fill_checkins", _checkins, ORACLES["app1_fill_checkins"])


def _lines(s, d):
    """Sub-trajectories of closed windows: window rows are collected per micro-batch."""
    rows = with_window(T.filter_ids(closing(s, d), fx.TRAJECTORY_IDS), TUMBLING)
    vertex = F.struct("ts", "x", "y")
    out = rows.groupBy("window", "obj_id").agg(
        F.count(F.lit(1)).alias("n_points"), F.min(vertex).alias("_f"), F.max(vertex).alias("_l"))
    table = run.run_to_table(out, "line-ends")
    return table.selectExpr("unix_seconds(window.start) AS win_start", "obj_id", "n_points",
                            *[f"round({s_}.{v}, 6) AS {n}_{v}" for s_, n in (("_f", "first"), ("_l", "last")) for v in "xy"])


register("str2_trj2_line_ends", _lines, ORACLES["trj2_filter_lines"])


def _observed(s, d):
    hits = ranges.range_query(points(s, d), fx.QUERY_POINTS, range_queries.R)
    out = run.observed(ranges.with_latency(hits, F.lit(range_queries.AS_OF).cast("timestamp")), "hits",
                       worst=F.max("latency_ms"))
    return run.run_to_table(out, "observed").select("event_id", "latency_ms")


def _meter(s, d):
    """The meter itself: rows and worst latency over all micro-batches."""
    hits = ranges.range_query(points(s, d), fx.QUERY_POINTS, range_queries.R)
    out = run.observed(ranges.with_latency(hits, F.lit(range_queries.AS_OF).cast("timestamp")), "meter",
                       worst=F.max("latency_ms"))
    query = run.start_to_table(out, work_dir(s, "meter"))
    query.awaitTermination()
    seen = run.observations(query, "meter")
    worst = [x["worst"] for x in seen if x["worst"] is not None]
    return s.createDataFrame([(sum(x["rows"] for x in seen), max(worst, default=None))], "n long, worst_ms long")


register("str12_meter", _meter,
         range_queries.pair_distances(POINT, POINT, fx.QUERY_POINTS)
         + f" SELECT count(*) AS n, max(epoch_us(TIMESTAMP '{range_queries.AS_OF}') // 1000 - ts_ms) AS worst_ms FROM pts "
         f"WHERE event_id IN (SELECT k FROM dists WHERE dist <= {sql.d(range_queries.R)})")

register("str12_observed_latency", _observed,
         range_queries.pair_distances(POINT, POINT, fx.QUERY_POINTS)
         + f" SELECT event_id, epoch_us(TIMESTAMP '{range_queries.AS_OF}') // 1000 - ts_ms AS latency_ms FROM pts "
         f"WHERE event_id IN (SELECT k FROM dists WHERE dist <= {sql.d(range_queries.R)})")


# -- windowed trajectory operators, run as their windows close ------------------------------
def _closing(operator, result):
    def fn(spark, sf_dir):
        stream = fx.points_from(fx.closing_stream(spark, sf_dir))
        return result(run.run_closed_windows(stream, operator, TUMBLING, "closing"))
    return fn


def _touching(rows):
    return T.touching_lines(rows, fx.QUERY_POLYGONS, TUMBLING)


def _knn_lines(rows):
    return T.trajectory_knn_lines(rows, tq.Q, tq.R, tq.K, TUMBLING)


def _by_type(rows):
    return [rows.filter(F.col("event_type") == t) for t in ("click", "error")]


register("str_trj4_touching_lines", _closing(_touching, lambda out: tq._summary(out, "obj_id")),
         ORACLES["trj4_touching_lines"])
register("str_trj17_trajectory_knn_lines",
         _closing(_knn_lines, lambda out: tq._summary(out, "obj_id", "bigint(rank) AS rank", "round(dist, 6) AS dist")),
         ORACLES["trj17_trajectory_knn_lines"])
register("str_trj7_window_stats",
         _closing(lambda rows: T.window_stats(rows, TUMBLING),
                  lambda out: out.selectExpr("unix_seconds(window.start) AS win_start", "obj_id", *tq._stat)),
         ORACLES["trj7_window_stats"])
register("str_trj12_trajectory_join",
         _closing(lambda rows: T.trajectory_pairs(*_by_type(rows), tq.D, window=TUMBLING), tq._pairs),
         ORACLES["trj12_trajectory_join"])
register("str_trj13_trajectory_join_lines",
         _closing(lambda rows: T.trajectory_join_lines(*_by_type(rows), tq.D, TUMBLING),
                  lambda out: tq._summary(out, "a_obj_id", "b_obj_id", "side")),
         ORACLES["trj13_trajectory_join_lines"])
register("str_app3_stay_time",
         _closing(lambda rows: apps.stay_time(rows, fx.GRID20, TUMBLING),
                  lambda out: out.select(win_start().alias("win_start"), "cx", "cy", F.round("stay_ms", 5).alias("stay_ms"))),
         ORACLES["app3_stay_time"])
register("str_app5_normalized_stay_time",
         _closing(lambda rows: apps.normalized_stay_time(rows, fx.polys_from(rows), fx.GRID20, TUMBLING, cell_queries.SECONDS),
                  lambda out: out.select(win_start().alias("win_start"), "cx", "cy", F.round("normalized", 3).alias("normalized"))),
         ORACLES["app5_normalized_stay_time"])


# -- eviction and early results ---------------------------------------------------------------
def _stays(s, d):
    """Stays that were evicted, and those still open when the stream ends."""
    rows = run.run_to_table(state.cell_stays(points(s, d), fx.GRID20, tq.IDLE_MS), "stays", mode="update")
    keys = ["cx", "cy", "obj_id"]
    values = F.struct("traj_ms", "n_points", "last_ts", "ended")
    live = rows.groupBy(*keys).agg(F.max_by(values, F.struct("batch", "last_ts")).alias("v")).select(*keys, "v.*")
    ended = rows.filter("ended").select(*keys, "traj_ms", "n_points", "last_ts", "ended")
    return tq.stay_columns(ended.unionByName(live.filter("not ended")))


register("str9_trj9_evicted_stays", _stays, tq.STAYS_SQL)


def _early_knn(s, d):
    out = state.nearest_so_far(points(s, d), tq.Q, tq.R, tq.K, TUMBLING)
    rows = state.nearest_now(run.run_to_table(out, "early-knn", mode="update"), tq.K)
    return rows.select((F.col("start_us") / 1_000_000).cast("long").alias("win_start"), "obj_id", F.col("rank").cast("long").alias("rank"),
                       F.unix_micros("ts").alias("ts_us"), *[F.round(c, 6).alias(c) for c in ("x", "y", "dist")])


register("str8_trj16_early_knn", _early_knn, ORACLES["trj16_trajectory_knn"])


def _early_pairs(s, d):
    kinds = F.when(F.col("event_type") == "click", "a").when(F.col("event_type") == "error", "b")
    stream = fx.points_from(fx.events_stream(s, d)).withColumn("side", kinds).filter("side IS NOT NULL")
    path = work_dir(s, "early-pairs")
    run.start_early_pairs(stream, tq.D, TUMBLING, path, available_now=True).awaitTermination()
    return tq._pairs(run.latest(s.read.parquet(f"{path}/rows"), ["window", "a_obj_id", "b_obj_id"]))


register("str8_trj12_early_pairs", _early_pairs, ORACLES["trj12_trajectory_join"])


def _sliding_cells(s, d):
    """Sliding windows out of panes, as two aggregations of the stream."""
    spans = cells.window_spans(closing(s, d), fx.GRID20, SLIDING)
    return tq._window_cells(run.run_to_table(spans, "cell-panes", per_batch=lambda b: cells.roll_up(b, "MAX", ["window"])).drop("batch"))


register("str3_trj10_cell_window_sliding", _sliding_cells, ORACLES["trj10_cell_window_sliding_max"])


def _restamped(s, d):
    """Arrival time in place of event time: all rows of a micro-batch arrive at once, so a window of
    arrival times holds whole micro-batches, and in all windows together each row is once."""
    rows = watermark(cells.restamp(fx.points_from(fx.events_stream(s, d))), 0)
    out = with_window(rows, WindowSpec("1 second")).groupBy("window", "event_type").agg(F.count(F.lit(1)).alias("n"))
    table = run.latest(run.run_to_table(out, "restamped", mode="update"), ["window", "event_type"])
    return table.groupBy("event_type").agg(F.sum("n").alias("n"))


register("str5_restamped_windows", _restamped, "SELECT event_type, CAST(count(*) AS BIGINT) AS n FROM events GROUP BY 1")


def _late(s, d):
    """How many rows came too late, and how many windows closed without them: the first slice of
    the events is sent again at the end, a day behind the watermark at least."""
    stream = watermark(fx.points_from(fx.late_stream(s, d)), 0)
    counts = with_window(stream, TUMBLING).groupBy("window").count()
    query = run.start_to_table(counts, path := work_dir(s, "late"))
    query.awaitTermination()
    dropped = sum(op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in p["stateOperators"])
    total = s.read.parquet(f"{path}/rows").agg(F.sum("count")).first()[0]
    return s.createDataFrame([(dropped > 0, total)], "dropped boolean, n long")


register("str10_late_rows", _late, "SELECT true AS dropped, count(*) AS n FROM events")
