"""Registered trajectory queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.geometry import POINT
from ..functions.windows import WindowSpec
from ..operators import cells
from ..operators import trajectory as T
from . import fixtures as fx
from . import sql
from .range_queries import _columns, _sql_columns, pair_distances
from .registry import r6, register, us, win_start

WINDOW = WindowSpec(*fx.TUMBLING)
D, R, K = 3.0, 30.0, 5
Q = fx.QUERY_POINTS[0]
IDS = "(" + ", ".join(f"'{i}'" for i in fx.TRAJECTORY_IDS) + ")"
PTS_W = f"(SELECT *, {sql.win()} AS ws FROM pts)"

# SQL: end points of a path from its time-ordered points
SUMMARY = ("count(*) AS n_points, round(arg_min(x, ts), 6) AS first_x, round(arg_min(y, ts), 6) AS first_y, "
           "round(arg_max(x, ts), 6) AS last_x, round(arg_max(y, ts), 6) AS last_y")
SUMMARY_COLUMNS = ["n_points", *[f"round({c}, 6) AS {c}" for c in ("first_x", "first_y", "last_x", "last_y")]]


def _summary(paths, *lead):
    return T.line_summary(paths).selectExpr("unix_seconds(window.start) AS win_start", *lead, *SUMMARY_COLUMNS)


def _pts(spark, sf_dir):
    return fx.pts(spark, sf_dir)


# -- filter --------------------------------------------------------------------
register("trj1_filter_ids", lambda s, d: T.filter_ids(_pts(s, d), fx.TRAJECTORY_IDS).select(*_columns(POINT)),
         f"{sql.base()} SELECT {_sql_columns(POINT)} FROM pts p WHERE obj_id IN {IDS}")
register("trj1_filter_none", lambda s, d: T.filter_ids(_pts(s, d), ()).select(*_columns(POINT)),
         f"{sql.base()} SELECT {_sql_columns(POINT)} FROM pts p")
register("trj2_filter_lines",
         lambda s, d: _summary(T.lines(T.filter_ids(_pts(s, d), fx.TRAJECTORY_IDS), WINDOW), "obj_id"),
         f"{sql.base()} SELECT ws AS win_start, obj_id, {SUMMARY} FROM {PTS_W} WHERE obj_id IN {IDS} GROUP BY ws, obj_id")
register("trj2_lines_all", lambda s, d: _summary(T.lines(_pts(s, d), WINDOW), "obj_id"),
         f"{sql.base()} SELECT ws AS win_start, obj_id, {SUMMARY} FROM {PTS_W} GROUP BY ws, obj_id")

# -- containment -----------------------------------------------------------------
_on = ("(e.x2 - e.x1) * (p.y - e.y1) - (e.y2 - e.y1) * (p.x - e.x1) = 0 AND p.x BETWEEN least(e.x1, e.x2) "
       "AND greatest(e.x1, e.x2) AND p.y BETWEEN least(e.y1, e.y2) AND greatest(e.y1, e.y2)")
CONTAINED = (f"{sql.base()}, {sql.query_edges(fx.QUERY_POLYGONS)}, hits AS (SELECT DISTINCT event_id FROM "
             f"(SELECT p.event_id, e.qid, sum({sql.crosses('p.x', 'p.y', 'e')}) % 2 = 1 AS inn, bool_or({_on}) AS edge "
             "FROM pts p, q_edges e GROUP BY ALL) WHERE inn AND NOT edge)")
for name, prefilter in (("trj3_contained", True), ("trj5_contained_naive", False)):
    register(name, lambda s, d, pre=prefilter: T.contained(
        _pts(s, d), fx.QUERY_POLYGONS, pre).select(*_columns(POINT)),
        f"{CONTAINED} SELECT {_sql_columns(POINT)} FROM pts p WHERE event_id IN (SELECT event_id FROM hits)")
register("trj4_touching_lines",
         lambda s, d: _summary(T.touching_lines(_pts(s, d), fx.QUERY_POLYGONS, WINDOW), "obj_id"),
         f"{CONTAINED}, w AS {PTS_W}, ids AS (SELECT DISTINCT ws, obj_id FROM w WHERE event_id IN (SELECT event_id FROM hits)) "
         f"SELECT ws AS win_start, obj_id, {SUMMARY} FROM w SEMI JOIN ids USING (ws, obj_id) GROUP BY ws, obj_id")

# -- statistics ------------------------------------------------------------------
_step = sql.dist("x", "y", "px", "py")


def _steps_sql(keys):
    lag = lambda c: f"lag({c}) OVER (PARTITION BY {keys} ORDER BY ts)"
    return (f"(SELECT *, {lag('x')} AS px, {lag('y')} AS py, {lag('ts_ms')} AS pms FROM {PTS_W})")


_stat = ["round(spatial_length, 6) AS spatial_length", "temporal_length", "round(speed, 9) AS speed"]
register("trj6_running_stats",
         lambda s, d: T.running_stats(_pts(s, d)).selectExpr("obj_id", "unix_micros(ts) AS ts_us", *_stat),
         f"{sql.base()}, r AS (SELECT obj_id, ts_us, pms, sum({_step}) OVER w AS len, CAST(sum(ts_ms - pms) OVER w AS BIGINT) AS ms "
         f"FROM {_steps_sql('obj_id')} WINDOW w AS (PARTITION BY obj_id ORDER BY ts ROWS UNBOUNDED PRECEDING)) "
         "SELECT obj_id, ts_us, round(len, 6) AS spatial_length, ms AS temporal_length, round(len / ms, 9) AS speed FROM r WHERE pms IS NOT NULL")
register("trj7_window_stats",
         lambda s, d: T.window_stats(_pts(s, d), WINDOW).selectExpr(
             "unix_seconds(window.start) AS win_start", "obj_id", *_stat),
         f"{sql.base()}, r AS (SELECT ws, obj_id, coalesce(sum({_step}), 0) AS len, CAST(coalesce(sum(ts_ms - pms), 0) AS BIGINT) AS ms "
         f"FROM {_steps_sql('ws, obj_id')} GROUP BY ws, obj_id) SELECT ws AS win_start, obj_id, round(len, 6) AS spatial_length, "
         "ms AS temporal_length, CASE WHEN ms > 0 THEN round(len / ms, 9) END AS speed FROM r")
register("trj20_speed",
         lambda s, d: T.speed(_pts(s, d), tie=("event_id",)).selectExpr(
             "event_id", "obj_id", "unix_micros(ts) AS ts_us", "round(speed, 6) AS speed"),
         f"{sql.base()} SELECT event_id, obj_id, ts_us, round({_step} / (CAST(ts_ms - pms AS DOUBLE) / 1000), 6) AS speed "
         f"FROM {_steps_sql('obj_id')} WHERE ts_ms > pms")

# -- per-cell aggregates -----------------------------------------------------------
_CELLED = (f"c AS (SELECT *, {sql.cell(fx.GRID20, 'x', 'x')} AS cx, {sql.cell(fx.GRID20, 'y', 'y')} AS cy FROM {PTS_W})")


def roll_up_sql(spans, keys, function, keep_idle):
    """``spans``: SQL of (keys, cx, cy, obj_id, traj_ms, n_points)."""
    by = ", ".join([*keys, "cx", "cy"])
    if function == "ALL":
        return f"SELECT {by}, obj_id, traj_ms, count(*) OVER (PARTITION BY {by}) AS n_obj FROM ({spans})"
    if function in ("SUM", "AVG"):
        value = "sum(traj_ms)" if function == "SUM" else "floor(sum(traj_ms) / count(*) + 0.5)"
        having = "" if keep_idle else " HAVING sum(traj_ms) > 0"
        return f"SELECT {by}, count(*) AS n_obj, CAST({value} AS BIGINT) AS traj_ms FROM ({spans}) GROUP BY {by}{having}"
    order = "traj_ms" if function == "MIN" else "traj_ms DESC"
    keep = "" if keep_idle else "WHERE n_points >= 2"
    return (f"SELECT {by}, n_obj, obj_id, traj_ms FROM (SELECT *, row_number() OVER (PARTITION BY {by} ORDER BY {order}, obj_id) AS rn "
            f"FROM (SELECT *, count(*) OVER (PARTITION BY {by}) AS n_obj FROM ({spans})) {keep}) WHERE rn = 1")


def spans_sql(source, keys=(), having=""):
    by = ", ".join([*keys, "cx", "cy", "obj_id"])
    return (f"SELECT {by}, CAST(max(ts_ms) - min(ts_ms) AS BIGINT) AS traj_ms, count(*) AS n_points "
            f"FROM {source} GROUP BY {by}{having}")


IDLE_MS = 10 * 24 * 3600 * 1000
_numbered = "(SELECT *, row_number() OVER (PARTITION BY cx, cy ORDER BY ts, event_id) AS n FROM c)"
_ended = (f"(SELECT c.*, e.last_n FROM {_numbered} c JOIN (SELECT DISTINCT cx, cy, n AS last_n FROM {_numbered} WHERE n % 5 = 0) e "
          "ON c.cx = e.cx AND c.cy = e.cy AND c.n <= e.last_n AND c.n > e.last_n - 10)")


def _window_cells(df):
    return df.withColumn("win_start", win_start()).drop("window") if "window" in df.columns else df


for fn in cells.FUNCTIONS:
    low = fn.lower()
    register(f"trj8_cell_{low}", lambda s, d, fn=fn: cells.aggregate_now(_pts(s, d), fx.GRID20, fn),
             f"{sql.base()}, {_CELLED} " + roll_up_sql(spans_sql("c"), (), fn, True))
    register(f"trj9_cell_idle_{low}",
             lambda s, d, fn=fn: cells.aggregate_now(_pts(s, d), fx.GRID20, fn, idle_ms=IDLE_MS),
             f"{sql.base()}, {_CELLED} " + roll_up_sql(
                 spans_sql("c", having=f" HAVING max(ts_ms) >= (SELECT max(ts_ms) FROM pts) - {IDLE_MS}"), (), fn, True))
    register(f"trj10_cell_window_{low}",
             lambda s, d, fn=fn: _window_cells(cells.aggregate_windows(_pts(s, d), fx.GRID20, fn, WINDOW)),
             f"{sql.base()}, {_CELLED} SELECT * RENAME (ws AS win_start) FROM ("
             + roll_up_sql(spans_sql("c", ("ws",)), ("ws",), fn, False) + ")")
    register(f"trj11_cell_count_window_{low}",
             lambda s, d, fn=fn: cells.aggregate_counts(_pts(s, d), fx.GRID20, fn, 10, 5, tie=("event_id",)),
             f"{sql.base()}, {_CELLED} " + roll_up_sql(spans_sql(_ended, ("last_n",)), ("last_n",), fn, False))

# stays: sessions of an object in a cell, cut where it was idle
STAYS = (f"{sql.base()}, {_CELLED}, gaps AS (SELECT *, CASE WHEN ts_ms - lag(ts_ms) OVER w > {IDLE_MS} THEN 1 ELSE 0 END AS cut "
         "FROM c WINDOW w AS (PARTITION BY cx, cy, obj_id ORDER BY ts, event_id)), "
         "numbered AS (SELECT *, sum(cut) OVER (PARTITION BY cx, cy, obj_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS stay FROM gaps), "
         "stays AS (SELECT cx, cy, obj_id, stay, CAST(max(ts_ms) - min(ts_ms) AS BIGINT) AS traj_ms, count(*) AS n_points, "
         "max(ts_ms) AS last_ms FROM numbered GROUP BY ALL), told AS (SELECT *, stay < max(stay) OVER (PARTITION BY cx, cy, obj_id) "
         f"OR last_ms < (SELECT max(ts_ms) FROM pts) - {IDLE_MS} AS ended FROM stays)")
STAYS_SQL = f"{STAYS} SELECT cx, cy, obj_id, traj_ms, n_points, last_ms, ended FROM told"


def stay_columns(stays):
    return stays.select("cx", "cy", "obj_id", "traj_ms", "n_points", F.unix_millis("last_ts").alias("last_ms"), "ended")


register("trj9_cell_stays", lambda s, d: stay_columns(cells.stays(_pts(s, d), fx.GRID20, IDLE_MS, tie=("event_id",))), STAYS_SQL)
register("trj9_live_cells_avg",
         lambda s, d: cells.live_cells(_pts(s, d), fx.GRID20, "AVG", IDLE_MS, tie=("event_id",)),
         f"{STAYS} " + roll_up_sql("SELECT * FROM told WHERE NOT ended", (), "AVG", True))
register("trj10_cell_window_sliding_max",
         lambda s, d: _window_cells(cells.aggregate_windows(_pts(s, d), fx.GRID20, "MAX", WindowSpec(*fx.SLIDING))),
         f"{sql.base()}, c AS (SELECT *, {sql.cell(fx.GRID20, 'x', 'x')} AS cx, {sql.cell(fx.GRID20, 'y', 'y')} AS cy "
         f"FROM ({sql.sliding('pts')})) SELECT * RENAME (ws AS win_start) FROM ("
         + roll_up_sql(spans_sql("c", ("ws",)), ("ws",), "MAX", False) + ")")

register("trj8_cell_running",
         lambda s, d: cells.running_spans(_pts(s, d), fx.GRID20, tie=("event_id",)).select(
             "event_id", "cx", "cy", "traj_ms", "n_obj", "sum_ms", "avg_ms", "max_ms"),
         f"""{sql.base()}, {_CELLED}, o AS (SELECT *, lag(ts_ms) OVER own AS pms,
           ts_ms - min(ts_ms) OVER (PARTITION BY cx, cy, obj_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS traj_ms
           FROM c WINDOW own AS (PARTITION BY cx, cy, obj_id ORDER BY ts, event_id)),
         r AS (SELECT event_id, cx, cy, traj_ms,
           CAST(sum(CASE WHEN pms IS NULL THEN 1 ELSE 0 END) OVER cell AS BIGINT) AS n_obj,
           CAST(sum(coalesce(ts_ms - pms, 0)) OVER cell AS BIGINT) AS sum_ms, max(traj_ms) OVER cell AS max_ms
           FROM o WINDOW cell AS (PARTITION BY cx, cy ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING))
         SELECT *, CAST(floor(sum_ms / n_obj + 0.5) AS BIGINT) AS avg_ms FROM r""")

# -- joins -------------------------------------------------------------------------
_pair = ["win_start", "a_obj_id", "b_obj_id"]


def _pairs(df):
    return df.select(win_start().alias("win_start"), "a_obj_id", "b_obj_id", us("a_ts").alias("a_ts_us"),
                     us("b_ts").alias("b_ts_us"), r6("dist").alias("dist"))


def _pairs_sql(a, b, r, where=""):
    return (f"{sql.base()}, w AS {PTS_W}, m AS (SELECT a.ws, a.obj_id AS a_obj_id, b.obj_id AS b_obj_id, a.ts_us AS a_ts_us, "
            f"b.ts_us AS b_ts_us, {sql.dist('a.x', 'a.y', 'b.x', 'b.y')} AS dist, a.x AS ax, a.y AS ay, b.x AS bx, b.y AS byy "
            f"FROM {a} a JOIN {b} b ON a.ws = b.ws{where}), near AS (SELECT * FROM m WHERE dist <= {sql.d(r)})")


_LATEST = (" SELECT ws AS win_start, a_obj_id, b_obj_id, a_ts_us, b_ts_us, round(dist, 6) AS dist FROM (SELECT *, row_number() OVER "
           "(PARTITION BY ws, a_obj_id, b_obj_id ORDER BY b_ts_us DESC, a_ts_us DESC, bx DESC, byy DESC, ax DESC, ay DESC) AS rn "
           "FROM near) WHERE rn = 1")
_CLICKS, _ERRORS = ("(SELECT * FROM w WHERE event_type = 'click')", "(SELECT * FROM w WHERE event_type = 'error')")


def _two(s, d):
    return fx.clicks(s, d), fx.errors(s, d)


register("trj12_trajectory_join", lambda s, d: _pairs(T.trajectory_pairs(*_two(s, d), D, window=WINDOW)),
         _pairs_sql(_CLICKS, _ERRORS, D) + _LATEST)
register("trj15_trajectory_join_naive",
         lambda s, d: _pairs(T.trajectory_pairs(*_two(s, d), D, window=WINDOW, leaves=True)),
         _pairs_sql(_CLICKS, _ERRORS, D) + _LATEST)


def _own(s, d):
    points = fx.pts(s, d)
    return points, points


register("trj14_self_join",
         lambda s, d: _pairs(T.trajectory_pairs(*_own(s, d), 1.0, window=WINDOW, exclude_same_id=True)),
         _pairs_sql("w", "w", 1.0, " AND a.obj_id <> b.obj_id") + _LATEST)


def _join_lines_sql(a, b, r, where=""):
    def part(side, rows):
        return (f"SELECT p.ws AS win_start, p.a_obj_id, p.b_obj_id, '{side}' AS side, l.* EXCLUDE (ws, obj_id) FROM pairs p "
                f"JOIN {side}_lines l ON l.ws = p.ws AND l.obj_id = p.{side}_obj_id")

    def lines(side, rows):
        return f"{side}_lines AS (SELECT ws, obj_id, {SUMMARY} FROM {rows} GROUP BY ws, obj_id HAVING count(*) >= 2)"

    return (f"{_pairs_sql(a, b, r, where)}, {lines('a', a)}, {lines('b', b)}, pairs AS (SELECT DISTINCT ws, a_obj_id, b_obj_id FROM near n "
            "WHERE EXISTS (SELECT 1 FROM a_lines l WHERE l.ws = n.ws AND l.obj_id = n.a_obj_id) "
            "AND EXISTS (SELECT 1 FROM b_lines l WHERE l.ws = n.ws AND l.obj_id = n.b_obj_id)) "
            f"{part('a', a)} UNION ALL {part('b', b)}")


register("trj13_trajectory_join_lines",
         lambda s, d: _summary(T.trajectory_join_lines(*_two(s, d), D, WINDOW), "a_obj_id", "b_obj_id", "side"),
         _join_lines_sql(_CLICKS, _ERRORS, D))
register("trj14_self_join_lines",
         lambda s, d: _summary(T.trajectory_join_lines(*_own(s, d), 1.0, WINDOW, exclude_same_id=True),
                               "a_obj_id", "b_obj_id", "side"),
         _join_lines_sql("w", "w", 1.0, " AND a.obj_id <> b.obj_id"))


# -- kNN ---------------------------------------------------------------------------
def _tknn_sql(r):
    limit = f"WHERE dist <= {sql.d(r)}" if r is not None else ""
    return (f"{pair_distances(POINT, POINT, [Q])}, w AS {PTS_W}, best AS (SELECT *, row_number() OVER (PARTITION BY ws, obj_id "
            f"ORDER BY dist, ts, x, y) AS rn FROM w JOIN dists ON k = event_id {limit}), "
            "ranked AS (SELECT *, row_number() OVER (PARTITION BY ws ORDER BY dist, obj_id) AS rank FROM best WHERE rn = 1)")


_TKNN = f" SELECT ws AS win_start, obj_id, rank, ts_us, round(x, 6) AS x, round(y, 6) AS y, round(dist, 6) AS dist FROM ranked WHERE rank <= {K}"
_TKNN_LINES = (f", l AS (SELECT ws, obj_id, {SUMMARY} FROM w GROUP BY ws, obj_id HAVING count(*) >= 2) SELECT ws AS win_start, obj_id, rank, "
               "round(dist, 6) AS dist, n_points, first_x, first_y, last_x, last_y FROM l JOIN (SELECT ws, obj_id, rank, dist FROM ranked "
               f"WHERE rank <= {K}) USING (ws, obj_id)")


def _tknn(r, **options):
    return lambda s, d: T.trajectory_knn(_pts(s, d), Q, r, K, window=WINDOW, **options).select(
        win_start().alias("win_start"), "obj_id", F.col("rank").cast("long").alias("rank"),
        us().alias("ts_us"), r6("x").alias("x"), r6("y").alias("y"), r6("dist").alias("dist"))


def _tknn_lines(r):
    return lambda s, d: _summary(T.trajectory_knn_lines(_pts(s, d), Q, r, K, WINDOW), "obj_id",
                                 "bigint(rank) AS rank", "round(dist, 6) AS dist")


register("trj16_trajectory_knn", _tknn(R), _tknn_sql(R) + _TKNN)
register("trj18_trajectory_knn_naive", _tknn(R, prefilter=False), _tknn_sql(R) + _TKNN)
register("trj17_trajectory_knn_lines", _tknn_lines(R), _tknn_sql(R) + _TKNN_LINES)
register("trj19_trajectory_knn_lines_naive", _tknn_lines(None), _tknn_sql(None) + _TKNN_LINES)
