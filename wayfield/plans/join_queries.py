"""Registered distance joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.geometry import LINE, POINT, POLYGON
from ..functions.windows import WindowSpec
from ..operators import joins
from . import fixtures as fx
from . import sql
from .range_queries import AS_OF
from .registry import r6_double, register, win_start

R = 3.0
WINDOW = WindowSpec(*fx.TUMBLING)
SLIDING = WindowSpec(*fx.SLIDING)

# the streams that are joined, by geometry and side
TABLES = {(POINT, "a"): fx.clicks, (POINT, "b"): fx.errors,
          (POLYGON, "a"): fx.polys, (POLYGON, "b"): fx.polys,
          (LINE, "a"): fx.lines, (LINE, "b"): fx.lines}


def _key(kind):
    return "event_id" if kind == POINT else "obj_id"


def _where(kind, side):
    if kind != POINT:
        return ""
    return f" WHERE event_type = '{'click' if side == 'a' else 'error'}'"


def _result(df, kinds, windowed=True):
    lead = [win_start().alias("win_start")] if windowed else []
    return df.select(*lead, *[F.col(f"{s}_{_key(k)}").alias(f"{s}_id") for s, k in zip("ab", kinds)],
                     r6_double("dist").alias("dist"))


def _run(kinds, join=joins.distance_join, window=WINDOW, **options):
    def fn(spark, sf_dir):
        a, b = (TABLES[k, s](spark, sf_dir) for k, s in zip(kinds, "ab"))
        return _result(join(a, b, R, kinds=kinds, window=window, **options), kinds)
    return fn


def _rows(kind, side, sliding):
    table = sql.TABLE[kind]
    source = f"({sql.sliding(table)})" if sliding else f"(SELECT *, {sql.win()} AS ws FROM {table})"
    return f"(SELECT * FROM {source}{_where(kind, side)})"


def join_sql(kinds, r, sliding=False, approx=False):
    """All pairs of a window with their distance, in plain SQL."""
    ka, kb = kinds
    head = sql.base(*kinds)
    a, b = _rows(ka, "a", sliding), _rows(kb, "b", sliding)
    ida, idb = f"a.{_key(ka)}", f"b.{_key(kb)}"
    if ka == kb == POINT:
        body = (f"SELECT a.ws AS win_start, {ida} AS a_id, {idb} AS b_id, "
                f"{sql.dist('a.x', 'a.y', 'b.x', 'b.y')} AS dist FROM {a} a JOIN {b} b ON a.ws = b.ws")
        return f"{head} SELECT win_start, a_id, b_id, round(dist, 6) AS dist FROM ({body}) WHERE dist <= {sql.d(r)}"
    box = {k: f"(SELECT *, x AS xmin, x AS xmax, y AS ymin, y AS ymax FROM {t})" if k == POINT else t
           for k, t in ((ka, a), (kb, b))}
    if ka == kb:
        box = {ka: a}
    if approx:
        body = (f"SELECT a.ws AS win_start, {ida} AS a_id, {idb} AS b_id, {sql.box_dist('a', 'b')} AS dist "
                f"FROM {box[ka]} a JOIN {box[kb]} b ON a.ws = b.ws")
        return f"{head} SELECT win_start, a_id, b_id, round(dist, 6) AS dist FROM ({body}) WHERE dist <= {sql.d(r)}"
    # candidates by box distance, then exact distances over the edges
    cand = (f"cand AS (SELECT a.ws, {ida} AS ka, {idb} AS kb FROM {box[ka]} a JOIN {box[kb]} b "
            f"ON a.ws = b.ws WHERE {sql.box_dist('a', 'b')} <= {sql.d(r + 1e-6)}), "
            "pairs AS (SELECT DISTINCT ka, kb FROM cand)")
    if POINT in kinds:
        other = kb if ka == POINT else ka
        kp, ke = ("ka", "kb") if ka == POINT else ("kb", "ka")
        exact = sql.point_edges_pairs(
            f"c.{kp}", f"c.{ke}",
            f"pairs c JOIN pts p ON p.event_id = c.{kp} JOIN {sql.EDGES[other]} e ON e.obj_id = c.{ke}",
            other == POLYGON)
    else:
        exact = "SELECT k_a AS ka, k_b AS kb, dist FROM (" + sql.geometry_pairs(
            "c.ka", "c.kb", f"pairs c JOIN {sql.EDGES[ka]} a ON a.obj_id = c.ka "
                            f"JOIN {sql.EDGES[kb]} b ON b.obj_id = c.kb",
            ka == POLYGON, kb == POLYGON) + ")"
    return (f"{head}, {cand}, dists AS ({exact}) SELECT ws AS win_start, ka AS a_id, kb AS b_id, "
            f"round(dist, 6) AS dist FROM cand JOIN dists USING (ka, kb) WHERE dist <= {sql.d(r)}")


PAIRINGS = (
    ("jon1_point_point", POINT, POINT), ("jon3_point_polygon", POINT, POLYGON),
    ("jon6_point_line", POINT, LINE), ("jon7_polygon_point", POLYGON, POINT),
    ("jon8_polygon_polygon", POLYGON, POLYGON), ("jon9_polygon_line", POLYGON, LINE),
    ("jon10_line_point", LINE, POINT), ("jon11_line_polygon", LINE, POLYGON),
    ("jon12_line_line", LINE, LINE),
)
for name, ka, kb in PAIRINGS:
    register(name, _run((ka, kb)), join_sql((ka, kb), R))
    if (ka, kb) != (POINT, POINT):
        register(f"{name}_approx", _run((ka, kb), approx=True), join_sql((ka, kb), R, approx=True))

register("jon1_point_point_sliding", _run((POINT, POINT), window=SLIDING),
         join_sql((POINT, POINT), R, sliding=True))

_k = fx.GRID20.candidate_layers(R)
_near = " AND ".join(
    f"abs({sql.cell(fx.GRID20, f'a.{v}', v)} - {sql.cell(fx.GRID20, f'b.{v}', v)}) <= {_k}" for v in "xy")
register("jon1_point_point_approx", _run((POINT, POINT), approx=True, grid=fx.GRID20),
         f"{sql.base()} SELECT a.ws AS win_start, a.event_id AS a_id, b.event_id AS b_id, "
         f"round({sql.dist('a.x', 'a.y', 'b.x', 'b.y')}, 6) AS dist FROM {_rows(POINT, 'a', False)} a "
         f"JOIN {_rows(POINT, 'b', False)} b ON a.ws = b.ws WHERE {_near}")

# grid-free twins
register("jon2_point_point_naive", _run((POINT, POINT), joins.leaf_join), join_sql((POINT, POINT), R))
register("jon4_point_polygon_naive", _run((POINT, POLYGON), joins.leaf_join),
         join_sql((POINT, POLYGON), R))


def _latency(spark, sf_dir):
    pairs = joins.join_candidates(fx.clicks(spark, sf_dir), fx.polys(spark, sf_dir), R, fx.GRID100,
                                  kinds=(POINT, POLYGON), window=WINDOW)
    as_of = F.lit(AS_OF).cast("timestamp")
    return pairs.select(
        win_start().alias("win_start"), F.col("a_event_id").alias("a_id"),
        F.col("b_obj_id").alias("b_id"),
        (F.unix_millis(as_of) - F.unix_millis("a_ts")).alias("latency_ms"))


_L = fx.GRID100.candidate_layers(R)
_cells = " AND ".join(
    f"{sql.cell(fx.GRID100, f'a.{v}', v)} BETWEEN {sql.cell(fx.GRID100, f'b.{v}min', v)} - {_L} "
    f"AND {sql.cell(fx.GRID100, f'b.{v}max', v)} + {_L}" for v in "xy")
register("jon5_point_polygon_latency", _latency,
         f"{sql.base(POLYGON)} SELECT a.ws AS win_start, a.event_id AS a_id, b.obj_id AS b_id, "
         f"epoch_us(TIMESTAMP '{AS_OF}') // 1000 - a.ts_ms AS latency_ms "
         f"FROM {_rows(POINT, 'a', False)} a JOIN {_rows(POLYGON, 'b', False)} b ON a.ws = b.ws "
         f"WHERE {_cells}")


def _self_join(spark, sf_dir):
    """All points with all points of the same window, the heaviest form."""
    a, b = (fx.pts(spark, sf_dir).select("event_id", "ts", "x", "y") for _ in "ab")
    return _result(joins.distance_join(a, b, 1.0, window=WINDOW), (POINT, POINT))


register("jon1_point_point_all", _self_join,
         f"{sql.base()}, w AS (SELECT *, {sql.win()} AS ws FROM pts) "
         f"SELECT a.ws AS win_start, a.event_id AS a_id, b.event_id AS b_id, "
         f"round({sql.dist('a.x', 'a.y', 'b.x', 'b.y')}, 6) AS dist FROM w a JOIN w b ON a.ws = b.ws "
         f"WHERE {sql.dist('a.x', 'a.y', 'b.x', 'b.y')} <= {sql.d(1.0)}")
