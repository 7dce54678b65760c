"""Registered range queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import geometry as G
from ..functions.geometry import LINE, POINT, POLYGON
from ..functions.windows import WindowSpec
from ..operators import ranges
from . import fixtures as fx
from . import sql
from .registry import ORACLES, r6, register, us, win_start

R = 5.0
QUERY_SETS = {POINT: fx.QUERY_POINTS, POLYGON: fx.QUERY_POLYGONS, LINE: (fx.QUERY_LINE,)}
TABLES = {POINT: fx.pts, POLYGON: fx.polys, LINE: fx.lines}
SLIDING = WindowSpec(*fx.SLIDING)
AS_OF = "2024-02-01 00:00:00"


def _columns(kind):
    if kind == POINT:
        return ["event_id", "obj_id", us().alias("ts_us"), r6("x").alias("x"), r6("y").alias("y")]
    return ["obj_id", us().alias("ts_us"), *[r6(c).alias(c) for c in ("xmin", "ymin", "xmax", "ymax")]]


def _sql_columns(kind, t="p"):
    if kind == POINT:
        return f"{t}.event_id, {t}.obj_id, {t}.ts_us, round({t}.x, 6) AS x, round({t}.y, 6) AS y"
    return f"{t}.obj_id, {t}.ts_us, " + ", ".join(
        f"round({t}.{c}, 6) AS {c}" for c in ("xmin", "ymin", "xmax", "ymax"))


def _key(kind):
    return "event_id" if kind == POINT else "obj_id"


def pair_distances(kind, query_kind, queries, approx=False):
    """SQL: CTEs up to ``dists(k, qid, dist)`` for all stream rows and query objects."""
    key = _key(kind)
    head = sql.base(kind, query_kind if query_kind == kind else kind)
    if approx and not kind == query_kind == POINT:
        box = "(SELECT event_id, x AS xmin, x AS xmax, y AS ymin, y AS ymax FROM pts)" \
            if kind == POINT else sql.TABLE[kind]
        return (f"{head}, {sql.query_boxes(queries)}, dists AS (SELECT s.{key} AS k, q.qid, "
                f"{sql.box_dist('s', 'q', 'q')} AS dist FROM {box} s, q)")
    if query_kind == POINT:
        qs = sql.query_points(queries)
        if kind == POINT:
            body = f"SELECT p.event_id AS k, q.qid, {sql.dist('p.x', 'p.y', 'q.qx', 'q.qy')} AS dist FROM pts p, q"
        else:
            body = sql.point_edges_pairs(
                "p.qid", "e.obj_id AS k",
                f"(SELECT qid, qx AS x, qy AS y FROM q) p, {sql.EDGES[kind]} e", kind == POLYGON)
        return f"{head}, {qs}, dists AS ({body})"
    qs = sql.query_edges(queries)
    if kind == POINT:
        body = sql.point_edges_pairs("p.event_id AS k", "e.qid", "pts p, q_edges e",
                                     query_kind == POLYGON)
    else:
        body = "SELECT k_a AS k, k_b AS qid, dist FROM (" + sql.geometry_pairs(
            "a.obj_id", "b.qid", f"{sql.EDGES[kind]} a, q_edges b",
            kind == POLYGON, query_kind == POLYGON) + ")"
    return f"{head}, {qs}, dists AS ({body})"


def within_sql(kind, query_kind, queries, r, approx=False, windowed=False, where=None):
    cond = where or f"min(dist) <= {sql.d(r)}"
    table, key = sql.TABLE[kind], _key(kind)
    ctes = pair_distances(kind, query_kind, queries, approx) + \
        f", hits AS (SELECT k FROM dists GROUP BY k HAVING {cond})"
    if windowed:
        return (f"{ctes} SELECT ws AS win_start, {_sql_columns(kind)} FROM ({sql.sliding(table)}) p "
                f"WHERE {key} IN (SELECT k FROM hits)")
    return f"{ctes} SELECT {_sql_columns(kind)} FROM {table} p WHERE {key} IN (SELECT k FROM hits)"


def _run(kind, queries, r, window=None, **options):
    def fn(spark, sf_dir):
        out = ranges.range_query(TABLES[kind](spark, sf_dir), queries, r, kind=kind,
                                 window=window, **options)
        lead = [win_start().alias("win_start")] if window else []
        return out.select(*lead, *_columns(kind))
    return fn


PAIRINGS = (
    ("rng1_point_point", POINT, POINT), ("rng3_point_polygon", POINT, POLYGON),
    ("rng8_point_line", POINT, LINE), ("rng9_polygon_point", POLYGON, POINT),
    ("rng10_polygon_polygon", POLYGON, POLYGON), ("rng11_polygon_line", POLYGON, LINE),
    ("rng12_line_point", LINE, POINT), ("rng13_line_polygon", LINE, POLYGON),
    ("rng14_line_line", LINE, LINE),
)

for name, kind, query_kind in PAIRINGS:
    qs = QUERY_SETS[query_kind]
    register(name, _run(kind, qs, R), within_sql(kind, query_kind, qs, R))
    register(f"{name}_windowed", _run(kind, qs, R, SLIDING),
             within_sql(kind, query_kind, qs, R, windowed=True))
    if not kind == query_kind == POINT:
        register(f"{name}_approx", _run(kind, qs, R, approx=True),
                 within_sql(kind, query_kind, qs, R, approx=True))

# point-point approximate mode: every point of the candidate block of cells
_block = " OR ".join(
    "({cx} BETWEEN {a} AND {b} AND {cy} BETWEEN {c} AND {e})".format(
        cx=sql.cell(fx.GRID100, "p.x", "x"), cy=sql.cell(fx.GRID100, "p.y", "y"),
        a=i - L, b=i + L, c=j - L, e=j + L)
    for q in fx.QUERY_POINTS
    for L in [fx.GRID100.candidate_layers(R)]
    for i, j in [fx.GRID100.of(*q.vertices[0])])
register("rng1_point_point_approx", _run(POINT, fx.QUERY_POINTS, R, approx=True, grid=fx.GRID100),
         f"{sql.base()} SELECT {_sql_columns(POINT)} FROM pts p WHERE {_block}")


def _incremental(spark, sf_dir):
    out = ranges.range_query_incremental(fx.pts(spark, sf_dir), fx.QUERY_POINTS[0], R, SLIDING)
    return out.select(win_start().alias("win_start"), *_columns(POINT))


register("rng2_point_point_incremental", _incremental,
         within_sql(POINT, POINT, fx.QUERY_POINTS[:1], R, windowed=True))


def _as_of():
    return F.lit(AS_OF).cast("timestamp")


_AS_OF_MS = f"epoch_ms(TIMESTAMP '{AS_OF}')"


def _candidate_sql(queries, r, grid, extra=""):
    layers = grid.candidate_layers(r)
    cond = " OR ".join(
        f"({sql.cell(grid, 'p.x', 'x')} BETWEEN {i0 - layers} AND {i1 + layers} AND "
        f"{sql.cell(grid, 'p.y', 'y')} BETWEEN {j0 - layers} AND {j1 + layers})"
        for q in queries
        for (i0, j0), (i1, j1) in [(grid.of(*q.bbox[:2]), grid.of(*q.bbox[2:]))])
    return cond


def _latency(spark, sf_dir):
    cand = ranges.candidates(fx.pts(spark, sf_dir), fx.QUERY_POLYGONS, R, fx.GRID100)
    return ranges.with_latency(cand, _as_of()).select("event_id", "latency_ms")


register("rng4_point_polygon_latency", _latency,
         f"{sql.base()} SELECT event_id, {_AS_OF_MS} - ts_ms AS latency_ms FROM pts p WHERE "
         + _candidate_sql(fx.QUERY_POLYGONS, R, fx.GRID100))

# outside
for mode, cond in (("all", f"min(dist) > {sql.d(R)}"), ("any", f"max(dist) > {sql.d(R)}")):
    suffix = "" if mode == "all" else "_any"
    register(f"rng5_point_polygon_outside{suffix}",
             _run(POINT, fx.QUERY_POLYGONS, R, outside_mode=mode),
             within_sql(POINT, POLYGON, fx.QUERY_POLYGONS, R, where=cond))
register("rng5_point_polygon_outside_windowed",
         _run(POINT, fx.QUERY_POLYGONS, R, SLIDING, outside_mode="all"),
         within_sql(POINT, POLYGON, fx.QUERY_POLYGONS, R, windowed=True,
                    where=f"min(dist) > {sql.d(R)}"))


def _outside_latency(spark, sf_dir):
    out = ranges.range_query(fx.pts(spark, sf_dir), fx.QUERY_POLYGONS, R, outside_mode="all")
    return ranges.with_latency(out, _as_of()).select("event_id", "latency_ms")


register("rng6_point_polygon_outside_latency", _outside_latency,
         pair_distances(POINT, POLYGON, fx.QUERY_POLYGONS)
         + f", hits AS (SELECT k FROM dists GROUP BY k HAVING min(dist) > {sql.d(R)}) "
         f"SELECT event_id, {_AS_OF_MS} - ts_ms AS latency_ms FROM pts "
         "WHERE event_id IN (SELECT k FROM hits)")
register("rng7_point_polygon_outside_batch",
         _run(POINT, fx.QUERY_POLYGONS[:1], 1e-7, outside_mode="all"),
         within_sql(POINT, POLYGON, fx.QUERY_POLYGONS[:1], 1e-7,
                    where=f"min(dist) > {sql.d(1e-7)}"))


def _table_query(spark, sf_dir):
    """Query set given as a table of any size: here every purchase polygon."""
    out = ranges.range_query(fx.pts(spark, sf_dir), fx.polys(spark, sf_dir), 0.25, kind=POINT,
                             query_kind=POLYGON)
    return out.select(*_columns(POINT))


register("rng3_point_polygon_table", _table_query,
         sql.base(POLYGON) + ", hits AS (SELECT DISTINCT k FROM (" + sql.point_edges_pairs(
             "p.event_id AS k", "e.obj_id",
             "pts p JOIN poly_box x ON "
             "p.x BETWEEN x.xmin - 1 AND x.xmax + 1 AND p.y BETWEEN x.ymin - 1 AND x.ymax + 1 "
             "JOIN poly_edges e ON e.obj_id = x.obj_id", True)
         + f") WHERE dist <= {sql.d(0.25)}) SELECT {_sql_columns(POINT)} FROM pts p "
         "WHERE event_id IN (SELECT k FROM hits)")


# the query sets above as tables, joined whatever their size
def query_table(spark, queries):
    if queries[0].kind == POINT:
        return spark.createDataFrame([(float(x), float(y)) for q in queries for x, y in q.vertices],
                                     "x double, y double")
    rows = [([[(float(x), float(y)) for x, y in path] for path in q.paths],) for q in queries]
    return G.with_edges(spark.createDataFrame(rows, "rings array<array<struct<x:double,y:double>>>"), "rings")


def _run_table(queries, **options):
    def fn(spark, sf_dir):
        out = ranges.range_query(fx.pts(spark, sf_dir), query_table(spark, queries), R, row_id=["event_id"],
                                 query_kind=queries[0].kind, max_literal=0, **options)
        return out.select(*_columns(POINT))
    return fn


for name, queries, options in (
        ("rng1_point_point_approx", fx.QUERY_POINTS, {"approx": True, "grid": fx.GRID100}),
        ("rng3_point_polygon_approx", fx.QUERY_POLYGONS, {"approx": True}),
        ("rng5_point_polygon_outside", fx.QUERY_POLYGONS, {"outside_mode": "all"}),
        ("rng5_point_polygon_outside_any", fx.QUERY_POLYGONS, {"outside_mode": "any"})):
    register(f"{name}_table", _run_table(queries, **options), ORACLES[name])
