"""Registered projections, filters, expressions and applications."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import geometry as G
from ..functions.geometry import LINE, POINT, POLYGON
from ..functions.grid import neighbor_cells, within_layers
from ..functions.windows import WindowSpec
from ..operators import apps, cells
from . import fixtures as fx
from . import sql
from .range_queries import AS_OF, _columns, _sql_columns, pair_distances
from .registry import r6, register, win_start

WINDOW = WindowSpec(*fx.TUMBLING)
G20, G100 = fx.GRID20, fx.GRID100
Q = fx.QUERY_POINTS[0]
QX, QY = Q.vertices[0]


def _cell_sql(g, t=""):
    return sql.cell(g, f"{t}x", "x"), sql.cell(g, f"{t}y", "y")


CX, CY = _cell_sql(G20)
CELLED = f"c AS (SELECT *, {CX} AS cx, {CY} AS cy FROM pts)"

# -- projections and filters -----------------------------------------------------
register("prj1_point_cell",
         lambda s, d: cells.project(fx.pts(s, d), G20).select(
             "event_id", r6("x").alias("x"), r6("y").alias("y"), "cell"),
         f"{sql.base()}, {CELLED} SELECT event_id, round(x, 6) AS x, round(y, 6) AS y, "
         "printf('%05d%05d', cx, cy) AS cell FROM c")
register("prj2_count_per_cell", lambda s, d: cells.count_per_cell(fx.pts(s, d), G20),
         f"{sql.base()}, {CELLED} SELECT cx, cy, count(*) AS n FROM c GROUP BY cx, cy")
register("prj3_restamp",
         lambda s, d: cells.restamp(fx.pts(s, d), F.lit(AS_OF).cast("timestamp")).select(
             "event_id", F.unix_micros("ts").alias("ts_us")),
         f"{sql.base()} SELECT event_id, epoch_us(TIMESTAMP '{AS_OF}') AS ts_us FROM pts")


def _query_cells(spark, sf_dir):
    """Candidate cells around the cells where errors happened."""
    hot = G20.with_cell(fx.pts(spark, sf_dir)).filter(
        (F.col("event_type") == "error") & (F.col("x") > 60)).select("cx", "cy").distinct()
    return neighbor_cells(hot, G20, 5.0).select(F.col("ncx").alias("cx"), F.col("ncy").alias("cy"))


register("flt1_counts_in_cells",
         lambda s, d: cells.in_cells(cells.count_per_cell(fx.pts(s, d), G20), _query_cells(s, d)),
         f"{sql.base()}, {CELLED}, h AS (SELECT DISTINCT cx, cy FROM c WHERE event_type = 'error' AND x > 60), "
         "n AS (SELECT cx, cy, count(*) AS n FROM c GROUP BY cx, cy) SELECT * FROM n WHERE EXISTS "
         "(SELECT 1 FROM h WHERE abs(h.cx - n.cx) <= 1 AND abs(h.cy - n.cy) <= 1) "
         "AND cx BETWEEN 0 AND 19 AND cy BETWEEN 0 AND 19")

BLOCK = [(i, j) for i in range(2, 5) for j in range(8, 12)]


def _touch_sql(kind):
    g = {f"{v}{e}": sql.cell(G20, f"p.{v}{e}", v) for v in "xy" for e in ("min", "max")}
    return (f"{sql.base(kind)} SELECT {_sql_columns(kind)} FROM {sql.TABLE[kind]} p WHERE {g['xmax']} >= 2 "
            f"AND {g['xmin']} <= 4 AND {g['ymax']} >= 8 AND {g['ymin']} <= 11")


register("flt2_polygons_in_cells",
         lambda s, d: cells.bbox_touches_cells(fx.polys(s, d), G20, BLOCK).select(*_columns(POLYGON)),
         _touch_sql(POLYGON))
register("flt3_lines_in_block",
         lambda s, d: cells.bbox_touches_block(fx.lines(s, d), G20, (2, 8), (4, 11)).select(*_columns(LINE)),
         _touch_sql(LINE))


def _features(spark, sf_dir):
    kind = F.when(F.col("event_type") == "view", "control").otherwise("Point")
    return fx.pts(spark, sf_dir).withColumn("geom_type", kind)


register("flt4_without_control",
         lambda s, d: cells.without_control(_features(s, d)).select(*_columns(POINT)),
         f"{sql.base()} SELECT {_sql_columns(POINT)} FROM pts p WHERE event_type <> 'view'")


def _some_without_x(spark, sf_dir):
    points = fx.pts(spark, sf_dir)
    return points.withColumn("x", F.when(F.col("event_type") != "view", F.col("x")))


register("flt5_has_cell",
         lambda s, d: cells.has_cell(G20.with_cell(_some_without_x(s, d))).select("event_id", "cx", "cy"),
         f"{sql.base()}, {CELLED} SELECT event_id, cx, cy FROM c WHERE event_type <> 'view'")
_q20 = G20.of(QX, QY)
register("flt6_within_layers",
         lambda s, d: G20.with_cell(fx.pts(s, d)).filter(
             within_layers(F.col("cx"), F.col("cy"), *_q20, 2)).select("event_id", "cx", "cy"),
         f"{sql.base()}, {CELLED} SELECT event_id, cx, cy FROM c WHERE abs(cx - {_q20[0]}) <= 2 AND abs(cy - {_q20[1]}) <= 2")


def _extremes(spark, sf_dir):
    out = cells.extreme_points(fx.pts(spark, sf_dir), ["event_type"])
    return out.select("event_type", *[c for m in ("min_x", "max_x", "min_y", "max_y") for c in (
        F.col(f"{m}.obj_id").alias(f"{m}_id"), r6(f"{m}.x").alias(f"{m}_x"), r6(f"{m}.y").alias(f"{m}_y"))])


register("agg0_extreme_points", _extremes,
         f"{sql.base()}" + "".join(
             f", {m} AS (SELECT event_type, obj_id AS {m}_id, round(x, 6) AS {m}_x, round(y, 6) AS {m}_y FROM (SELECT *, "
             f"row_number() OVER (PARTITION BY event_type ORDER BY {o}, obj_id, ts_us, x, y) AS rn FROM pts) WHERE rn = 1)"
             for m, o in (("min_x", "x"), ("max_x", "x DESC"), ("min_y", "y"), ("max_y", "y DESC")))
         + " SELECT * FROM min_x JOIN max_x USING (event_type) JOIN min_y USING (event_type) JOIN max_y USING (event_type)")

# -- expressions over whole tables -------------------------------------------------
register("exp2_boundary_distance",
         lambda s, d: fx.pts(s, d).select("event_id", r6(F.expr(G.boundary_distance_sql(
             "x", "y", G.literal(fx.QUERY_POLYGONS[0]).edges))).alias("dist")),
         f"{sql.base()}, {sql.query_edges(fx.QUERY_POLYGONS[:1])} SELECT event_id, "
         f"round(sqrt(min({sql.seg2('p.x', 'p.y', 'e')})), 6) AS dist FROM pts p, q_edges e GROUP BY event_id")


def _distance_to(table, kind, q, fn):
    key = "event_id" if kind == POINT else "obj_id"
    return lambda s, d: table(s, d).select(F.col(key).alias("k"), r6(fn(G.shape(kind), G.literal(q))).alias("dist"))


_DIST = "SELECT k, round(dist, 6) AS dist FROM dists"
register("exp1_point_distance", _distance_to(fx.pts, POINT, Q, G.distance),
         f"{pair_distances(POINT, POINT, [Q])} {_DIST}")
for _name, _kind, _table, _q in (
        ("point_polygon", POINT, fx.pts, fx.QUERY_POLYGONS[1]), ("point_line", POINT, fx.pts, fx.QUERY_LINE),
        ("polygon_polygon", POLYGON, fx.polys, fx.QUERY_POLYGONS[1]), ("polygon_line", POLYGON, fx.polys, fx.QUERY_LINE),
        ("line_line", LINE, fx.lines, fx.QUERY_LINE)):
    register(f"exp3_{_name}_distance", _distance_to(_table, _kind, _q, G.distance),
             f"{pair_distances(_kind, _q.kind, [_q])} {_DIST}")
    register(f"exp{4 if _kind == POINT else 5}_{_name}_bbox_distance", _distance_to(_table, _kind, _q, G.bbox_distance),
             f"{pair_distances(_kind, _q.kind, [_q], approx=True)} {_DIST}")
register("exp6_haversine",
         lambda s, d: fx.pts(s, d).select("event_id", F.round(G.haversine(
             "x", "y * 0.8D", G.num(QX), G.num(QY)), 3).alias("metres")),
         f"{sql.base()} SELECT event_id, round(acos(greatest(-1, least(1, sin(radians(y * {sql.d(0.8)})) * sin(radians({sql.d(QY)})) + "
         f"cos(radians(y * {sql.d(0.8)})) * cos(radians({sql.d(QY)})) * cos(radians({sql.d(QX)}) - radians(x))))) * {sql.d(G.EARTH_RADIUS_M)}, 3) AS metres FROM pts")


def _text_paths(spark, sf_dir):
    text = F.format_string("[[%s,%s],[%s,%s]]", "x", "y", F.col("x") + 1, F.col("y") + 2)
    rows = fx.pts(spark, sf_dir).select("event_id", G.coordinates_from_text(text).alias("path"))
    return rows.select("event_id", F.size("path").cast("long").alias("n"),
                       *[r6(F.get("path", F.lit(i))[v]).alias(f"{v}{i}") for i in (0, 1) for v in "xy"])


register("exp9_coordinates_from_text", _text_paths,
         f"{sql.base()} SELECT event_id, 2 AS n, round(x, 6) AS x0, round(y, 6) AS y0, round(x + 1, 6) AS x1, round(y + 2, 6) AS y1 FROM pts"
         .replace("2 AS n", "CAST(2 AS BIGINT) AS n"))
for _kind, _table in ((POLYGON, fx.polys), (LINE, fx.lines)):
    register(f"exp10_bbox_{_kind}", lambda s, d, t=_table, k=_kind: t(s, d).select(*_columns(k)),
             f"{sql.base(_kind)} SELECT {_sql_columns(_kind)} FROM {sql.TABLE[_kind]} p")

# -- check-in ------------------------------------------------------------------------
CHECKINS = (f"{sql.base()}, ci AS (SELECT CAST(event_id AS VARCHAR) AS event_id, 'room' || (event_id % 5) || '-' || "
            "CASE WHEN event_type IN ('click', 'view') THEN 'in' ELSE 'out' END AS device_id, obj_id AS user_id, ts, ts_us, ts_ms FROM pts), "
            "lagged AS (SELECT *, lag(device_id) OVER w AS pd, lag(ts_ms) OVER w AS pms FROM ci WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)), "
            "filled AS (SELECT event_id, device_id, user_id, ts_us, ts_ms, FALSE AS synthetic FROM lagged UNION ALL "
            "SELECT event_id, split_part(device_id, '-', 1) || CASE WHEN device_id LIKE '%-in' THEN '-out' ELSE '-in' END, user_id, "
            "(pms + ts_ms) // 2 * 1000, (pms + ts_ms) // 2, TRUE FROM lagged WHERE pd = device_id)")
register("app1_fill_checkins",
         lambda s, d: apps.fill_checkins(fx.checkins(s, d)).select(
             "event_id", "device_id", "user_id", F.unix_millis("ts").alias("ts_ms"), "synthetic"),
         f"{CHECKINS} SELECT event_id, device_id, user_id, ts_ms, synthetic FROM filled")

_capacity = " ".join(f"WHEN '{room}' THEN {n}" for room, n in fx.ROOM_CAPACITY.items())


def _occupancy(rows):
    return apps.room_occupancy(rows, fx.ROOM_CAPACITY).select(
        "event_id", "room", F.unix_micros("ts").alias("ts_us"), "count", F.col("capacity").cast("long").alias("capacity"))


def _occupancy_sql(table, tie):
    return (f"{CHECKINS} SELECT event_id, split_part(device_id, '-', 1) AS room, ts_us, CAST(sum(CASE WHEN device_id LIKE '%-in' THEN 1 ELSE -1 END) "
            f"OVER (PARTITION BY split_part(device_id, '-', 1) ORDER BY ts_us, event_id{tie} ROWS UNBOUNDED PRECEDING) AS BIGINT) AS \"count\", "
            f"CAST(CASE split_part(device_id, '-', 1) {_capacity} END AS BIGINT) AS capacity FROM {table}")


register("app2_room_occupancy", lambda s, d: _occupancy(fx.checkins(s, d)), _occupancy_sql("ci", ""))
register("app2_room_occupancy_filled", lambda s, d: _occupancy(apps.fill_checkins(fx.checkins(s, d))),
         _occupancy_sql("filled", ", synthetic"))

# -- stay time -------------------------------------------------------------------------
_c, _g = sql.d(G20.cell), (sql.d(G20.minx), sql.d(G20.miny))
_cell = lambda v, axis: sql.cell(G20, v, axis)
_xl = f"greatest({_g[0]} + i * {_c}, least(px, x))"
_xr = f"least({_g[0]} + (i + 1) * {_c}, greatest(px, x))"
_ya, _yb = (f"(py + ({v} - px) * ((y - py) / (x - px)))" for v in (_xl, _xr))
STAY = (f"""steps AS (SELECT ws, event_id, ts_ms - lag(ts_ms) OVER w AS ms, lag(x) OVER w AS px, lag(y) OVER w AS py, x, y
    FROM (SELECT *, {sql.win()} AS ws FROM pts) WINDOW w AS (PARTITION BY ws, obj_id ORDER BY ts)),
  s AS (SELECT *, {_cell('px', 'x')} AS ax, {_cell('py', 'y')} AS ay, {_cell('x', 'x')} AS bx, {_cell('y', 'y')} AS byy
    FROM steps WHERE ms IS NOT NULL),
  straight AS (SELECT ws, event_id, ms, i AS cx, unnest(generate_series(least(ay, byy), greatest(ay, byy))) AS cy
    FROM (SELECT *, unnest(generate_series(least(ax, bx), greatest(ax, bx))) AS i FROM s WHERE ax = bx OR ay = byy)),
  cols AS (SELECT *, least({_ya}, {_yb}) AS ylo, greatest({_ya}, {_yb}) AS yhi
    FROM (SELECT *, unnest(generate_series(least(ax, bx), greatest(ax, bx))) AS i FROM s WHERE ax <> bx AND ay <> byy)),
  diagonal AS (SELECT ws, event_id, ms, i AS cx, unnest(generate_series(
      greatest(least(ay, byy), CAST(ceil((ylo - {_g[1]}) / {_c}) AS INTEGER) - 1),
      least(greatest(ay, byy), CAST(floor((yhi - {_g[1]}) / {_c}) AS INTEGER)))) AS cy FROM cols
    UNION SELECT ws, event_id, ms, ax, ay FROM s WHERE ax <> bx AND ay <> byy
    UNION SELECT ws, event_id, ms, bx, byy FROM s WHERE ax <> bx AND ay <> byy),
  crossed AS (SELECT * FROM straight UNION ALL SELECT * FROM diagonal),
  stay AS (SELECT ws, cx, cy, sum(ms / n) AS stay_ms FROM (SELECT *, CAST(count(*) OVER (PARTITION BY ws, event_id) AS DOUBLE) AS n FROM crossed) GROUP BY ALL)""")
register("app3_stay_time",
         lambda s, d: apps.stay_time(fx.pts(s, d), G20, WINDOW).select(
             win_start().alias("win_start"), "cx", "cy", F.round("stay_ms", 5).alias("stay_ms")),
         f"{sql.base()}, {STAY} SELECT ws AS win_start, CAST(cx AS INTEGER) AS cx, CAST(cy AS INTEGER) AS cy, round(stay_ms, 5) AS stay_ms FROM stay")

_rect = {"xl": f"({_g[0]} + cx * {_c})", "yl": f"({_g[1]} + cy * {_c})",
         "xr": f"({_g[0]} + (cx + 1) * {_c})", "yr": f"({_g[1]} + (cy + 1) * {_c})"}
_sides = ", ".join(f"(e.x2 - e.x1) * ({cy} - e.y1) - (e.y2 - e.y1) * ({cx} - e.x1)" for cx, cy in (
    (_rect["xl"], _rect["yl"]), (_rect["xr"], _rect["yl"]), (_rect["xr"], _rect["yr"]), (_rect["xl"], _rect["yr"])))
_hit = (f"greatest(e.x1, e.x2) >= {_rect['xl']} AND least(e.x1, e.x2) <= {_rect['xr']} AND greatest(e.y1, e.y2) >= {_rect['yl']} "
        f"AND least(e.y1, e.y2) <= {_rect['yr']} AND least({_sides}) <= 0 AND greatest({_sides}) >= 0")
COVERAGE = (f"""pc AS (SELECT *, unnest(generate_series({_cell('ymin', 'y')}, {_cell('ymax', 'y')})) AS cy FROM
    (SELECT *, {sql.win()} AS ws, unnest(generate_series({_cell('xmin', 'x')}, {_cell('xmax', 'x')})) AS cx FROM poly_box)),
  covered AS (SELECT p.ws, p.obj_id, p.ts_ms, p.cx, p.cy FROM pc p JOIN poly_edges e ON e.obj_id = p.obj_id GROUP BY ALL
    HAVING bool_or({_hit}) OR sum({sql.crosses(_rect['xl'], _rect['yl'], 'e')}) % 2 = 1),
  coverage AS (SELECT ws, cx, cy, count(DISTINCT ts_ms) AS coverage FROM covered GROUP BY ALL)""")
register("app4_sensor_coverage",
         lambda s, d: apps.sensor_coverage(fx.polys(s, d), G20, WINDOW).select(
             win_start().alias("win_start"), "cx", "cy", "coverage"),
         f"{sql.base(POLYGON)}, {COVERAGE} SELECT ws AS win_start, CAST(cx AS INTEGER) AS cx, CAST(cy AS INTEGER) AS cy, coverage FROM coverage")
SECONDS = 6 * 3600


def _normalized(s, d):
    return apps.normalized_stay_time(fx.pts(s, d), fx.polys(s, d), G20, WINDOW, SECONDS)


_NORMAL = (f"{sql.base(POLYGON)}, {STAY}, {COVERAGE}, normal AS (SELECT *, stay_ms / 1000 / coverage * {SECONDS} AS normalized "
           "FROM stay JOIN coverage USING (ws, cx, cy))")
register("app5_normalized_stay_time",
         lambda s, d: _normalized(s, d).select(win_start().alias("win_start"), "cx", "cy",
                                               F.round("normalized", 3).alias("normalized")),
         f"{_NORMAL} SELECT ws AS win_start, CAST(cx AS INTEGER) AS cx, CAST(cy AS INTEGER) AS cy, round(normalized, 3) AS normalized FROM normal")


def _stay_json(s, d):
    text = apps.stay_time_json(_normalized(s, d))
    parsed = F.from_json("value", "cellID string, window array<bigint>, normalizedStayTime double")
    return text.select(parsed.alias("j")).select(
        F.col("j.cellID").alias("cell"), F.get("j.window", F.lit(0)).alias("start_ms"),
        F.get("j.window", F.lit(1)).alias("end_ms"), F.round("j.normalizedStayTime", 3).alias("normalized"))


register("snk15_stay_time_json", _stay_json,
         f"{_NORMAL} SELECT printf('%05d%05d', cx, cy) AS cell, ws * 1000 AS start_ms, ws * 1000 + {SECONDS * 1000} AS end_ms, "
         "round(normalized, 3) AS normalized FROM normal")

# -- geofence --------------------------------------------------------------------------
FENCE = fx.QUERY_POLYGONS[0]
_OUT = (f"{pair_distances(POINT, POLYGON, [FENCE])}, o AS (SELECT pts.* FROM pts JOIN dists ON k = event_id "
        f"WHERE dist > {sql.d(apps.GEOFENCE_TOLERANCE)})")
register("app6_geofence_windows",
         lambda s, d: apps.geofence_windows(fx.pts(s, d), FENCE).select(win_start().alias("win_start"), "n", "value"),
         f"{_OUT} SELECT ts_ms // 1000 AS win_start, count(*) AS n, 'TRUE' AS value FROM o GROUP BY ts_ms // 1000")
register("app7_geofence_batch",
         lambda s, d: apps.geofence_report(apps.geofence(fx.pts(s, d), FENCE)),
         f"{_OUT} SELECT DISTINCT 'Second ' || (ts_ms // 1000) || ': TRUE' AS value FROM o")

# -- tiles -------------------------------------------------------------------------------
N_TILES = 2500


def _tile_counts(spark, sf_dir):
    points = fx.pts(spark, sf_dir)
    bounds = points.agg(F.min("x").alias("xmin"), F.min("y").alias("ymin"),
                        F.max("x").alias("xmax"), F.max("y").alias("ymax"))
    made = apps.tiles(bounds, N_TILES)
    side = apps.tile_side(*[F.col(c) for c in ("xmin", "ymin", "xmax", "ymax")]).alias("side")
    tiled = points.withColumn("_b", bounds.select(F.struct("xmin", "ymin", side)).scalar())
    counts = tiled.groupBy(F.expr("floor((x - _b.xmin) / _b.side)").alias("ti"),
                           F.expr("floor((y - _b.ymin) / _b.side)").alias("tj")).agg(F.count(F.lit(1)).alias("n"))
    return made.join(counts, ["ti", "tj"], "left").select(
        "ti", "tj", r6("xmin").alias("xmin"), r6("ymin").alias("ymin"), F.coalesce("n", F.lit(0)).alias("n"))


register("app9_tiles", _tile_counts,
         f"{sql.base()}, b AS (SELECT min(x) AS x0, min(y) AS y0, max(x) AS x1, max(y) AS y1, least((max(x) - min(x)) / 100, (max(y) - min(y)) / 100) AS side FROM pts), "
         "m AS (SELECT *, CAST(ceil((x1 - x0) / side) AS BIGINT) AS nx, CAST(ceil((y1 - y0) / side) AS BIGINT) AS ny FROM b), "
         f"t AS (SELECT ti, unnest(range(0, ny)) AS tj, x0, y0, side FROM (SELECT *, unnest(range(0, least(nx, CAST(ceil(CAST({N_TILES} AS DOUBLE) / ny) AS BIGINT)))) AS ti FROM m)), "
         "n AS (SELECT CAST(floor((x - x0) / side) AS BIGINT) AS ti, CAST(floor((y - y0) / side) AS BIGINT) AS tj, count(*) AS n FROM pts, b GROUP BY ALL) "
         "SELECT t.ti, t.tj, round(x0 + t.ti * side, 6) AS xmin, round(y0 + t.tj * side, 6) AS ymin, coalesce(n, 0) AS n FROM t LEFT JOIN n USING (ti, tj)")

# -- centroid and tracks -----------------------------------------------------------------
_cross = "(x1 * y2 - x2 * y1)"
register("app10_centroid",
         lambda s, d: apps.centroid(fx.polys(s, d)).select(
             F.round("area", 3).alias("area"), r6("cx").alias("cx"), r6("cy").alias("cy")),
         f"{sql.base(POLYGON)}, a AS (SELECT obj_id, sum({_cross}) / 2 AS a, sum((x1 + x2) * {_cross}) / 6 AS mx, sum((y1 + y2) * {_cross}) / 6 AS my "
         "FROM poly_edges WHERE e < 20 GROUP BY obj_id) SELECT round(sum(abs(a)), 3) AS area, round(sum(mx * sign(a)) / sum(abs(a)), 6) AS cx, "
         "round(sum(my * sign(a)) / sum(abs(a)), 6) AS cy FROM a")
_jump = sql.dist("x", "y", "lag(x) OVER w", "lag(y) OVER w")
register("app10_track_segments",
         lambda s, d: apps.track_segments(fx.pts(s, d), 20.0).select("event_id", "obj_id", "track"),
         f"{sql.base()}, j AS (SELECT event_id, obj_id, ts, CASE WHEN {_jump} > 20 THEN 1 ELSE 0 END AS jump FROM pts WINDOW w AS (PARTITION BY obj_id ORDER BY ts)) "
         "SELECT event_id, obj_id, CAST(sum(jump) OVER (PARTITION BY obj_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS BIGINT) AS track FROM j")


def _shifted(spark, sf_dir):
    """Points relative to the centroid of all polygons."""
    c = apps.centroid(fx.polys(spark, sf_dir))
    points = fx.pts(spark, sf_dir).withColumn("_c", c.select(F.struct("cx", "cy")).scalar())
    out = apps.shift(points, F.col("_c.cx"), F.col("_c.cy"))
    return out.select("event_id", F.round("x", 5).alias("x"), F.round("y", 5).alias("y"))


register("app10_shift_to_centroid", _shifted,
         f"{sql.base(POLYGON)}, a AS (SELECT obj_id, sum({_cross}) / 2 AS a, sum((x1 + x2) * {_cross}) / 6 AS mx, sum((y1 + y2) * {_cross}) / 6 AS my "
         "FROM poly_edges WHERE e < 20 GROUP BY obj_id), m AS (SELECT sum(mx * sign(a)) / sum(abs(a)) AS cx, sum(my * sign(a)) / sum(abs(a)) AS cy FROM a) "
         "SELECT event_id, round(x - cx, 5) AS x, round(y - cy, 5) AS y FROM pts, m")
