"""Registered parse and emit queries: tables to text and back."""

from __future__ import annotations

import struct
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import functions as F

from ..functions.geometry import LINE, POLYGON
from ..session import work_dir
from ..sources import binary, emit, readers, text
from . import fixtures as fx
from . import sql
from .registry import r6, register

FORMAT = emit.DATE_FORMAT
TIME_SQL = "strftime(ts, '%Y-%m-%d %H:%M:%S')"
XY = "array<array<array<struct<x:double,y:double>>>>"


# -- tables in emit form -----------------------------------------------------------
def _points(s, d):
    return emit.as_points(fx.pts(s, d))


def _multipoints(s, d):
    return fx.pts(s, d).selectExpr(
        "obj_id", "ts", "x", "y", "event_id", "'MULTIPOINT' AS geom_type",
        "array(array(array(named_struct('x', x, 'y', y)), array(named_struct('x', x + 1, 'y', y + 2)))) AS parts")


def _polygons(s, d):
    return emit.as_polygons(fx.polys(s, d))


def _multipolygons(s, d):
    moved = "transform(rings, p -> transform(p, v -> named_struct('x', v.x + 50, 'y', v.y)))"
    return fx.polys(s, d).selectExpr("obj_id", "ts", "'MULTIPOLYGON' AS geom_type", f"array(rings, {moved}) AS parts")


def _lines(s, d):
    return emit.as_lines(fx.lines(s, d))


def _multilines(s, d):
    moved = "transform(paths[0], v -> named_struct('x', v.x + 50, 'y', v.y))"
    return emit.as_lines(fx.lines(s, d).selectExpr("obj_id", "ts", f"array(paths[0], {moved}) AS paths"))


def _collections(s, d):
    """A point, a line and a polygon per signup event."""
    p = "paths[0][0]"
    return fx.lines(s, d).selectExpr(
        "obj_id", "ts",
        f"array(named_struct('geom_type', 'POINT', 'parts', array(array(array({p})))), "
        "named_struct('geom_type', 'LINESTRING', 'parts', array(paths)), "
        f"named_struct('geom_type', 'POLYGON', 'parts', array(array(concat(paths[0], array({p})))))) AS members")


# -- what is compared: id, time, and size and sums of the coordinates ----------------
def _digest(df, *extra):
    v = "flatten(flatten(parts))"
    total = lambda c: f"aggregate({v}, 0D, (a, p) -> a + p.{c})"
    return df.selectExpr("obj_id", *extra, f"date_format(ts, '{FORMAT}') AS time", "geom_type",
                         "bigint(size(parts)) AS n_parts", f"bigint(size({v})) AS n_vertices",
                         f"round({total('x')}, 4) AS sum_x", f"round({total('y')}, 4) AS sum_y",
                         "round(parts[0][0][0].x, 6) AS first_x", "round(parts[0][0][0].y, 6) AS first_y")


def _digest_sql(geom_type, n_parts, n, sx, sy, fx_, fy, extra=""):
    return (f"SELECT obj_id, {extra}{TIME_SQL} AS time, '{geom_type}' AS geom_type, CAST({n_parts} AS BIGINT) AS n_parts, "
            f"CAST({n} AS BIGINT) AS n_vertices, round({sx}, 4) AS sum_x, round({sy}, 4) AS sum_y, "
            f"round({fx_}, 6) AS first_x, round({fy}, 6) AS first_y")


POINT_SQL = f"{sql.base()} " + _digest_sql("POINT", 1, 1, "x", "y", "x", "y") + " FROM pts"
MULTIPOINT_SQL = f"{sql.base()} " + _digest_sql("MULTIPOINT", 1, 2, "2 * x + 1", "2 * y + 2", "x", "y") + " FROM pts"
# shells first: 5 vertices per ring, the first one repeated
_n = "CASE WHEN k = 2 THEN 10 ELSE 5 END"
_rings = "CASE WHEN k = 2 THEN 2 ELSE 1 END"
_s = "CASE WHEN k = 2 THEN h * 2 ELSE h END"
_fx = f"CASE WHEN k = 1 THEN x ELSE x - {_s} END"
_fy = f"CASE WHEN k = 1 THEN y - h ELSE y - {_s} END"
_sx = "CASE k WHEN 0 THEN 5 * x - h WHEN 1 THEN 5 * x ELSE 10 * x - 3 * h END"
_sy = "CASE k WHEN 0 THEN 5 * y - h WHEN 1 THEN 5 * y - h ELSE 10 * y - 3 * h END"
POLYGON_SQL = f"{sql.base(POLYGON)} " + _digest_sql("POLYGON", 1, _n, _sx, _sy, _fx, _fy) + " FROM polys"
MULTIPOLYGON_SQL = (f"{sql.base(POLYGON)} " + _digest_sql(
    "MULTIPOLYGON", 2, f"2 * ({_n})", f"2 * ({_sx}) + 50 * ({_n})", f"2 * ({_sy})", _fx, _fy) + " FROM polys")
_lx, _ly = "xa + 2 * xb", "ya + yb + yc"
LINE_SQL = f"{sql.base(LINE)} " + _digest_sql("LINESTRING", 1, 3, _lx, _ly, "xa", "ya") + " FROM lines"
MULTILINE_SQL = (f"{sql.base(LINE)} " + _digest_sql(
    "MULTILINESTRING", 1, 6, f"2 * ({_lx}) + 150", f"2 * ({_ly})", "xa", "ya") + " FROM lines")
COLLECTION_SQL = (
    f"{sql.base(LINE)} " + _digest_sql("POINT", 1, 1, "xa", "ya", "xa", "ya", "0 AS member, ") + " FROM lines UNION ALL "
    + _digest_sql("LINESTRING", 1, 3, _lx, _ly, "xa", "ya", "1 AS member, ") + " FROM lines UNION ALL "
    + _digest_sql("POLYGON", 1, 4, f"{_lx} + xa", f"{_ly} + ya", "xa", "ya", "2 AS member, ") + " FROM lines")

FORMS = (  # name, table, check, ids of the parse and emit queries by format
    ("point", _points, POINT_SQL, ("par2", "snk4"), ("par4", "snk5")),
    ("polygon", _polygons, POLYGON_SQL, ("par7", "snk7"), ("par9", "snk8")),
    ("multipolygon", _multipolygons, MULTIPOLYGON_SQL, ("par7", "snk7"), ("par9", "snk8")),
    ("line", _lines, LINE_SQL, ("par11", "snk9"), ("par12", "snk10")),
    ("multiline", _multilines, MULTILINE_SQL, ("par11", "snk9"), ("par12", "snk10")),
    ("multipoint", _multipoints, MULTIPOINT_SQL, ("par15", "snk13"), ("par16", "snk14")),
)
for name, table, check, (pj, sj), (pw, sw) in FORMS:
    register(f"{pj}_{sj}_geojson_{name}", lambda s, d, t=table: _digest(
        text.parse_geojson(emit.to_geojson(t(s, d)))), check)
    register(f"{pw}_{sw}_wkt_{name}", lambda s, d, t=table: _digest(
        text.parse_wkt(emit.to_wkt(t(s, d)))), check)
register("par13_snk11_geojson_collection", lambda s, d: _digest(
    text.parse_geojson_collection(emit.to_geojson_collection(_collections(s, d))), "member"), COLLECTION_SQL)
register("par14_snk12_wkt_collection", lambda s, d: _digest(
    text.parse_wkt_collection(emit.to_wkt_collection(_collections(s, d))), "member"), COLLECTION_SQL)

# -- records without id and time -------------------------------------------------------
_xy_sql = f"{sql.base()} SELECT round(x, 6) AS x, round(y, 6) AS y, count(*) AS n FROM pts GROUP BY 1, 2"


def _xy(points):
    return points.groupBy(r6("x").alias("x"), r6("y").alias("y")).agg(F.count(F.lit(1)).alias("n"))


def _bare(s, d):
    return _points(s, d).withColumns({"obj_id": F.lit(None).cast("string"), "ts": F.lit(None).cast("timestamp")})


def _envelope(s, d):
    rows = emit.to_geojson(_points(s, d))
    return readers.as_envelope(rows.select(F.lit("1").alias("key"), "value"))


register("par1_geojson_point_envelope", lambda s, d: _xy(text.points(text.parse_geojson(_envelope(s, d)))), _xy_sql)
register("par3_wkt_point_bare", lambda s, d: _xy(text.points(text.parse_wkt(emit.to_wkt(_bare(s, d))))), _xy_sql)
register("par5_csv_point_xy", lambda s, d: _xy(text.parse_delimited(
    fx.pts(s, d).selectExpr("concat_ws(' , ', 'a', 'b', x, y) AS value"))), _xy_sql)


def _polygon_csv(s, d):
    """A CSV cell holding the WKT of a polygon."""
    quoted = emit.to_wkt(_polygons(s, d)).select(F.concat(F.lit("17;"), "value").alias("value"))
    parsed = text.parse_wkt(quoted, delimiter=";")
    return _digest(parsed).drop("obj_id", "time")


register("par8_par10_wkt_polygon_in_csv", _polygon_csv,
         f"SELECT * EXCLUDE (obj_id, time) FROM ({POLYGON_SQL})")

# -- delimited -------------------------------------------------------------------------
_csv_cols = ["obj_id", "unix_millis(ts) AS ts_ms", "round(x, 6) AS x", "round(y, 6) AS y"]
_csv_sql = f"{sql.base()} SELECT obj_id, ts_ms, round(x, 6) AS x, round(y, 6) AS y FROM pts"
for delim, positions, name in ((",", (0, 1, 2, 3), "csv"), ("\t", (1, 0, 2, 3), "tsv"), (",", (4, 0, 2, 1), "csv_gaps")):
    register(f"par6_snk6_{name}", lambda s, d, c=delim, p=positions: text.parse_delimited(
        emit.to_delimited(fx.pts(s, d), c, p), delimiter=c, positions=p).selectExpr(*_csv_cols), _csv_sql)

# -- exact text ------------------------------------------------------------------------
register("snk4_geojson_text", lambda s, d: emit.to_geojson(_points(s, d)),
         f"{sql.base()} SELECT '{{\"geometry\":{{\"coordinates\":[' || x || ',' || y || '],\"type\":\"Point\"}},\"properties\":{{\"oID\":\"' || obj_id || "
         f"'\",\"timestamp\":\"' || {TIME_SQL} || '\"}},\"type\":\"Feature\"}}' AS value FROM pts")
register("snk5_wkt_text", lambda s, d: emit.to_wkt(_points(s, d)),
         f"{sql.base()} SELECT '\"' || obj_id || ', POINT(' || x || ' ' || y || '), ' || {TIME_SQL} || '\",' AS value FROM pts")
register("snk6_csv_text", lambda s, d: emit.to_delimited(fx.pts(s, d), ",", (4, 0, 2, 1)),
         f"{sql.base()} SELECT ts_ms || ',' || y || ',' || x || ',0,' || obj_id AS value FROM pts")
register("snk10_wkt_line_text", lambda s, d: emit.to_wkt(_lines(s, d)),
         f"{sql.base(LINE)} SELECT '\"' || obj_id || ', LINESTRING(' || xa || ' ' || ya || ', ' || xb || ' ' || yb || ', ' || xb || ' ' || yc || '), ' || {TIME_SQL} || '\",' AS value FROM lines")


# -- files -----------------------------------------------------------------------------
def _file_round_trip(spark, sf_dir):
    path = work_dir(spark, "points-csv")
    emit.write_sorted_text(emit.to_delimited(fx.pts(spark, sf_dir)), path, "value")
    return text.parse_delimited(readers.text_file(spark, path)).selectExpr(*_csv_cols)


register("src3_snk3_text_file", _file_round_trip, _csv_sql)


def _latency(spark, sf_dir):
    as_of = F.lit("2024-02-01 00:00:00").cast("timestamp")
    rows = fx.pts(spark, sf_dir).withColumn("ingest_ts", F.col("ts"))
    return emit.with_ingestion_latency(rows, "ingest_ts", as_of).select("event_id", "latency_ms")


register("snk16_latency", _latency,
         f"{sql.base()} SELECT event_id, epoch_us(TIMESTAMP '2024-02-01') // 1000 - ts_ms AS latency_ms FROM pts")


# -- binary geometry made from the polygons ----------------------------------------------
def _wkb_hex(rings) -> str:
    out = struct.pack("<BIII", 1, 3 | binary.SRID_FLAG, 4326, len(rings))
    for ring in rings:
        out += struct.pack("<I", len(ring)) + b"".join(struct.pack("<dd", v["x"], v["y"]) for v in ring)
    return out.hex().upper()


def _encode_wkb(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        yield pd.DataFrame({"name": b["obj_id"], "id": b["obj_id"].astype("int32"),
                            "geom": [_wkb_hex(r) for r in b["rings"]]})


def _parcels(s, d):
    table = fx.polys(s, d).select("obj_id", "rings").mapInPandas(_encode_wkb, "name string, id int, geom string")
    return binary.parse_parcels(table)


def _geometry_digest(df, *lead):
    v = "flatten(rings)"
    total = lambda c: f"aggregate({v}, 0D, (a, p) -> a + p.{c})"
    return df.selectExpr(*lead, f"bigint(size({v})) AS n_vertices", f"round({total('x')}, 4) AS sum_x",
                         f"round({total('y')}, 4) AS sum_y", "round(xmin, 6) AS xmin", "round(ymax, 6) AS ymax")


_box = f"round(x - {_s}, 6) AS xmin, round(y + {_s}, 6) AS ymax"
register("src5_parcels", lambda s, d: _geometry_digest(_parcels(s, d), "name"),
         f"{sql.base(POLYGON)} SELECT obj_id AS name, CAST({_n} AS BIGINT) AS n_vertices, round({_sx}, 4) AS sum_x, round({_sy}, 4) AS sum_y, {_box} FROM polys")


def _shp_record(number: int, rings) -> bytes:
    xy = [(v["x"], v["y"]) for r in rings for v in r]
    starts = [sum(len(r) for r in rings[:i]) for i in range(len(rings))]
    xs, ys = zip(*xy)
    body = struct.pack("<i4dii", 5, min(xs), min(ys), max(xs), max(ys), len(rings), len(xy))
    body += struct.pack(f"<{len(starts)}i", *starts) + b"".join(struct.pack("<dd", *p) for p in xy)
    return struct.pack(">ii", number, len(body) // 2) + body


def shapefile(records: list) -> bytes:
    """One shapefile of polygons (lists of rings)."""
    body = b"".join(_shp_record(i + 1, r) for i, r in enumerate(records))
    head = struct.pack(">7i", binary.FILE_CODE, 0, 0, 0, 0, 0, (binary.HEADER_BYTES + len(body)) // 2)
    return head + struct.pack("<ii8d", 1000, 5, *[0.0] * 8) + body


def _encode_shapefiles(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:  # one file per batch of rows
        yield pd.DataFrame({"path": [b["obj_id"].iloc[0]], "content": [shapefile(list(b["rings"]))]})


def _shapefiles(s, d):
    files = fx.polys(s, d).select("obj_id", "rings").mapInPandas(_encode_shapefiles, "path string, content binary")
    return text.polygons(binary.shapes_of(files))


register("src4_shapefiles",
         lambda s, d: _geometry_digest(_shapefiles(s, d)),
         f"{sql.base(POLYGON)} SELECT CAST({_n} AS BIGINT) AS n_vertices, round({_sx}, 4) AS sum_x, round({_sy}, 4) AS sum_y, {_box} FROM polys")
