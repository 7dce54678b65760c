"""Text records to spatial tables: GeoJSON, WKT, CSV and TSV.

Every parser takes a DataFrame (batch or stream) with a string column and returns

    obj_id STRING, ts TIMESTAMP, geom_type STRING, parts ARRAY<ARRAY<ARRAY<STRUCT<x,y>>>>

``parts`` holds the polygons of a geometry, each a list of rings; for lines one part
with all paths, for points one part with a single-vertex path per point. What cannot be
read is NULL; rows are never dropped.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import Optional

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import geometry as G

# fixed values: geometry type names
TYPES = ("POINT", "MULTIPOINT", "LINESTRING", "MULTILINESTRING", "POLYGON", "MULTIPOLYGON",
         "GEOMETRYCOLLECTION")
POINT_TYPES = TYPES[0:2]
LINE_TYPES = TYPES[2:4]
POLYGON_TYPES = TYPES[4:6]

# JSON nesting of the coordinates, and how they become parts
_DEPTH = {"POINT": 1, "MULTIPOINT": 2, "LINESTRING": 2, "MULTILINESTRING": 3,
          "POLYGON": 3, "MULTIPOLYGON": 4}

GEOMETRY_SCHEMA = "type string, coordinates string, geometries array<struct<type:string,coordinates:string>>"
FEATURE_SCHEMA = f"{GEOMETRY_SCHEMA}, geometry struct<{GEOMETRY_SCHEMA}>, properties map<string,string>"


def _xy(v: str) -> str:
    return f"named_struct('x', get({v}, 0), 'y', get({v}, 1))"


def _nested(text: str, depth: int) -> str:
    return f"from_json({text}, '{'array<' * depth}double{'>' * depth}')"


def parts_sql(kind: str, text: str) -> str:
    """Parts of a geometry whose upper-case type is ``kind`` from its JSON coordinates."""
    def case(name: str) -> str:
        c = _nested(text, _DEPTH[name])
        if name == "POINT":
            return f"transform(array({c}), v -> array(array({_xy('v')})))"
        if name == "MULTIPOINT":
            return f"array(transform({c}, v -> array({_xy('v')})))"
        if name == "LINESTRING":
            return f"array(array(transform({c}, v -> {_xy('v')})))"
        if name in ("MULTILINESTRING", "POLYGON"):
            return f"array(transform({c}, p -> transform(p, v -> {_xy('v')})))"
        return f"transform({c}, q -> transform(q, p -> transform(p, v -> {_xy('v')})))"
    whens = " ".join(f"WHEN '{n}' THEN {case(n)}" for n in _DEPTH)
    return f"CASE WHEN {text} IS NOT NULL THEN CASE {kind} {whens} END END"


def _time_sql(text: str, date_format: Optional[str]) -> str:
    millis = f"timestamp_millis(try_cast({text} AS bigint))"
    if date_format is None:
        return millis
    return f"coalesce(try_to_timestamp({text}, '{date_format}'), {millis})"


def _finish(df: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Close polygon rings and put the shell first."""
    ordered = F.when(F.col("geom_type").isin(*POLYGON_TYPES),
                     F.transform("parts", G.order_rings)).otherwise(F.col("parts"))
    return G.once(df, _parts=ordered).select(*keep, F.col("_parts").alias("parts"))


# -- GeoJSON -----------------------------------------------------------------------
def _features(df: DataFrame, column: str) -> DataFrame:
    """The feature of each record, bare or in a ``{"key":..., "value":...}`` envelope."""
    j = F.from_json(F.col(column), f"{FEATURE_SCHEMA}, value struct<{FEATURE_SCHEMA}>")
    out = G.once(df, _j=j)
    f = {name: F.coalesce(F.col(f"_j.value.{name}"), F.col(f"_j.{name}"))
         for name in ("type", "coordinates", "geometries", "geometry", "properties")}
    # a record without a feature is a bare geometry
    whole = F.struct(f["type"].alias("type"), f["coordinates"].alias("coordinates"),
                     f["geometries"].alias("geometries"))
    return out.withColumns({"_g": F.coalesce(f["geometry"], whole), "_p": f["properties"]}).drop("_j")


def _with_id_and_time(df: DataFrame, oid: str, time: str, date_format: Optional[str]) -> DataFrame:
    return df.withColumns({
        "obj_id": F.expr(f"replace(_p['{oid}'], '\"', '')"),
        "ts": F.expr(_time_sql(f"_p['{time}']", date_format))})


def parse_geojson(df: DataFrame, column: str = "value", *, oid: str = "oID", time: str = "timestamp",
                  date_format: Optional[str] = "yyyy-MM-dd HH:mm:ss") -> DataFrame:
    rows = _with_id_and_time(_features(df, column), oid, time, date_format)
    rows = rows.withColumn("geom_type", F.upper("_g.type"))
    rows = G.once(rows, parts=F.expr(parts_sql("geom_type", "_g.coordinates")))
    return _finish(rows, ["obj_id", "ts", "geom_type"])


def parse_geojson_collection(df: DataFrame, column: str = "value", *, oid: str = "oID",
                             time: str = "timestamp",
                             date_format: Optional[str] = "yyyy-MM-dd HH:mm:ss") -> DataFrame:
    """One row per member of a geometry collection, numbered by ``member``."""
    rows = _with_id_and_time(_features(df, column), oid, time, date_format)
    rows = rows.select("obj_id", "ts", F.posexplode("_g.geometries").alias("member", "_m"))
    rows = rows.withColumn("geom_type", F.upper("_m.type"))
    rows = G.once(rows, parts=F.expr(parts_sql("geom_type", "_m.coordinates")))
    return _finish(rows, ["obj_id", "ts", "member", "geom_type"])


# -- WKT -----------------------------------------------------------------------------
_NUMBER = r"[-+]?[0-9.]+(?:[eE][-+]?[0-9]+)?"
_KEYWORD = ("(?i)(GEOMETRYCOLLECTION|MULTIPOLYGON|MULTILINESTRING|MULTIPOINT|POLYGON|"
            r"LINESTRING|POINT)\\s*(?:ZM|Z|M)?\\s*(\\(.*\\)|EMPTY)")
_MEMBER = (r"(?i)(?:MULTIPOLYGON|MULTILINESTRING|MULTIPOINT|POLYGON|LINESTRING|POINT)"
           r"\\s*(?:ZM|Z|M)?\\s*\\([-+0-9.eE,()\\s]*\\)")


def _wkt_json(body: str, kind: str) -> str:
    """WKT coordinates as JSON text; a bare MULTIPOINT loses nothing by the same rule."""
    number = _NUMBER.replace("\\", "\\\\")
    pairs = (f"regexp_replace({body}, '({number})\\\\s+({number})(?:\\\\s+{number}){{0,2}}', '[$1,$2]')")
    flat = f"regexp_replace({pairs}, '[\\\\s()]', '')"
    nested = f"translate(regexp_replace({pairs}, '\\\\s', ''), '()', '[]')"
    single = f"regexp_extract({flat}, '(\\\\[.*\\\\])', 1)"
    return (f"CASE {kind} WHEN 'POINT' THEN {single} WHEN 'MULTIPOINT' THEN concat('[', {flat}, ']') "
            f"ELSE {nested} END")


def _wkt_fields(df: DataFrame, column: str, delimiter: str, date_format: Optional[str]) -> DataFrame:
    """Split a record into id, geometry and time.

    The id is what stands before the geometry (none without a geometry); the time is the last field behind it (or
    anywhere) that reads as one.
    """
    sep = {"\t": "\\\\t"}.get(delimiter, delimiter.replace("|", "\\\\|"))
    rows = df.withColumn("_s", F.regexp_replace(F.col(column), '"', ""))
    rows = rows.withColumns({
        "geom_type": F.expr(f"upper(nullif(regexp_extract(_s, '{_KEYWORD}', 1), ''))"),
        "_body": F.expr(f"nullif(upper(regexp_extract(_s, '{_KEYWORD}', 2)), 'EMPTY')"),
        "_before": F.expr(f"regexp_replace(_s, '{_KEYWORD}.*$', '')"),
        "_fields": F.expr(f"reverse(split(_s, '\\\\s*{sep}\\\\s*'))")})
    # only text in the date format counts: plain numbers may be coordinates
    stamp = (F.expr(f"get(filter(transform(_fields, f -> try_to_timestamp(trim(f), '{date_format}')), "
                    "t -> t IS NOT NULL), 0)")
             if date_format else F.lit(None).cast("timestamp"))
    return rows.withColumns({
        "obj_id": F.expr(f"IF(geom_type IS NULL, NULL, nullif(trim(get(split(_before, '{sep}'), 0)), ''))"),
        "ts": stamp})


def parse_wkt(df: DataFrame, column: str = "value", *, delimiter: str = ",",
              date_format: Optional[str] = "yyyy-MM-dd HH:mm:ss") -> DataFrame:
    rows = _wkt_fields(df, column, delimiter, date_format)
    rows = G.once(rows, _c=F.expr(_wkt_json("_body", "geom_type")))
    rows = G.once(rows, parts=F.expr(parts_sql("geom_type", "_c")))
    return _finish(rows, ["obj_id", "ts", "geom_type"])


def parse_wkt_collection(df: DataFrame, column: str = "value", *, delimiter: str = ",",
                         date_format: Optional[str] = "yyyy-MM-dd HH:mm:ss") -> DataFrame:
    """One row per member of a geometry collection, numbered by ``member``."""
    rows = _wkt_fields(df, column, delimiter, date_format)
    rows = rows.withColumn("_all", F.expr(f"regexp_extract_all(_body, '{_MEMBER}', 0)"))
    rows = rows.select("obj_id", "ts", F.posexplode("_all").alias("member", "_m"))
    # the last member also takes the closing bracket of the collection
    surplus = F.expr("length(replace(_m, '(', '')) < length(replace(_m, ')', ''))")
    rows = rows.withColumn("_m", F.when(surplus, F.expr("left(_m, length(_m) - 1)")).otherwise(F.col("_m")))
    rows = rows.withColumns({
        "geom_type": F.expr(f"upper(regexp_extract(_m, '{_KEYWORD}', 1))"),
        "_body": F.expr(f"regexp_extract(_m, '{_KEYWORD}', 2)")})
    rows = G.once(rows, _c=F.expr(_wkt_json("_body", "geom_type")))
    rows = G.once(rows, parts=F.expr(parts_sql("geom_type", "_c")))
    return _finish(rows, ["obj_id", "ts", "member", "geom_type"])


# -- CSV / TSV -------------------------------------------------------------------------
def parse_delimited(df: DataFrame, column: str = "value", *, delimiter: str = ",",
                    positions: Sequence[int] = (0, 1, 2, 3)) -> DataFrame:
    """Points from delimited text; ``positions`` are those of id, time (ms), x and y."""
    sep = {"\t": "\\t"}.get(delimiter, "\\" + delimiter if delimiter in "|.*+?^$" else delimiter)
    rows = df.withColumn("_f", F.split(F.regexp_replace(F.col(column), '"', ""), rf"\s*{sep}\s*"))
    oid, time, x, y = (f"trim(get(_f, {i}))" for i in positions)
    return rows.selectExpr(f"nullif({oid}, '') AS obj_id",
                           f"timestamp_millis(try_cast({time} AS bigint)) AS ts",
                           f"try_cast({x} AS double) AS x", f"try_cast({y} AS double) AS y")


# -- parsed geometry to the tables the operators take ------------------------------------
def points(parsed: DataFrame) -> DataFrame:
    """``x, y`` of POINT records; MULTIPOINT records give one row per vertex."""
    keep = [c for c in parsed.columns if c not in ("parts", "geom_type")]
    rows = parsed.filter(F.col("geom_type").isin(*POINT_TYPES))
    return rows.select(*keep, F.explode(F.flatten(F.flatten("parts"))).alias("_v")).select(
        *keep, "_v.x", "_v.y")


def polygons(parsed: DataFrame) -> DataFrame:
    """Polygon table (``rings`` of all parts, edges, bounding box)."""
    rows = parsed.filter(F.col("geom_type").isin(*POLYGON_TYPES))
    return G.with_edges(rows.withColumn("rings", F.flatten("parts")).drop("parts"), "rings")


def lines(parsed: DataFrame) -> DataFrame:
    """Line table (``paths`` of all parts, edges, bounding box)."""
    rows = parsed.filter(F.col("geom_type").isin(*LINE_TYPES))
    return G.with_edges(rows.withColumn("paths", F.flatten("parts")).drop("parts"), "paths")
