"""Spatial tables to text records, and the sinks they go to.

The encoders take ``obj_id, ts, geom_type, parts`` (see ``text``) and return one
``value`` column, which any Spark sink writes.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import Optional

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DATE_FORMAT = "yyyy-MM-dd HH:mm:ss"  # fixed value

# fixed values: GeoJSON names of the geometry types
GEOJSON_NAMES = {
    "POINT": "Point", "MULTIPOINT": "MultiPoint", "LINESTRING": "LineString",
    "MULTILINESTRING": "MultiLineString", "POLYGON": "Polygon", "MULTIPOLYGON": "MultiPolygon"}


def as_points(df: DataFrame) -> DataFrame:
    """``x, y`` rows as POINT geometries."""
    parts = "array(array(array(named_struct('x', x, 'y', y))))"
    return df.selectExpr("*", "'POINT' AS geom_type", f"{parts} AS parts")


def as_polygons(df: DataFrame) -> DataFrame:
    return df.selectExpr("*", "'POLYGON' AS geom_type", "array(rings) AS parts")


def as_lines(df: DataFrame) -> DataFrame:
    return df.selectExpr("*", "IF(size(paths) > 1, 'MULTILINESTRING', 'LINESTRING') AS geom_type",
                         "array(paths) AS parts")


# -- GeoJSON -----------------------------------------------------------------------
def _coordinates_json(kind: str, parts: str) -> str:
    pair = "array(v.x, v.y)"
    path = f"transform(p, v -> {pair})"
    shapes = {
        "POINT": "array({0}[0][0][0].x, {0}[0][0][0].y)",
        "MULTIPOINT": "transform(flatten({0}[0]), v -> " + pair + ")",
        "LINESTRING": "transform({0}[0][0], v -> " + pair + ")",
        "MULTILINESTRING": "transform({0}[0], p -> " + path + ")",
        "POLYGON": "transform({0}[0], p -> " + path + ")",
        "MULTIPOLYGON": "transform({0}, q -> transform(q, p -> " + path + "))"}
    whens = " ".join(f"WHEN '{k}' THEN to_json({v.format(parts)})" for k, v in shapes.items())
    return f"CASE {kind} {whens} END"


def _geojson_name(kind: str) -> str:
    return f"CASE {kind} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in GEOJSON_NAMES.items()) + " END"


def _geometry_json(kind: str, parts: str) -> str:
    return (f"concat('{{\"coordinates\":', {_coordinates_json(kind, parts)}, ',\"type\":\"', "
            f"{_geojson_name(kind)}, '\"}}')")


def _properties_json(date_format: str) -> str:
    """Missing id or time are left out, and so are empty properties."""
    props = f"to_json(named_struct('oID', obj_id, 'timestamp', date_format(ts, '{date_format}')))"
    return f"IF(obj_id IS NULL AND ts IS NULL, '', concat(',\"properties\":', {props}))"


def to_geojson(df: DataFrame, date_format: str = DATE_FORMAT) -> DataFrame:
    return df.select(F.expr(
        f"concat('{{\"geometry\":', {_geometry_json('geom_type', 'parts')}, "
        f"{_properties_json(date_format)}, ',\"type\":\"Feature\"}}')").alias("value"))


def to_geojson_collection(df: DataFrame, date_format: str = DATE_FORMAT) -> DataFrame:
    """``members ARRAY<STRUCT<geom_type, parts>>`` per row as a GeometryCollection."""
    members = f"array_join(transform(members, m -> {_geometry_json('m.geom_type', 'm.parts')}), ',')"
    return df.select(F.expr(
        f"concat('{{\"geometry\":{{\"geometries\":[', {members}, '],\"type\":\"GeometryCollection\"}}', "
        f"{_properties_json(date_format)}, ',\"type\":\"Feature\"}}')").alias("value"))


# -- WKT -----------------------------------------------------------------------------
def wkt_sql(kind: str, parts: str) -> str:
    xy = "concat_ws(' ', v.x, v.y)"
    path = f"concat('(', array_join(transform(p, v -> {xy}), ', '), ')')"

    def rings(part: str, sep: str) -> str:
        return f"concat('(', array_join(transform({part}, p -> {path}), '{sep}'), ')')"

    shapes = {
        "POINT": "concat('(', {0}[0][0][0].x, ' ', {0}[0][0][0].y, ')')".format(parts),
        "MULTIPOINT": rings(f"{parts}[0]", ", "),
        "LINESTRING": f"concat('(', array_join(transform({parts}[0][0], v -> {xy}), ', '), ')')",
        "MULTILINESTRING": rings(f"{parts}[0]", ","),
        "POLYGON": rings(f"{parts}[0]", ", "),
        "MULTIPOLYGON": f"concat('(', array_join(transform({parts}, q -> {rings('q', ',')}), ','), ')')"}
    whens = " ".join(f"WHEN '{k}' THEN {v}" for k, v in shapes.items())
    return f"concat({kind}, CASE {kind} {whens} END)"


def _record(body: str, delimiter: str, date_format: str) -> Column:
    """``"id, GEOMETRY, time",`` with missing id or time left out."""
    sep = delimiter.replace("\t", "\\t")
    return F.expr(f"concat('\"', concat_ws('{sep} ', obj_id, {body}, date_format(ts, '{date_format}')), '\"{sep}')")


def to_wkt(df: DataFrame, delimiter: str = ",", date_format: str = DATE_FORMAT) -> DataFrame:
    return df.select(_record(wkt_sql("geom_type", "parts"), delimiter, date_format).alias("value"))


def to_wkt_collection(df: DataFrame, delimiter: str = ",", date_format: str = DATE_FORMAT) -> DataFrame:
    members = f"array_join(transform(members, m -> {wkt_sql('m.geom_type', 'm.parts')}), ', ')"
    body = f"concat('GEOMETRYCOLLECTION(', {members}, ')')"
    return df.select(_record(body, delimiter, date_format).alias("value"))


def collect_members(df: DataFrame, order: str = "member") -> DataFrame:
    """Rows of one collection (same obj_id and ts) back to a ``members`` array."""
    m = F.struct(order, F.struct("geom_type", "parts").alias("m"))
    return df.groupBy("obj_id", "ts").agg(F.array_sort(F.collect_list(m)).alias("_m")).select(
        "obj_id", "ts", F.transform("_m", lambda v: v["m"]).alias("members"))


# -- CSV / TSV -------------------------------------------------------------------------
def to_delimited(df: DataFrame, delimiter: str = ",",
                 positions: Sequence[int] = (0, 1, 2, 3)) -> DataFrame:
    """Points by position; positions without a field get ``0``."""
    field = dict(zip(positions, ("coalesce(obj_id, 'null')", "coalesce(unix_millis(ts), 0)", "x", "y")))
    cells = ", ".join(f"string({field.get(i, '0')})" for i in range(max(positions) + 1))
    sep = delimiter.replace("\t", "\\t")
    return df.select(F.expr(f"array_join(array({cells}), '{sep}', 'null')").alias("value"))


# -- sinks -----------------------------------------------------------------------------
def kafka_options(servers: str, topic: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": servers, "topic": topic}


def write_kafka(df: DataFrame, servers: str, topic: str, checkpoint: Optional[str] = None):
    """Write ``value`` to a topic; starts a query for a stream."""
    out = df.select(F.col("value").cast("string"))
    options = kafka_options(servers, topic)
    if df.isStreaming:
        return (out.writeStream.format("kafka").options(**options)
                .option("checkpointLocation", checkpoint).outputMode("append").start())
    return out.write.format("kafka").options(**options).save()


def write_console(df: DataFrame, checkpoint: Optional[str] = None):
    if not df.isStreaming:
        return df.show(truncate=False)
    writer = df.writeStream.format("console").option("truncate", "false")
    return (writer.option("checkpointLocation", checkpoint) if checkpoint else writer).start()


def write_sorted_text(df: DataFrame, path: str, by: str, value: str = "value") -> None:
    """Overwrite ``path`` with text in global order.

    The sort is range-partitioned, so the part files are in order one after another and
    no task handles all lines.
    """
    df.orderBy(by).select(value).write.mode("overwrite").text(path)


def with_ingestion_latency(df: DataFrame, ingested: str, now: Optional[Column] = None) -> DataFrame:
    """``latency_ms`` since ingestion, written like any other column."""
    now = F.current_timestamp() if now is None else now
    return df.withColumn("latency_ms", F.unix_millis(now) - F.unix_millis(F.col(ingested)))
