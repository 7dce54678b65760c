"""Applications composed of the operators."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Optional

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geometry as G
from ..functions import ordered
from ..functions.geometry import QueryGeometry
from ..functions.grid import Grid, cell_id
from ..functions.windows import WindowSpec, with_window
from . import cells, knn
from .ranges import Queries, range_query


# -- check-in and room occupancy ---------------------------------------------
def opposite(device: Column) -> Column:
    room = F.substring_index(device, "-", 1)
    return F.concat(room, F.when(F.endswith(device, F.lit("-in")), "-out").otherwise("-in"))


def fill_checkins(events: DataFrame, *, tie: Sequence[str] = ("event_id",),
                  hot_rows: Optional[int] = ordered.HOT_ROWS) -> DataFrame:
    """Insert the missing opposite event between two equal consecutive ones of a user.

    The inserted event lies halfway in time, takes the place of the later event and is
    marked ``synthetic``.
    """
    rows = ordered.drop_slices(ordered.previous(
        events, ["user_id"], ["device_id", "ts"], tie=tie, hot_rows=hot_rows))
    return insert_opposites(rows)


def insert_opposites(rows: DataFrame) -> DataFrame:
    """The rows, with a synthetic one before each that repeats the device in ``prev``."""
    middle = F.timestamp_millis(F.floor(
        (F.unix_millis("prev.ts") + F.unix_millis("ts")) / 2).cast("long"))
    own = F.struct(F.col("device_id").alias("device_id"), F.col("ts").alias("ts"),
                   F.lit(False).alias("synthetic"))
    extra = F.struct(opposite(F.col("device_id")).alias("device_id"), middle.alias("ts"),
                     F.lit(True).alias("synthetic"))
    repeat = F.coalesce(F.col("prev.device_id") == F.col("device_id"), F.lit(False))
    return (rows.withColumn("_e", F.explode(F.when(repeat, F.array(extra, own)).otherwise(F.array(own))))
            .select("event_id", F.col("_e.device_id").alias("device_id"), "user_id",
                    F.col("_e.ts").alias("ts"), "x", "y", F.col("_e.synthetic").alias("synthetic")))


def room_of(device: Column) -> Column:
    return F.substring_index(device, "-", 1)


def capacity_of(room: Column, capacities: dict[str, int]) -> Column:
    """Capacity lookup as a literal map; rooms without one get NULL."""
    pairs = [F.lit(v) for item in capacities.items() for v in item]
    return F.try_element_at(F.create_map(*pairs), room)


def room_occupancy(events: DataFrame, capacities: dict[str, int], *,
                   hot_rows: Optional[int] = ordered.HOT_ROWS) -> DataFrame:
    """People in the room after each event: +1 for ``in``, -1 otherwise."""
    rows = events.withColumns({
        "room": room_of(F.col("device_id")),
        "_d": F.when(F.endswith(F.col("device_id"), F.lit("-in")), 1).otherwise(-1).cast("long")})
    tie = [c for c in ("event_id", "synthetic") if c in events.columns]
    out = ordered.running(rows, ["room"], {"count": ("sum", F.col("_d"))}, tie=tie, hot_rows=hot_rows)
    return ordered.drop_slices(out).drop("_d").withColumn(
        "capacity", capacity_of(F.col("room"), capacities))


# -- cell stay time ----------------------------------------------------------
def stay_time(points: DataFrame, grid: Grid, window: WindowSpec, *, tie: Sequence[str] = (),
              hot_rows: Optional[int] = ordered.HOT_ROWS) -> DataFrame:
    """Milliseconds spent per window and cell; a step is shared evenly by its cells."""
    rows = ordered.previous(with_window(points, window), ["window", "obj_id"],
                            ["ts", "x", "y"], tie=tie, hot_rows=hot_rows)
    steps = rows.filter(F.col("prev").isNotNull()).withColumns({
        "_ms": (F.unix_millis("ts") - F.unix_millis("prev.ts")).cast("double"),
        "_cells": cells.cells_on_step(grid, F.col("prev.x"), F.col("prev.y"), F.col("x"), F.col("y"))})
    shares = steps.select("window", (F.col("_ms") / F.size("_cells")).alias("_share"),
                          F.explode("_cells").alias("_c"))
    return shares.groupBy("window", F.col("_c.cx").alias("cx"), F.col("_c.cy").alias("cy")).agg(
        F.sum("_share").alias("stay_ms"))


def sensor_coverage(polygons: DataFrame, grid: Grid, window: WindowSpec) -> DataFrame:
    """Distinct timestamps at which some polygon covers the cell, per window."""
    # the exact test runs once per polygon, its cells are then spread over windows
    hit = with_window(cells.cells_touched(polygons, grid, G.shape(G.POLYGON)).select("ts", "cx", "cy"), window)
    return hit.groupBy("window", "cx", "cy").agg(
        F.countDistinct(F.unix_millis("ts")).alias("coverage"))


def normalized_stay_time(points: DataFrame, polygons: DataFrame, grid: Grid, window: WindowSpec,
                         window_seconds: float, **options) -> DataFrame:
    """Stay seconds per coverage, scaled by the window length."""
    stay = stay_time(points, grid, window, **options)
    cover = sensor_coverage(polygons, grid, window)
    return stay.join(cover, ["window", "cx", "cy"]).withColumn(
        "normalized", F.col("stay_ms") / 1000.0 / F.col("coverage") * window_seconds)


def stay_time_json(normalized: DataFrame) -> DataFrame:
    return normalized.select(F.to_json(F.struct(
        cell_id(F.col("cx"), F.col("cy")).alias("cellID"),
        F.array(F.unix_millis("window.start"), F.unix_millis("window.end")).alias("window"),
        F.col("normalized").alias("normalizedStayTime"))).alias("value"))


# -- geofence ----------------------------------------------------------------
GEOFENCE_TOLERANCE = 1e-7  # fixed value


def geofence(points: DataFrame, fence: Queries, r: float = GEOFENCE_TOLERANCE) -> DataFrame:
    """Seconds in which some point lies outside the fence."""
    out = range_query(points, fence, r, outside_mode="all")
    return out.groupBy(F.floor(F.unix_millis("ts") / 1000).cast("long").alias("second")).agg(
        F.lit(True).alias("alarm"))


def geofence_report(alarms: DataFrame) -> DataFrame:
    return alarms.orderBy("second").select(F.format_string("Second %d: TRUE", "second").alias("value"))


def geofence_windows(points: DataFrame, fence: Queries, r: float = GEOFENCE_TOLERANCE) -> DataFrame:
    """The streaming form: one "TRUE" per one-second window with a point outside."""
    out = range_query(points, fence, r, outside_mode="all", window=WindowSpec("1 second"))
    return out.groupBy("window").agg(F.count(F.lit(1)).alias("n")).select(
        "window", "n", F.lit("TRUE").alias("value"))


# -- robots ------------------------------------------------------------------
def nearest_of(streams: Sequence[DataFrame], query: QueryGeometry, r: Optional[float],
               window: WindowSpec) -> DataFrame:
    """Which object of several streams is nearest to the query, per window."""
    merged = streams[0]
    for s in streams[1:]:
        merged = merged.unionByName(s)
    return knn.knn(merged, query, r, 1, window=window)


# -- tiles -------------------------------------------------------------------
TILES_PER_AXIS = 100  # fixed value


def tile_side(xmin, ymin, xmax, ymax):
    return F.least((xmax - xmin) / TILES_PER_AXIS, (ymax - ymin) / TILES_PER_AXIS)


def tiles(bounds: DataFrame, n: int) -> DataFrame:
    """Square query polygons over a box (columns xmin, ymin, xmax, ymax), column by column.

    Whole columns are made until ``n`` tiles are reached, so there can be a few more.
    """
    b = bounds.withColumn("side", tile_side(*[F.col(c) for c in ("xmin", "ymin", "xmax", "ymax")]))
    b = b.withColumns({"_nx": F.ceil((F.col("xmax") - F.col("xmin")) / F.col("side")),
                       "_ny": F.ceil((F.col("ymax") - F.col("ymin")) / F.col("side"))})
    columns = F.least(F.col("_nx"), F.ceil(F.lit(n) / F.col("_ny")))
    out = (b.withColumn("ti", F.explode(F.sequence(F.lit(0).cast("long"), columns - 1)))
            .withColumn("tj", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_ny") - 1))))
    x, y, side = F.col("xmin") + F.col("ti") * F.col("side"), F.col("ymin") + F.col("tj") * F.col("side"), F.col("side")
    ring = F.array(*[F.struct(a.alias("x"), c.alias("y")) for a, c in (
        (x, y), (x + side, y), (x + side, y + side), (x, y + side), (x, y))])
    return G.with_edges(out.select("ti", "tj", "side", F.array(ring).alias("rings")), "rings")


# -- parcels and tracks ------------------------------------------------------
def centroid(polygons: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Area-weighted centroid of polygon shells (ring 0); holes are not subtracted."""
    shell = F.slice(F.col("rings"), 1, 1)
    e = G.edges_of(shell)

    def total(fn) -> Column:
        return F.aggregate(e, F.lit(0.0), lambda acc, d: acc + fn(d))

    cross = lambda d: d["x1"] * d["y2"] - d["x2"] * d["y1"]
    area = total(cross) / 2
    sign = F.signum(area)
    rows = polygons.select(*by, (area * sign).alias("_a"),
                           (total(lambda d: (d["x1"] + d["x2"]) * cross(d)) / 6 * sign).alias("_mx"),
                           (total(lambda d: (d["y1"] + d["y2"]) * cross(d)) / 6 * sign).alias("_my"))
    return rows.groupBy(*by).agg(
        F.sum("_a").alias("area"), (F.sum("_mx") / F.sum("_a")).alias("cx"),
        (F.sum("_my") / F.sum("_a")).alias("cy"))


def shift(points: DataFrame, x0, y0) -> DataFrame:
    return points.withColumns({"x": F.col("x") - x0, "y": F.col("y") - y0})


def track_segments(points: DataFrame, max_step: float, *, tie: Sequence[str] = (),
                   hot_rows: Optional[int] = ordered.HOT_ROWS) -> DataFrame:
    """Number the tracks of each object: a step longer than ``max_step`` starts a new one."""
    rows = ordered.previous(points, ["obj_id"], ["x", "y"], tie=tie, hot_rows=hot_rows)
    far = G.point_distance("x", "y", "prev.x", "prev.y") > max_step
    rows = rows.withColumn("_jump", F.coalesce(far, F.lit(False)).cast("long"))
    out = ordered.running(rows, ["obj_id"], {"track": ("sum", F.col("_jump"))}, tie=tie)
    return ordered.drop_slices(out).drop("prev", "_jump")
