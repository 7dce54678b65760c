"""Spatial tables derived from the ``events`` table by fixed formulas."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import geometry as G
from ..functions.grid import Grid
from ..session import configure, work_dir

BOX = (0.0, 0.0, 100.0, 100.0)
GRID20 = Grid.by_count(*BOX, 20)
GRID100 = Grid.by_count(*BOX, 100)

QUERY_POINTS = (G.point(10, 50), G.point(30, 20))
QUERY_POLYGONS = (
    G.rectangle(5, 40, 15, 60),
    G.polygon([(30, 16), (34, 20), (30, 24), (26, 20)]),
    G.rectangle(-4, -4, 4, 4),
)
QUERY_LINE = G.line([(20, 0), (30, 50), (30, 100)])
TRAJECTORY_IDS = ("1", "2", "3")
TUMBLING = ("6 hours", None)
SLIDING = ("6 hours", "2 hours")


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir}/events.parquet")


def clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pts(spark, sf_dir).filter(F.col("event_type") == "click")


def errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pts(spark, sf_dir).filter(F.col("event_type") == "error")


def points_from(events: DataFrame) -> DataFrame:
    rows = G.once(events, x=F.expr("least(value / 5, 99.99D)"), y=F.expr(
        "double(get_json_object(props, '$.k')) + double(event_id % 100) / 100D"))
    return rows.selectExpr("event_id", "event_type", "string(user_id) AS obj_id",
                           "timestamp(ts) AS ts", "x", "y")


def pts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return points_from(raw_events(spark, sf_dir))


def _v(x, y):
    return F.struct(x.alias("x"), y.alias("y"))


def _ring(*corners):
    return F.array(*[_v(x, y) for x, y in corners + corners[:1]])


def _square(x, y, h):
    return _ring((x - h, y - h), (x + h, y - h), (x + h, y + h), (x - h, y + h))


def polys_from(points: DataFrame) -> DataFrame:
    x, y, eid = F.col("x"), F.col("y"), F.col("event_id")
    h = 0.5 + (eid % 4).cast("double") * 0.5
    diamond = _ring((x, y - h), (x + h, y), (x, y + h), (x - h, y))
    rings = (F.when(eid % 3 == 0, F.array(_square(x, y, h)))
             .when(eid % 3 == 1, F.array(diamond))
             .otherwise(F.array(_square(x, y, h * 2), _square(x, y, h))))
    rows = G.once(points.filter(F.col("event_type") == "purchase"), rings=rings)
    return G.with_edges(rows.select(eid.cast("string").alias("obj_id"), "ts", "rings"), "rings")


def lines_from(points: DataFrame) -> DataFrame:
    x, y, eid = F.col("x"), F.col("y"), F.col("event_id")
    right = x + 1.0 + (eid % 3).cast("double")
    path = F.array(_v(x, y), _v(right, y + 1.0), _v(right, y + 2.0 + (eid % 2).cast("double")))
    rows = G.once(points.filter(F.col("event_type") == "signup"), paths=F.array(path))
    return G.with_edges(rows.select(eid.cast("string").alias("obj_id"), "ts", "paths"), "paths")


def polys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return polys_from(pts(spark, sf_dir))


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines_from(pts(spark, sf_dir))


def checkins_from(events: DataFrame) -> DataFrame:
    direction = F.when(F.col("event_type").isin("click", "view"), "in").otherwise("out")
    return points_from(events).select(
        F.col("event_id").cast("string").alias("event_id"),
        F.concat(F.lit("room"), (F.col("event_id") % 5).cast("string"), F.lit("-"), direction)
        .alias("device_id"),
        F.col("obj_id").alias("user_id"), "ts", "x", "y")


def checkins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checkins_from(raw_events(spark, sf_dir))


ROOM_CAPACITY = {f"room{i}": 10 * (i + 1) for i in range(5)}


SLICES, SLICE_ROWS = 3, 1_000_000
SENTINEL_TIME = "2099-01-01 00:00:00"


def _replay(spark: SparkSession, sf_dir: str, behind: Sequence[DataFrame] = ()) -> DataFrame:
    """The events as a stream in order of time, then those ``behind``: at least ``SLICES`` micro-batches,
    a file of at most about ``SLICE_ROWS`` rows each."""
    events = raw_events(spark, sf_dir)
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    slices = max(SLICES, -(-events.count() // SLICE_ROWS))
    shares = [(i + 1) / slices for i in range(slices - 1)]
    cuts = events.agg(F.percentile_approx(us, shares, 10 * slices)).first()[0] or []
    bounds = [None, *sorted(set(cuts)), None]
    path = work_dir(spark, "replay")
    if slices > SLICES:  # not every slice reads the whole table
        dealt, number = work_dir(spark, "slices"), sum(((us > c).cast("int") for c in bounds[1:-1]), F.lit(0))
        events.withColumn("__slice", number).filter("__slice IS NOT NULL").write.partitionBy("__slice").parquet(dealt)
        held = spark.read.schema(T.StructType([*events.schema.fields, T.StructField("__slice", T.IntegerType())])).parquet(dealt)
        parts = [held.filter(F.col("__slice") == i).drop("__slice") for i in range(len(bounds) - 1)]
    else:
        parts = [events.filter((F.lit(True) if a is None else us > a) & (F.lit(True) if b is None else us <= b))
                 for a, b in zip(bounds, bounds[1:])]
    for i, part in enumerate([*parts, *behind]):  # one after the other: files are read by age
        part.coalesce(1).write.parquet(f"{path}/slice={i:05d}")
    return (spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1)
            .parquet(f"{path}/slice=*").select(*events.columns))


def events_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as a stream of several micro-batches."""
    return _replay(spark, sf_dir)


def sentinels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One far-future row per event type at (10, 50) and at (90, 10), so that one gets past the
    filters of a query."""
    rows = [(-100 * (i + 1), kind, value, k) for i, (kind, value, k) in enumerate(
        (kind, value, k) for kind in ("click", "view", "purchase", "signup", "error")
        for value, k in ((50.0, 50), (450.0, 10)))]
    made = spark.createDataFrame(rows, "event_id long, event_type string, value double, k int").selectExpr(
        "event_id", "event_type", "1L AS user_id", f"timestamp_ntz'{SENTINEL_TIME}' AS ts", "value",
        "concat('{\"k\": ', k, '}') AS props")
    schema = raw_events(spark, sf_dir).schema
    return made.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def closing_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events with far-future rows behind them, so that every window of the events closes;
    their own window stays open."""
    return _replay(spark, sf_dir, [sentinels(spark, sf_dir)])


def late_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``closing_stream``, and the events of the first day once more behind it, when they are late."""
    events = raw_events(spark, sf_dir)
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    first = events.agg(F.min(us)).first()[0] or 0
    return _replay(spark, sf_dir, [sentinels(spark, sf_dir), events.filter(us < first + 86_400_000_000)])
