"""Running streaming queries into tables, and the streaming forms of the operators."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import Optional

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.geometry import POINT, QueryGeometry
from ..functions.grid import Grid
from ..functions.windows import WindowSpec, micros
from ..operators import apps, cells, knn, trajectory
from ..session import work_dir


def start_to_table(stream: DataFrame, path: str, *, available_now: bool = True,
                   per_batch: Optional[Callable[[DataFrame], DataFrame]] = None,
                   mode: str = "append"):
    """Start a query that writes Parquet below ``path``.

    With ``per_batch``, or in update mode, each micro-batch is written to its own folder,
    overwriting it if the batch is retried, so the result is exactly-once.
    """
    spark = stream.sparkSession
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", f"{path}/_checkpoint")
    if available_now:
        writer = writer.trigger(availableNow=True)
    if per_batch is None and mode == "append":
        return writer.format("parquet").option("path", f"{path}/rows").start()

    def write(batch: DataFrame, number: int) -> None:
        out = per_batch(batch) if per_batch else batch
        out.write.mode("overwrite").parquet(f"{path}/rows/batch={number}")

    return writer.foreachBatch(write).start()


def run_to_table(stream: DataFrame, name: str, **options) -> DataFrame:
    """Process what is available, then return the written rows."""
    spark: SparkSession = stream.sparkSession
    path = work_dir(spark, name)
    query = start_to_table(stream, path, **options)
    query.awaitTermination()
    return spark.read.parquet(f"{path}/rows")


def latest(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Final state of an update-mode table: the newest batch of every key."""
    values = [c for c in rows.columns if c not in (*keys, "batch")]
    newest = F.max_by(F.struct(*values), "batch").alias("_v")
    return rows.groupBy(*keys).agg(newest).select(*keys, "_v.*")


# -- any windowed operator on a stream ---------------------------------------------------
def start_closed_windows(stream: DataFrame, operator: Callable[[DataFrame], DataFrame],
                         window: WindowSpec, path: str, *, lateness_seconds: float = 0,
                         available_now: bool = False):
    """Start a query that runs a windowed batch operator on a stream, each window once, when it
    closes, and writes below ``path``; started again with the same path it resumes.

    For operators that need several shuffles per window (sub-trajectories, joins of
    them, stay time). Rows are appended to a table by day; a micro-batch that moves the
    newest event time past the end of windows runs ``operator`` (rows to rows with
    ``window``) on the stretch of time those windows cover. Rows of windows that closed
    in an earlier micro-batch are late and ignored. What is kept, and for how long, is told at
    ``WindowLog``.
    """
    log = WindowLog(stream.sparkSession, path, window, lateness_seconds)

    def close(batch: DataFrame, number: int) -> None:
        before, now = log.add(batch, number)
        if now is None or now == before:
            return
        out = operator(log.rows(batch, before, number))
        end = F.unix_micros("window.end")
        out = out.filter(end <= now) if before is None else out.filter((end > before) & (end <= now))
        out.write.mode("overwrite").parquet(f"{path}/rows/batch={number}")
        log.forget(before)

    writer = stream.writeStream.option("checkpointLocation", f"{path}/_checkpoint").foreachBatch(close)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


class WindowLog:
    """The rows of a stream that open windows may still need, by micro-batch and day, and the
    newest event time up to each micro-batch. Everything is written per batch, so that a retried
    batch gives the same files; days that no window needs any more are removed."""

    def __init__(self, spark: SparkSession, path: str, window: WindowSpec, lateness_seconds: float = 0):
        self.spark, self.path = spark, path
        self.late = int(lateness_seconds * 1_000_000)
        self.size = micros(window.size)

    def add(self, batch: DataFrame, number: int) -> tuple[Optional[int], Optional[int]]:
        """Write the batch; newest event time less lateness before it, and with it."""
        (batch.withColumn("day", F.to_date("ts")).write.mode("overwrite").partitionBy("day")
         .parquet(f"{self.path}/raw/batch={number}"))
        newest = f"{self.path}/newest/batch="
        before = self.spark.read.schema("us long").parquet(f"{newest}{number - 1}").first()["us"] if number else None
        top = batch.agg(F.max(F.unix_micros("ts"))).first()[0]
        late = None if top is None else top - self.late
        now = max((t for t in (before, late) if t is not None), default=None)
        self.spark.createDataFrame([(now,)], "us long").coalesce(1).write.mode("overwrite").parquet(f"{newest}{number}")
        return before, now

    def rows(self, batch: DataFrame, before: Optional[int], number: int, keep: Sequence[str] = ()) -> DataFrame:
        """Rows of this and earlier batches that windows open before this batch may hold."""
        rows = self.spark.read.schema(f"{_ddl(batch)}, batch int, day date").parquet(f"{self.path}/raw")
        rows = rows.filter(F.col("batch") <= number)
        if before is not None:
            first = F.timestamp_micros(F.lit(before - self.size))
            rows = rows.filter((F.col("day") >= F.to_date(first)) & (F.col("ts") >= first))
        return rows.drop(*[c for c in ("batch", "day") if c not in keep])

    def forget(self, before: Optional[int]) -> None:
        """Remove days that even a retry of this batch does not read."""
        if before is None:
            return
        first = self.spark.range(1).select(F.to_date(F.timestamp_micros(F.lit(before - self.size))).cast("string")).first()[0]
        remove(self.spark, f"{self.path}/raw/batch=*/day=*", lambda name: name.split("=", 1)[1] < first)


def remove(spark: SparkSession, pattern: str, gone: Callable[[str], bool]) -> None:
    """Delete the folders that match and whose name is ``gone``, in any file system of Spark."""
    jvm = spark.sparkContext._jvm
    glob = jvm.org.apache.hadoop.fs.Path(pattern)
    fs = glob.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for status in fs.globStatus(glob) or []:
        if gone(status.getPath().getName()):
            fs.delete(status.getPath(), True)


def run_closed_windows(stream: DataFrame, operator: Callable[[DataFrame], DataFrame],
                       window: WindowSpec, name: str, **options) -> DataFrame:
    """Process what is available by ``start_closed_windows``, then return the written rows."""
    path = work_dir(stream.sparkSession, name)
    start_closed_windows(stream, operator, window, path, available_now=True, **options).awaitTermination()
    return stream.sparkSession.read.parquet(f"{path}/rows").drop("batch")


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{name}` {kind}" for name, kind in df.dtypes)


# -- early results -------------------------------------------------------------------
def start_early_pairs(stream: DataFrame, d: float, window: WindowSpec, path: str, *, side: str = "side",
                      lateness_seconds: float = 0, exclude_same_id: bool = False, available_now: bool = False):
    """Start ``trajectory.trajectory_pairs`` while windows are open, written below ``path``.

    ``stream`` holds both sides, told apart by the column ``side`` (``a`` or ``b``). A micro-batch
    joins its new points of either side with the other side's points of all open windows (old
    with old was joined before), and keeps the best pair of points per window and id pair: the
    pairs that got better come out (``latest`` makes the state of them), the rest of the state is
    one row per id pair of an open window. Points of windows that closed are forgotten.
    """
    spark = stream.sparkSession
    log = WindowLog(spark, path, window, lateness_seconds)
    keys = ["window", "a_obj_id", "b_obj_id"]

    def step(batch: DataFrame, number: int) -> None:
        rows = batch.select("obj_id", "ts", "x", "y", F.col(side).alias("side"))
        before, _ = log.add(rows, number)
        held = log.rows(rows, before, number, keep=["batch"])
        new, old = F.col("batch") == number, F.col("batch") < number

        def of(which, when):
            return held.filter((F.col("side") == which) & when).drop("side", "batch")

        def pairs(a, b):
            # aggregated below in any case, and nothing is left behind per micro-batch
            return trajectory.trajectory_pairs(a, b, d, window=window, exclude_same_id=exclude_same_id, few=None)

        found = pairs(of("a", new), of("b", new | old)).unionByName(pairs(of("a", old), of("b", new)))
        if before is not None:
            found = found.filter(F.unix_micros("window.end") > before)
        values = [c for c in found.columns if c not in keys]  # ordered as trajectory_pairs compares them
        value = F.struct(*values)
        best = found.groupBy(*keys).agg(F.max(value).alias("v")).withColumn("was", F.lit(None).cast(found.select(value).dtypes[0][1]))
        if number:
            state = spark.read.schema(f"{_ddl(found)}").parquet(f"{path}/state/batch={number - 1}")
            state = state.filter(F.unix_micros("window.end") > before).select(*keys, value.alias("v"), value.alias("was"))
            best = best.unionByName(state).groupBy(*keys).agg(F.max("v").alias("v"), F.max("was").alias("was"))
        best.select(*keys, "v.*", (F.col("was").isNull() | (F.col("v") > F.col("was"))).alias("better")).write.mode(
            "overwrite").parquet(f"{path}/state/batch={number}")
        kept = spark.read.schema(f"{_ddl(found)}, better boolean").parquet(f"{path}/state/batch={number}")
        kept.filter("better").drop("better").write.mode("overwrite").parquet(f"{path}/rows/batch={number}")
        log.forget(before)
        remove(spark, f"{path}/state/batch=*", lambda name: int(name.split("=")[1]) < number - 1)

    writer = stream.writeStream.option("checkpointLocation", f"{path}/_checkpoint").foreachBatch(step)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


# -- streaming forms ---------------------------------------------------------------
def start_nearest(stream: DataFrame, query: QueryGeometry, r: Optional[float], k: int,
                  window: WindowSpec, path: str, *, kind: str = POINT, available_now: bool = False):
    """Start kNN on a stream, written below ``path``: object minima as a windowed aggregation,
    ranked per closed window.

    A window's rows leave the aggregation in one micro-batch, so ranking the batch is
    exact.
    """
    best = knn.object_distances(stream, query, r, kind=kind, window=window)
    return start_to_table(best, path, available_now=available_now, per_batch=lambda b: knn.rank_nearest(b, k))


def nearest(stream: DataFrame, query: QueryGeometry, r: Optional[float], k: int,
            window: WindowSpec, *, kind: str = POINT, name: str = "knn") -> DataFrame:
    """Process what is available by ``start_nearest``, then return the written rows."""
    path = work_dir(stream.sparkSession, name)
    start_nearest(stream, query, r, k, window, path, kind=kind, available_now=True).awaitTermination()
    return stream.sparkSession.read.parquet(f"{path}/rows")


def cell_spans(stream: DataFrame, grid: Grid) -> DataFrame:
    """Per cell and object span, for update mode: each micro-batch reports what changed."""
    return cells.spans(cells.has_cell(grid.with_cell(stream)))


def occupancy(stream: DataFrame, capacities: dict[str, int]) -> DataFrame:
    """People per room, for update mode."""
    room = apps.room_of(F.col("device_id")).alias("room")
    step = F.when(F.endswith(F.col("device_id"), F.lit("-in")), 1).otherwise(-1)
    out = stream.groupBy(room).agg(F.sum(step).alias("count"))
    return out.withColumn("capacity", apps.capacity_of(F.col("room"), capacities))


def late_rows_dropped(query) -> int:
    """Rows the last progress of a query dropped behind the watermark."""
    progress = query.lastProgress
    return sum(op["numRowsDroppedByWatermark"] for op in progress["stateOperators"]) if progress else 0


def observed(df: DataFrame, name: str, **metrics) -> DataFrame:
    """Count rows (and more) as they pass; read back from query progress or listener."""
    return df.observe(name, F.count(F.lit(1)).alias("rows"), *[c.alias(n) for n, c in metrics.items()])


def observations(query, name: str) -> list[dict]:
    """What ``observed`` measured in each recent micro-batch of a query."""
    seen = [p["observedMetrics"].get(name) for p in query.recentProgress if p["observedMetrics"]]
    return [s.asDict() if hasattr(s, "asDict") else dict(s) for s in seen if s is not None]
