"""Streams: several micro-batches give the batch result; late rows are dropped."""

import random

import pytest
from pyspark.sql import functions as F

from wayfield.functions import geometry as G
from wayfield.functions.grid import Grid
from wayfield.functions.windows import WindowSpec, watermark, with_window
from wayfield.operators import apps, cells, joins, knn, ranges
from wayfield.operators import trajectory as T
from wayfield.plans import fixtures as fx
from wayfield.session import work_dir
from wayfield.streaming import run, state

GRID = Grid.by_count(0, 0, 100, 100, 4)
HOUR = WindowSpec("1 hour")
FILES = 4


@pytest.fixture(scope="module")
def points(spark):
    rng = random.Random(8)
    rows = [(i, f"o{rng.randint(0, 4)}", 60 * i + rng.randint(0, 59), rng.uniform(0, 100), rng.uniform(0, 100),
             rng.choice(["room0-in", "room0-out", "room1-in", "room1-out"])) for i in range(400)]
    df = spark.createDataFrame(rows, "event_id long, obj_id string, s long, x double, y double, device_id string")
    return df.withColumn("ts", F.timestamp_seconds("s")).drop("s").cache()


class Replay:
    """Files that arrive one after another, one per micro-batch."""

    def __init__(self, spark, schema):
        self.spark, self.schema = spark, schema
        self.path = work_dir(spark, "replay")
        self.files = 0

    def add(self, df):
        df.coalesce(1).write.parquet(f"{self.path}/file={self.files:03d}")
        self.files += 1

    def stream(self):
        return (self.spark.readStream.schema(self.schema).option("maxFilesPerTrigger", 1)
                .parquet(f"{self.path}/file=*").select(*self.schema.names))


@pytest.fixture(scope="module")
def replay(spark, points):
    out = Replay(spark, points.schema)
    for i in range(FILES):
        out.add(points.filter((F.col("event_id") >= 100 * i) & (F.col("event_id") < 100 * (i + 1))))
    return out


def rows(df, digits=6):
    cols = sorted(df.columns)
    return sorted(tuple(str(round(v, digits)) if isinstance(v, float) else str(v) for v in r)
                  for r in df.select(*cols).collect())


def closed(points, df):
    newest = points.agg(F.max("ts")).first()[0]
    return df.filter(F.col("window.end") <= F.lit(newest))


def test_running_stats_over_micro_batches(points, replay):
    got = run.run_to_table(state.running_stats(replay.stream()), "t")
    assert rows(got) == rows(T.running_stats(points))


def test_speed_over_micro_batches(points, replay):
    got = run.run_to_table(state.speed(replay.stream()), "t").select("event_id", "speed")
    assert rows(got) == rows(T.speed(points, tie=["event_id"]).select("event_id", "speed"))


@pytest.mark.parametrize("size,slide", [(10, 5), (7, 3), (4, 4), (3, 5)])
def test_count_windows_over_micro_batches(points, replay, size, slide):
    for function in ("ALL", "MAX"):
        spans = state.count_window_spans(replay.stream(), GRID, size, slide)
        got = run.run_to_table(spans, "t", per_batch=lambda b: cells.roll_up(b, function, ["last_n"])).drop("batch")
        assert rows(got) == rows(cells.aggregate_counts(points, GRID, function, size, slide, tie=["event_id"]))


def test_checkins_over_micro_batches(points, replay):
    def events(df):
        return df.select(F.col("event_id").cast("string").alias("event_id"), "device_id",
                         F.col("obj_id").alias("user_id"), "ts", "x", "y")
    got = run.run_to_table(state.fill_checkins(events(replay.stream())), "t")
    assert rows(got) == rows(apps.fill_checkins(events(points)))
    assert got.filter("synthetic").count() > 10


def test_occupancy_in_update_mode(points, replay):
    got = run.run_to_table(run.occupancy(replay.stream(), {"room0": 3}), "t", mode="update")
    assert got.select("batch").distinct().count() > 1
    final = {r.room: (r["count"], r.capacity) for r in run.latest(got, ["room"]).collect()}
    last = apps.room_occupancy(points, {"room0": 3}).groupBy("room").agg(
        F.max_by(F.struct("count", "capacity"), F.struct("ts", "event_id")).alias("v")).collect()
    assert final == {r.room: tuple(r.v) for r in last}


def test_cell_state_in_update_mode(points, replay):
    got = run.run_to_table(run.cell_spans(replay.stream(), GRID), "t", mode="update")
    state_ = run.latest(got, ["cx", "cy", "obj_id"])
    for function in cells.FUNCTIONS:
        assert rows(cells.roll_up(state_, function, keep_idle=True)) == \
            rows(cells.aggregate_now(points, GRID, function))


def test_knn_of_closed_windows(points, replay):
    q = G.point(50, 50)
    got = run.nearest(watermark(replay.stream(), 0), q, 60.0, 3, HOUR).drop("batch")
    near = points.filter(G.distance(G.shape(G.POINT), G.literal(q)) <= 60.0)
    assert rows(got) == rows(closed(near, knn.knn(points, q, 60.0, 3, window=HOUR)))


@pytest.mark.parametrize("spec", [HOUR, WindowSpec("1 hour", "20 minutes")], ids=["tumbling", "sliding"])
@pytest.mark.parametrize("operator", [
    lambda df, w: T.line_summary(T.touching_lines(df, G.rectangle(0, 0, 60, 60), w)),
    lambda df, w: T.line_summary(T.trajectory_knn_lines(df, G.point(50, 50), 60.0, 3, w)),
    lambda df, w: T.trajectory_pairs(df, df, 8.0, window=w, exclude_same_id=True),
    lambda df, w: apps.stay_time(df, GRID, w),
], ids=["touching", "knn_lines", "pairs", "stay_time"])
def test_windowed_operators_when_windows_close(points, replay, spec, operator):
    plain = points.drop("device_id")
    got = run.run_closed_windows(replay.stream().drop("device_id"), lambda df: operator(df, spec), spec, "t")
    assert rows(got, 4) == rows(closed(plain, operator(plain, spec)), 4)


def test_closed_windows_ignore_late_rows(spark, points):
    replay = Replay(spark, points.schema)
    replay.add(points.filter("event_id < 200"))
    replay.add(points.filter("event_id < 5").withColumn("event_id", F.col("event_id") + 10_000))
    replay.add(points.filter("event_id >= 200"))
    got = run.run_closed_windows(replay.stream(), lambda df: T.window_stats(df, HOUR), HOUR, "t", lateness_seconds=30)
    newest = points.agg(F.max("ts")).first()[0]
    want = T.window_stats(points, HOUR).filter(F.col("window.end") <= F.lit(newest) - F.expr("INTERVAL 30 SECONDS"))
    assert rows(got) == rows(want)


def test_join_over_micro_batches(points, replay):
    def sides(df):
        return df.filter("event_id % 2 = 0").drop("device_id"), df.filter("event_id % 2 = 1").drop("device_id")
    a, b = sides(watermark(replay.stream(), 0))
    got = run.run_to_table(joins.distance_join(a, b, 20.0, window=HOUR), "t")
    assert rows(got) == rows(joins.distance_join(*sides(points), 20.0, window=HOUR))


def test_range_is_stateless(points, replay):
    got = run.run_to_table(ranges.range_query(replay.stream(), G.rectangle(0, 0, 50, 50), 1.0), "t")
    assert rows(got) == rows(ranges.range_query(points, G.rectangle(0, 0, 50, 50), 1.0))


def test_late_rows_are_dropped(spark, points):
    replay = Replay(spark, points.schema)
    replay.add(points.filter("event_id < 200"))
    replay.add(points.filter("event_id >= 200"))
    late = points.filter("event_id < 5").withColumn("event_id", F.col("event_id") + 10_000)
    replay.add(late)
    counts = with_window(watermark(replay.stream(), 60), HOUR).groupBy("window").count()
    path = work_dir(spark, "late")
    query = run.start_to_table(counts, path)
    query.awaitTermination()
    dropped = sum(op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in p["stateOperators"])
    assert dropped > 0
    newest = points.agg(F.max("ts")).first()[0]
    want = with_window(points, HOUR).groupBy("window").count().filter(
        F.col("window.end") <= F.lit(newest) - F.expr("INTERVAL 60 SECONDS"))
    assert rows(spark.read.parquet(f"{path}/rows")) == rows(want)


def test_out_of_order_points_are_ignored(spark, points):
    replay = Replay(spark, points.schema)
    replay.add(points.filter("event_id >= 200"))
    replay.add(points.filter("event_id < 200"))
    got = run.run_to_table(state.running_stats(replay.stream()), "t")
    assert rows(got) == rows(T.running_stats(points.filter("event_id >= 200")))


def test_metrics_are_observed(points, replay):
    out = run.observed(replay.stream().select("event_id"), "m", top=F.max("event_id"))
    query = run.start_to_table(out, work_dir(points.sparkSession, "m"))
    query.awaitTermination()
    seen = [p["observedMetrics"]["m"] for p in query.recentProgress if p.get("observedMetrics")]
    assert sum(m["rows"] for m in seen) == 400
    assert run.late_rows_dropped(query) == 0


def test_restart_continues(spark, points):
    """A second start from the same checkpoint only takes what is new."""
    replay = Replay(spark, points.schema)
    path = work_dir(spark, "restart")
    for part in ("event_id < 200", "event_id >= 200"):
        replay.add(points.filter(part))
        run.start_to_table(state.running_stats(replay.stream()), path).awaitTermination()
    assert rows(spark.read.parquet(f"{path}/rows")) == rows(T.running_stats(points))


@pytest.mark.parametrize("streaming,batch", [
    (state.running_stats, lambda df: T.running_stats(df).select("obj_id", "ts", "spatial_length", "temporal_length", "speed")),
    (state.speed, lambda df: T.speed(df).select("event_id", "obj_id", "ts", "speed")),
    (state.fill_checkins, lambda df: apps.fill_checkins(df)),
], ids=["running_stats", "speed", "fill_checkins"])
def test_many_keys_share_few_entries_of_the_state(spark, streaming, batch):
    """More objects than buckets, one of them NULL, some in every micro-batch and some in one."""
    rng = random.Random(4)
    ids = [None, *[f"o{i}" for i in range(600)]]
    made = []
    for i in range(2400):
        who = ids[i % 601] if i < 1202 else rng.choice(ids[:50])
        made.append((f"e{i:05d}" if streaming is state.fill_checkins else i, who, 60 * i + rng.randint(0, 59), rng.uniform(0, 100),
                     rng.uniform(0, 100), rng.choice(["room0-in", "room0-out", None]), who))
    kind = "string" if streaming is state.fill_checkins else "long"
    points = spark.createDataFrame(made, f"event_id {kind}, obj_id string, s long, x double, y double, device_id string, user_id string")
    points = points.withColumn("ts", F.timestamp_seconds("s")).drop("s")
    replay = Replay(spark, points.schema)
    for begin in range(0, 2400, 600):
        replay.add(points.filter(F.unix_seconds("ts").between(60 * begin, 60 * (begin + 600) - 1)))
    query = run.start_to_table(streaming(replay.stream()), path := work_dir(spark, "many"))
    query.awaitTermination()
    assert rows(spark.read.parquet(f"{path}/rows").drop("prev")) == rows(batch(points))
    held = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    assert 0 < max(held) <= 256  # buckets


def test_replay_of_many_slices(spark, tmp_path, monkeypatch):
    """Slices follow one another in time and hold every event with a time once."""
    made = [(i, f"2024-01-01 {i * 7 % 24:02d}:{i % 60:02d}:00" if i % 50 else None) for i in range(1000)]
    events = spark.createDataFrame(made, "event_id long, t string").selectExpr(
        "event_id", "cast(t AS timestamp_ntz) AS ts", "1L AS user_id", "'view' AS event_type", "1D AS value", "'{}' AS props")
    events.coalesce(3).write.parquet(f"{tmp_path}/events.parquet")
    monkeypatch.setattr(fx, "SLICE_ROWS", 100)
    path = work_dir(spark, "replayed")
    query = run.start_to_table(fx.events_stream(spark, str(tmp_path)), path, per_batch=lambda b: b)
    query.awaitTermination()
    found = spark.read.parquet(f"{path}/rows")
    assert rows(found.select("event_id")) == rows(events.filter("ts IS NOT NULL").select("event_id"))
    spans = [tuple(r) for r in found.groupBy("batch").agg(F.min("ts"), F.max("ts")).orderBy("batch").collect()]
    assert len(spans) > 5 and all(a[2] < b[1] for a, b in zip(spans, spans[1:]))
