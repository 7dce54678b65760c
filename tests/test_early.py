"""Streams that evict, answer early and aggregate by panes give the batch rows."""

import random

import pytest
from pyspark.sql import functions as F
from test_streaming import Replay, closed, rows

from wayfield.functions import geometry as G
from wayfield.functions.grid import Grid
from wayfield.functions.windows import WindowSpec, micros, watermark, window_aggregate, with_window
from wayfield.operators import cells, knn
from wayfield.operators import trajectory as T
from wayfield.session import work_dir
from wayfield.streaming import run, state

GRID = Grid.by_count(0, 0, 100, 100, 2)
HOUR, SLIDING = WindowSpec("1 hour"), WindowSpec("1 hour", "20 minutes")
Q = G.point(50, 50)


@pytest.fixture(scope="module")
def moves(spark):
    """Objects that come and go: some are seen only early, one only now and then."""
    rng = random.Random(11)
    out = []
    for i in range(400):
        names = [f"o{j}" for j in range(6)] + (["early"] if i < 90 else []) + (["rare"] * 2 if i % 70 < 8 else [])
        out.append((i, rng.choice(names), 60_000 * i + rng.randint(0, 59_999), rng.uniform(0, 100), rng.uniform(0, 100),
                    rng.choice("ab")))
    df = spark.createDataFrame(out, "event_id long, obj_id string, ms long, x double, y double, side string")
    return df.withColumn("ts", F.timestamp_millis("ms")).drop("ms").cache()


@pytest.fixture(scope="module")
def replay(spark, moves):
    out = Replay(spark, moves.schema)
    for i in range(5):
        out.add(moves.filter((F.col("event_id") >= 80 * i) & (F.col("event_id") < 80 * (i + 1))))
    return out


@pytest.mark.parametrize("idle_ms", [600_000, 3_600_000])
def test_idle_stays_are_evicted(spark, moves, replay, idle_ms):
    path = work_dir(spark, "stays")
    query = run.start_to_table(state.cell_stays(watermark(replay.stream(), 0), GRID, idle_ms), path, mode="update")
    query.awaitTermination()
    held = [op["numRowsTotal"] for p in query.recentProgress for op in p["stateOperators"]]
    assert max(held) > held[-1] > 0  # the state shrinks
    got = spark.read.parquet(f"{path}/rows")
    keys = ["cx", "cy", "obj_id"]
    ended = got.filter("ended").select(*keys, "traj_ms", "n_points", F.unix_millis("last_ts").alias("last_ms"), "ended")
    values = F.struct("traj_ms", "n_points", F.unix_millis("last_ts").alias("last_ms"), "ended")
    live = got.groupBy(*keys).agg(F.max_by(values, F.struct("batch", "last_ts")).alias("v")).select(*keys, "v.*").filter("not ended")
    assert live.count() == held[-1]
    want = cells.stays(moves, GRID, idle_ms).select(*ended.columns[:-2], F.unix_millis("last_ts").alias("last_ms"), "ended")
    assert rows(ended.unionByName(live)) == rows(want)
    for function in cells.FUNCTIONS:
        assert rows(cells.roll_up(live, function, keep_idle=True)) == rows(cells.live_cells(moves, GRID, function, idle_ms))


def test_stays_by_bucket(spark, moves):
    """However many objects there are, Python is called per bucket; ids may be NULL, rows repeat."""
    odd = moves.withColumn("obj_id", F.expr("IF(event_id % 7 = 0, NULL, obj_id)"))
    odd = odd.unionByName(odd.filter("event_id % 5 = 0"))
    replay = Replay(spark, odd.schema)
    for i in range(2):
        replay.add(odd.filter((F.col("event_id") >= 200 * i) & (F.col("event_id") < 200 * (i + 1))))
    stream = state.cell_stays(watermark(replay.stream(), 0), GRID, 600_000, buckets=1)
    got = run.run_to_table(stream, "stays", mode="update")
    live = got.groupBy("cx", "cy", "obj_id").agg(F.max_by("ended", F.struct("batch", "last_ts")).alias("ended")).filter("not ended")
    want = cells.stays(odd, GRID, 600_000)
    columns = ["cx", "cy", "obj_id", "traj_ms", "n_points", F.unix_millis("last_ts").alias("last_ms")]
    assert rows(got.filter("ended").select(*columns)) == rows(want.filter("ended").select(*columns))
    assert live.count() == want.filter("not ended").count() > 0


def test_stays_of_hot_objects(moves):
    for idle in (300_000, 1_200_000):
        assert rows(cells.stays(moves, GRID, idle, hot_rows=10)) == rows(cells.stays(moves, GRID, idle))


@pytest.mark.parametrize("spec", [HOUR, SLIDING], ids=["tumbling", "sliding"])
@pytest.mark.parametrize("buckets", [1, 4])
def test_early_knn(spark, moves, replay, spec, buckets):
    path = work_dir(spark, "early-knn")
    stream = state.nearest_so_far(watermark(replay.stream(), 0), Q, 60.0, 3, spec, buckets=buckets)
    query = run.start_to_table(stream, path, mode="update")
    query.awaitTermination()
    got = spark.read.parquet(f"{path}/rows")
    assert got.select("batch").distinct().count() > 2
    want = T.trajectory_knn(moves, Q, 60.0, 3, window=spec).withColumn("start_us", F.unix_micros("window.start")).drop("window")
    assert rows(state.nearest_now(got, 3)) == rows(want)
    windows = with_window(moves, spec).select("window").distinct().count()
    assert query.recentProgress[-1]["stateOperators"][0]["numRowsTotal"] < windows * buckets  # closed windows are gone


@pytest.mark.parametrize("spec", [HOUR, SLIDING], ids=["tumbling", "sliding"])
def test_early_pairs(spark, moves, replay, spec):
    path = work_dir(spark, "early-pairs")
    run.start_early_pairs(replay.stream(), 25.0, spec, path, exclude_same_id=True, available_now=True).awaitTermination()
    got = spark.read.parquet(f"{path}/rows")
    assert got.select("batch").distinct().count() == 5
    keys = ["window", "a_obj_id", "b_obj_id"]
    a, b = (moves.filter(F.col("side") == s) for s in "ab")
    want = T.trajectory_pairs(a, b, 25.0, window=spec, exclude_same_id=True)
    assert rows(run.latest(got, keys)) == rows(want)
    assert got.count() > want.count()  # results came before the windows closed
    # every row is an improvement on the one before it
    assert got.groupBy(*keys, "b_ts", "a_ts", "dist").count().filter("count > 1").isEmpty()
    state_rows = spark.read.parquet(f"{path}/state").filter("batch = 4").count()
    assert state_rows < want.count()


def test_forgotten_days(spark, moves):
    """Raw rows of days that no open window needs are removed, the result stays whole."""
    days = moves.withColumn("ts", F.timestamp_millis(F.unix_millis("ts") * 20))
    replay = Replay(spark, days.schema)
    for i in range(4):
        replay.add(days.filter((F.col("event_id") >= 100 * i) & (F.col("event_id") < 100 * (i + 1))))
    path = work_dir(spark, "days")
    day = WindowSpec("6 hours")
    run.start_closed_windows(replay.stream(), lambda df: T.window_stats(df, day), day, path, available_now=True).awaitTermination()
    got = spark.read.parquet(f"{path}/rows").drop("batch")
    assert rows(got) == rows(closed(days, T.window_stats(days, day)))
    kept = spark.read.parquet(f"{path}/raw").select("day").distinct().count()
    assert kept < days.select(F.to_date("ts")).distinct().count()


@pytest.mark.parametrize("spec", [HOUR, SLIDING, WindowSpec("50 minutes", "20 minutes")], ids=["tumbling", "sliding", "uneven"])
def test_panes(moves, replay, spec):
    aggs = {"n": ("count", F.lit(1)), "far": ("max", F.col("x")), "low": ("min", F.struct("y", "x")), "s": ("sum", F.col("event_id"))}
    got = window_aggregate(moves, ["side"], spec, aggs)
    want = with_window(moves, spec).groupBy("window", "side").agg(
        F.count(F.lit(1)).alias("n"), F.max("x").alias("far"), F.min(F.struct("y", "x")).alias("low"), F.sum("event_id").alias("s"))
    assert rows(got) == rows(want)
    streamed = run.run_to_table(window_aggregate(watermark(replay.stream(), 0), ["side"], spec, aggs), "panes")
    done = rows(streamed)
    assert set(done) <= set(rows(want)) and len(done) > want.count() / 2


def test_panes_copy_no_rows(moves):
    """Every event goes into one pane before the shuffle."""
    plan = knn.object_distances(moves, Q, 60.0, window=SLIDING)._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.rindex("Exchange"):]
    assert "Expand" in plan and "Expand" not in below


def test_lengths():
    assert micros("6 hours") == 21_600_000_000 and micros("1 day 12 hours") == 129_600_000_000
    assert micros("INTERVAL 30 SECONDS") == 30_000_000 and micros("1 microsecond") == 1
    for wrong in ("hours", "6 parsecs", "", "1 month"):
        with pytest.raises(ValueError):
            micros(wrong)
