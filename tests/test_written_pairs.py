"""What joins make and write: no pairs of objects that cannot come out, no columns that are not read."""

from pyspark.sql import functions as F

from wayfield.functions.windows import WindowSpec
from wayfield.operators import trajectory as T
from wayfield.plans import stream_queries
from wayfield.session import work_dir
from wayfield.streaming import run


def test_short_objects_make_no_pairs(spark, monkeypatch):
    """Objects of one point are gone before pairs are looked for."""
    rows = [("a", 1, 1.0), ("a", 2, 1.0), ("b", 1, 1.5), ("b", 3, 1.5), *[(f"one{i}", 2, 1.2) for i in range(5)]]
    df = spark.createDataFrame(rows, "obj_id string, s long, x double").selectExpr(
        "obj_id", "timestamp_seconds(s) AS ts", "x", "x AS y")
    seen, near_ids = [], T.near_ids

    def spy(left, right, *args, **options):
        seen.append({r[0] for r in left.select("obj_id").collect()})
        return near_ids(left, right, *args, **options)

    monkeypatch.setattr(T, "near_ids", spy)
    out = T.trajectory_join_lines(df, df, 2.0, WindowSpec("1 minute"), exclude_same_id=True)
    assert sorted(tuple(r) for r in out.select("a_obj_id", "b_obj_id", "side", "n_points").collect()) == [
        ("a", "b", "a", 2), ("a", "b", "b", 2), ("b", "a", "a", 2), ("b", "a", "b", 2)]
    assert seen == [{"a", "b"}]


def test_stream_joins_write_their_result_only(spark, monkeypatch, tmp_path):
    rows = [(i, i, "signup", 5.0 * i, 10 * i) for i in range(12)]
    spark.createDataFrame(rows, "event_id long, user_id long, event_type string, value double, s long").selectExpr(
        "event_id", "cast(timestamp_seconds(s) AS timestamp_ntz) AS ts", "user_id", "event_type", "value",
        "'{\"k\": 5}' AS props").coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    paths = []

    def kept(spark_, name):
        paths.append(work_dir(spark_, name))
        return paths[-1]

    monkeypatch.setattr(run, "work_dir", kept)
    out = stream_queries._sized_join("line", stream_queries.fx.lines_from, stream_queries._BOXED)(spark, str(tmp_path))
    assert out.filter(F.col("a_id") == F.col("b_id")).count() == 12
    assert spark.read.parquet(f"{paths[-1]}/rows").columns == out.columns == ["win_start", "a_id", "b_id", "dist"]
