"""Physical plans: what must not be in them, and what must."""

import pytest
from pyspark.sql import functions as F

from wayfield.functions import geometry as G
from wayfield.functions.windows import WindowSpec
from wayfield.operators import joins, knn, ranges
from wayfield.plans import catalog
from wayfield.plans import fixtures as fx

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    """Stored points: plain columns, so predicates can reach the files."""
    path = str(tmp_path_factory.mktemp("pts") / "pts")
    spark.range(1000).selectExpr("id", "string(id % 7) AS obj_id", "timestamp_seconds(id) AS ts",
                                 "double(id % 100) AS x", "double(id % 37) AS y", "'unused' AS note").write.parquet(path)
    return spark.read.parquet(path)


@pytest.mark.parametrize("name", sorted(n for n in catalog.QUERIES if not n.startswith("str")))
def test_no_nested_loops(spark, name):
    text = plan(catalog.QUERIES[name](spark, SF))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "PythonUDF" not in text and "ArrowEvalPython" not in text


def test_range_reaches_the_scan(table):
    out = ranges.range_query(table, G.rectangle(10, 10, 20, 20), 1.0).select("id")
    text = plan(out)
    assert "GreaterThanOrEqual(x," in text and "LessThanOrEqual(y," in text
    assert "ReadSchema: struct<id:bigint,x:double,y:double>" in text
    assert "Exchange" not in text and "Join" not in text


def test_exact_refinement_adds_no_exchange(spark, table):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rings = fx.polys(spark, SF)
        text = plan(joins.distance_join(table, rings, 1.0, kinds=("point", "polygon")))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    above = text[:text.index("SortMergeJoin")]
    assert "HashAggregate" in above and "Exchange" not in above


def test_knn_limits_rows_before_the_shuffle(table):
    text = plan(knn.knn(table, G.point(1, 1), 5.0, 3, window=WindowSpec("1 minute")))
    assert text.count("WindowGroupLimit") == 2
    assert "partial_min" in text


def test_knn_without_windows_is_a_top_k(table):
    assert "TakeOrderedAndProject(limit=3" in plan(knn.knn(table, G.point(1, 1), 5.0, 3))


def test_large_sides_are_not_broadcast(table, monkeypatch):
    monkeypatch.setattr(joins, "MAX_BROADCAST_ROWS", 10)
    text = plan(joins.distance_join(table.select("id", "x", "y", "ts"), table.select("id", "x", "y", "ts"), 1.0))
    assert "SortMergeJoin" in text and "BroadcastHashJoin" not in text


def test_points_have_one_key_and_neighbours_at_most_four(table):
    pts = table.select("id", "x", "y", "ts")
    base = joins._base(2.0)
    a, b = joins._prefixed(pts, "a"), joins._prefixed(pts, "b")
    ka, kb, _ = joins._prepare(a, b, G.shape(G.POINT, "a_"), G.shape(G.POINT, "b_"), 2.0, base, list(joins.KEYS), None)
    assert ka.count() == 1000
    assert kb.groupBy("b_id").count().agg(F.max("count")).first()[0] <= 4
