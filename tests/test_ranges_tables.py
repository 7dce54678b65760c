"""Range queries give the same rows whether the query set is a filter or a joined table."""

import random

import pytest
import shapes
from pyspark.sql import functions as F

from wayfield.functions.grid import Grid
from wayfield.operators import cells, ranges

GRID = Grid.by_count(0, 0, 100, 100, 10)


@pytest.fixture(scope="module")
def points(spark):
    rng = random.Random(1)
    rows = [(i, rng.uniform(0, 100), rng.uniform(0, 100)) for i in range(300)]
    rows += [(300 + i, None, 5.0) for i in range(10)] + [(320, 10.0, 10.0), (321, 20.0, 30.0)]
    return spark.createDataFrame(rows, "id long, x double, y double").cache()


def both(stream, queries, r, **options):
    rows = [sorted(x.id for x in ranges.range_query(stream, queries, r, row_id=["id"], max_literal=n, **options)
                   .select("id").collect()) for n in (10 ** 6, 0)]
    assert rows[0] == rows[1] and rows[0]
    return rows[0]


@pytest.mark.parametrize("mode", [None, "all", "any"])
@pytest.mark.parametrize("approx", [False, True])
def test_points(spark, points, mode, approx):
    queries = spark.createDataFrame([(50.0, 50.0), (52.0, 48.0), (None, 1.0), (90.0, 5.0)][:3 if mode == "any" else 4],
                                    "x double, y double")
    got = both(points, queries, 12.0, query_kind="point", outside_mode=mode, approx=approx, grid=GRID)
    assert not set(got) & set(range(300, 310))
    if mode == "any":  # some rows are near every query object
        assert len(got) < 302


@pytest.mark.parametrize("kind", ["polygon", "line"])
@pytest.mark.parametrize("mode", [None, "all", "any"])
def test_geometries(spark, points, kind, mode):
    make = shapes.random_polygons if kind == "polygon" else shapes.random_lines
    queries = make(12, 3)
    if kind == "polygon" and mode != "any":  # one object far larger than the others
        queries = queries + [("polygon", [[(60, 0), (95, 0), (95, 40), (60, 40), (60, 0)]])]
    both(points, shapes.table(spark, queries), 2.0 if mode != "any" else 40.0, query_kind=kind, outside_mode=mode)


def test_streams(spark, points, tmp_path):
    points.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(points.schema).parquet(str(tmp_path / "in"))
    queries = shapes.table(spark, shapes.random_polygons(12, 3))
    for mode in (None, "all"):
        found = ranges.range_query(stream, queries, 2.0, query_kind="polygon", outside_mode=mode, max_literal=0)
        name = f"ranges_{mode}"
        found.writeStream.format("memory").queryName(name).trigger(availableNow=True).start().awaitTermination()
        want = ranges.range_query(points, queries, 2.0, query_kind="polygon", outside_mode=mode)
        assert sorted(r.id for r in spark.table(name).collect()) == sorted(r.id for r in want.collect())


def test_no_join_back(spark, points):
    queries = shapes.table(spark, shapes.random_polygons(12, 3))
    plan = ranges.range_query(points, queries, 1.0, query_kind="polygon", max_literal=0)
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("LeftSemi") >= 1 and "Aggregate" not in text


def test_cells_as_table(spark):
    boxes = shapes.table(spark, shapes.random_polygons(40, 9))
    wanted = [(i, j) for i in range(3) for j in range(4)]
    as_list = cells.bbox_touches_cells(boxes, GRID, wanted)
    as_table = cells.bbox_touches_cells(boxes, GRID, spark.createDataFrame(wanted, "cx int, cy int"), ["id"])
    assert sorted(r.id for r in as_list.collect()) == sorted(r.id for r in as_table.collect())


def test_uneven_time_is_cut(spark):
    from wayfield.functions import ordered
    from wayfield.operators import trajectory as T
    rows = spark.range(4000).selectExpr("'a' AS obj_id", "timestamp_seconds(IF(id = 0, 0, 1700000000 + id)) AS ts",
                                        "double(id) AS x", "double(id) AS y")
    many = rows.unionByName(spark.range(3000).selectExpr(
        "concat('k', id % 30) AS obj_id", "timestamp_seconds(id) AS ts", "double(id) AS x", "0D AS y"))
    parts = T.lines(many, hot_rows=200)
    assert parts.agg(F.max("n_points")).first()[0] <= 200
    assert parts.agg(F.sum("n_points")).first()[0] == 7000
    assert ordered.with_slices(many, ["obj_id"], hot_rows=200).filter("obj_id LIKE 'k%' AND _slice > 0").isEmpty()
