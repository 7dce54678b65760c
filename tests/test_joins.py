"""Distance joins and range queries against brute force, with and without hot cells."""

import brute
import pytest
import shapes
from pyspark.sql import functions as F

from wayfield.functions import geometry as G
from wayfield.functions.grid import Grid
from wayfield.operators import joins, ranges

MAKE = {"point": shapes.random_points, "polygon": shapes.random_polygons, "line": shapes.random_lines}
KINDS = sorted(MAKE)


def expected(a, b, r):
    return sorted((i, j) for i, s in enumerate(a) for j, t in enumerate(b) if brute.distance(s, t) <= r)


@pytest.mark.parametrize("ka", KINDS)
@pytest.mark.parametrize("kb", KINDS)
@pytest.mark.parametrize("r", [0.0, 1.5])
def test_join_equals_brute_force(spark, rows_of, ka, kb, r):
    a, b = MAKE[ka](40, 1), MAKE[kb](40, 2)
    df = joins.distance_join(shapes.table(spark, a), shapes.table(spark, b), r, kinds=(ka, kb))
    assert rows_of(df, "a_id", "b_id") == expected(a, b, r)


@pytest.mark.parametrize("ka,kb", [("point", "point"), ("point", "polygon"), ("polygon", "line"), ("polygon", "polygon")])
def test_join_with_hot_cells(spark, rows_of, ka, kb):
    """Nearly everything in one spot: cells are salted on both sides."""
    a, b = MAKE[ka](60, 3, span=2.0), MAKE[kb](60, 4, span=2.0)
    ta, tb = shapes.table(spark, a), shapes.table(spark, b)
    df = joins.distance_join(ta, tb, 1.0, kinds=(ka, kb), hot_rows=7)
    assert "_salt_a" in df._jdf.queryExecution().analyzed().toString()
    assert rows_of(df, "a_id", "b_id") == expected(a, b, 1.0)


@pytest.mark.parametrize("ka,kb", [("point", "point"), ("point", "polygon"), ("line", "polygon")])
def test_leaf_join_agrees(spark, rows_of, ka, kb):
    a, b = shapes.table(spark, MAKE[ka](50, 5)), shapes.table(spark, MAKE[kb](50, 6))
    assert rows_of(joins.leaf_join(a, b, 2.0, kinds=(ka, kb)), "a_id", "b_id") == \
        rows_of(joins.distance_join(a, b, 2.0, kinds=(ka, kb)), "a_id", "b_id")


def test_giant_polygon_is_not_spread_over_many_cells(spark, rows_of):
    big = [("polygon", [[(-1e6, -1e6), (1e6, -1e6), (1e6, 1e6), (-1e6, 1e6), (-1e6, -1e6)]])]
    a, b = shapes.random_points(30, 7), big + shapes.random_polygons(10, 8, sizes=(0.01,))
    df = joins.distance_join(shapes.table(spark, a), shapes.table(spark, b), 0.001, kinds=("point", "polygon"))
    assert rows_of(df, "a_id", "b_id") == expected(a, b, 0.001)


def test_equal_rows_keep_their_number(spark):
    one = shapes.random_polygons(12, 9)
    a = shapes.table(spark, one).withColumns({"id": F.lit(0), "ts": F.lit(None).cast("timestamp")})
    same = a.unionByName(a)
    b = shapes.table(spark, shapes.random_points(60, 10))
    once = joins.distance_join(b, a, 1.0, kinds=("point", "polygon")).count()
    assert joins.distance_join(b, same, 1.0, kinds=("point", "polygon")).count() == 2 * once > 0
    assert joins.distance_join(same, a, 1.0, kinds=("polygon", "polygon")).count() == \
        2 * joins.distance_join(a, a, 1.0, kinds=("polygon", "polygon")).count()


def test_points_on_cell_edges(spark, rows_of):
    pts = [("point", [[(float(i), float(j))]]) for i in range(-3, 4) for j in range(-3, 4)]
    t = shapes.table(spark, pts)
    assert rows_of(joins.distance_join(t, t, 1.0), "a_id", "b_id") == expected(pts, pts, 1.0)


def test_empty_sides(spark):
    p, q = shapes.table(spark, shapes.random_points(5, 1)), shapes.table(spark, shapes.random_polygons(5, 1))
    assert joins.distance_join(p, q.limit(0), 5.0, kinds=("point", "polygon")).count() == 0
    assert joins.distance_join(p.limit(0), q, 5.0, kinds=("point", "polygon")).count() == 0


def test_null_coordinates_match_nothing(spark):
    p = shapes.table(spark, shapes.random_points(5, 1)).withColumn("x", F.lit(None).cast("double"))
    assert joins.distance_join(p, p, 5.0).count() == 0


def as_query(s):
    return G.QueryGeometry(s[0], tuple(tuple(p) for p in s[1]))


@pytest.mark.parametrize("kind", KINDS)
@pytest.mark.parametrize("query_kind", KINDS)
@pytest.mark.parametrize("r", [0.0, 2.0])
def test_range_equals_brute_force(spark, rows_of, kind, query_kind, r):
    stream, queries = MAKE[kind](60, 11), MAKE[query_kind](3, 12)
    df = ranges.range_query(shapes.table(spark, stream), [as_query(q) for q in queries], r, kind=kind)
    assert rows_of(df, "id") == sorted({(i,) for i, _ in expected(stream, queries, r)})


@pytest.mark.parametrize("kind,query_kind", [("point", "polygon"), ("point", "point"), ("line", "polygon")])
@pytest.mark.parametrize("outside", [None, "all"])
def test_large_query_table_is_joined(spark, rows_of, kind, query_kind, outside):
    stream, queries = MAKE[kind](60, 13), MAKE[query_kind](20, 14)
    df = ranges.range_query(shapes.table(spark, stream), shapes.table(spark, queries), 1.0, kind=kind,
                            query_kind=query_kind, row_id=["id"], outside_mode=outside, max_literal=2)
    hits = {i for i, _ in expected(stream, queries, 1.0)}
    want = hits if outside is None else set(range(len(stream))) - hits
    assert rows_of(df, "id") == sorted((i,) for i in want)


def test_small_query_table_becomes_a_filter(spark, rows_of):
    stream, queries = shapes.random_points(60, 13), shapes.random_polygons(5, 14)
    t = shapes.table(spark, stream)
    df = ranges.range_query(t, shapes.table(spark, queries), 1.0, query_kind="polygon")
    assert rows_of(df, "id") == sorted({(i,) for i, _ in expected(stream, queries, 1.0)})
    assert "Join" not in df._jdf.queryExecution().executedPlan().toString()


def test_many_edges_are_not_unrolled(spark, rows_of):
    import math
    ring = [(10 * math.cos(i / 50 * math.tau), 10 * math.sin(i / 50 * math.tau)) for i in range(50)]
    circle = ("polygon", [ring + ring[:1], [(x / 2, y / 2) for x, y in ring + ring[:1]]])
    stream = shapes.random_points(80, 15)
    df = ranges.range_query(shapes.table(spark, stream), as_query(circle), 1.0)
    assert rows_of(df, "id") == sorted((i,) for i, _ in expected(stream, [circle], 1.0))


def test_empty_query_set(spark):
    t = shapes.table(spark, shapes.random_points(5, 1))
    assert ranges.range_query(t, [], 5.0).count() == 0
    assert ranges.range_query(t, [], 5.0, outside_mode="all").count() == t.count()


def test_outside_modes(spark, rows_of):
    t = shapes.table(spark, shapes.random_points(40, 16))
    a, b = G.rectangle(-30, -30, 0, 30), G.rectangle(0, -30, 30, 30)
    assert ranges.range_query(t, [a, b], 0.1, outside_mode="all").count() == 0
    assert ranges.range_query(t, [a, b], 0.0, outside_mode="any").count() >= 40


def test_box_corner_is_not_a_hit(spark):
    """The corner of a diamond's box is outside the diamond, however coarse the grid."""
    t = spark.createDataFrame([(1, 3.9, 3.9)], "id int, x double, y double")
    diamond = G.polygon([(0, -4), (4, 0), (0, 4), (-4, 0)])
    assert ranges.range_query(t, diamond, 0.5).count() == 0
    assert ranges.range_query(t, diamond, 0.5, approx=True).count() == 1


def test_all_parts_count(spark):
    t = spark.createDataFrame([(1, 10.5, 0.5), (2, 5.0, 5.0)], "id int, x double, y double")
    two = G.polygon([(0, 0), (1, 0), (1, 1), (0, 1)], [(10, 0), (11, 0), (11, 1), (10, 1)])
    assert [r.id for r in ranges.range_query(t, two, 0.0).collect()] == [1]


def test_approx_point_block(spark):
    grid = Grid.by_count(0, 0, 100, 100, 100)
    t = spark.createDataFrame([(1, 12.9, 12.9), (2, 13.1, 10.0)], "id int, x double, y double")
    out = ranges.range_query(t, [G.point(10.5, 10.5), G.point(10.6, 10.6)], 2.0, approx=True, grid=grid)
    assert [r.id for r in out.collect()] == [1]


def test_leaves_split_a_cluster_on_one_x(spark):
    """Points of one x are spread over leaves by y; equal points and none at all make one leaf."""
    tree = joins._split([(5.0, i / 7) for i in range(640)], 10)

    def leaves(node):
        return [node] if isinstance(node, int) else leaves(node[2]) + leaves(node[3])

    assert sorted(leaves(tree)) == list(range(len(leaves(tree)))) and len(leaves(tree)) >= 64
    assert joins._split([(1.0, 2.0)] * 50, 10) == 0 == joins._split([], 1)
    assert len(leaves(joins._split([(1.0, 1.0)] * 50 + [(0.0, 0.0)], 10))) == 2
    rows = [(f"p{i}", 5.0, i / 7) for i in range(200)] + [("q", None, 1.0)]
    df = spark.createDataFrame(rows, "obj_id string, x double, y double")
    a, b = (df.select("obj_id", "x", "y") for _ in "ab")
    assert joins.leaf_join(a, b, 0.5).count() == joins.distance_join(a, b, 0.5).count() > 200


@pytest.mark.parametrize("kinds", [("point", "point"), ("line", "polygon"), ("polygon", "point")])
def test_tasks_follow_pairs(spark, monkeypatch, kinds):
    """Denser tables get more tasks, not larger ones, and the same pairs."""
    x = "double(id % 20) / 2"
    pts = spark.range(300).selectExpr("id", x, f"{x} AS x", "double(id div 20) AS y").select("id", "x", "y")
    box = "array(struct(x, y), struct(x + 1 AS x, y), struct(x + 1 AS x, y + 1 AS y), struct(x, y))"
    shapes = {"point": pts, "line": G.with_edges(pts.selectExpr("id", f"array({box}) AS paths"), "paths"),
              "polygon": G.with_edges(pts.selectExpr("id", f"array({box}) AS rings"), "rings")}
    a, b = shapes[kinds[0]], shapes[kinds[1]]

    def pairs():
        out = joins.distance_join(a, b, 1.5, kinds=kinds)
        return sorted((r.a_id, r.b_id, round(r.dist, 9)) for r in out.select("a_id", "b_id", "dist").collect())

    want = pairs()
    wide, _ = joins._spread(pts.withColumn("k", F.lit(1)), pts.withColumn("k", F.lit(1)), ["k"])
    assert wide.rdd.getNumPartitions() == pts.rdd.getNumPartitions()  # few pairs: as they are
    monkeypatch.setattr(joins, "MAX_BROADCAST_ROWS", 0)
    monkeypatch.setattr(joins, "PAIRS_PER_TASK", 900)
    wide, other = joins._spread(pts.withColumn("k", F.lit(1)), pts.withColumn("k", F.lit(1)), ["k"])
    assert wide.rdd.getNumPartitions() == other.rdd.getNumPartitions() == 101  # 300 x 300 pairs
    assert pairs() == want and len(want) > 300


def _points(spark, n, name):
    return spark.range(n).selectExpr(f"id AS {name}", "id * 7 % 13 / 4D - 1 AS x", "id * 5 % 11 / 4D - 1 AS y").localCheckpoint()


def test_spread_point_pairs_are_shuffled_once(spark, monkeypatch):
    """A join with cells of one size is dealt once, into the tasks that its pairs ask for."""
    monkeypatch.setattr(joins, "MAX_BROADCAST_ROWS", 10)
    monkeypatch.setattr(joins, "PAIRS_PER_TASK", 50)
    a, b = _points(spark, 60, "i"), _points(spark, 50, "j")
    for options in ({}, {"approx": True, "grid": Grid.by_count(0, 0, 10, 10, 20)}):
        plan = joins.distance_join(a, b, 0.5, **options)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 2 and plan.count("REPARTITION_BY_NUM") == 2


def test_candidate_blocks_share_few_keys(spark):
    """Points of a candidate block meet once, in keys that hold few other pairs; what lies outside the grid too."""
    grid = Grid.by_count(0, 0, 10, 10, 20)
    for r in (0.0, 0.5, 0.6, 1.7):
        k = grid.candidate_layers(r)
        a, b = _points(spark, 150, "i"), _points(spark, 140, "j")
        got = sorted((p.a_i, p.b_j) for p in joins.distance_join(a, b, r, approx=True, grid=grid).collect())
        want = [(p.i, q.j) for p in a.collect() for q in b.collect()
                if all(abs(u - v) <= k for u, v in zip(grid.of(p.x, p.y), grid.of(q.x, q.y)))]
        assert got == sorted(want)
    k = grid.candidate_layers(0.5)
    sa, sb = (joins._cell_centre(G.shape(G.POINT), grid) for _ in "ab")
    ka, kb = joins._keyed(a, b, sa, sb, k + 1e-9, 2.0 * k, [0], [0])
    assert kb.count() == 4 * 140 and ka.count() == 150


def test_rounding_by_arithmetic_is_rounding(spark):
    from wayfield.plans.registry import r6, r6_double
    fixed = [None, float("nan"), float("inf"), -float("inf"), 0.0, -0.0, 1e-9, -1e-9, 5e-7, -5e-7, 1.0000005, 2.5000015, 1e6, 123456.7890125,
             1e15 + 0.3, -2.9999995, 1e300, 999999.9999995]
    rows = spark.createDataFrame([(v,) for v in fixed], "v double").unionByName(
        spark.range(20000).selectExpr("sqrt(id / 7D) * pow(10D, id % 9 - 4) * IF(id % 2 = 0, 1, -1) AS v")).unionByName(
        spark.range(5000).selectExpr("id / 2e6D AS v"))
    odd = rows.select("v", r6_double("v").alias("got"), r6("v").alias("want")).filter("NOT (got <=> want) OR string(got) != string(want)")
    assert odd.collect() == []


def test_leaf_join_refines_without_loops(spark, monkeypatch):
    """Edges of the twin's pairs are rows, not loops over arrays; many pairs go to many tasks."""
    monkeypatch.setattr(joins, "MAX_BROADCAST_ROWS", 10)
    monkeypatch.setattr(joins, "PAIRS_PER_TASK", 20)
    from wayfield.functions.windows import WindowSpec
    ts = "timestamp_seconds(id * 600) AS ts"
    a = spark.range(60).selectExpr("id", ts, "id * 7 % 13 / 4D AS x", "id * 5 % 11 / 4D AS y").localCheckpoint()
    corners = ", ".join(f"named_struct('x', id % 9 / 2D + {dx}D, 'y', id % 5 / 2D + {dy}D)" for dx, dy in ((0, 0), (1, 0), (0, 1), (0, 0)))
    b = G.with_edges(spark.range(50).selectExpr("id", ts, f"array(array({corners})) AS rings"), "rings").localCheckpoint()
    options = {"kinds": (G.POINT, G.POLYGON), "window": WindowSpec("2 hours")}
    got = joins.leaf_join(a, b, 0.4, **options)
    text = got._jdf.queryExecution().executedPlan().toString()
    assert "lambda" not in text and "REPARTITION_BY_NUM" in text
    key = lambda df: sorted((r.window.start, r.a_id, r.b_id, r.dist) for r in df.collect())
    assert key(got) == key(joins.distance_join(a, b, 0.4, **options)) and got.count() > 20
