"""Geometry and grid expressions."""

import math
import random

import brute
import pytest
import shapes
from pyspark.sql import functions as F

from wayfield.functions import geometry as G
from wayfield.functions.grid import Grid, cell_id, layer, neighbor_cells
from wayfield.operators import cells


def test_contains_excludes_the_boundary(spark):
    pts = [(1, 5.0, 5.0), (2, 0.0, 5.0), (3, 10.0, 10.0), (4, 4.0, 5.0), (5, 11.0, 5.0), (6, 3.0, 3.0)]
    df = spark.createDataFrame(pts, "id int, x double, y double")
    hole = G.polygon([(0, 0), (10, 0), (10, 10), (0, 10)], [(4, 4), (6, 4), (6, 6), (4, 6)])
    got = df.filter(G.contains_point_sql(G.literal(hole), "x", "y"))
    assert [r.id for r in got.collect()] == [6]


def test_boundary_distance_ignores_the_interior(spark):
    square = G.rectangle(0, 0, 10, 10)
    df = spark.createDataFrame([(5.0, 4.0)], "x double, y double")
    assert df.select(F.expr(G.boundary_distance_sql("x", "y", G.literal(square).edges))).first()[0] == 4.0
    assert df.select(G.distance(G.shape(G.POINT), G.literal(square))).first()[0] == 0.0


def test_degenerate_edge(spark):
    q = G.line([(1, 1), (1, 1)])
    df = spark.createDataFrame([(4.0, 5.0)], "x double, y double")
    assert df.select(G.distance(G.shape(G.POINT), G.literal(q))).first()[0] == 5.0


def test_bbox_distance(spark):
    df = spark.createDataFrame([(0.0, 0.0)], "x double, y double")
    q = G.literal(G.rectangle(3, 4, 9, 9))
    assert df.select(G.bbox_distance(G.shape(G.POINT), q)).first()[0] == 5.0


def test_haversine(spark):
    df = spark.range(1).select(
        G.haversine("0D", "0D", "180D", "0D"), G.haversine("3D", "46D", "3D", "46D"),
        G.haversine("0D", "0D", "0D", "1D"))
    half, zero, degree = df.first()
    assert half == pytest.approx(math.pi * 6371008.7714) and zero < 1
    assert degree == pytest.approx(math.pi / 180 * 6371008.7714)


def test_text_coordinates(spark):
    df = spark.createDataFrame([("[[1, 2],[3.5,-4]]",), ("oops",)], "t string")
    a, b = df.select(G.coordinates_from_text(F.col("t")).alias("p")).collect()
    assert [(v.x, v.y) for v in a.p] == [(1, 2), (3.5, -4)] and b.p is None


@pytest.mark.parametrize("kind", ["polygon", "line"])
def test_cells_touched_equals_brute_force(spark, kind):
    make = shapes.random_polygons if kind == "polygon" else shapes.random_lines
    geometries = make(25, 21, span=10.0)
    grid = Grid.by_count(-20, -20, 20, 20, 20)
    got = cells.cells_touched(shapes.table(spark, geometries), grid, G.shape(kind)).select("id", "cx", "cy")

    def square(i, j):
        x, y = -20 + 2 * i, -20 + 2 * j
        return ("polygon", [[(x, y), (x + 2, y), (x + 2, y + 2), (x, y + 2), (x, y)]])

    want = {(n, i, j) for n, g in enumerate(geometries) for i in range(-12, 34) for j in range(-12, 34)
            if brute.distance(g, square(i, j)) <= 1e-12}
    assert {tuple(r) for r in got.collect()} == want


def test_cells_on_step_equals_brute_force(spark):
    rng = random.Random(3)
    steps = [tuple(rng.uniform(-3, 13) for _ in range(4)) for _ in range(300)] + [(0.5, 0.5, 0.6, 0.7)]
    grid = Grid.by_count(0, 0, 10, 10, 10)
    df = spark.createDataFrame(steps, "x1 double, y1 double, x2 double, y2 double")
    got = df.select("*", cells.cells_on_step(grid, *[F.col(c) for c in ("x1", "y1", "x2", "y2")]).alias("c")).collect()
    for row in got:
        (ax, ay), (bx, by) = grid.of(row.x1, row.y1), grid.of(row.x2, row.y2)
        line = ("line", [[(row.x1, row.y1), (row.x2, row.y2)]])
        span = [(i, j) for i in range(min(ax, bx), max(ax, bx) + 1) for j in range(min(ay, by), max(ay, by) + 1)]
        if ax == bx or ay == by:
            want = set(span)
        else:
            want = {(i, j) for i, j in span if (i, j) in ((ax, ay), (bx, by)) or brute.distance(
                line, ("polygon", [[(i, j), (i + 1, j), (i + 1, j + 1), (i, j + 1), (i, j)]])) == 0.0}
        assert {(c.cx, c.cy) for c in row.c} == want and len(row.c) == len(want)


def test_grid_by_cell_length_is_square():
    g = Grid.by_cell(0, 0, 100, 50, 7)
    assert (g.minx, g.miny, g.n) == (0, -25, 15) and g.cell == pytest.approx(100 / 15)
    assert Grid.by_cell(0, 0, 10, 10, 1000).n == 1


def test_grid_by_count_uses_the_x_extent():
    g = Grid.by_count(0, 0, 100, 50, 20)
    assert (g.cell, g.n) == (5, 20) and g.of(12.5, 49.9) == (2, 9) and g.of(-0.1, 0) == (-1, 0)


@pytest.mark.parametrize("r", [0.0, 0.5, 3.0, 10.0, 25.0])
def test_layers_are_sound(r):
    """Every pair of points in guaranteed cells is within r, none outside candidates is."""
    g = Grid.by_count(0, 0, 100, 100, 20)
    inner, outer = g.guaranteed_layers(r), g.candidate_layers(r)
    if inner >= 0:
        assert (inner + 1) * g.cell * math.sqrt(2) <= r + 1e-9
    assert outer * g.cell >= r


def test_cells_and_neighbours(spark):
    g = Grid.by_count(0, 0, 100, 100, 20)
    df = g.with_cell(spark.createDataFrame([(1, 12.0, 99.0), (2, -1.0, 5.0), (3, None, 1.0)], "id int, x double, y double"))
    rows = df.withColumns({"cell": cell_id(F.col("cx"), F.col("cy")), "l": layer(F.col("cx"), F.col("cy"), 0, 19)}).collect()
    assert [(r.cx, r.cy) for r in rows[:2]] == [(2, 19), (-1, 1)] and rows[0].cell == "0000200019" and rows[0].l == 2
    assert g.with_cell(df.drop("cx", "cy"), clip=True).count() == 1
    assert cells.has_cell(df).count() == 2
    block = neighbor_cells(df.filter("id = 1"), g, 5.0)
    assert block.count() == 6  # one row of the 3 x 3 block is beyond the grid
    assert neighbor_cells(df.filter("id = 1"), g, 0.0).count() == 1
