"""Random spatial tables for tests."""

import random

from pyspark.sql import functions as F

from wayfield.functions import geometry as G


def random_points(n, seed, span=30.0):
    rng = random.Random(seed)
    out = [[(rng.uniform(-span, span), rng.uniform(-span, span))] for _ in range(n)]
    return [("point", [p]) for p in out] + [("point", [[(0.0, 0.0)]]), ("point", [[(5.0, -5.0)]])]


def random_polygons(n, seed, span=30.0, sizes=(0.3, 2.0, 9.0)):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        x, y, s = rng.uniform(-span, span), rng.uniform(-span, span), rng.choice(sizes)

        def square(h, x=x, y=y):
            return [(x - h, y - h), (x + h, y - h), (x + h, y + h), (x - h, y + h), (x - h, y - h)]
        if i % 3 == 0:
            rings = [square(s)]
        elif i % 3 == 1:
            rings = [[(x, y - s), (x + s, y), (x, y + s), (x - s, y), (x, y - s)]]
        else:
            rings = [square(2 * s), square(s)]
        out.append(("polygon", rings))
    return out


def random_lines(n, seed, span=30.0):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        path = [(rng.uniform(-span, span), rng.uniform(-span, span))]
        for _ in range(rng.randint(1, 3)):
            path.append((path[-1][0] + rng.uniform(-4, 4), path[-1][1] + rng.uniform(-4, 4)))
        out.append(("line", [path]))
    return out


def table(spark, shapes):
    """(id, ts, geometry) of one kind."""
    kind = shapes[0][0]
    if kind == "point":
        df = spark.createDataFrame([(i, *s[1][0][0]) for i, s in enumerate(shapes)], "id int, x double, y double")
        return df.withColumn("ts", F.timestamp_seconds("id"))
    rows = [(i, [[{"x": float(x), "y": float(y)} for x, y in path] for path in s[1]]) for i, s in enumerate(shapes)]
    column = "rings" if kind == "polygon" else "paths"
    df = spark.createDataFrame(rows, f"id int, {column} {G.RINGS_TYPE}")
    return G.with_edges(df.withColumn("ts", F.timestamp_seconds("id")), column)
