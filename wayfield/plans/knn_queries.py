"""Registered k-nearest-neighbour queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.geometry import LINE, POINT, POLYGON
from ..functions.windows import WindowSpec
from ..operators import apps, knn, ranges
from . import fixtures as fx
from . import sql
from .range_queries import AS_OF, QUERY_SETS, TABLES, _key, pair_distances
from .registry import r6, register, win_start

R, K = 30.0, 5
WINDOW = WindowSpec(*fx.TUMBLING)
SLIDING = WindowSpec(*fx.SLIDING)


def result(df):
    return df.select(win_start().alias("win_start"), "obj_id", F.col("rank").cast("long").alias("rank"),
                     r6("dist").alias("dist"))


def _run(kind, q, r, window=WINDOW, **options):
    def fn(spark, sf_dir):
        return result(knn.knn(TABLES[kind](spark, sf_dir), q, r, K, kind=kind, window=window, **options))
    return fn


def knn_sql(kind, q, r, k=K, sliding=False, approx=False, where=""):
    table, key = sql.TABLE[kind], _key(kind)
    rows = f"({sql.sliding(table)})" if sliding else f"(SELECT *, {sql.win()} AS ws FROM {table})"
    limit = f" WHERE dist <= {sql.d(r)}" if r is not None else ""
    return (f"{pair_distances(kind, q.kind, [q], approx)}, "
            f"best AS (SELECT ws, obj_id, min(dist) AS dist FROM {rows} p JOIN dists ON dists.k = p.{key}"
            f"{limit}{where} GROUP BY ALL), "
            "ranked AS (SELECT *, row_number() OVER (PARTITION BY ws ORDER BY dist, obj_id) AS rank FROM best) "
            f"SELECT ws AS win_start, obj_id, rank, round(dist, 6) AS dist FROM ranked WHERE rank <= {k}")


PAIRINGS = (
    ("knn1_point_point", POINT, POINT), ("knn2_point_polygon", POINT, POLYGON),
    ("knn5_point_line", POINT, LINE), ("knn6_polygon_point", POLYGON, POINT),
    ("knn7_polygon_polygon", POLYGON, POLYGON), ("knn8_polygon_line", POLYGON, LINE),
    ("knn9_line_point", LINE, POINT), ("knn10_line_polygon", LINE, POLYGON),
    ("knn11_line_line", LINE, LINE),
)
for name, kind, query_kind in PAIRINGS:
    q = QUERY_SETS[query_kind][0]
    register(name, _run(kind, q, R), knn_sql(kind, q, R))
    if not kind == query_kind == POINT:
        register(f"{name}_approx", _run(kind, q, R, approx=True), knn_sql(kind, q, R, approx=True))
register("knn1_point_point_sliding", _run(POINT, fx.QUERY_POINTS[0], R, SLIDING),
         knn_sql(POINT, fx.QUERY_POINTS[0], R, sliding=True))
register("knn3_point_polygon_naive", _run(POINT, fx.QUERY_POLYGONS[1], None),
         knn_sql(POINT, fx.QUERY_POLYGONS[1], None))


def _latency(spark, sf_dir):
    """Latency of every point inside the radius that competes for the k places."""
    near = knn.nearby(fx.pts(spark, sf_dir), fx.QUERY_POLYGONS[0], R, POINT)
    return ranges.with_latency(near, F.lit(AS_OF).cast("timestamp")).select(
        "event_id", r6("dist").alias("dist"), "latency_ms")


register("knn4_point_polygon_latency", _latency,
         f"{pair_distances(POINT, POLYGON, fx.QUERY_POLYGONS[:1])} SELECT event_id, round(dist, 6) AS dist, "
         f"epoch_us(TIMESTAMP '{AS_OF}') // 1000 - ts_ms AS latency_ms FROM pts JOIN dists ON k = event_id "
         f"WHERE dist <= {sql.d(R)}")


def _nearest_robot(spark, sf_dir):
    streams = [fx.clicks(spark, sf_dir), fx.errors(spark, sf_dir)]
    return result(apps.nearest_of(streams, fx.QUERY_POINTS[0], None, WINDOW))


register("app8_nearest_of_union", _nearest_robot,
         knn_sql(POINT, fx.QUERY_POINTS[0], None, k=1, where=" WHERE event_type IN ('click', 'error')"))
