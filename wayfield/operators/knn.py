"""The k objects nearest to a query object, per window."""

from __future__ import annotations

from typing import Optional

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import geometry as G
from ..functions.geometry import QueryGeometry
from ..functions.windows import WindowSpec, window_aggregate
from .ranges import query_shape


def nearby(stream: DataFrame, query: QueryGeometry, r: Optional[float], kind: str,
           approx: bool = False, prefilter: bool = True) -> DataFrame:
    """Rows within ``r`` (all rows for None) with their distance ``dist``.

    Without ``prefilter`` the box test is left out, which serves as a check of it.
    """
    s, q = G.shape(kind), query_shape(query, kind)
    points = s.kind == q.kind == G.POINT
    dist = G.bbox_distance_sql(s, q) if approx and not points else G.distance_sql(s, q)
    if r is not None:
        near = f"{G.bbox_near_sql(s, q, r)} AND " if prefilter else ""
        stream = stream.filter(f"{near}{dist} <= {G.num(r)}")
    return stream.withColumn("dist", F.expr(dist))


def object_distances(stream: DataFrame, query: QueryGeometry, r: Optional[float], *,
                     kind: str = G.POINT, window: Optional[WindowSpec] = None,
                     approx: bool = False) -> DataFrame:
    """Smallest distance of every object in every window; runs on streams too."""
    near = nearby(stream, query, r, kind, approx)
    if window:
        return window_aggregate(near, ["obj_id"], window, {"dist": ("min", F.col("dist"))})
    return near.groupBy("obj_id").agg(F.min("dist").alias("dist"))


def rank_nearest(distances: DataFrame, k: int) -> DataFrame:
    """Keep the first k objects per window; each task forwards at most k rows of one."""
    order = ["dist", "obj_id"]
    if "window" not in distances.columns:
        distances = distances.orderBy(*order).limit(k)
        return distances.withColumn("rank", F.row_number().over(W.partitionBy(F.lit(0)).orderBy(*order)))
    rank = F.row_number().over(W.partitionBy("window").orderBy(*order))
    return distances.withColumn("rank", rank).filter(F.col("rank") <= k)


def knn(stream: DataFrame, query: QueryGeometry, r: Optional[float], k: int, *,
        kind: str = G.POINT, window: Optional[WindowSpec] = None,
        approx: bool = False) -> DataFrame:
    """(window, obj_id, dist, rank) of the k nearest distinct objects; ties by id."""
    return rank_nearest(object_distances(stream, query, r, kind=kind, window=window,
                                         approx=approx), k)
