"""Range queries: keep stream objects within a distance of a set of query objects.

One operator covers every pairing of point, line and polygon. A small query set
(size checked, see ``MAX_LITERAL_VERTICES``) becomes a filter: no join, no shuffle,
box comparisons that reach the scan, and it works unchanged on a stream. A larger
set is joined on cell keys; the rows are the same.

Objects without coordinates are in no result, neither inside nor outside, and query
objects without coordinates count for nothing.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import Optional, Union

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geometry as G
from ..functions.geometry import QueryGeometry, Shape
from ..functions.grid import Grid
from ..functions.windows import WindowSpec, with_window
from . import joins

MAX_LITERAL_VERTICES = 2_000
# Up to this many edges a predicate is unrolled; beyond, edges are a literal array.
MAX_UNROLLED_EDGES = 64
MAX_UNROLLED_INNER_EDGES = 16  # inside a loop over the edges of a stream geometry

Queries = Union[QueryGeometry, Sequence[QueryGeometry]]


def _as_list(queries: Queries) -> list[QueryGeometry]:
    return [queries] if isinstance(queries, QueryGeometry) else list(queries)


def query_shape(q: QueryGeometry, stream_kind: str = G.POINT) -> Shape:
    """Unrolled while small; a literal edge array beyond that."""
    limit = MAX_UNROLLED_EDGES if stream_kind == G.POINT else MAX_UNROLLED_INNER_EDGES
    return G.literal(q, unrolled=q.kind == G.POINT or len(q.edges) <= limit)


def _any(preds: Sequence[str]) -> str:
    return "(" + " OR ".join(preds) + ")" if preds else "FALSE"


def within_any(stream: Shape, queries: Queries, r: float, approx: bool = False,
               grid: Optional[Grid] = None) -> str:
    """Predicate: the stream object is within ``r`` of at least one query object.

    ``approx`` compares bounding boxes; between points it accepts every point in the
    block of grid cells that can hold matches, and so needs ``grid``.
    """
    preds = []
    for q in _as_list(queries):
        s = query_shape(q, stream.kind)
        if approx and stream.kind == q.kind == G.POINT:
            preds.append(block_sql(stream, grid, q.bbox, grid.candidate_layers(r)))
        else:
            dist = G.bbox_distance_sql(stream, s) if approx else G.distance_sql(stream, s)
            preds.append(f"({G.bbox_near_sql(stream, s, r)} AND {dist} <= {G.num(r)})")
    return _any(preds)


def block_sql(stream: Shape, grid: Grid, box: tuple, layers: int) -> str:
    """Predicate: the point's cell is within ``layers`` of the cells under a box."""
    (i0, j0), (i1, j1) = grid.of(*box[:2]), grid.of(*box[2:])
    return (f"({grid.cx_sql(stream.x)} BETWEEN {i0 - layers} AND {i1 + layers} AND "
            f"{grid.cy_sql(stream.y)} BETWEEN {j0 - layers} AND {j1 + layers})")


def outside(stream: Shape, queries: Queries, r: float, mode: str = "all",
            approx: bool = False, grid: Optional[Grid] = None) -> str:
    """Predicate: farther than ``r`` from all query objects, or from any of them."""
    if mode == "all":
        return f"NOT {within_any(stream, queries, r, approx, grid)}"
    return _any([f"NOT {within_any(stream, q, r, approx, grid)}" for q in _as_list(queries)])


def located(df: DataFrame, kind: str) -> DataFrame:
    """The rows that have coordinates."""
    return df.filter("x IS NOT NULL AND y IS NOT NULL" if kind == G.POINT else "xmin IS NOT NULL")


def range_query(stream: DataFrame, queries: Union[Queries, DataFrame], r: float, *,
                kind: str = G.POINT, query_kind: Optional[str] = None,
                window: Optional[WindowSpec] = None, approx: bool = False,
                outside_mode: Optional[str] = None, grid: Optional[Grid] = None,
                row_id: Optional[Sequence[str]] = None, max_extent: Optional[float] = None,
                max_literal: int = MAX_LITERAL_VERTICES) -> DataFrame:
    """Stream objects within ``r`` of the query set (or outside it).

    The predicate is evaluated once per object and only survivors are spread over
    windows, so a sliding window re-evaluates nothing. A query DataFrame holding more
    than ``max_literal`` vertices is joined. For that case two things may be needed:
    ``row_id``, columns that identify a row, for lines and polygons in a table and for
    ``outside_mode="any"`` (tables only); ``max_extent``, the largest width or height,
    for a stream of lines or polygons.
    """
    if isinstance(queries, DataFrame):
        small = collect_queries(queries, query_kind, max_literal)
        if small is None:
            out = _range_join(stream, queries, r, kind, query_kind, approx, outside_mode, grid,
                              row_id, max_extent)
            return with_window(out, window) if window else out
        queries = small
    s = G.shape(kind)
    pred = (outside(s, queries, r, outside_mode, approx, grid) if outside_mode
            else within_any(s, queries, r, approx, grid))
    out = located(stream, kind).filter(pred)
    return with_window(out, window) if window else out


def collect_queries(queries: DataFrame, kind: str,
                    limit: int = MAX_LITERAL_VERTICES) -> Optional[list[QueryGeometry]]:
    """The query objects with coordinates as literals, or None if they are over the limit."""
    if kind == G.POINT:
        rows = located(queries, kind).select("x", "y").limit(limit + 1).collect()
        return None if len(rows) > limit else [G.point(*row) for row in rows]
    column = "rings" if kind == G.POLYGON else "paths"
    queries = queries.filter(F.size(F.flatten(column)) > 0)
    if (queries.agg(F.sum(F.size(F.flatten(column)))).first()[0] or 0) > limit:
        return None
    return [QueryGeometry(kind, tuple(tuple((v["x"], v["y"]) for v in path) for path in row[0]))
            for row in queries.select(column).limit(limit + 1).collect()]


def _range_join(stream, queries, r, kind, query_kind, approx, outside_mode, grid, row_id,
                max_extent) -> DataFrame:
    stream, queries = located(stream, kind), located(queries, query_kind)
    kinds = (kind, query_kind)
    if outside_mode == "any":
        return _outside_any(stream, queries, r, kinds, approx, grid, row_id)
    if kind == G.POINT or max_extent is not None:
        return joins.match(stream, queries, r, kinds=kinds, approx=approx, grid=grid,
                           inside=not outside_mode, max_extent=max_extent or 0.0)
    if stream.isStreaming or not row_id:
        raise ValueError("lines and polygons against a large query table need row_id (tables) "
                         "or max_extent (streams)")
    ids = joins.semi_join(stream, queries, r, kinds=kinds, row_id=row_id, approx=approx)
    return stream.join(ids, list(row_id), "left_anti" if outside_mode else "left_semi")


def _outside_any(stream, queries, r, kinds, approx, grid, row_id) -> DataFrame:
    """Rows that some query object is farther from than ``r``: all but those that hit every one.

    A few query objects, taken as literals, leave hardly a row that might; only these are
    paired with all query objects.
    """
    if stream.isStreaming or not row_id:
        raise ValueError("outside 'any' of a large query table needs row_id and a batch table")
    probes = collect_queries(queries.limit(4), kinds[1], 1_000_000)
    number = queries.count()
    s = G.shape(kinds[0])
    near = " AND ".join(within_any(s, q, r, approx, grid) for q in probes) or "TRUE"
    numbered = queries.withColumn("_query", F.monotonically_increasing_id())
    shape = ["x", "y"] if kinds[0] == G.POINT else ["xmin", "ymin", "xmax", "ymax", "edges", "anchors"]
    rows = stream.filter(near).select(*dict.fromkeys([*row_id, *shape]))
    pairs = joins.distance_join(rows, numbered, r, kinds=kinds, approx=approx, grid=grid)
    everywhere = (pairs.groupBy(*[F.col(f"a_{c}").alias(c) for c in row_id])
                  .agg(F.count_distinct("b__query").alias("_n")).filter(F.col("_n") == number).drop("_n"))
    return stream.join(everywhere, list(row_id), "left_anti")


def range_query_incremental(stream: DataFrame, query: QueryGeometry, r: float,
                            window: WindowSpec) -> DataFrame:
    """Windowed range query that evaluates each point once, on arrival.

    ``range_query`` with a window works this way always; this is its name for a single
    query object.
    """
    return range_query(stream, query, r, window=window)


def with_latency(df: DataFrame, as_of: Optional[Column] = None, ts: str = "ts") -> DataFrame:
    """Add ``latency_ms``: time from the event until now (or until ``as_of``)."""
    now = F.current_timestamp() if as_of is None else as_of
    return df.withColumn("latency_ms", F.unix_millis(now) - F.unix_millis(F.col(ts)))


def candidates(stream: DataFrame, queries: Queries, r: float, grid: Grid) -> DataFrame:
    """Points whose cell block can hold matches: what the latency probes count."""
    s = G.shape(G.POINT)
    layers = grid.candidate_layers(r)
    return stream.filter(_any([block_sql(s, grid, q.bbox, layers) for q in _as_list(queries)]))
