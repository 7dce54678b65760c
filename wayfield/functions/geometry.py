"""Planar geometry as Column expressions.

A geometry is described by a ``Shape``: the SQL text of its coordinates, its edges
and its bounding box. The edges of a column-backed shape are an
``ARRAY<STRUCT<x1,y1,x2,y2>>``; those of a query object known when the plan is
written can be unrolled into plain arithmetic that stays inside generated code.
Expressions are composed as SQL text because one ``F.expr`` is far cheaper to build
than thousands of Column calls.

Containment follows the even-odd rule over all edges, so holes and disjoint parts
need no special case, and every distance takes all parts into account.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from typing import Optional, Union

from pyspark.sql import Column
from pyspark.sql import functions as F

POINT, LINE, POLYGON = "point", "line", "polygon"

EARTH_RADIUS_M = 6371008.7714  # fixed value

COORDS_TYPE = "array<struct<x:double,y:double>>"
RINGS_TYPE = f"array<{COORDS_TYPE}>"
PARTS_TYPE = f"array<{RINGS_TYPE}>"
EDGES_TYPE = "array<struct<x1:double,y1:double,x2:double,y2:double>>"


def num(v: float) -> str:
    """A double literal in SQL text."""
    return f"({float(v)!r}D)"


# --------------------------------------------------------------------------
# shapes
# --------------------------------------------------------------------------
@dataclass(frozen=True)
class QueryGeometry:
    """A query object written in the driver: point, line(s) or polygon ring(s)."""

    kind: str
    paths: tuple[tuple[tuple[float, float], ...], ...]

    @property
    def vertices(self) -> list[tuple[float, float]]:
        return [v for path in self.paths for v in path]

    @property
    def edges(self) -> list[tuple[float, float, float, float]]:
        return [(*p, *q) for path in self.paths for p, q in zip(path, path[1:])]

    @property
    def bbox(self) -> tuple[float, float, float, float]:
        xs, ys = zip(*self.vertices)
        return min(xs), min(ys), max(xs), max(ys)


def point(x: float, y: float) -> QueryGeometry:
    return QueryGeometry(POINT, (((float(x), float(y)),),))


def _path(coords: Sequence[Sequence[float]]) -> tuple[tuple[float, float], ...]:
    return tuple((float(x), float(y)) for x, y in coords)


def line(*paths: Sequence[Sequence[float]]) -> QueryGeometry:
    return QueryGeometry(LINE, tuple(_path(p) for p in paths))


def polygon(*rings: Sequence[Sequence[float]]) -> QueryGeometry:
    """Rings of one polygon, or of several disjoint ones; open rings are closed."""
    closed = [_path(r) for r in rings]
    return QueryGeometry(POLYGON, tuple(r if r[0] == r[-1] else r + r[:1] for r in closed))


def rectangle(xmin: float, ymin: float, xmax: float, ymax: float) -> QueryGeometry:
    return polygon([(xmin, ymin), (xmax, ymin), (xmax, ymax), (xmin, ymax)])


@dataclass(frozen=True)
class Shape:
    """SQL text for the parts of a geometry.

    ``edges`` is the name of an edge array, or the list of edges of a query object.
    """

    kind: str
    xmin: str
    ymin: str
    xmax: str
    ymax: str
    edges: Union[str, list, None] = None
    anchors: Union[str, list, None] = None  # first vertex of every ring or path
    box: Optional[tuple[float, float, float, float]] = None  # of a query object

    @property
    def x(self) -> str:
        return self.xmin

    @property
    def y(self) -> str:
        return self.ymin


def shape(kind: str, prefix: str = "") -> Shape:
    """The shape held by the columns of a spatial table (see ``with_edges``)."""
    if kind == POINT:
        x, y = f"{prefix}x", f"{prefix}y"
        return Shape(POINT, x, y, x, y)
    return Shape(kind, *[prefix + c for c in ("xmin", "ymin", "xmax", "ymax", "edges", "anchors")])


def literal(q: QueryGeometry, unrolled: bool = True) -> Shape:
    """A query object; ``unrolled`` edges become plain arithmetic, else a literal array."""
    edges = None if q.kind == POINT else q.edges
    if edges is not None and not unrolled:
        rows = ", ".join(
            f"named_struct('x1', {num(a)}, 'y1', {num(b)}, 'x2', {num(c)}, 'y2', {num(d)})"
            for a, b, c, d in edges)
        edges = f"array({rows})"
    return Shape(q.kind, *[num(v) for v in q.bbox], edges=edges,
                 anchors=[path[0] for path in q.paths], box=q.bbox)


def edges_of(paths: Column) -> Column:
    """Edges of an ``array<array<struct<x,y>>>`` (rings of a polygon, parts of a line)."""
    def one(path):
        n = F.greatest(F.size(path) - 1, F.lit(0))
        return F.zip_with(
            F.slice(path, F.lit(1), n), F.slice(path, F.lit(2), n),
            lambda a, b: F.struct(a["x"].alias("x1"), a["y"].alias("y1"),
                                  b["x"].alias("x2"), b["y"].alias("y2")))
    return F.flatten(F.transform(paths, one))


def bbox_columns(paths: Column) -> dict[str, Column]:
    """xmin, ymin, xmax, ymax of an ``array<array<struct<x,y>>>``."""
    flat = F.flatten(paths)
    xs = F.transform(flat, lambda v: v["x"])
    ys = F.transform(flat, lambda v: v["y"])
    return {"xmin": F.array_min(xs), "ymin": F.array_min(ys),
            "xmax": F.array_max(xs), "ymax": F.array_max(ys)}


def once(df, **columns: Column):
    """Add columns that are computed once per row.

    The optimizer copies a plain derived column into every predicate that mentions it;
    it does not look through a generator.
    """
    row = F.struct(*[c.alias(name) for name, c in columns.items()])
    return df.select("*", F.inline(F.array(row)))


def with_edges(df, paths: str):
    """Add ``edges``, ``anchors`` and the flat bounding box of the geometry column ``paths``."""
    first = F.transform(F.col(paths), lambda p: F.get(p, F.lit(0)))
    return once(df, edges=edges_of(F.col(paths)), anchors=first, **bbox_columns(F.col(paths)))


def close_ring(ring: Column) -> Column:
    first, last = F.get(ring, 0), F.get(ring, F.size(ring) - 1)
    return F.when(first == last, ring).otherwise(F.concat(ring, F.array(first)))


def ring_area(ring: Column) -> Column:
    """Signed area of a closed ring."""
    return F.aggregate(edges_of(F.array(ring)), F.lit(0.0),
                       lambda acc, e: acc + (e["x1"] * e["y2"] - e["x2"] * e["y1"])) / 2


def order_rings(rings: Column) -> Column:
    """Close every ring and put the one with the largest area (the shell) first."""
    keyed = F.transform(F.transform(rings, close_ring),
                        lambda r: F.struct((-F.abs(ring_area(r))).alias("a"), r.alias("ring")))
    return F.transform(F.array_sort(keyed), lambda s: s["ring"])


def coordinates_from_text(text: Column) -> Column:
    """``[[x,y],...]`` as ``array<struct<x,y>>``."""
    return F.transform(F.from_json(text, "array<array<double>>"),
                       lambda p: F.struct(F.get(p, 0).alias("x"), F.get(p, 1).alias("y")))


# --------------------------------------------------------------------------
# reductions over edges: unrolled for query objects, higher-order for columns
# --------------------------------------------------------------------------
Edge = tuple  # of four SQL texts, or of four numbers


def _over(edges, var: str, fn: Callable[[Edge], str]):
    """Terms of an unrolled edge list, or (array, lambda body) of a column."""
    if isinstance(edges, list):
        return [fn(e) for e in edges]
    return edges, fn(tuple(f"{var}.{c}" for c in ("x1", "y1", "x2", "y2")))


def _min_over(edges, var: str, fn: Callable[[Edge], str]) -> str:
    out = _over(edges, var, fn)
    if isinstance(out, list):
        return f"least({', '.join(out)})" if len(out) > 1 else out[0]
    return f"array_min(transform({out[0]}, {var} -> {out[1]}))"


def _any_over(edges, var: str, fn: Callable[[Edge], str]) -> str:
    out = _over(edges, var, fn)
    if isinstance(out, list):
        return "(" + " OR ".join(out) + ")"
    return f"exists({out[0]}, {var} -> {out[1]})"


def _count_over(edges, var: str, fn: Callable[[Edge], str]) -> str:
    one = lambda e: f"CASE WHEN {fn(e)} THEN 1 ELSE 0 END"
    out = _over(edges, var, one)
    if isinstance(out, list):
        return "(" + " + ".join(out) + ")"
    return f"aggregate({out[0]}, 0, (n, {var}) -> n + {out[1]})"


def _numbers(e: Edge) -> bool:
    return isinstance(e[0], float)


def _texts(e: Edge) -> Edge:
    return tuple(num(v) for v in e) if _numbers(e) else e


def _delta(e: Edge) -> tuple[str, str, str]:
    """dx, dy and squared length of an edge, folded for query objects."""
    if _numbers(e):
        dx, dy = e[2] - e[0], e[3] - e[1]
        return num(dx), num(dy), num(dx * dx + dy * dy)
    x1, y1, x2, y2 = e
    dx, dy = f"({x2} - {x1})", f"({y2} - {y1})"
    return dx, dy, f"({dx} * {dx} + {dy} * {dy})"


# --------------------------------------------------------------------------
# distances
# --------------------------------------------------------------------------
def _square_sum(a: str, b: str) -> str:
    return f"({a} * {a} + {b} * {b})"


def point_distance_sql(x1: str, y1: str, x2: str, y2: str) -> str:
    return f"sqrt({_square_sum(f'({x1} - {x2})', f'({y1} - {y2})')})"


def point_distance(x1: str, y1: str, x2: str, y2: str) -> Column:
    return F.expr(point_distance_sql(x1, y1, x2, y2))


def segment_distance2_sql(px: str, py: str, e: Edge) -> str:
    """Squared distance to an edge: to an end, or to the line if the foot lies between."""
    x1, y1, x2, y2 = _texts(e)
    dx, dy, len2 = _delta(e)
    along = f"(({px} - {x1}) * {dx} + ({py} - {y1}) * {dy})"
    across = f"(({px} - {x1}) * {dy} - ({py} - {y1}) * {dx})"
    return (f"CASE WHEN {along} <= 0D THEN {_square_sum(f'({px} - {x1})', f'({py} - {y1})')} "
            f"WHEN {along} >= {len2} THEN {_square_sum(f'({px} - {x2})', f'({py} - {y2})')} "
            f"ELSE {across} * {across} / {len2} END")


def boundary_distance_sql(px: str, py: str, edges, var: str = "e") -> str:
    """Distance from a point to the nearest edge; the interior does not count."""
    return f"sqrt({_min_over(edges, var, lambda e: segment_distance2_sql(px, py, e))})"


def crosses_ray_sql(px: str, py: str, e: Edge) -> str:
    """The ray from the point towards larger x crosses the edge."""
    x1, y1, x2, y2 = _texts(e)
    dx, dy, _ = _delta(e)
    return (f"({y1} > {py}) != ({y2} > {py}) AND "
            f"{px} < {dx} * try_divide({py} - {y1}, {dy}) + {x1}")


def inside_sql(px: str, py: str, edges, var: str = "e") -> str:
    """Even-odd test; a point on the boundary may fall on either side."""
    if isinstance(edges, list):
        edges = [e for e in edges if e[1] != e[3]]
    return f"({_count_over(edges, var, lambda e: crosses_ray_sql(px, py, e))} % 2 = 1)"


def on_boundary_sql(px: str, py: str, edges) -> str:
    def on(e: Edge) -> str:
        x1, y1, x2, y2 = _texts(e)
        dx, dy, _ = _delta(e)
        return (f"({dx} * ({py} - {y1}) - {dy} * ({px} - {x1}) = 0D "
                f"AND {px} BETWEEN least({x1}, {x2}) AND greatest({x1}, {x2}) "
                f"AND {py} BETWEEN least({y1}, {y2}) AND greatest({y1}, {y2}))")
    return _any_over(edges, "e", on)


def contains_point_sql(poly: Shape, px: str, py: str, prefilter: bool = True) -> str:
    """True for points in the interior; the boundary is excluded."""
    box = (f"{px} > {poly.xmin} AND {px} < {poly.xmax} AND {py} > {poly.ymin} AND "
           f"{py} < {poly.ymax} AND " if prefilter else "")
    return f"({box}{inside_sql(px, py, poly.edges)} AND NOT {on_boundary_sql(px, py, poly.edges)})"


def edges_distance2_sql(e: Edge, f: Edge, kinds: tuple[str, str]) -> str:
    """Squared distance of two edges; 0 if they cross.

    Over all edges of a closed ring the start points alone cover every vertex.
    """
    ax, ay, bx, by = _texts(e)
    cx, cy, dx, dy = _texts(f)

    def side(px, py, qx, qy, rx, ry):
        return f"(({qx} - {px}) * ({ry} - {py}) - ({qy} - {py}) * ({rx} - {px}))"

    crossing = (f"{side(ax, ay, bx, by, cx, cy)} * {side(ax, ay, bx, by, dx, dy)} < 0D AND "
                f"{side(cx, cy, dx, dy, ax, ay)} * {side(cx, cy, dx, dy, bx, by)} < 0D")
    ends = [segment_distance2_sql(ax, ay, f), segment_distance2_sql(cx, cy, e)]
    if kinds[0] != POLYGON:
        ends.append(segment_distance2_sql(bx, by, f))
    if kinds[1] != POLYGON:
        ends.append(segment_distance2_sql(dx, dy, e))
    return f"CASE WHEN {crossing} THEN 0D ELSE least({', '.join(ends)}) END"


def _anchored_sql(outer: Shape, inner: Shape) -> str:
    """Some part of ``inner`` starts inside ``outer``.

    Where boundaries do not meet, a part lies on one side as a whole, so its first
    vertex decides.
    """
    if isinstance(inner.anchors, list):
        return "(" + " OR ".join(inside_sql(num(x), num(y), outer.edges)
                                 for x, y in inner.anchors) + ")"
    within = f"p.x BETWEEN {outer.xmin} AND {outer.xmax} AND p.y BETWEEN {outer.ymin} AND {outer.ymax}"
    # a single part inside has its box inside; loops are interpreted, so cheap tests come first
    boxed = (f"{inner.xmin} >= {outer.xmin} AND {inner.xmax} <= {outer.xmax} AND "
             f"{inner.ymin} >= {outer.ymin} AND {inner.ymax} <= {outer.ymax}")
    return (f"((size({inner.anchors}) > 1 OR ({boxed})) AND "
            f"exists({inner.anchors}, p -> {within} AND {inside_sql('p.x', 'p.y', outer.edges)}))")


def covered_sql(a: Shape, b: Shape) -> str:
    """One geometry lies inside the other, given that their boundaries do not meet (where they do,
    the distance of their edges is 0)."""
    tests = [_anchored_sql(o, i) for o, i in ((a, b), (b, a)) if o.kind == POLYGON]
    return "(" + " OR ".join(tests) + ")" if tests else "FALSE"


def distance_sql(a: Shape, b: Shape) -> str:
    if a.kind == POINT and b.kind == POINT:
        return point_distance_sql(a.x, a.y, b.x, b.y)
    if b.kind == POINT:
        a, b = b, a
    if a.kind == POINT:
        edge = boundary_distance_sql(a.x, a.y, b.edges)
        if b.kind == LINE:
            return edge
        return f"CASE WHEN {inside_sql(a.x, a.y, b.edges)} THEN 0D ELSE {edge} END"
    gap = "sqrt(" + _min_over(a.edges, "e", lambda e: _min_over(
        b.edges, "f", lambda f: edges_distance2_sql(e, f, (a.kind, b.kind)))) + ")"
    return f"CASE WHEN {covered_sql(a, b)} THEN 0D ELSE {gap} END"


def distance(a: Shape, b: Shape) -> Column:
    """Exact distance; 0 if the shapes touch, cross or contain one another."""
    return F.expr(distance_sql(a, b))


def _gap(lo1: str, hi1: str, lo2: str, hi2: str) -> str:
    return f"greatest({lo1} - {hi2}, {lo2} - {hi1}, 0D)"


def bbox_distance_sql(a: Shape, b: Shape) -> str:
    dx = _gap(a.xmin, a.xmax, b.xmin, b.xmax)
    dy = _gap(a.ymin, a.ymax, b.ymin, b.ymax)
    return f"sqrt({_square_sum(dx, dy)})"


def bbox_distance(a: Shape, b: Shape) -> Column:
    """Distance between bounding boxes: a lower bound, and the approximate mode."""
    return F.expr(bbox_distance_sql(a, b))


def bbox_near_sql(a: Shape, q: Shape, r: float) -> str:
    """Cheap necessary condition for ``distance <= r`` to a query object.

    Plain column-against-value comparisons, so they reach the Parquet scan.
    """
    reach = r + 1e-9 * (abs(r) + max(map(abs, q.box)))
    xmin, ymin, xmax, ymax = q.box
    return (f"({a.xmax} >= {num(xmin - reach)} AND {a.xmin} <= {num(xmax + reach)} AND "
            f"{a.ymax} >= {num(ymin - reach)} AND {a.ymin} <= {num(ymax + reach)})")


def haversine(lon1: str, lat1: str, lon2: str, lat2: str) -> Column:
    """Great-circle distance in metres (spherical law of cosines)."""
    cosine = (f"sin(radians({lat1})) * sin(radians({lat2})) + cos(radians({lat1})) * "
              f"cos(radians({lat2})) * cos(radians({lon2}) - radians({lon1}))")
    return F.expr(f"acos(greatest(-1D, least(1D, {cosine}))) * {num(EARTH_RADIUS_M)}")


# --------------------------------------------------------------------------
# cell rectangles
# --------------------------------------------------------------------------
def rect_intersects(s: Shape, xl: str, yl: str, xr: str, yr: str) -> Column:
    """Line or polygon intersects a closed axis-parallel rectangle.

    An edge does if their boxes overlap and the corners of the rectangle do not all
    lie strictly on one side of it.
    """
    def hits(e: Edge) -> str:
        x1, y1, x2, y2 = _texts(e)
        dx, dy, _ = _delta(e)
        sides = ", ".join(f"{dx} * ({cy} - {y1}) - {dy} * ({cx} - {x1})"
                          for cx, cy in ((xl, yl), (xr, yl), (xr, yr), (xl, yr)))
        return (f"(greatest({x1}, {x2}) >= {xl} AND least({x1}, {x2}) <= {xr} AND "
                f"greatest({y1}, {y2}) >= {yl} AND least({y1}, {y2}) <= {yr} AND "
                f"least({sides}) <= 0D AND greatest({sides}) >= 0D)")
    hit = _any_over(s.edges, "e", hits)
    return F.expr(f"{hit} OR {inside_sql(xl, yl, s.edges)}" if s.kind == POLYGON else hit)
