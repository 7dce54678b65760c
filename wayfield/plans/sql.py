"""SQL fragments for the checks: the fixture tables and plain-arithmetic geometry."""

from __future__ import annotations

from collections.abc import Sequence

from ..functions.geometry import LINE, POINT, POLYGON, QueryGeometry
from ..functions.grid import Grid

PTS = """pts AS (
  SELECT event_id, event_type, CAST(user_id AS VARCHAR) AS obj_id, ts,
         epoch_us(ts) AS ts_us, epoch_us(ts) // 1000 AS ts_ms,
         least(value / 5, CAST(99.99 AS DOUBLE)) AS x,
         CAST(json_extract(props, '$.k') AS DOUBLE) + CAST(event_id % 100 AS DOUBLE) / CAST(100 AS DOUBLE) AS y
  FROM events)"""

POLYS = """polys AS (
  SELECT CAST(event_id AS VARCHAR) AS obj_id, ts, ts_us, ts_ms, x, y, event_id % 3 AS k,
         CAST(0.5 AS DOUBLE) + CAST(event_id % 4 AS DOUBLE) * CAST(0.5 AS DOUBLE) AS h
  FROM pts WHERE event_type = 'purchase'),
poly_box AS (
  SELECT obj_id, ts, ts_us, ts_ms, x - s AS xmin, y - s AS ymin, x + s AS xmax, y + s AS ymax
  FROM (SELECT *, CASE WHEN k = 2 THEN h * 2 ELSE h END AS s FROM polys)),
poly_rings AS (
  SELECT obj_id, ts, 1 AS ring, CASE WHEN k = 1
      THEN [x, x + h, x, x - h] ELSE [x - s, x + s, x + s, x - s] END AS vx,
      CASE WHEN k = 1 THEN [y - h, y, y + h, y] ELSE [y - s, y - s, y + s, y + s] END AS vy
  FROM (SELECT *, CASE WHEN k = 2 THEN h * 2 ELSE h END AS s FROM polys)
  UNION ALL
  SELECT obj_id, ts, 2, [x - h, x + h, x + h, x - h], [y - h, y - h, y + h, y + h]
  FROM polys WHERE k = 2),
poly_edges AS (
  SELECT obj_id, ts, ring * 10 + i AS e, vx[i] AS x1, vy[i] AS y1,
         vx[i % 4 + 1] AS x2, vy[i % 4 + 1] AS y2
  FROM poly_rings, (SELECT unnest(range(1, 5)) AS i))"""

LINES = """lines AS (
  SELECT CAST(event_id AS VARCHAR) AS obj_id, ts, ts_us, ts_ms, x AS xa, y AS ya,
         x + CAST(1 AS DOUBLE) + CAST(event_id % 3 AS DOUBLE) AS xb, y + CAST(1 AS DOUBLE) AS yb,
         y + CAST(2 AS DOUBLE) + CAST(event_id % 2 AS DOUBLE) AS yc
  FROM pts WHERE event_type = 'signup'),
line_box AS (
  SELECT obj_id, ts, ts_us, ts_ms, xa AS xmin, ya AS ymin, xb AS xmax, yc AS ymax FROM lines),
line_edges AS (
  SELECT obj_id, ts, 1 AS e, xa AS x1, ya AS y1, xb AS x2, yb AS y2 FROM lines
  UNION ALL SELECT obj_id, ts, 2, xb, yb, xb, yc FROM lines)"""

TABLE = {POINT: "pts", POLYGON: "poly_box", LINE: "line_box"}
EDGES = {POLYGON: "poly_edges", LINE: "line_edges"}


def base(*kinds: str) -> str:
    parts = [PTS]
    if POLYGON in kinds:
        parts.append(POLYS)
    if LINE in kinds:
        parts.append(LINES)
    return "WITH " + ",\n".join(parts)


def d(v: float) -> str:
    return f"CAST({v!r} AS DOUBLE)"


def query_edges(queries: Sequence[QueryGeometry]) -> str:
    rows = ", ".join(
        f"({i}, {j}, {d(e[0])}, {d(e[1])}, {d(e[2])}, {d(e[3])})"
        for i, q in enumerate(queries) for j, e in enumerate(q.edges))
    return f"q_edges AS (SELECT * FROM (VALUES {rows}) AS t(qid, e, x1, y1, x2, y2))"


def query_points(queries: Sequence[QueryGeometry]) -> str:
    rows = ", ".join(f"({i}, {d(q.vertices[0][0])}, {d(q.vertices[0][1])})"
                     for i, q in enumerate(queries))
    return f"q AS (SELECT * FROM (VALUES {rows}) AS t(qid, qx, qy))"


def query_boxes(queries: Sequence[QueryGeometry]) -> str:
    rows = ", ".join(f"({i}, {', '.join(d(v) for v in q.bbox)})" for i, q in enumerate(queries))
    return f"q AS (SELECT * FROM (VALUES {rows}) AS t(qid, qxmin, qymin, qxmax, qymax))"


def dist(x1: str, y1: str, x2: str, y2: str) -> str:
    return f"sqrt(({x1} - {x2}) * ({x1} - {x2}) + ({y1} - {y2}) * ({y1} - {y2}))"


def seg2(px: str, py: str, e: str) -> str:
    dx, dy = f"({e}.x2 - {e}.x1)", f"({e}.y2 - {e}.y1)"
    len2 = f"({dx} * {dx} + {dy} * {dy})"
    along = f"(({px} - {e}.x1) * {dx} + ({py} - {e}.y1) * {dy})"
    across = f"(({px} - {e}.x1) * {dy} - ({py} - {e}.y1) * {dx})"
    d1, d2 = ([f"({px} - {e}.x{i})", f"({py} - {e}.y{i})"] for i in (1, 2))
    return (f"CASE WHEN {along} <= 0 THEN {d1[0]} * {d1[0]} + {d1[1]} * {d1[1]} "
            f"WHEN {along} >= {len2} THEN {d2[0]} * {d2[0]} + {d2[1]} * {d2[1]} "
            f"ELSE {across} * {across} / {len2} END")


def crosses(px: str, py: str, e: str) -> str:
    return (f"CASE WHEN ({e}.y1 > {py}) <> ({e}.y2 > {py}) AND {px} < ({e}.x2 - {e}.x1)"
            f" * (({py} - {e}.y1) / ({e}.y2 - {e}.y1)) + {e}.x1 THEN 1 ELSE 0 END")


def side(a: str, b: str, c: str) -> str:
    (px, py), (qx, qy), (rx, ry) = ([f"{p}.x{n}", f"{p}.y{n}"] for p, n in (a, b, c))
    return f"(({qx} - {px}) * ({ry} - {py}) - ({qy} - {py}) * ({rx} - {px}))"


def edge_edge2(a: str, b: str) -> str:
    a1, a2, b1, b2 = (a, 1), (a, 2), (b, 1), (b, 2)
    cross = (f"{side(a1, a2, b1)} * {side(a1, a2, b2)} < 0 AND "
             f"{side(b1, b2, a1)} * {side(b1, b2, a2)} < 0")
    ends = ", ".join([seg2(f"{a}.x1", f"{a}.y1", b), seg2(f"{a}.x2", f"{a}.y2", b),
                      seg2(f"{b}.x1", f"{b}.y1", a), seg2(f"{b}.x2", f"{b}.y2", a)])
    return f"CASE WHEN {cross} THEN 0 ELSE least({ends}) END"


def box_dist(a: str, b: str, q: str = "") -> str:
    """Distance between boxes a and b; columns of b may carry the prefix q."""
    zero = "CAST(0 AS DOUBLE)"
    gx = f"greatest({a}.xmin - {b}.{q}xmax, {b}.{q}xmin - {a}.xmax, {zero})"
    gy = f"greatest({a}.ymin - {b}.{q}ymax, {b}.{q}ymin - {a}.ymax, {zero})"
    return f"sqrt({gx} * {gx} + {gy} * {gy})"


def point_edges_pairs(point_key: str, edges_key: str, source: str, polygon: bool) -> str:
    """Distances of point-geometry pairs: ``source`` joins p (points) with e (edges)."""
    inside = (f"sum({crosses('p.x', 'p.y', 'e')}) % 2 = 1" if polygon else "FALSE")
    return (f"SELECT {point_key}, {edges_key}, CASE WHEN {inside} THEN CAST(0 AS DOUBLE) "
            f"ELSE sqrt(min({seg2('p.x', 'p.y', 'e')})) END AS dist "
            f"FROM {source} GROUP BY ALL")


def geometry_pairs(a_key: str, b_key: str, source: str, a_poly: bool, b_poly: bool) -> str:
    """Distances of geometry pairs: ``source`` joins edges a and b; keys are aliased
    k_a and k_b."""
    pair = f"{a_key} AS k_a, {b_key} AS k_b"
    per_a = (f"SELECT {pair}, a.e, min({edge_edge2('a', 'b')}) AS d2, "
             f"sum({crosses('a.x1', 'a.y1', 'b')}) % 2 = 1 AS a_in FROM {source} GROUP BY ALL")
    per_b = (f"SELECT {pair}, b.e, sum({crosses('b.x1', 'b.y1', 'a')}) % 2 = 1 AS b_in "
             f"FROM {source} GROUP BY ALL")
    a_in = "bool_or(a_in)" if b_poly else "FALSE"
    b_in = "bool_or(b_in)" if a_poly else "FALSE"
    return (f"SELECT k_a, k_b, CASE WHEN a_in OR b_in THEN CAST(0 AS DOUBLE) ELSE sqrt(d2) END AS dist FROM "
            f"(SELECT k_a, k_b, min(d2) AS d2, {a_in} AS a_in FROM ({per_a}) GROUP BY ALL) "
            f"JOIN (SELECT k_a, k_b, {b_in} AS b_in FROM ({per_b}) GROUP BY ALL) USING (k_a, k_b)")


def win(ts: str = "ts", hours: int = 6) -> str:
    """Start of the tumbling window, in epoch seconds."""
    return f"CAST(epoch(time_bucket(INTERVAL '{hours} hours', {ts}, TIMESTAMP '1970-01-01')) AS BIGINT)"


def sliding(table: str) -> str:
    """Rows of ``table`` once per 6-hour window with a 2-hour slide, as ``ws``."""
    return (f"SELECT *, {win('ts', 2)} - i * 7200 AS ws FROM {table}, "
            f"(SELECT unnest(range(0, 3)) AS i)")


def cell(g: Grid, v: str, axis: str) -> str:
    low = g.minx if axis == "x" else g.miny
    return f"CAST(floor(({v} - {d(low)}) / {d(g.cell)}) AS INTEGER)"
