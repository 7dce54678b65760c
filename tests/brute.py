"""Reference geometry for tests, one pair at a time."""

import math


def point_segment(p, a, b):
    (px, py), (ax, ay), (bx, by) = p, a, b
    dx, dy = bx - ax, by - ay
    n = dx * dx + dy * dy
    t = 0.0 if n == 0 else max(0.0, min(1.0, ((px - ax) * dx + (py - ay) * dy) / n))
    return math.hypot(px - (ax + t * dx), py - (ay + t * dy))


def edges(paths):
    return [(p, q) for path in paths for p, q in zip(path, path[1:])]


def inside(p, rings):
    px, py = p
    odd = False
    for (x1, y1), (x2, y2) in edges(rings):
        if (y1 > py) != (y2 > py) and px < (x2 - x1) * ((py - y1) / (y2 - y1)) + x1:
            odd = not odd
    return odd


def crossing(a, b, c, d):
    def side(p, q, r):
        return (q[0] - p[0]) * (r[1] - p[1]) - (q[1] - p[1]) * (r[0] - p[0])
    return side(a, b, c) * side(a, b, d) < 0 and side(c, d, a) * side(c, d, b) < 0


def distance(a, b):
    """a, b: (kind, paths); a point is [[(x, y)]]."""
    (ka, pa), (kb, pb) = a, b
    if ka == "point" and kb == "point":
        return math.dist(pa[0][0], pb[0][0])
    if kb == "point":
        return distance(b, a)
    if ka == "point":
        p = pa[0][0]
        if kb == "polygon" and inside(p, pb):
            return 0.0
        return min(point_segment(p, *e) for e in edges(pb))
    for (p, q) in edges(pa):
        for (r, s) in edges(pb):
            if crossing(p, q, r, s):
                return 0.0
    if kb == "polygon" and any(inside(v, pb) for path in pa for v in path):
        return 0.0
    if ka == "polygon" and any(inside(v, pa) for path in pb for v in path):
        return 0.0
    return min(min(point_segment(p, r, s), point_segment(q, r, s), point_segment(r, p, q), point_segment(s, p, q))
               for p, q in edges(pa) for r, s in edges(pb))
