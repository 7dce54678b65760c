"""Distance joins between two sets (or streams) of spatial objects.

Catalyst can only run a bare ``distance <= r`` as a nested loop, so the join gets
equi keys: cells of a grid whose side follows from ``r`` and from the size of the
geometries. Each geometry has a level, cells double per level, and a geometry
covers at most 2 x 2 cells of its own level. A pair meets at the coarser of its two
levels, so neither points nor large polygons are replicated over many cells. A pair
sharing several cells is kept only in the cell at the corner of their common cell
rectangle, so no distinct is needed afterwards.

Cells with many rows on either side are split: both sides get salts in proportion
to their counts, and each row meets every salt of the other side exactly once.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import count
from typing import Optional

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geometry as G
from ..functions.geometry import Shape
from ..functions.grid import Grid
from ..functions.windows import WindowSpec, with_window

HOT_CELL_ROWS = 50_000
# Up to this many hot cells are broadcast; more are joined.
MAX_HOT_CELLS = 50_000
# Spark's size estimate does not see that keys multiply rows, so a side with more rows
# than this is never broadcast.
MAX_BROADCAST_ROWS = 50_000
# Pairs of rows that share a cell, for one task of a shuffled join: what a task holds follows from
# them, and they grow with the square of the density. The number of tasks has a limit.
PAIRS_PER_TASK, MAX_TASKS = 500_000, 20_000
MIN_CELL = 1e-6
# Leaves and sampled points of the grid-free twin.
LEAVES, LEAF_SAMPLE = 64, 10_000
# Level of a stream's geometries that are larger than all levels given: its cells meet at 0.
TOP_LEVEL = 200
KEYS = ("_role", "_lvl", "_kx", "_ky")
GEOMETRY_ARRAYS = {"edges", "anchors", "rings", "paths"}
_BOXED = ("xmin", "ymin", "xmax", "ymax", "edges", "anchors")
_SHAPE_COLUMNS = {G.POINT: ("x", "y"), G.LINE: _BOXED, G.POLYGON: _BOXED}


def _prefixed(df: DataFrame, side: str) -> DataFrame:
    return df.select(*[F.col(c).alias(c if c == "window" else f"{side}_{c}") for c in df.columns])


def _level(s: Shape, by: float, base: float, listed: Sequence[int] = ()) -> Column:
    """Level whose cells are at least as wide as the geometry; with ``listed``, the next of these."""
    extent = f"(greatest({s.xmax} - {s.xmin}, {s.ymax} - {s.ymin}) + {G.num(2 * by)})"
    level = f"IF({extent} <= {G.num(base)}, 0, int(ceil(log2({extent} / {G.num(base)}))))"
    if listed:
        level = f"coalesce(get(filter(array({', '.join(map(str, listed))}), l -> l >= {level}), 0), {listed[-1]})"
    return F.expr(level)


def _profiles(a: DataFrame, b: DataFrame, sa: Shape, sb: Shape, by: float,
              base: float) -> list[tuple[int, list[int]]]:
    """Row count and distinct levels (a few dozen integers at most) of both sides, in one job."""
    def levels(df, side, s, pad):
        level = F.lit(0) if s.kind == G.POINT else _level(s, pad, base)
        return df.select(F.lit(side).alias("s"), level.alias("l"))

    rows = levels(a, 0, sa, 0.0).unionByName(levels(b, 1, sb, by)).groupBy("s", "l").count().collect()
    return [(sum(r["count"] for r in rows if r["s"] == side),
             sorted(r["l"] for r in rows if r["s"] == side and r["l"] is not None) if s.kind != G.POINT else [0])
            for side, s in ((0, sa), (1, sb))]


def _cells(df: DataFrame, s: Shape, by: float, base: float, single: bool) -> DataFrame:
    """Explode rows to the cells they cover at ``_lvl``; keep the lowest cell."""
    side, pad = f"({G.num(base)} * pow(2D, _lvl))", G.num(by)
    out = df.selectExpr("*", f"floor(({s.xmin} - {pad}) / {side}) AS _x0",
                        f"floor(({s.ymin} - {pad}) / {side}) AS _y0")
    if single:
        return out.selectExpr("*", "_x0 AS _kx", "_y0 AS _ky")
    return (out.selectExpr("*", f"explode(sequence(_x0, floor(({s.xmax} + {pad}) / {side}))) AS _kx")
               .selectExpr("*", f"explode(sequence(_y0, floor(({s.ymax} + {pad}) / {side}))) AS _ky"))


def _keyed(a: DataFrame, b: DataFrame, sa: Shape, sb: Shape, r: float, base: float, levels_a: list[int],
           levels_b: list[int], listed: Sequence[int] = ()) -> tuple[DataFrame, DataFrame]:
    """Both sides with join keys; b is expanded by r.

    role 0 joins at the level of b (a is not coarser), role 1 at the level of a (a is
    coarser); every pair has exactly one role and level. ``levels_a`` and ``levels_b`` are all
    levels that occur; with ``listed``, geometries are put at the next level of that list.
    """
    if len(set(levels_a + levels_b)) <= 1:
        fixed = ["*", "0 AS _role", f"{(levels_a + levels_b + [0])[0]} AS _lvl"]
        a, b = a.selectExpr(*fixed), b.selectExpr(*fixed)
    else:
        def keys(role: int, levels: list[int], keep: str) -> str:
            every = f"array({', '.join(map(str, levels))})" if levels else "array()"
            return (f"transform(filter(cast({every} AS array<int>), l -> {keep}), "
                    f"l -> named_struct('_role', {role}, '_lvl', l))")

        def own(role: int, when: str) -> str:
            return (f"IF({when}, array(named_struct('_role', {role}, '_lvl', _own)), "
                    "cast(array() AS array<struct<_role:int,_lvl:int>>))")

        low = min(levels_b, default=0)
        a = (a.withColumn("_own", _level(sa, 0.0, base, listed))
             .selectExpr("*", f"inline(concat({keys(0, levels_b, 'l >= _own')}, "
                              f"{own(1, f'{low} < _own')}))").drop("_own"))
        b = (b.withColumn("_own", _level(sb, r, base, listed))
             .selectExpr("*", f"inline(concat({own(0, 'true')}, "
                              f"{keys(1, levels_a, 'l > _own')}))").drop("_own"))
    return (_cells(a, sa, 0.0, base, sa.kind == G.POINT),
            _cells(b, sb, r, base, False))


def _tally(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of both sides in every cell."""
    return (a.select(*keys, F.lit(1).alias("_na"), F.lit(0).alias("_nb"))
            .unionByName(b.select(*keys, F.lit(0).alias("_na"), F.lit(1).alias("_nb")))
            .groupBy(*keys).agg(F.sum("_na").alias("_na"), F.sum("_nb").alias("_nb")))


def _spread(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Both sides in as many partitions as their pairs ask for, where that is more than usual."""
    pairs = _tally(a, b, keys).agg(F.sum(F.col("_na").cast("double") * F.col("_nb"))).first()[0] or 0.0
    tasks = min(MAX_TASKS, int(pairs / PAIRS_PER_TASK) + 1)
    if tasks <= int(a.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        return a, b
    return a.repartition(tasks, *keys), b.repartition(tasks, *keys)


def _salted(a: DataFrame, b: DataFrame, keys: Sequence[str],
            hot_rows: int) -> Optional[tuple[DataFrame, DataFrame]]:
    """Both sides with salts for cells of more than ``hot_rows`` rows, None if there are none.

    A salted cell is a set of groups of at most about ``hot_rows`` rows of either side.
    """
    limit = F.lit(hot_rows)
    hot = _tally(a, b, keys).filter((F.col("_na") > 0) & (F.col("_nb") > 0)
                       & ((F.col("_na") > limit) | (F.col("_nb") > limit)))
    hot = hot.select(*[F.col(k).alias(f"_h{k}") for k in keys],
                     F.ceil(F.col("_na") / limit).cast("int").alias("_sa"),
                     F.ceil(F.col("_nb") / limit).cast("int").alias("_sb"))
    found = hot.limit(MAX_HOT_CELLS + 1).collect()
    if not found:
        return None
    if len(found) <= MAX_HOT_CELLS:
        hot = F.broadcast(a.sparkSession.createDataFrame(found, hot.schema))

    def add(df: DataFrame, own: str, other: str, own_salt: str, other_salt: str) -> DataFrame:
        same = [F.col(k) == F.col(f"_h{k}") for k in keys]
        rows = df.join(hot, same, "left")
        scalars = [c for c, t in df.dtypes if not t.startswith(("array", "struct", "map"))
                   and c not in keys]
        pick = F.pmod(F.xxhash64(*scalars), F.coalesce(F.col(own), F.lit(1))).cast("int")
        spread = F.explode(F.sequence(F.lit(0), F.coalesce(F.col(other), F.lit(1)) - 1))
        return (rows.withColumn(own_salt, pick).withColumn(other_salt, spread)
                .drop("_sa", "_sb", *[f"_h{k}" for k in keys]))

    return add(a, "_sa", "_sb", "_salt_a", "_salt_b"), add(b, "_sb", "_sa", "_salt_b", "_salt_a")


def _dealt(df: DataFrame, own: str, n_own: int, other: str, n_other: int) -> DataFrame:
    """``df`` with one of ``n_own`` salts, once for every salt of the other side."""
    scalars = [c for c, t in df.dtypes if not t.startswith(("array", "struct", "map")) and c not in KEYS]
    pick = F.pmod(F.xxhash64(*scalars), F.lit(n_own)).cast("int")
    return df.withColumn(own, pick).withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(n_other - 1))))


def _windowed(df: DataFrame, window: WindowSpec) -> DataFrame:
    """On a stream the window becomes the only event-time column."""
    out = with_window(df, window)
    return out.withColumn("ts", F.timestamp_micros(F.unix_micros("ts"))) if df.isStreaming else out


def _prepare(a: DataFrame, b: DataFrame, sa: Shape, sb: Shape, reach: float, base: float,
             keys: list[str], hot_rows: Optional[int], right_only: bool = False, levels: Sequence[int] = (0,),
             salts: tuple[int, int] = (1, 1)) -> tuple[DataFrame, DataFrame, list[str]]:
    """Key both sides, split hot cells and rule out large broadcasts (``right_only``: of
    a join that can only broadcast its right side). Streams use the levels and salts given."""
    pad = reach + base * 1e-9
    if a.isStreaming or b.isStreaming:
        # cells of the last level are wider than anything, so that no geometry has more than 2 x 2
        listed = sorted({*levels, TOP_LEVEL})
        of = [[0] if s.kind == G.POINT else listed for s in (sa, sb)]
        ka, kb = _keyed(a, b, sa, sb, pad, base, *of, listed)
        if max(salts) > 1:
            ka, kb = _dealt(ka, "_salt_a", salts[0], "_salt_b", salts[1]), _dealt(kb, "_salt_b", salts[1], "_salt_a", salts[0])
            keys = keys + ["_salt_a", "_salt_b"]
        return ka, kb, keys
    (rows_a, levels_a), (rows_b, levels_b) = _profiles(a, b, sa, sb, pad, base)
    ka, kb = _keyed(a, b, sa, sb, pad, base, levels_a, levels_b)
    if hot_rows and max(rows_a, rows_b) > hot_rows:
        salted = _salted(ka, kb, keys, hot_rows)
        if salted:
            (ka, kb), keys = salted, keys + ["_salt_a", "_salt_b"]
    if (rows_b if right_only else min(rows_a, rows_b)) > MAX_BROADCAST_ROWS:
        # keys of one value are no keys to the planner: dealt by them, rows would be shuffled once more
        single = len(set(levels_a + levels_b)) <= 1
        ka, kb = _spread(ka, kb, [k for k in keys if not (single and k in ("_role", "_lvl"))])
        ka, kb = ka.hint("merge"), kb.hint("merge")
    return ka, kb, keys


def _cell_centre(s: Shape, grid: Grid) -> Shape:
    """The middle of the point's cell, in cells: far from the edges of blocks of whole cells."""
    x, y = (f"(floor(({v} - {G.num(low)}) / {G.num(grid.cell)}) + 0.5D)" for v, low in ((s.x, grid.minx), (s.y, grid.miny)))
    return Shape(G.POINT, x, y, x, y)


def _base(reach: float, max_extent: float = 0.0) -> float:
    return max(2.0 * reach * (1 + 1e-8) + max_extent, MIN_CELL)


def distance_join(a: DataFrame, b: DataFrame, r: float, *, kinds: tuple[str, str] = (G.POINT, G.POINT),
                  window: Optional[WindowSpec] = None, approx: bool = False,
                  grid: Optional[Grid] = None, hot_rows: Optional[int] = HOT_CELL_ROWS,
                  max_extent: float = 0.0, levels: Sequence[int] = (0, 2, 4, 7),
                  salts: tuple[int, int] = (1, 1)) -> DataFrame:
    """Pairs (a, b) in the same window whose distance is at most ``r``, each once.

    Columns come back prefixed ``a_`` and ``b_`` without the geometry arrays, with
    ``dist`` and, if windowed, ``window``. ``approx`` compares bounding boxes; point
    pairs then are all pairs whose cells of ``grid`` lie in one candidate block. A pass over
    the data (a count, and the sizes of geometries) that runs when this is called finds levels
    and hot cells.

    On streams the join is a window-keyed stream-stream join without such a pass: ``max_extent``
    (the usual geometry size) sets the cell side, ``levels`` lists the levels that geometries are
    put at (cells double per level; what is larger than the last goes to a level of one cell for
    all), and every cell is split into ``salts`` groups of rows of either side. A geometry has at
    most four keys per level and salt of the other side, however large it or ``r`` is.
    """
    if window:
        a, b = _windowed(a, window), _windowed(b, window)
    windowed = "window" in a.columns and "window" in b.columns
    streaming = a.isStreaming or b.isStreaming
    block = approx and kinds == (G.POINT, G.POINT)
    reach = (grid.candidate_layers(r) + 1) * grid.cell if block else r
    base = _base(reach, max_extent)
    a, b = _prefixed(a, "a"), _prefixed(b, "b")
    sa, sb = G.shape(kinds[0], "a_"), G.shape(kinds[1], "b_")
    key_a, key_b = sa, sb
    if block:  # keys are whole blocks of the grid's cells, so that few pairs beyond the candidates share one
        layers = grid.candidate_layers(r)
        reach, base = float(layers), max(2.0 * layers, 1.0)
        key_a, key_b = (_cell_centre(s, grid) for s in (sa, sb))
    window_key = [] if not windowed else ["window"] if streaming else ["_win"]
    if window_key == ["_win"]:  # sorts faster than the struct; a stream needs the struct
        a, b = (df.withColumn("_win", F.col("window.start")) for df in (a, b))
    ka, kb, keys = _prepare(a, b, key_a, key_b, reach, base, [*KEYS, *window_key], hot_rows, levels=levels, salts=salts)
    left, right = ka.alias("l"), kb.alias("r")
    cond = [F.col(f"l.{k}") == F.col(f"r.{k}") for k in keys]
    if kinds[0] != G.POINT:
        cond += [F.col("l._kx") == F.greatest(F.col("l._x0"), F.col("r._x0")),
                 F.col("l._ky") == F.greatest(F.col("l._y0"), F.col("r._y0"))]
    exact, boxes = G.distance_sql(sa, sb), G.bbox_distance_sql(sa, sb)
    lead = "l.window" if windowed else None
    if block:
        cond += [F.expr(f"abs({cell(p)} - {cell(q)}) <= {layers}") for cell, p, q in
                 ((grid.cx_sql, sa.x, sb.x), (grid.cy_sql, sa.y, sb.y))]
        return _with_plain_distance(left.join(right, cond), a, b, exact, lead)
    if approx or kinds == (G.POINT, G.POINT):
        cheap = boxes if approx else exact
        return _with_plain_distance(left.join(right, [*cond, F.expr(f"{cheap} <= {G.num(r)}")]), a, b, cheap, lead)
    slack = base * 1e-9
    pairs = left.join(right, [*cond, F.expr(f"{boxes} <= {G.num(r + slack)}")])
    if streaming:
        return _with_distance(pairs, a, b, exact, G.num(r), lead)
    return _refined(pairs, a, b, sa, sb, r, slack, keys)


def semi_join(stream: DataFrame, queries: DataFrame, r: float, *, kinds: tuple[str, str],
              row_id: Sequence[str], approx: bool = False,
              hot_rows: Optional[int] = HOT_CELL_ROWS) -> DataFrame:
    """The ``row_id`` of stream rows within ``r`` of some query object.

    A semi join stops at the first match of a row, so no pairs are made.
    """
    base = _base(r)
    keep = list(_SHAPE_COLUMNS[kinds[1]])
    a = _prefixed(stream.select(*dict.fromkeys([*row_id, *_SHAPE_COLUMNS[kinds[0]]])), "a")
    b = _prefixed(queries.select(*keep), "b")
    sa, sb = G.shape(kinds[0], "a_"), G.shape(kinds[1], "b_")
    ka, kb, keys = _prepare(a, b, sa, sb, r, base, list(KEYS), hot_rows, right_only=True)
    boxes = G.bbox_distance_sql(sa, sb)
    cond = [F.col(f"l.{k}") == F.col(f"r.{k}") for k in keys]
    cond.append(F.expr(f"{boxes} <= {G.num(r if approx else r + base * 1e-9)}"))
    if not approx:
        cond.append(F.expr(f"{G.distance_sql(sa, sb)} <= {G.num(r)}"))
    hits = ka.alias("l").join(kb.alias("r"), cond, "left_semi")
    return hits.select(*[F.col(f"a_{c}").alias(c) for c in row_id]).distinct()


def match(stream: DataFrame, queries: DataFrame, r: float, *, kinds: tuple[str, str],
          approx: bool = False, grid: Optional[Grid] = None, inside: bool = True,
          max_extent: float = 0.0) -> DataFrame:
    """Stream rows with a query object within ``r`` (or, not ``inside``, without one).

    Every row has one key, the cell of its lower left corner, and is emitted once, so the
    semi join makes no pairs and nothing is joined back; the stream side may be a stream.
    Query objects cover the cells they reach; their sizes are grouped by powers of four,
    each with a grid that fits, and a row is held against one group after the other.
    ``max_extent`` is the largest width or height of the stream objects (0 for points).
    """
    block = approx and kinds == (G.POINT, G.POINT)
    reach = (grid.candidate_layers(r) + 1) * grid.cell if block else r
    a, b = _prefixed(stream, "a"), _prefixed(queries.select(*_SHAPE_COLUMNS[kinds[1]]), "b")
    sa, sb = G.shape(kinds[0], "a_"), G.shape(kinds[1], "b_")
    extent = f"greatest({sb.xmax} - {sb.xmin}, {sb.ymax} - {sb.ymin})"
    usual, total = b.agg(F.percentile_approx(F.expr(extent), 0.95), F.count(F.lit(1))).first()
    base = _base(reach, max(usual or 0.0, max_extent))
    group = f"IF({extent} <= {G.num(base)}, 0, int(ceil(log(4D, {extent} / {G.num(base)}))))"
    b = b.withColumn("_group", F.expr(group))
    groups = [0] if kinds[1] == G.POINT else sorted(b.agg(F.collect_set("_group")).first()[0])
    if block:
        k = grid.candidate_layers(r)
        near = [f"abs({cell(p)} - {cell(q)}) <= {k}" for cell, p, q in
                ((grid.cx_sql, sa.x, sb.x), (grid.cy_sql, sa.y, sb.y))]
    else:
        near = [f"{G.bbox_distance_sql(sa, sb)} <= {G.num(r if approx else r + base * 1e-9)}"]
        near += [] if approx else [f"{G.distance_sql(sa, sb)} <= {G.num(r)}"]
    low, high = G.num(reach + max_extent + base * 1e-9), G.num(reach + base * 1e-9)
    found = None
    for g in groups or [0]:
        side = G.num(base * 4.0 ** g)
        left = a.selectExpr("*", f"floor({sa.xmin} / {side}) AS _kx", f"floor({sa.ymin} / {side}) AS _ky")
        right = (b.filter(F.col("_group") == g)
                 .selectExpr("*", f"explode(sequence(floor(({sb.xmin} - {low}) / {side}), "
                                  f"floor(({sb.xmax} + {high}) / {side}))) AS _kx")
                 .selectExpr("*", f"explode(sequence(floor(({sb.ymin} - {low}) / {side}), "
                                  f"floor(({sb.ymax} + {high}) / {side}))) AS _ky"))
        if total > MAX_BROADCAST_ROWS:
            left, right = left.hint("merge"), right.hint("merge")
        cond = [F.col("l._kx") == F.col("r._kx"), F.col("l._ky") == F.col("r._ky"), *map(F.expr, near)]
        left, right = left.alias("l"), right.alias("r")
        if inside:
            hits = left.join(right, cond, "left_semi").drop("_kx", "_ky")
            found = hits if found is None else found.unionByName(hits)
        if not inside or g != groups[-1]:
            a = left.join(right, cond, "left_anti").drop("_kx", "_ky")
    out = found if inside else a
    return out.select(*[F.col(c if c == "window" else f"a_{c}").alias(c) for c in stream.columns])


def _with_plain_distance(pairs: DataFrame, a: DataFrame, b: DataFrame, dist: str, window: Optional[str]) -> DataFrame:
    """Add ``dist`` to pairs that the join has held against the limit already. A distance that is plain
    arithmetic is cheaper computed again than passed through an interpreted array."""
    return pairs.selectExpr(*([f"{window} AS window"] if window else []), *_plain_columns(a, b), f"{dist} AS dist")


def _with_distance(pairs: DataFrame, a: DataFrame, b: DataFrame, dist: str,
                   limit: Optional[str], window: Optional[str]) -> DataFrame:
    """Add ``dist`` and drop pairs beyond the limit.

    The generator evaluates the costly distance once per pair; a filter next to a
    column would evaluate it twice.
    """
    names = _plain_columns(a, b)
    lead = [f"{window} AS window"] if window else []
    kept = f"filter(array({dist}), d -> d <= {limit})" if limit else f"array({dist})"
    return pairs.selectExpr(*lead, *names, f"explode({kept}) AS dist")


def _plain_columns(a: DataFrame, b: DataFrame) -> list[str]:
    return [c for c in a.columns + b.columns
            if c not in ("window", "_win") and c[2:] not in GEOMETRY_ARRAYS]


def _near_box(e: str, xmin: str, ymin: str, xmax: str, ymax: str, reach: str) -> str:
    """The box of edge ``e`` comes within ``reach`` of a box on both axes."""
    return (f"greatest({e}.x1, {e}.x2) >= {xmin} - {reach} AND least({e}.x1, {e}.x2) <= {xmax} + {reach} AND "
            f"greatest({e}.y1, {e}.y2) >= {ymin} - {reach} AND least({e}.y1, {e}.y2) <= {ymax} + {reach}")


_FIXED_WIDTH = ("boolean", "tinyint", "smallint", "int", "bigint", "float", "double", "date", "timestamp")


def _refined(pairs: DataFrame, a: DataFrame, b: DataFrame, sa: Shape, sb: Shape, r: float, slack: float,
             keys: Sequence[str]) -> DataFrame:
    """Exact distance of candidate pairs, one row per edge (or edge pair) that can matter.

    Loops over array elements are interpreted, rows run in generated code, which is many times
    faster. An edge matters only if its box comes within ``r`` of the other geometry's box, and
    meets of the other side's edges those within ``r`` of its own box: two geometries that are not
    near each other make no edge pair at all. Rows are grouped by a number of the pair and the join
    keys, which keeps the partitioning of a shuffled join, so this adds no exchange to it; columns
    of fixed width are carried as aggregates.
    """
    names = _plain_columns(a, b)
    types = {**dict(a.dtypes), **dict(b.dtypes)}
    carried = [c for c in names if types[c] in _FIXED_WIDTH]
    lead = ["window"] if "_win" in keys else []
    group = [*keys, *lead, "_pair", *[c for c in names if c not in carried]]
    rows = pairs.withColumn("_pair", F.monotonically_increasing_id()).selectExpr(
        *[f"l.{k} AS {k}" for k in [*keys, *lead]], "_pair", *names,
        *[c for s in (sa, sb) if s.kind != G.POINT for c in (s.edges, s.anchors)])
    e, f = (tuple(f"{v}.{c}" for c in ("x1", "y1", "x2", "y2")) for v in "ef")
    reach = G.num(r + slack)
    every = [*group, *carried]
    if G.POINT in (sa.kind, sb.kind):
        p, g = (sa, sb) if sa.kind == G.POINT else (sb, sa)
        crosses = G.crosses_ray_sql(p.x, p.y, e) if g.kind == G.POLYGON else "false"
        rows = rows.select(*every, F.explode(g.edges).alias("e"))
        rows = rows.filter(f"({_near_box('e', p.x, p.y, p.x, p.y, reach)}) OR ({crosses})")
        d2, covered = G.segment_distance2_sql(p.x, p.y, e), f"sum(IF({crosses}, 1, 0)) % 2 = 1"
    else:
        rows = rows.withColumn("_covered", F.expr(
            f"IF({G.bbox_distance_sql(sa, sb)} = 0D, {G.covered_sql(sa, sb)}, false)"))
        every = [*every, "_covered"]
        rows = rows.select(*every, sb.edges, F.explode(sa.edges).alias("e"))
        rows = rows.filter(f"_covered OR ({_near_box('e', sb.xmin, sb.ymin, sb.xmax, sb.ymax, reach)})")
        rows = rows.select(*every, "e", F.explode(sb.edges).alias("f"))
        rows = rows.filter("_covered OR (" + _near_box(
            "f", "least(e.x1, e.x2)", "least(e.y1, e.y2)", "greatest(e.x1, e.x2)", "greatest(e.y1, e.y2)", reach) + ")")
        d2, covered = G.edges_distance2_sql(e, f, (sa.kind, sb.kind)), "max(_covered)"
    out = rows.groupBy(*group).agg(F.expr(f"IF({covered}, 0D, sqrt(min({d2})))").alias("dist"),
                                   *[F.first(c).alias(c) for c in carried])
    return out.filter(F.col("dist") <= r).select(*lead, *names, "dist")


def _split(points: list[tuple[float, float]], most: int):
    """Tree of cells over a sample: a number for a leaf, else (axis, cut, lower part, upper part). A
    cell with more than ``most`` points is halved on its wider axis."""
    numbers = count()

    def grow(part):
        spans = [max(p[i] for p in part) - min(p[i] for p in part) for i in (0, 1)] if part else [0.0, 0.0]
        axis = int(spans[1] > spans[0])
        if len(part) <= most or spans[axis] <= 0:
            return next(numbers)
        part = sorted(part, key=lambda p: p[axis])
        cut = part[(len(part) - 1) // 2][axis]
        if cut == part[-1][axis]:  # many points on the upper edge
            cut = max(p[axis] for p in part if p[axis] < cut)
        return (axis, cut, grow([p for p in part if p[axis] <= cut]), grow([p for p in part if p[axis] > cut]))

    return grow(points)


def leaf_join(a: DataFrame, b: DataFrame, r: float, *, kinds: tuple[str, str] = (G.POINT, G.POINT),
              window: Optional[WindowSpec] = None) -> DataFrame:
    """Grid-free twin of ``distance_join``: space is cut into leaves where a sample of ``a`` is dense.

    The lower left corner of an object of ``a`` lies in one leaf; objects of ``b`` go to all leaves
    that an object of ``a`` within ``r`` could have its corner in. Serves as an independent check
    of the grid keys; prefer ``distance_join``. The sample is at most ``2 * LEAF_SAMPLE`` points.
    """
    if window:
        a, b = with_window(a, window), with_window(b, window)
    windowed = "window" in a.columns
    a, b = _prefixed(a, "a"), _prefixed(b, "b")
    if windowed:
        a, b = (df.withColumn("_win", F.col("window.start")) for df in (a, b))
    sa, sb = G.shape(kinds[0], "a_"), G.shape(kinds[1], "b_")
    rows, wide, high = a.agg(F.count(F.lit(1)), F.expr(f"max({sa.xmax} - {sa.xmin})"), F.expr(f"max({sa.ymax} - {sa.ymin})")).first()
    corners = a.selectExpr(f"double({sa.xmin}) AS x", f"double({sa.ymin}) AS y").filter("x = x AND y = y AND NOT isnan(x) AND NOT isnan(y)")
    sample = [tuple(p) for p in corners.sample(min(1.0, LEAF_SAMPLE / max(rows, 1)), 11).limit(2 * LEAF_SAMPLE).collect()]
    tree = _split(sample, max(1, len(sample) // LEAVES))
    pad = r * (1 + 1e-9)
    low = [f"({c} - {G.num(pad + (w or 0.0) * (1 + 1e-9))})" for c, w in ((sb.xmin, wide), (sb.ymin, high))]
    top = [f"({c} + {G.num(pad)})" for c in (sb.xmax, sb.ymax)]
    none = "cast(array() AS array<int>)"

    def own(node) -> str:
        if isinstance(node, int):
            return str(node)
        axis, cut, lower, upper = node
        return f"IF({(sa.xmin, sa.ymin)[axis]} <= {G.num(cut)}, {own(lower)}, {own(upper)})"

    def reached(node) -> str:
        if isinstance(node, int):
            return f"array({node})"
        axis, cut, lower, upper = node
        return (f"concat(IF({low[axis]} <= {G.num(cut)}, {reached(lower)}, {none}), "
                f"IF({top[axis]} > {G.num(cut)}, {reached(upper)}, {none}))")

    keys = ["_leaf", *(["_win"] if windowed else [])]
    left, right = a.withColumn("_leaf", F.expr(own(tree))), b.withColumn("_leaf", F.explode(F.expr(reached(tree))))
    if rows > MAX_BROADCAST_ROWS and b.count() > MAX_BROADCAST_ROWS:
        left, right = _spread(left, right, keys)
        left, right = left.hint("merge"), right.hint("merge")
    left, right = left.alias("l"), right.alias("r")
    cond = [F.col(f"l.{k}") == F.col(f"r.{k}") for k in keys]
    if kinds == (G.POINT, G.POINT):
        exact = G.distance_sql(sa, sb)
        return _with_plain_distance(left.join(right, [*cond, F.expr(f"{exact} <= {G.num(r)}")]), a, b, exact,
                                    "l.window" if windowed else None)
    cond.append(F.expr(f"{G.bbox_distance_sql(sa, sb)} <= {G.num(pad)}"))
    return _refined(left.join(right, cond), a, b, sa, sb, r, pad - r, keys)


def join_candidates(a: DataFrame, b: DataFrame, r: float, grid: Grid, *,
                    kinds: tuple[str, str], window: Optional[WindowSpec] = None) -> DataFrame:
    """Pairs of a point and a geometry whose grid cells allow a match, distance ignored.

    The geometry counts for every cell within the candidate layers of its bounding
    box; this is the pair set over which the latency probe reports.
    """
    reach = grid.candidate_layers(r)
    padded = b.withColumns({
        "xmin": F.lit(grid.minx) + (grid.cx(F.col("xmin")) - reach) * grid.cell,
        "ymin": F.lit(grid.miny) + (grid.cy(F.col("ymin")) - reach) * grid.cell,
        "xmax": F.lit(grid.minx) + (grid.cx(F.col("xmax")) + reach + 1) * grid.cell,
        "ymax": F.lit(grid.miny) + (grid.cy(F.col("ymax")) + reach + 1) * grid.cell,
        "_i0": grid.cx(F.col("xmin")) - reach, "_i1": grid.cx(F.col("xmax")) + reach,
        "_j0": grid.cy(F.col("ymin")) - reach, "_j1": grid.cy(F.col("ymax")) + reach})
    pairs = distance_join(a, padded, 0.0, kinds=kinds, window=window, approx=True,
                          max_extent=grid.cell)
    ci, cj = grid.cx(F.col("a_x")), grid.cy(F.col("a_y"))
    return pairs.filter(ci.between(F.col("b__i0"), F.col("b__i1"))
                        & cj.between(F.col("b__j0"), F.col("b__j1"))) \
        .drop("b__i0", "b__i1", "b__j0", "b__j1", "dist")
