"""Trajectory queries: points that share an ``obj_id``, ordered by time.

Sub-trajectories are returned as rows ``(window, obj_id, part, n_points, path)``. An
object with up to ``hot_rows`` points in a window is one row (part 0); a larger one
is split into time parts with rising numbers, so no task ever holds an unbounded path.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import Optional

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import geometry as G
from ..functions import ordered
from ..functions.geometry import QueryGeometry
from ..functions.windows import WindowSpec, window_aggregate, with_window
from ..session import work_dir
from . import joins, knn
from .ranges import Queries, _any, _as_list, query_shape

MAX_PATH_POINTS = 100_000
MAX_LITERAL_IDS = 1_000
# Objects with at most so many points in a window settle their pairs without a shuffle.
FEW_POINTS = 8


# -- filter ------------------------------------------------------------------
def filter_ids(stream: DataFrame, ids: Sequence[str] | DataFrame) -> DataFrame:
    """Keep the named trajectories; an empty set keeps all."""
    if isinstance(ids, DataFrame):
        head = [row[0] for row in ids.select("obj_id").distinct().limit(MAX_LITERAL_IDS + 1).collect()]
        if len(head) > MAX_LITERAL_IDS:
            return stream.join(ids.select("obj_id").distinct(), "obj_id", "left_semi")
        ids = head
    return stream.filter(F.col("obj_id").isin(list(ids))) if ids else stream


def lines(stream: DataFrame, window: Optional[WindowSpec] = None, *, min_points: int = 1,
          tie: Sequence[str] = ("x", "y"), hot_rows: Optional[int] = MAX_PATH_POINTS) -> DataFrame:
    """Sub-trajectory paths per window and object, vertices in time order."""
    rows = with_window(stream, window) if window else stream
    keys = (["window"] if "window" in rows.columns else []) + ["obj_id"]
    vertex = F.struct("ts", *[F.col(c).alias(f"_t{i}") for i, c in enumerate(tie)], "x", "y")
    out = (ordered.with_slices(rows, keys, hot_rows=hot_rows, tie=tie)
           .groupBy(*keys, F.col(ordered.SLICE).alias("part"))
           .agg(F.array_sort(F.collect_list(vertex)).alias("_v"))
           .select(*keys, "part", F.size("_v").cast("long").alias("n_points"),
                   F.transform("_v", lambda v: F.struct(v["ts"].alias("ts"), v["x"].alias("x"),
                                                        v["y"].alias("y"))).alias("path")))
    if min_points > 1:
        # a split object has more than min_points rows by construction
        out = out.filter((F.col("part") > 0) | (F.col("n_points") >= min_points))
    return out


def line_summary(paths: DataFrame) -> DataFrame:
    """Size and end points of each sub-trajectory, over all of its parts."""
    keys = [c for c in paths.columns if c not in ("part", "n_points", "path")]
    return paths.groupBy(*keys).agg(
        F.sum("n_points").alias("n_points"),
        F.min(F.struct("part", F.get("path", F.lit(0)).alias("v"))).alias("_f"),
        F.max(F.struct("part", F.element_at("path", -1).alias("v"))).alias("_l")).select(
        *keys, "n_points",
        F.col("_f.v.x").alias("first_x"), F.col("_f.v.y").alias("first_y"),
        F.col("_l.v.x").alias("last_x"), F.col("_l.v.y").alias("last_y"))


# -- containment -------------------------------------------------------------
def contained(stream: DataFrame, polygons: Queries, prefilter: bool = True) -> DataFrame:
    """Points in the interior of at least one polygon.

    Without ``prefilter`` the box test is left out, which serves as a check of it.
    """
    return stream.filter(_any([G.contains_point_sql(query_shape(q), "x", "y", prefilter)
                               for q in _as_list(polygons)]))


def touching_lines(stream: DataFrame, polygons: Queries, window: WindowSpec,
                   **options) -> DataFrame:
    """Whole window sub-trajectories of the objects that enter a polygon at least once."""
    rows = with_window(stream, window)
    ids = contained(rows, polygons).select("window", "obj_id").distinct()
    return lines(rows.join(ids, ["window", "obj_id"], "left_semi"), **options)


# -- statistics --------------------------------------------------------------
def _steps(rows: DataFrame, keys: Sequence[str], tie: Sequence[str], hot_rows: int) -> DataFrame:
    """Length and duration of the step into each row; equal timestamps count once."""
    tie = [*tie, "x", "y"]
    first = ordered.first_per_time(ordered.with_slices(rows, keys, hot_rows=hot_rows, tie=tie), keys, tie=tie)
    out = ordered.previous(first.select(*keys, ordered.SLICE, "ts", "x", "y"), keys, ["ts", "x", "y"])
    return out.withColumns({
        "step": G.point_distance("x", "y", "prev.x", "prev.y"),
        "step_ms": F.unix_millis("ts") - F.unix_millis("prev.ts")})


def running_stats(stream: DataFrame, *, tie: Sequence[str] = (),
                  hot_rows: Optional[int] = ordered.HOT_ROWS) -> DataFrame:
    """Running length, duration (ms) and mean speed at every point but an object's first."""
    steps = _steps(stream, ["obj_id"], tie, hot_rows)
    out = ordered.running(steps, ["obj_id"], {
        "spatial_length": ("sum", F.coalesce("step", F.lit(0.0))),
        "temporal_length": ("sum", F.coalesce("step_ms", F.lit(0)))})
    return out.filter(F.col("prev").isNotNull()).select(
        "obj_id", "ts", "spatial_length", "temporal_length",
        F.try_divide("spatial_length", "temporal_length").alias("speed"))


def window_stats(stream: DataFrame, window: WindowSpec, *, tie: Sequence[str] = (),
                 hot_rows: Optional[int] = ordered.HOT_ROWS) -> DataFrame:
    """Length, duration and mean speed per window and object; speed NULL for one point."""
    steps = _steps(with_window(stream, window), ["window", "obj_id"], tie, hot_rows)
    return steps.groupBy("window", "obj_id").agg(
        F.coalesce(F.sum("step"), F.lit(0.0)).alias("spatial_length"),
        F.coalesce(F.sum("step_ms"), F.lit(0)).alias("temporal_length")).withColumn(
        "speed", F.try_divide("spatial_length", "temporal_length"))


def speed(stream: DataFrame, *, tie: Sequence[str] = (),
          hot_rows: Optional[int] = ordered.HOT_ROWS) -> DataFrame:
    """Distance per second between consecutive points of an object, where time passed."""
    out = ordered.previous(stream, ["obj_id"], ["ts", "x", "y"], tie=tie, hot_rows=hot_rows)
    seconds = (F.unix_millis("ts") - F.unix_millis("prev.ts")) / 1000.0
    step = G.point_distance("x", "y", "prev.x", "prev.y")
    return ordered.drop_slices(out).filter(seconds > 0).withColumn("speed", step / seconds).drop("prev")


# -- join --------------------------------------------------------------------
def _by_object(df: DataFrame, keys: Sequence[str], most: int) -> DataFrame:
    """Per object its first ``most + 1`` distinct points as ``_pts``; points without a place meet nothing."""
    points = df.filter("x IS NOT NULL AND y IS NOT NULL AND NOT isnan(x) AND NOT isnan(y)").selectExpr(
        *keys, "ts", "x + 0D AS x", "y + 0D AS y").distinct()
    first = F.row_number().over(W.partitionBy(*keys).orderBy("ts", "x", "y"))  # limited before the shuffle
    return (points.withColumn("_n", first).filter(F.col("_n") <= most + 1)
            .groupBy(*keys).agg(F.collect_list(F.struct("ts", "x", "y")).alias("_pts")))


def _with_box(objects: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per point: all points of its object, their box, and the box of those not before it."""
    rest = "filter(_pts, w -> NOT coalesce(w.ts < v.ts, false) AND NOT (w <=> v))"
    rows = objects.selectExpr(*keys, "_pts", f"inline(transform(_pts, v -> struct(v.ts, v.x, v.y, {rest} AS _rest)))")
    boxes = [f"array_{m}({of}.{v}) AS _{n}{v}{m}" for of, n in (("_pts", "e"), ("_rest", "l"))
             for v in "xy" for m in ("min", "max")]
    return rows.selectExpr(*keys, "ts", "x", "y", "_pts", *boxes)


def _latest_here(d: float) -> str:
    """SQL: no other pair of points of the two objects is within ``d`` and later.

    A later pair has a right point that is not before this one, or this one and a left point that
    is not before this one. Boxes rule most of them out before points are compared.
    """
    def apart(lx, hx, ly, hy, x, y):  # 1E-100: a distance whose square is no double is 0
        reach = G.num(d + 1e-100)
        return (f"({lx.format('x')} - {x[1]} > {reach} OR {x[0]} - {hx.format('x')} > {reach} OR "
                f"{ly.format('y')} - {y[1]} > {reach} OR {y[0]} - {hy.format('y')} > {reach})")

    rest = lambda s: (f"{s}__l{{}}min", f"{s}__l{{}}max") * 2
    far = (f"(b__lxmin IS NULL OR {apart(*rest('b'), ('a__exmin', 'a__exmax'), ('a__eymin', 'a__eymax'))}) AND "
           f"(a__lxmin IS NULL OR {apart(*rest('a'), ('b_x', 'b_x'), ('b_y', 'b_y'))})")
    other = "struct(q.ts, p.ts, q.x, q.y, p.x, p.y) > struct(b_ts, a_ts, b_x, b_y, a_x, a_y)"
    near = f"{G.point_distance_sql('p.x', 'p.y', 'q.x', 'q.y')} <= {G.num(d)}"
    return f"({far}) OR NOT exists(b__pts, q -> exists(a__pts, p -> coalesce({near} AND {other}, false)))"


def trajectory_pairs(a: DataFrame, b: DataFrame, d: float, *, window: Optional[WindowSpec],
                     exclude_same_id: bool = False, leaves: bool = False, few: Optional[int] = FEW_POINTS,
                     **options) -> DataFrame:
    """Per window and id pair, the latest right point within ``d`` and its left partner.

    Points of an object that has at most ``few`` in a window carry all of them along, so a pair of
    points tells by itself whether it is the latest of its id pair: such pairs are neither
    shuffled nor aggregated after the join. Only pairs with a larger object are, and all of them
    where ``few`` is None.
    """
    join = joins.leaf_join if leaves else joins.distance_join
    keep = ["obj_id", "ts", "x", "y"]
    keys = (["window"] if window else []) + ["obj_id"]
    ids = keys[:-1] + ["a_obj_id", "b_obj_id"]
    values = ["b_ts", "a_ts", "b_x", "b_y", "a_x", "a_y", "dist"]

    def parts(df: DataFrame) -> tuple[DataFrame, DataFrame, bool]:
        """Points of small objects, those of large ones, and whether there are any of these. Objects
        are written once, as every join looks at its sides before it runs."""
        rows = df.select(*keep)
        rows = with_window(rows, window) if window else rows
        found = _by_object(rows, keys, few)
        path = work_dir(df.sparkSession, "objects")
        found.write.parquet(path)
        objects = df.sparkSession.read.schema(found.schema).parquet(path)
        named = objects.filter(F.size("_pts") > few).select(*[F.col(k).alias(f"_l{k}") for k in keys])
        same = [F.col(k).eqNullSafe(F.col(f"_l{k}")) for k in keys]
        rest = rows.select(*keys, "ts", "x", "y").distinct().join(named, same, "left_semi")
        return _with_box(objects.filter(F.size("_pts") <= few), keys), rest, not named.isEmpty()

    def pairs(left: DataFrame, right: DataFrame) -> DataFrame:
        found = join(left, right, d, **options)
        return found.filter(F.col("a_obj_id") != F.col("b_obj_id")) if exclude_same_id else found

    def latest(found: DataFrame) -> DataFrame:
        return found.groupBy(*ids).agg(F.max(F.struct(*values)).alias("_m")).select(*ids, "_m.*")

    if few is None:
        plain = [with_window(df.select(*keep), window) if window else df.select(*keep) for df in (a, b)]
        return latest(pairs(*plain))
    small_a, large_a, some_a = parts(a)
    small_b, large_b, some_b = (small_a, large_a, some_a) if a is b else parts(b)
    out = pairs(small_a, small_b).filter(_latest_here(d)).select(*ids, *values)
    points = [*keys, "ts", "x", "y"]
    every_b = small_b.select(*points).unionByName(large_b)
    for left, right in [(large_a, every_b)] * some_a + [(small_a.select(*points), large_b)] * some_b:
        out = out.unionByName(latest(pairs(left, right)))
    return out


def near_ids(a: DataFrame, b: DataFrame, d: float, window: Optional[WindowSpec], *,
             exclude_same_id: bool = False) -> DataFrame:
    """(window, a_obj_id, b_obj_id): id pairs with some points within ``d`` in a window, each once.

    An existence test, not a join of points. Points first become boxes per window, id and cell of
    side ``d``. Boxes whose farthest corners are within ``d`` prove a pair without a look at points;
    only for id pairs without such a proof are the points of boxes near each other compared. Where
    both sides are one table, each unordered pair is tested once and mirrored after. Without
    ``window`` the rows have theirs already.
    """
    side = max(d, joins.MIN_CELL)
    box, ids = ["window", "obj_id", "_bx", "_by"], ["window", "a_obj_id", "b_obj_id"]

    def celled(df):
        rows = with_window(df.select("obj_id", "ts", "x", "y"), window) if window else df
        return rows.selectExpr("window", "obj_id", "x", "y", f"floor(x / {G.num(side)}) AS _bx", f"floor(y / {G.num(side)}) AS _by")

    def boxes(df):
        return celled(df).groupBy(*box).agg(F.min("x").alias("xmin"), F.min("y").alias("ymin"),
                                            F.max("x").alias("xmax"), F.max("y").alias("ymax"))

    near = joins.distance_join(boxes(a), boxes(b), d, kinds=(G.LINE, G.LINE), approx=True)
    mirrored = a is b
    if mirrored:
        near = near.filter("a_obj_id < b_obj_id" if exclude_same_id else "a_obj_id <= b_obj_id")
    elif exclude_same_id:
        near = near.filter("a_obj_id <> b_obj_id")
    far = [f"greatest(a_{v}max - b_{v}min, b_{v}max - a_{v}min)" for v in "xy"]
    proof = F.expr(f"sqrt({far[0]} * {far[0]} + {far[1]} * {far[1]}) <= {G.num(d)}")
    near = near.select(*ids, "a__bx", "a__by", "b__bx", "b__by",
                       F.max(proof).over(W.partitionBy(*ids)).alias("_proven"))
    open_pairs = near.filter("not _proven")
    for name, rows in (("a", celled(a)), ("b", celled(b))):
        keys = [c if c == "window" else f"{name}_{c}" for c in box]
        open_pairs = open_pairs.join(rows.toDF(*keys[:2], f"{name}_x", f"{name}_y", *keys[2:]), keys)
    witnessed = open_pairs.filter(F.expr(f"{G.point_distance_sql('a_x', 'a_y', 'b_x', 'b_y')} <= {G.num(d)}"))
    pairs = near.filter("_proven").select(*ids).unionByName(witnessed.select(*ids)).distinct()
    if mirrored:
        other = pairs.filter("a_obj_id < b_obj_id").selectExpr("window", "b_obj_id AS a_obj_id", "a_obj_id AS b_obj_id")
        pairs = pairs.unionByName(other)
    return pairs


def trajectory_join_lines(a: DataFrame, b: DataFrame, d: float, window: WindowSpec, *,
                          exclude_same_id: bool = False, min_points: int = 2,
                          hot_rows: Optional[int] = MAX_PATH_POINTS) -> DataFrame:
    """Sub-trajectories of both members of every joined id pair, ``side`` a and b.

    A pair is kept when both members have at least ``min_points`` points: other objects are left
    out before any pair is made.
    """
    def long_enough(df: DataFrame) -> DataFrame:
        rows = with_window(df, window)
        counts = rows.groupBy("window", "obj_id").agg(F.count(F.lit(1)).alias("_n"))
        return rows.join(counts.filter(F.col("_n") >= min_points), ["window", "obj_id"], "left_semi")

    left = long_enough(a)
    right = left if a is b else long_enough(b)
    pairs = near_ids(left, right, d, None, exclude_same_id=exclude_same_id)
    sides = {"a": left, "b": right}
    members = pairs.select("*", F.inline(F.array(*[
        F.struct(F.lit(s).alias("side"), F.col(f"{s}_obj_id").alias("obj_id")) for s in sides])))
    paths = [lines(rows, hot_rows=hot_rows).withColumn("side", F.lit(s)) for s, rows in sides.items()]
    return members.join(paths[0].unionByName(paths[1]), ["window", "side", "obj_id"]).select(
        "window", "a_obj_id", "b_obj_id", "side", "part", "n_points", "path")


# -- kNN ---------------------------------------------------------------------
def trajectory_knn(stream: DataFrame, query: QueryGeometry, r: Optional[float], k: int, *,
                   window: Optional[WindowSpec] = None, prefilter: bool = True) -> DataFrame:
    """The k nearest objects with the point at which each came nearest."""
    near = knn.nearby(stream, query, r, G.POINT, prefilter=prefilter)
    nearest = F.struct("dist", "ts", "x", "y")
    if window:
        best = window_aggregate(near, ["obj_id"], window, {"_m": ("min", nearest)})
        return knn.rank_nearest(best.select("window", "obj_id", "_m.*"), k)
    return knn.rank_nearest(near.groupBy("obj_id").agg(F.min(nearest).alias("_m")).select("obj_id", "_m.*"), k)


def trajectory_knn_lines(stream: DataFrame, query: QueryGeometry, r: Optional[float], k: int,
                         window: WindowSpec, *, min_points: int = 2,
                         hot_rows: Optional[int] = MAX_PATH_POINTS) -> DataFrame:
    """Sub-trajectories of the k nearest objects per window, with rank and distance."""
    top = knn.knn(stream, query, r, k, window=window)
    rows = with_window(stream, window)
    members = rows.join(top.select("window", "obj_id"), ["window", "obj_id"], "left_semi")
    return lines(members, min_points=min_points, hot_rows=hot_rows).join(top, ["window", "obj_id"])
