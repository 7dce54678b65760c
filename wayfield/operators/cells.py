"""Per-cell projections, filters and trajectory aggregates."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Optional

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import geometry as G
from ..functions import ordered
from ..functions.geometry import Shape
from ..functions.grid import Grid, cell_id
from ..functions.windows import WindowSpec, window_aggregate

MAX_LITERAL_CELLS = 10_000


# -- projections and filters -------------------------------------------------
def project(points: DataFrame, grid: Grid) -> DataFrame:
    """x, y and cell of each point; points without coordinates have no cell."""
    out = has_cell(grid.with_cell(points))
    return out.withColumn("cell", cell_id(F.col("cx"), F.col("cy")))


def has_cell(points: DataFrame) -> DataFrame:
    return points.filter(F.col("cx").isNotNull() & F.col("cy").isNotNull())


def count_per_cell(points: DataFrame, grid: Grid) -> DataFrame:
    return has_cell(grid.with_cell(points)).groupBy("cx", "cy").agg(F.count(F.lit(1)).alias("n"))


def restamp(points: DataFrame, now: Optional[Column] = None) -> DataFrame:
    """Replace event time by arrival time (the current time unless given)."""
    return points.withColumn("ts", F.current_timestamp() if now is None else now)


def in_cells(rows: DataFrame, cells: DataFrame) -> DataFrame:
    """Keep rows whose ``cx, cy`` is in the cell set; adaptive execution picks the join."""
    return rows.join(cells.select("cx", "cy").distinct(), ["cx", "cy"], "left_semi")


def bbox_touches_block(df: DataFrame, grid: Grid, lo: tuple[int, int],
                       hi: tuple[int, int]) -> DataFrame:
    """Keep each line or polygon once if its bounding box covers a cell of the block."""
    return df.filter((grid.cx(F.col("xmax")) >= lo[0]) & (grid.cx(F.col("xmin")) <= hi[0])
                     & (grid.cy(F.col("ymax")) >= lo[1]) & (grid.cy(F.col("ymin")) <= hi[1]))


def bbox_touches_cells(df: DataFrame, grid: Grid, cells: DataFrame | Sequence[tuple[int, int]],
                       row_id: Optional[Sequence[str]] = None) -> DataFrame:
    """The same for any set of cells: a list, or a table of ``cx, cy``.

    A table, or a list of more than ``MAX_LITERAL_CELLS``, is joined; that needs ``row_id``,
    columns that identify a row.
    """
    if not isinstance(cells, DataFrame) and len(cells) > MAX_LITERAL_CELLS:
        cells = df.sparkSession.createDataFrame(list(cells), "cx int, cy int")
    if isinstance(cells, DataFrame):
        if not row_id:
            raise ValueError("row_id is needed to match a table of cells")
        covered = grid.explode_bbox_cells(df.select(*row_id, "xmin", "ymin", "xmax", "ymax"))
        return df.join(in_cells(covered, cells).select(*row_id).distinct(), list(row_id), "left_semi")
    wanted = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i, j in cells])
    return df.filter(F.exists(wanted, lambda c: c["i"].between(
        grid.cx(F.col("xmin")), grid.cx(F.col("xmax"))) & c["j"].between(
        grid.cy(F.col("ymin")), grid.cy(F.col("ymax")))))


def without_control(features: DataFrame, kind: str = "geom_type") -> DataFrame:
    """Drop control records from a stream of parsed features."""
    return features.filter(F.lower(F.col(kind)) != "control")


def extreme_points(points: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The points with largest and smallest x and y; ties go to the smallest id."""
    who = F.struct("obj_id", F.unix_micros("ts").alias("t"), "x", "y")

    def first(measure: Column) -> Column:
        return F.min(F.struct(measure.alias("m"), who.alias("p")))["p"]

    return points.groupBy(*by).agg(
        first(F.col("x")).alias("min_x"), first(-F.col("x")).alias("max_x"),
        first(F.col("y")).alias("min_y"), first(-F.col("y")).alias("max_y"))


# -- trajectory spans per cell -----------------------------------------------
FUNCTIONS = ("ALL", "SUM", "AVG", "MIN", "MAX")


def spans(points: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Per cell and object: last - first timestamp (ms), point count, last timestamp."""
    return points.groupBy(*keys, "cx", "cy", "obj_id").agg(
        (F.max(F.unix_millis("ts")) - F.min(F.unix_millis("ts"))).alias("traj_ms"),
        F.count(F.lit(1)).alias("n_points"), F.max("ts").alias("last_ts"))


def window_spans(points: DataFrame, grid: Grid, window: WindowSpec) -> DataFrame:
    """``spans`` per window, cell and object; runs on streams too."""
    ms = F.unix_millis("ts")
    out = window_aggregate(has_cell(grid.with_cell(points)), ["cx", "cy", "obj_id"], window, {
        "_first": ("min", ms), "_last": ("max", ms), "n_points": ("count", F.lit(1)), "last_ts": ("max", F.col("ts"))})
    return out.select("window", "cx", "cy", "obj_id", (F.col("_last") - F.col("_first")).alias("traj_ms"),
                      "n_points", "last_ts")


def roll_up(object_spans: DataFrame, function: str, keys: Sequence[str] = (), *,
            keep_idle: bool = False) -> DataFrame:
    """Aggregate spans per cell.

    ALL keeps one row per cell and object (the entries of the cell's map). SUM and AVG
    (rounded half up) have no ``obj_id``; MIN and MAX name the object, ties by id.
    Unless ``keep_idle``, SUM and AVG need a positive sum, and MIN and MAX look only at
    objects with at least two points.
    """
    by = [*keys, "cx", "cy"]
    moving = F.lit(True) if keep_idle else F.col("n_points") >= 2
    per_cell = object_spans.groupBy(*by)
    n_obj = F.count(F.lit(1)).alias("n_obj")
    if function == "ALL":
        return object_spans.select(*by, "obj_id", "traj_ms").join(per_cell.agg(n_obj), by)
    if function in ("SUM", "AVG"):
        out = per_cell.agg(n_obj, F.sum("traj_ms").alias("total"))
        if not keep_idle:
            out = out.filter(F.col("total") > 0)
        value = F.col("total") if function == "SUM" else F.floor(F.col("total") / F.col("n_obj") + 0.5)
        return out.select(*by, "n_obj", value.cast("long").alias("traj_ms"))
    sign = {"MIN": 1, "MAX": -1}[function]
    best = F.min(F.when(moving, F.struct((F.col("traj_ms") * sign).alias("v"), "obj_id")))
    return (per_cell.agg(n_obj, best.alias("_b")).filter(F.col("_b").isNotNull())
            .select(*by, "n_obj", F.col("_b.obj_id").alias("obj_id"),
                    (F.col("_b.v") * sign).alias("traj_ms")))


def aggregate_now(points: DataFrame, grid: Grid, function: str,
                  idle_ms: Optional[int] = None) -> DataFrame:
    """State of every cell after the last point.

    With ``idle_ms``, objects last seen in the cell longer ago than that (measured from
    the newest point of all) are forgotten.
    """
    celled = has_cell(grid.with_cell(points))
    state = spans(celled)
    if idle_ms is not None:
        newest = points.select(F.max(F.unix_millis("ts"))).scalar()
        state = state.filter(F.unix_millis("last_ts") >= newest - F.lit(idle_ms))
    return roll_up(state, function, keep_idle=True)


def stays(points: DataFrame, grid: Grid, idle_ms: int, *, tie: Sequence[str] = (),
          hot_rows: Optional[int] = ordered.HOT_ROWS) -> DataFrame:
    """Every stay of an object in a cell: ``traj_ms``, ``n_points``, ``last_ts`` and ``ended``.

    A stay ends where its object is not seen in the cell for more than ``idle_ms``, before the
    next point or before the newest point of all.
    """
    celled = has_cell(grid.with_cell(points))
    own = ["cx", "cy", "obj_id"]
    rows = ordered.previous(celled.select(*own, "ts", *[c for c in tie if c not in (*own, "ts")]), own, ["ts"],
                            tie=tie, hot_rows=hot_rows)
    gap = F.unix_millis("ts") - F.unix_millis("prev.ts")
    rows = ordered.running(rows, own, {"stay": ("sum", F.coalesce((gap > idle_ms).cast("long"), F.lit(0)))}, tie=tie)
    newest = points.select(F.max(F.unix_millis("ts"))).scalar()
    latest = F.max("stay").over(W.partitionBy(*own))
    return (spans(ordered.drop_slices(rows), ["stay"])
            .withColumn("ended", (F.col("stay") < latest) | (F.unix_millis("last_ts") < newest - F.lit(idle_ms))))


def live_cells(points: DataFrame, grid: Grid, function: str, idle_ms: int, **options) -> DataFrame:
    """State of every cell after the last point, of the stays that have not ended."""
    return roll_up(stays(points, grid, idle_ms, **options).filter("not ended"), function, keep_idle=True)


def running_spans(points: DataFrame, grid: Grid, *, tie: Sequence[str] = (),
                  hot_rows: Optional[int] = ordered.HOT_ROWS) -> DataFrame:
    """State of the cell as each point arrives: own span, object count, SUM, AVG, MAX."""
    celled = has_cell(grid.with_cell(points))
    own = ["cx", "cy", "obj_id"]
    step = ordered.previous(celled, own, ["ts"], tie=tie, hot_rows=hot_rows)
    step = step.withColumns({
        "_step": F.coalesce(F.unix_millis("ts") - F.unix_millis("prev.ts"), F.lit(0)),
        "_new": F.col("prev").isNull().cast("long")})
    step = ordered.running(step, own, {"traj_ms": ("sum", F.col("_step"))}, tie=tie)
    cell = ordered.running(ordered.drop_slices(step), ["cx", "cy"], {
        "n_obj": ("sum", F.col("_new")), "sum_ms": ("sum", F.col("_step")),
        "max_ms": ("max", F.col("traj_ms"))}, tie=tie, hot_rows=hot_rows)
    return (ordered.drop_slices(cell).drop("prev", "_step", "_new")
            .withColumn("avg_ms", F.floor(F.col("sum_ms") / F.col("n_obj") + 0.5).cast("long")))


def aggregate_windows(points: DataFrame, grid: Grid, function: str,
                      window: WindowSpec) -> DataFrame:
    """Per window and cell."""
    return roll_up(window_spans(points, grid, window), function, ["window"])


def aggregate_counts(points: DataFrame, grid: Grid, function: str, size: int, slide: int, *,
                     tie: Sequence[str] = (), hot_rows: Optional[int] = ordered.HOT_ROWS) -> DataFrame:
    """Per cell, every ``slide`` points over the last ``size`` points; ``last_n`` names
    the point number that closes the window."""
    celled = has_cell(grid.with_cell(points))
    cell = ["cx", "cy"]
    numbered = ordered.drop_slices(
        ordered.running(celled, cell, {"_n": ("sum", F.lit(1))}, tie=tie, hot_rows=hot_rows))
    first_end = F.ceil(F.col("_n") / slide) * slide
    spread = numbered.withColumn("last_n", F.explode(F.sequence(
        first_end.cast("long"), (F.col("_n") + size - 1 + slide).cast("long"),
        F.lit(slide).cast("long")))).filter(F.col("last_n") < F.col("_n") + size)
    # a window exists once its closing point has arrived
    closed = celled.groupBy(*cell).agg(F.count(F.lit(1)).alias("_total"))
    per_object = spans(spread, ["last_n"]).join(closed, cell).filter(F.col("last_n") <= F.col("_total"))
    return roll_up(per_object.drop("_total"), function, ["last_n"])


# -- cell crossings ----------------------------------------------------------
def cells_on_step(grid: Grid, x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """Cells ``array<struct<cx,cy>>`` that the straight step crosses.

    Column by column: the y range of the step inside the closed column gives the rows.
    The end cells are always part of it.
    """
    ax, ay, bx, by = grid.cx(x1), grid.cy(y1), grid.cx(x2), grid.cy(y2)
    side = F.lit(grid.cell)
    lo_x, hi_x = F.least(x1, x2), F.greatest(x1, x2)
    lo_row, hi_row = F.least(ay, by), F.greatest(ay, by)

    def rows_of(i: Column) -> Column:
        left = F.greatest(F.lit(grid.minx) + i * side, lo_x)
        right = F.least(F.lit(grid.minx) + (i + 1) * side, hi_x)
        slope = F.try_divide(y2 - y1, x2 - x1)
        ya, yb = y1 + (left - x1) * slope, y1 + (right - x1) * slope
        top = (F.greatest(ya, yb) - F.lit(grid.miny)) / side
        low = (F.least(ya, yb) - F.lit(grid.miny)) / side
        j0 = F.greatest(lo_row, (F.ceil(low) - 1).cast("int"))
        j1 = F.least(hi_row, F.floor(top).cast("int"))
        cells = F.transform(F.sequence(j0, j1), lambda j: F.struct(i.alias("cx"), j.alias("cy")))
        return F.when(j0 <= j1, cells).otherwise(F.array().cast("array<struct<cx:int,cy:int>>"))

    ends = F.array(F.struct(ax.alias("cx"), ay.alias("cy")), F.struct(bx.alias("cx"), by.alias("cy")))
    diagonal = F.array_union(ends, F.flatten(F.transform(
        F.sequence(F.least(ax, bx), F.greatest(ax, bx)), rows_of)))
    return (F.when((ax == bx) & (ay == by), F.slice(ends, 1, 1))
            .when(ax == bx, F.transform(F.sequence(lo_row, hi_row),
                                        lambda j: F.struct(ax.alias("cx"), j.alias("cy"))))
            .when(ay == by, F.transform(F.sequence(F.least(ax, bx), F.greatest(ax, bx)),
                                        lambda i: F.struct(i.alias("cx"), ay.alias("cy"))))
            .otherwise(diagonal))


def cells_touched(df: DataFrame, grid: Grid, s: Shape) -> DataFrame:
    """One row per cell whose closed rectangle the line or polygon intersects."""
    out = grid.explode_bbox_cells(df)
    out = out.withColumns({f"_{k}": v for k, v in grid.bounds(F.col("cx"), F.col("cy")).items()})
    corners = ("_cell_xmin", "_cell_ymin", "_cell_xmax", "_cell_ymax")
    return out.filter(G.rect_intersects(s, *corners)).drop(*corners)
