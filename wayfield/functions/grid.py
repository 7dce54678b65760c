"""Uniform grid: cell numbers, neighbour blocks and layers as Column expressions."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Grid:
    minx: float
    miny: float
    cell: float
    n: int

    @classmethod
    def by_count(cls, minx: float, miny: float, maxx: float, maxy: float, n: int) -> Grid:
        """n x n cells; the x extent fixes the cell side for both axes."""
        return cls(float(minx), float(miny), (maxx - minx) / n, n)

    @classmethod
    def by_cell(cls, minx: float, miny: float, maxx: float, maxy: float, cell: float) -> Grid:
        """Square the box by padding its shorter axis, then fit cells of at most ``cell``."""
        width, height = maxx - minx, maxy - miny
        side = max(width, height)
        minx, miny = minx - (side - width) / 2, miny - (side - height) / 2
        n = max(1, math.ceil(side / cell))
        return cls(float(minx), float(miny), side / n, n)

    # -- cells -----------------------------------------------------------
    def cx(self, x: Column) -> Column:
        return F.floor((x - F.lit(self.minx)) / F.lit(self.cell)).cast("int")

    def cy(self, y: Column) -> Column:
        return F.floor((y - F.lit(self.miny)) / F.lit(self.cell)).cast("int")

    def cx_sql(self, x: str) -> str:
        return f"int(floor(({x} - ({self.minx!r}D)) / {self.cell!r}D))"

    def cy_sql(self, y: str) -> str:
        return f"int(floor(({y} - ({self.miny!r}D)) / {self.cell!r}D))"

    def of(self, x: float, y: float) -> tuple[int, int]:
        return math.floor((x - self.minx) / self.cell), math.floor((y - self.miny) / self.cell)

    def valid(self, cx: Column, cy: Column) -> Column:
        return cx.between(0, self.n - 1) & cy.between(0, self.n - 1)

    def bounds(self, cx: Column, cy: Column) -> dict[str, Column]:
        return {"cell_xmin": F.lit(self.minx) + cx * F.lit(self.cell),
                "cell_ymin": F.lit(self.miny) + cy * F.lit(self.cell),
                "cell_xmax": F.lit(self.minx) + (cx + 1) * F.lit(self.cell),
                "cell_ymax": F.lit(self.miny) + (cy + 1) * F.lit(self.cell)}

    def with_cell(self, df: DataFrame, x: str = "x", y: str = "y", clip: bool = False) -> DataFrame:
        """Add ``cx, cy``. Rows outside the grid keep their numbers unless ``clip``."""
        out = df.withColumns({"cx": self.cx(F.col(x)), "cy": self.cy(F.col(y))})
        return out.filter(self.valid(F.col("cx"), F.col("cy"))) if clip else out

    def explode_bbox_cells(self, df: DataFrame, clip: bool = False) -> DataFrame:
        """One row per cell under the bounding box of a line or polygon."""
        out = (df
               .withColumn("cx", F.explode(F.sequence(self.cx(F.col("xmin")), self.cx(F.col("xmax")))))
               .withColumn("cy", F.explode(F.sequence(self.cy(F.col("ymin")), self.cy(F.col("ymax"))))))
        return out.filter(self.valid(F.col("cx"), F.col("cy"))) if clip else out

    # -- layers ----------------------------------------------------------
    def guaranteed_layers(self, r: float) -> int:
        """Layers around a cell that lie within r of every point in it; -1 for none."""
        return math.floor(r / (self.cell * math.sqrt(2)) - 1)

    def candidate_layers(self, r: float) -> int:
        return math.ceil(r / self.cell)


def cell_id(cx: Column, cy: Column) -> Column:
    """Two five-digit numbers joined, as used in reports."""
    return F.format_string("%05d%05d", cx, cy)


def layer(cx: Column, cy: Column, qx, qy) -> Column:
    """Chebyshev ring number of a cell around the cell (qx, qy)."""
    return F.greatest(F.abs(cx - F.lit(qx)), F.abs(cy - F.lit(qy)))


def within_layers(cx: Column, cy: Column, qx, qy, layers: int) -> Column:
    return layer(cx, cy, qx, qy) <= layers


def neighbor_cells(df: DataFrame, grid: Grid, r: float, clip: bool = True) -> DataFrame:
    """Explode rows with ``cx, cy`` to the block of cells that can hold points within r."""
    k = grid.candidate_layers(r)
    out = (df.withColumn("ncx", F.explode(F.sequence(F.col("cx") - k, F.col("cx") + k)))
             .withColumn("ncy", F.explode(F.sequence(F.col("cy") - k, F.col("cy") + k))))
    return out.filter(grid.valid(F.col("ncx"), F.col("ncy"))) if clip else out
