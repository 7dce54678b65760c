"""Per-key ordered computations (previous row, running sums, numbering) that survive hot keys.

A plain ``Window.partitionBy(key).orderBy(ts)`` sorts a whole key in one task. Here the rows of
keys with more than ``hot_rows`` rows are range-partitioned by (key, time, tie) first: Spark samples
splitters and cuts the keys into slices of a fraction of ``hot_rows`` rows, however uneven the rows
lie in time, and also rows of one instant. The slices are written below the shared folder, so that
a row stays in its slice when a task is run again. The window function then runs per (key, slice),
every slice leaves a summary row, and a scan over the summaries of a key carries to each slice what
it needs from those before it. Keys below the limit form a single slice, for which this is the plain
window; without hot keys nothing is written and no summary is joined.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import Optional

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import work_dir

HOT_ROWS = 1_000_000
# Slices per ``hot_rows`` rows: sampled splitters leave some slices larger than others.
SLICES_PER_CHUNK = 4
# Up to this many hot keys are broadcast; more are joined.
MAX_HOT_KEYS = 10_000

SLICE = "_slice"


def with_slices(df: DataFrame, keys: Sequence[str], ts: str = "ts", hot_rows: Optional[int] = HOT_ROWS,
                tie: Sequence[str] = ()) -> DataFrame:
    """Add ``_slice``: 0 for ordinary keys, for hot keys numbers (from 1) that rise in the order of
    (ts, tie); rows equal in both may be in neighbouring slices.

    Counts the rows, and those of every key, when called: without more than ``hot_rows`` rows (or
    with ``hot_rows=None``) there are no hot keys to look for.
    """
    one = F.lit(0).cast("long")
    total = df.count() if hot_rows else 0
    if not hot_rows or total <= hot_rows:
        # a constant: the optimizer then removes everything that concerns hot keys
        return df.withColumn(SLICE, one)
    hot = (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > hot_rows)
           .select(*[F.col(k).alias(f"_hot_{k}") for k in keys], "_n"))
    found = hot.limit(MAX_HOT_KEYS + 1).collect()
    if not found:
        return df.withColumn(SLICE, one)
    if len(found) <= MAX_HOT_KEYS:
        rows = sum(r["_n"] for r in found)
        hot = F.broadcast(df.sparkSession.createDataFrame(found, hot.schema))
    else:
        rows = hot.agg(F.sum("_n")).first()[0]
    same = [F.col(k).eqNullSafe(F.col(f"_hot_{k}")) for k in keys]
    scalars = [c for c, t in df.dtypes if not t.startswith(("array", "map"))]
    order = [*dict.fromkeys([*keys, ts, *tie]), F.xxhash64(*scalars)]
    slices = -(-rows * SLICES_PER_CHUNK // hot_rows)
    path = work_dir(df.sparkSession, "slices")
    (df.join(hot, same, "left_semi").repartitionByRange(int(slices), *order)
     .withColumn(SLICE, (F.spark_partition_id() + 1).cast("long")).write.parquet(path))
    cut = df.sparkSession.read.schema(df.withColumn(SLICE, one).schema).parquet(path)
    return df.join(hot, same, "left_anti").withColumn(SLICE, one).unionByName(cut)


def first_per_time(sliced: DataFrame, keys: Sequence[str], ts: str = "ts",
                   tie: Sequence[str] = ()) -> DataFrame:
    """Keep the first row of every timestamp."""
    out = previous(sliced, keys, [ts], ts, tie)
    return out.filter(F.col("prev").isNull() | (F.col(f"prev.{ts}") != F.col(ts))).drop("prev")


def _order(ts: str, tie: Sequence[str]) -> list[str]:
    return [ts, *tie]


def _carry_join(df: DataFrame, keys: Sequence[str], per_slice: DataFrame) -> DataFrame:
    """Left-join one summary row per (key, slice) back onto the rows."""
    right = per_slice.select(*[F.col(k).alias(f"_c_{k}") for k in keys],
                             F.col(SLICE).alias("_c_slice"), "_carry")
    same = [F.col(k).eqNullSafe(F.col(f"_c_{k}")) for k in keys]
    return (df.join(right, [*same, F.col(SLICE) == F.col("_c_slice")], "left")
            .drop("_c_slice", *[f"_c_{k}" for k in keys]))


def previous(df: DataFrame, keys: Sequence[str], cols: Sequence[str], ts: str = "ts",
             tie: Sequence[str] = (), hot_rows: Optional[int] = HOT_ROWS) -> DataFrame:
    """Add ``prev``: a struct of ``cols`` from the preceding row of the same key.

    NULL for the first row of a key. ``_slice`` is taken over if present; it stays on the
    result for a following ``running`` call and is removed by ``drop_slices``.
    """
    base = df if SLICE in df.columns else with_slices(df, keys, ts, hot_rows, tie)
    order = _order(ts, tie)
    w = W.partitionBy(*keys, SLICE).orderBy(*order)
    rows = base.withColumn("_prev", F.lag(F.struct(*cols)).over(w))
    last = (base.filter(F.col(SLICE) > 0).groupBy(*keys, SLICE)
            .agg(F.max(F.struct(*order, F.struct(*cols).alias("_row"))).alias("_last")))
    carry = last.select(*keys, SLICE, F.lag("_last._row").over(
        W.partitionBy(*keys).orderBy(SLICE)).alias("_carry"))
    return (_carry_join(rows, keys, carry)
            .withColumn("prev", F.coalesce("_prev", "_carry")).drop("_prev", "_carry"))


def running(df: DataFrame, keys: Sequence[str], aggs: dict[str, tuple[str, Column]],
            ts: str = "ts", tie: Sequence[str] = (), hot_rows: Optional[int] = HOT_ROWS) -> DataFrame:
    """Add running aggregates ``name -> ('sum'|'min'|'max', column)`` up to each row."""
    base = df if SLICE in df.columns else with_slices(df, keys, ts, hot_rows, tie)
    fns = {"sum": F.sum, "min": F.min, "max": F.max}
    merge = {"sum": lambda a, b: F.coalesce(a + b, a, b), "min": F.least, "max": F.greatest}
    w = (W.partitionBy(*keys, SLICE).orderBy(*_order(ts, tie))
         .rowsBetween(W.unboundedPreceding, W.currentRow))
    rows = base.withColumns({f"_r_{name}": fns[fn](c).over(w) for name, (fn, c) in aggs.items()})
    totals = (base.filter(F.col(SLICE) > 0).groupBy(*keys, SLICE)
              .agg(*[fns[fn](c).alias(name) for name, (fn, c) in aggs.items()]))
    before = (W.partitionBy(*keys).orderBy(SLICE)
              .rowsBetween(W.unboundedPreceding, -1))
    carry = totals.select(*keys, SLICE, F.struct(
        *[fns[fn](F.col(name)).over(before).alias(name)
          for name, (fn, _) in aggs.items()]).alias("_carry"))
    out = _carry_join(rows, keys, carry).withColumns(
        {name: merge[fn](F.col(f"_r_{name}"), F.col(f"_carry.{name}"))
         for name, (fn, _) in aggs.items()})
    return out.drop("_carry", *[f"_r_{name}" for name in aggs])


def drop_slices(df: DataFrame) -> DataFrame:
    return df.drop(SLICE)
