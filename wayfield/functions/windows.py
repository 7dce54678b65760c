"""Event-time windows. The window struct is carried along, never recomputed."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from math import gcd
from typing import NamedTuple, Optional

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class WindowSpec(NamedTuple):
    size: str
    slide: Optional[str] = None


def with_window(df: DataFrame, spec: WindowSpec, ts: str = "ts") -> DataFrame:
    """Add ``window``; a row in several sliding windows appears once per window."""
    return df.withColumn("window", F.window(F.col(ts), *[s for s in spec if s]))


def watermark(df: DataFrame, lateness_seconds: float, ts: str = "ts") -> DataFrame:
    return df.withWatermark(ts, f"{lateness_seconds} seconds")


_UNITS = {"microsecond": 1, "millisecond": 1_000, "second": 1_000_000, "minute": 60_000_000, "hour": 3_600_000_000,
          "day": 86_400_000_000, "week": 604_800_000_000}


def micros(length: str) -> int:
    """Length of an interval such as ``6 hours`` or ``1 day 12 hours`` in microseconds."""
    text = length.strip().lower().removeprefix("interval").strip()
    parts = [(int(n), unit.removesuffix("s")) for n, unit in re.findall(r"(\d+)\s*([a-z]+)", text)]
    if not re.fullmatch(r"(\d+\s*[a-z]+\s*)+", text) or any(unit not in _UNITS for _, unit in parts):
        raise ValueError(f"not an interval of fixed units: {length!r}")
    return sum(n * _UNITS[unit] for n, unit in parts)


_AGGREGATES = {"count": F.count, "sum": F.sum, "min": F.min, "max": F.max}
_MERGES = {**_AGGREGATES, "count": F.sum}


def window_aggregate(df: DataFrame, keys: Sequence[str], spec: WindowSpec, aggs: Mapping[str, tuple[str, Column]],
                     ts: str = "ts") -> DataFrame:
    """Aggregates ``name -> (count | sum | min | max, column)`` per window and keys.

    Sliding windows are made of panes, stretches of time that lie wholly inside or outside of every
    window: rows are aggregated once per pane, and only the panes' results are copied to the
    windows that they are part of. On a stream these are two aggregations in append mode.
    """
    if not spec.slide:
        parts = with_window(df, spec, ts).groupBy("window", *keys)
        return parts.agg(*[_AGGREGATES[fn](c).alias(name) for name, (fn, c) in aggs.items()])
    pane = f"{gcd(micros(spec.size), micros(spec.slide))} microseconds"
    panes = (df.groupBy(F.window(F.col(ts), pane).alias("pane"), *keys)
             .agg(*[_AGGREGATES[fn](c).alias(name) for name, (fn, c) in aggs.items()]))
    windows = panes.groupBy(F.window(F.window_time("pane"), spec.size, spec.slide).alias("window"), *keys)
    return windows.agg(*[_MERGES[fn](name).alias(name) for name, (fn, _) in aggs.items()])
