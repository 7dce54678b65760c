"""Stateful per-key operators for streams.

Each keeps a few values per key in the state store. Rows of a key that arrive in one
micro-batch are taken in time order; a row not later than the last one of an earlier
micro-batch is out of order. Where keys are objects or users, of which there are many, they
are dealt into buckets: Python is called per bucket, whose rows are taken in one go.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Optional

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..functions.geometry import POINT, QueryGeometry
from ..functions.grid import Grid
from ..functions.windows import WindowSpec, with_window
from ..operators import apps, cells, knn


def _sorted(frames: Iterator[pd.DataFrame], by: list[str]) -> pd.DataFrame:
    return pd.concat(list(frames), ignore_index=True).sort_values(by, ignore_index=True)


def _apply(df: DataFrame, keys: list[str], fn, output: str, state: str) -> DataFrame:
    return df.groupBy(*keys).applyInPandasWithState(
        fn, output, state, "append", GroupStateTimeout.NoTimeout)


# -- stays in cells, with eviction ---------------------------------------------------
_STAY_KEYS = ["cx", "cy", "obj_id"]
_STAY = [*_STAY_KEYS, "first", "last", "n"]


def _united(stays: pd.DataFrame, gap: int) -> pd.DataFrame:
    """Stays of a cell and object united where they lie at most ``gap`` apart, in order of key and time.
    ``new`` tells rows whose points are not all from the state, ``held`` those with a part that is."""
    stays = stays.sort_values([*_STAY_KEYS, "first"], kind="stable", ignore_index=True)
    key = stays.groupby(_STAY_KEYS, sort=False, dropna=False).ngroup().to_numpy()
    reach = stays["last"].groupby(key).cummax().to_numpy()
    start = np.ones(len(stays), dtype=bool)
    start[1:] = (key[1:] != key[:-1]) | (stays["first"].to_numpy()[1:] - reach[:-1] > gap)
    at = np.flatnonzero(start)
    out = stays.iloc[at].copy()
    for name, of in (("last", np.maximum), ("n", np.add), ("new", np.logical_or), ("held", np.logical_or)):
        out[name] = of.reduceat(stays[name].to_numpy(), at)
    out["key"] = key[at]
    return out.reset_index(drop=True)


class _Stays(StatefulProcessor):
    """The open stays of a bucket of cells and objects: a map with one entry per stay, and one timer, set
    to when the first of them is over."""

    def __init__(self, idle_ms: int):
        self.idle_ms = idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getMapState("open", "cx int, cy int, obj_id string", "first_ms bigint, last_ms bigint, n bigint")

    def _held(self) -> pd.DataFrame:
        rows = pd.DataFrame([(*k, *v) for k, v in self.open.iterator()], columns=_STAY)
        types = {c: "int64" for c in ("cx", "cy", "first", "last", "n")}
        return rows.astype({**types, "obj_id": object}).assign(new=False, held=True)

    def _settle(self, stays: pd.DataFrame, now_ms: int) -> Iterator[pd.DataFrame]:
        """Keep what is open, forget what is over, and tell both: open stays only if they grew."""
        newest = np.append(stays["key"].to_numpy()[1:] != stays["key"].to_numpy()[:-1], True)[:len(stays)]
        over = ~newest | (stays["last"].to_numpy() + self.idle_ms < now_ms)
        new, held = stays["new"].to_numpy(), stays["held"].to_numpy()
        grown = ~over & new
        emptied = stays[over & held]
        # an entry is kept per cell and object: that of a stay behind takes the place of one that is over
        emptied = emptied[~emptied["key"].isin(stays["key"][~over])]
        kept = stays[grown]
        if len(emptied) > int((~over & ~new).sum()):  # fewer entries stay than go
            self.open.clear()
            emptied, kept = emptied[:0], stays[~over]
        for k in _entries(emptied[_STAY_KEYS]):
            self.open.removeKey(k)
        for row in _entries(kept[_STAY]):
            self.open.updateValue(row[:3], row[3:])
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if not over.all():
            self.handle.registerTimer(int(stays["last"][~over].min()) + self.idle_ms)
        told = stays[over | grown]
        if len(told):
            yield pd.DataFrame({
                "cx": told["cx"].astype("int32"), "cy": told["cy"].astype("int32"), "obj_id": told["obj_id"],
                "traj_ms": told["last"] - told["first"], "n_points": told["n"],
                "last_ts": pd.to_datetime(told["last"], unit="ms", utc=True), "ended": over[over | grown]})

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        stays = self._held()
        for frame in rows:  # a frame at a time, in any order: stays unite
            points = frame[_STAY_KEYS].assign(first=frame["ms"], last=frame["ms"], n=1, new=True, held=False)
            stays = _united(pd.concat([stays[points.columns], points]) if len(stays) else points, self.idle_ms)
        yield from self._settle(stays, timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        stays = self._held()
        if len(stays):
            yield from self._settle(_united(stays, self.idle_ms), timerValues.getCurrentWatermarkInMs())


def _entries(rows: pd.DataFrame):
    return zip(*[rows[c].tolist() for c in rows.columns])


def cell_stays(stream: DataFrame, grid: Grid, idle_ms: int, *, buckets: int = 256) -> DataFrame:
    """Streaming twin of ``cells.stays``, in update mode; the stream needs a watermark.

    The state is one entry per cell and object that have an open stay: an object that was not seen in a
    cell for more than ``idle_ms`` is forgotten once the watermark says so, and comes out with
    ``ended``; if it returns, a new stay begins. An open stay comes out whenever it grows. Cells and
    objects are dealt into ``buckets`` by hash; a bucket's rows of a micro-batch are united in one go
    and its open stays looked through, so Python is called per bucket, not per object. The state store
    must be RocksDB (``session.configure``).
    """
    rows = cells.has_cell(grid.with_cell(stream)).select(
        F.pmod(F.xxhash64("cx", "cy", "obj_id"), F.lit(buckets)).cast("int").alias("bucket"),
        "cx", "cy", "obj_id", F.unix_millis("ts").alias("ms"), "ts")
    return rows.groupBy("bucket").transformWithStateInPandas(
        _Stays(idle_ms), "cx int, cy int, obj_id string, traj_ms bigint, n_points bigint, last_ts timestamp, ended boolean",
        "update", "EventTime")


# -- last rows of keys, by bucket --------------------------------------------------
BUCKETS = 256
NO_TIME = np.iinfo(np.int64).min


def _in_buckets(df: DataFrame, key: str, fn, output: str, state: str, buckets: int) -> DataFrame:
    """``fn`` on the rows of a bucket of keys. Its state is the columns of a table with a row per key,
    that is, arrays of one length."""
    rows = df.withColumn("bucket", F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int"))
    arrays = ", ".join(f"{c.split()[0]} array<{c.split()[1]}>" for c in state.split(", "))
    return _apply(rows, ["bucket"], fn, output, arrays)


def _table(state: GroupState, columns: list[str]) -> pd.DataFrame:
    return pd.DataFrame(dict(zip(columns, state.get if state.exists else [[]] * len(columns))), columns=columns)


def _joined(held: pd.Series, new: pd.Series, kind=None) -> np.ndarray:
    """Values of the state's rows with those of the new rows behind them."""
    return np.concatenate([held.to_numpy(kind), new.to_numpy(kind)]) if len(held) else new.to_numpy(kind)


def _codes(held: pd.Series, new: pd.Series) -> np.ndarray:
    """A number per key, NULL among them."""
    return pd.factorize(np.concatenate([held.to_numpy(object), new.to_numpy(object)]), use_na_sentinel=False)[0]


def _edges(code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether a row is the first and whether it is the last of its key, in rows by key."""
    change = code[1:] != code[:-1]
    return np.append(True, change), np.append(change, True)


# -- trajectory statistics ---------------------------------------------------------
_STATS = ["obj_id", "spatial_length", "temporal_length", "last_us", "x", "y"]


def _stats(key, frames, state: GroupState) -> Iterator[pd.DataFrame]:
    rows = pd.concat(list(frames), ignore_index=True).dropna(subset="us")
    held = _table(state, _STATS)
    code = _codes(held["obj_id"], rows["obj_id"])
    us = _joined(held["last_us"], rows["us"], "int64")
    x, y = (_joined(held[c], rows[c], "float64") for c in "xy")
    old = np.arange(len(us)) < len(held)
    last = np.full(len(us), NO_TIME)  # by code
    last[code[old]] = us[old]
    at = np.lexsort((y, x, us, code))
    at = at[old[at] | (us[at] > last[code[at]])]
    if len(at) <= len(held):
        return
    at = at[np.append(True, (code[at[1:]] != code[at[:-1]]) | (us[at[1:]] != us[at[:-1]]))]
    first, end = _edges(code[at])
    begins = np.flatnonzero(first)
    sizes = np.diff(np.append(begins, len(at)))
    us, x, y, old = us[at], x[at], y[at], old[at]
    # what a key has from before is added to the sum of its new steps
    spans = np.append(0, np.diff(us // 1000))
    spans[first] = 0
    spans = np.cumsum(spans)
    spans -= np.repeat(spans[first], sizes)
    lengths = np.append(0.0, np.hypot(np.diff(x), np.diff(y)))
    lengths[first] = 0.0
    for begin, size in zip(begins[sizes > 2].tolist(), sizes[sizes > 2].tolist()):
        np.cumsum(lengths[begin:begin + size], out=lengths[begin:begin + size])
    from_state = at[begins][old[begins]]  # rows of the state come before all others
    length, ms = np.zeros(len(begins)), np.zeros(len(begins), np.int64)
    length[old[begins]] = held["spatial_length"].to_numpy("float64")[from_state]
    ms[old[begins]] = held["temporal_length"].to_numpy("int64")[from_state]
    lengths, spans = np.repeat(length, sizes) + lengths, np.repeat(ms, sizes) + spans
    ids = _joined(held["obj_id"], rows["obj_id"], object)[at]
    state.update(tuple(v[end].tolist() for v in (ids, lengths, spans, us, x, y)))
    more = ~first
    if more.any():
        yield pd.DataFrame({"obj_id": ids[more], "ts": pd.to_datetime(us[more], unit="us", utc=True),
                            "spatial_length": lengths[more], "temporal_length": spans[more]})


def running_stats(stream: DataFrame, *, buckets: int = BUCKETS) -> DataFrame:
    """Streaming twin of ``trajectory.running_stats``; the state has a row per object."""
    rows = stream.select("obj_id", F.unix_micros("ts").alias("us"), "x", "y")
    out = _in_buckets(rows, "obj_id", _stats,
                      "obj_id string, ts timestamp, spatial_length double, temporal_length bigint",
                      "obj_id string, spatial_length double, temporal_length bigint, last_us bigint, x double, y double",
                      buckets)
    return out.withColumn("speed", F.try_divide("spatial_length", "temporal_length"))


_SPEED = ["obj_id", "last_us", "x", "y"]


def _speed(key, frames, state: GroupState) -> Iterator[pd.DataFrame]:
    rows = pd.concat(list(frames), ignore_index=True).dropna(subset="us")
    if rows.empty:
        return
    held = _table(state, _SPEED)
    code = _codes(held["obj_id"], rows["obj_id"])
    us = _joined(held["last_us"], rows["us"], "int64")
    new = np.arange(len(us)) >= len(held)
    event = np.append(np.full(len(held), -1), rows["event_id"].to_numpy())
    # the last point is the one before even if it is not the older one
    at = np.lexsort((event, us, new, code))
    first, end = _edges(code[at])
    us, x, y = us[at], *(_joined(held[c], rows[c], "float64")[at] for c in "xy")
    ids = _joined(held["obj_id"], rows["obj_id"], object)[at]
    state.update(tuple(v[end].tolist() for v in (ids, us, x, y)))
    seconds = np.append(0, np.diff(us // 1000)) / 1000.0
    ok = (seconds > 0) & ~first
    if ok.any():
        step = np.append(0.0, np.hypot(np.diff(x), np.diff(y)))
        yield pd.DataFrame({
            "event_id": event[at][ok], "obj_id": ids[ok],
            "ts": pd.to_datetime(us[ok], unit="us", utc=True), "speed": step[ok] / seconds[ok]})


def speed(stream: DataFrame, *, buckets: int = BUCKETS) -> DataFrame:
    """Streaming twin of ``trajectory.speed``; the state has a row per object."""
    rows = stream.select("event_id", "obj_id", F.unix_micros("ts").alias("us"), "x", "y")
    return _in_buckets(rows, "obj_id", _speed, "event_id bigint, obj_id string, ts timestamp, speed double",
                       "obj_id string, last_us bigint, x double, y double", buckets)


# -- count windows -----------------------------------------------------------------
PLACES = 1 << 20  # points of windows looked at together


def _count_windows(size: int, slide: int):
    def fn(key, frames, state: GroupState) -> Iterator[pd.DataFrame]:
        rows = _sorted(frames, ["us", "event_id"])
        n, ms, ids = state.get if state.exists else (0, [], [])
        ms = np.append(np.array(ms, dtype="int64"), rows["us"].to_numpy() // 1000)
        ids = np.append(np.array(ids, dtype=object), rows["obj_id"].to_numpy())
        first, total = n - (len(ms) - len(rows)), n + len(rows)  # number of the first kept point - 1
        state.update((total, [int(v) for v in ms[-size:]], [str(v) for v in ids[-size:]]))
        ends = np.arange((n // slide + 1) * slide, total + 1, slide)
        lot = max(1, PLACES // size)
        for begin in range(0, len(ends), lot):  # a lot of windows at a time
            lot_ends = ends[begin:begin + lot]
            at = lot_ends[:, None] - size + np.arange(size)[None, :] - first
            end, at = np.repeat(lot_ends, size), at.ravel()
            end, at = end[at >= 0], at[at >= 0]
            if not len(at):
                continue
            spans = pd.DataFrame({"last_n": end, "obj_id": ids[at], "ms": ms[at]}).groupby(
                ["last_n", "obj_id"])["ms"].agg(["min", "max", "count"]).reset_index()
            yield pd.DataFrame({
                "cx": np.int32(key[0]), "cy": np.int32(key[1]), "last_n": spans["last_n"],
                "obj_id": spans["obj_id"], "traj_ms": spans["max"] - spans["min"],
                "n_points": spans["count"]})
    return fn


def count_window_spans(stream: DataFrame, grid: Grid, size: int, slide: int) -> DataFrame:
    """Object spans of every closed count window; the state is the last ``size`` points.

    A window comes out whole in one micro-batch, so ``cells.roll_up`` with the key
    ``last_n`` can follow in ``foreachBatch``.
    """
    rows = cells.has_cell(grid.with_cell(stream)).select(
        "cx", "cy", "event_id", "obj_id", F.unix_micros("ts").alias("us"))
    return _apply(rows, ["cx", "cy"], _count_windows(size, slide),
                  "cx int, cy int, last_n bigint, obj_id string, traj_ms bigint, n_points bigint",
                  "n bigint, ms array<bigint>, ids array<string>")


# -- check-in ----------------------------------------------------------------------
_LAST = ["user_id", "device_id", "last_us"]


def _with_previous(key, frames, state: GroupState) -> Iterator[pd.DataFrame]:
    rows = pd.concat(list(frames), ignore_index=True)
    held = _table(state, _LAST)
    code = _codes(held["user_id"], rows["user_id"])
    us = _joined(held["last_us"].astype("Int64").fillna(NO_TIME), rows["us"].astype("Int64").fillna(NO_TIME), "int64")
    new = np.arange(len(us)) >= len(held)
    event = pd.factorize(rows["event_id"], sort=True)[0]
    event = np.append(np.zeros(len(held), int), np.where(event < 0, len(event), event))
    at = np.lexsort((event, us, new, code))
    first, end = _edges(code[at])
    us, new = us[at], new[at]
    users = _joined(held["user_id"], rows["user_id"], object)[at]
    device = _joined(held["device_id"], rows["device_id"], object)[at]
    times = np.where(us == NO_TIME, None, us.astype(object))
    state.update(tuple(v[end].tolist() for v in (users, device, times)))
    before, prev = np.append(None, device[:-1]), np.append(None, times[:-1])
    before[first], prev[first] = None, None
    out = rows.iloc[at[new] - len(held)][["event_id", "device_id", "user_id", "us", "x", "y"]]
    yield out.assign(prev_device=before[new], prev_us=pd.array(prev[new], dtype="Int64"))


def fill_checkins(stream: DataFrame, *, buckets: int = BUCKETS) -> DataFrame:
    """Streaming twin of ``apps.fill_checkins``; the state is each user's last event."""
    rows = stream.select("event_id", "device_id", "user_id", F.unix_micros("ts").alias("us"), "x", "y")
    out = _in_buckets(rows, "user_id", _with_previous,
                      "event_id string, device_id string, user_id string, us bigint, x double, y double, "
                      "prev_device string, prev_us bigint", "user_id string, device_id string, last_us bigint", buckets)
    return apps.insert_opposites(out.withColumns({
        "ts": F.timestamp_micros("us"),
        "prev": F.struct(F.col("prev_device").alias("device_id"),
                         F.timestamp_micros("prev_us").alias("ts"))}))


# -- early kNN ---------------------------------------------------------------------
_NEAR = ["dist", "obj_id", "us", "x", "y"]


def _best(frames: list[pd.DataFrame], k: int) -> pd.DataFrame:
    """The k nearest objects, each with its best point, of all frames."""
    rows = pd.concat(frames, ignore_index=True).sort_values(_NEAR, ignore_index=True)
    return rows.drop_duplicates("obj_id").head(k)


def _nearest(k: int):
    def fn(key, frames, state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        old = pd.DataFrame(dict(zip(_NEAR, state.get))) if state.exists else pd.DataFrame(columns=_NEAR)
        top = old
        for frame in frames:  # only k rows are kept from one frame to the next
            top = _best([f for f in (top, frame[_NEAR]) if len(f)], k)
        top = top.reset_index(drop=True)
        state.update(tuple(top[c].tolist() for c in _NEAR))
        end = int(key[1])
        if end > state.getCurrentWatermarkMs():
            state.setTimeoutTimestamp(end)
        if not top.equals(old.astype(top.dtypes)) if len(old) else len(top):
            yield pd.DataFrame({"start_us": int(key[0]), "bucket": int(key[2]), "place": np.arange(len(top), dtype="int32"),
                                **{c: top[c] for c in _NEAR}})
    return fn


def nearest_so_far(stream: DataFrame, query: QueryGeometry, r: Optional[float], k: int, window: WindowSpec, *,
                   buckets: int = 16) -> DataFrame:
    """Trajectory kNN while windows are open, in update mode; the stream needs a watermark.

    Objects are dealt into ``buckets`` by id. The state of a window and bucket is its k nearest
    objects, each with its best point. That is enough: an object outside it has k objects
    before it that only come nearer, and enters with the point that brings it in. Whenever a
    list changes it comes out whole (``place`` from 0); ``nearest_now`` makes the answer of it.
    """
    near = with_window(knn.nearby(stream, query, r, POINT), window)
    rows = near.select(
        F.unix_micros("window.start").alias("start_us"), F.unix_millis("window.end").alias("end_ms"),
        F.pmod(F.xxhash64("obj_id"), F.lit(buckets)).cast("int").alias("bucket"),
        "dist", "obj_id", F.unix_micros("ts").alias("us"), "x", "y", "ts")
    return rows.groupBy("start_us", "end_ms", "bucket").applyInPandasWithState(
        _nearest(k), "start_us bigint, bucket int, place int, dist double, obj_id string, us bigint, x double, y double",
        "dist array<double>, obj_id array<string>, us array<bigint>, x array<double>, y array<double>",
        "update", GroupStateTimeout.EventTimeTimeout)


def nearest_now(rows: DataFrame, k: int) -> DataFrame:
    """The k nearest per window after the newest micro-batch in ``rows``, a table of
    ``nearest_so_far``: the newest list of every bucket, merged."""
    newest = rows.groupBy("start_us", "bucket").agg(F.max("batch").alias("batch"))
    lists = rows.join(newest, ["start_us", "bucket", "batch"]).select(
        "start_us", "obj_id", "dist", F.timestamp_micros("us").alias("ts"), "x", "y")
    rank = F.row_number().over(W.partitionBy("start_us").orderBy("dist", "obj_id"))
    return lists.withColumn("rank", rank).filter(F.col("rank") <= k)
