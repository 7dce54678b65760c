"""Shards of near-equal bytes by sampled splitters.

Records are ordered by a hash of their text, so equal texts lie together. A size-weighted sample
of the keys gives splitters; the bytes between splitters are counted exactly, ranges that came out
overfull are sampled again and subdivided, and the shards' boundaries fall on the splitters
nearest to the byte quantiles. A group of equal texts that weighs more than a hundredth of a shard
is no range between two splitters but placed by itself: whole where it fits, else its records are
subdivided by a hash of their ids and fill several shards. Shards have room for the light records
that the heavy groups leave.

What is collected or broadcast is bounded by parameters: at most ``shards * HEAVY`` heavy groups,
as many blocks of them plus one per group, and ``4 * shards * RANGES`` splitters.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import written

HEAVY = 100          # a group above 1 / HEAVY of a shard is placed by itself
RANGES = 250         # ranges per shard between sampled splitters
OVERFULL = 2.0       # a range of more than this many mean sizes is subdivided
ROUNDS = 4
OVERHEAD = 16


def described(docs: DataFrame, id_col: str, text_col: str, overhead: int) -> DataFrame:
    data = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    return docs.select(
        F.col(id_col).cast("long").alias("doc"), (F.octet_length(data) + F.lit(overhead)).cast("long").alias("size"),
        F.crc32(data).alias("crc"), F.xxhash64(data).alias("key"), F.xxhash64(F.col(id_col).cast("long"), F.lit(7)).alias("h"))


def place_heavy(groups: list[tuple[int, list[int]]], shards: int, capacity: float):
    """Shard of every block of every heavy group (key, bytes per block), and the loads."""
    load = np.zeros(shards)
    where: dict[int, list[int]] = {}
    for key, blocks in sorted(groups, key=lambda g: (-sum(g[1]), g[0])):
        total = sum(blocks)
        at = int(load.argmin())
        if load[at] + total <= capacity * 1.005 or len(blocks) == 1:
            where[key] = [at] * len(blocks)
            load[at] += total
            continue
        where[key] = []
        for b in blocks:
            if load[at] + b / 2 > capacity:
                at = int(load.argmin())
            where[key].append(at)
            load[at] += b
    return where, load


@dataclass
class Units:
    """Unit of each record: a range of light keys, or a block of a heavy group behind them."""

    splitters: np.ndarray
    heavy: np.ndarray
    blocks: np.ndarray
    first: np.ndarray

    def __call__(self, key: np.ndarray, h: np.ndarray) -> np.ndarray:
        out = np.searchsorted(self.splitters, key, side="right").astype(np.int64)
        if len(self.heavy):
            at = np.minimum(np.searchsorted(self.heavy, key), len(self.heavy) - 1)
            hit = self.heavy[at] == key
            block = h[hit].view(np.uint64) % self.blocks[at[hit]].astype(np.uint64)
            out[hit] = self.first[at[hit]] + block.astype(np.int64)
        return out


def shard(docs: DataFrame, shards: int = 40, overhead: int = OVERHEAD, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """(doc, size, crc, shard, slot): shard 0 .. shards - 1 and gapless place in it, for every row.

    Sizes are UTF-8 bytes plus ``overhead``; NULL texts count as empty and are one group with
    empty texts. Rows with equal texts share a shard unless their group does not fit into one.
    Repeated rows are rows of their own. The result depends on ids and texts alone.
    """
    spark = docs.sparkSession
    rows = written(described(docs, id_col, text_col, overhead), "sharding-rows")
    total = rows.agg(F.sum("size")).first()[0] or 0
    capacity = total / shards
    by_key = rows.groupBy("key").agg(F.sum("size").alias("bytes"))
    heavy = {r["key"]: r["bytes"] for r in by_key.filter(F.col("bytes") > capacity / HEAVY).collect()}
    keys = np.array(sorted(heavy), np.int64)
    n_blocks = np.array([max(1, int(-(-heavy[k] * HEAVY // max(capacity, 1)))) for k in keys.tolist()], np.int64)
    light = total - sum(heavy.values())

    splitters = np.empty(0, np.int64)
    mean = light / (shards * RANGES) or 1.0
    rate = 1 / mean
    over = None
    for _ in range(ROUNDS):
        sampled = sample(rows, splitters, keys, over, rate)
        splitters = np.unique(np.concatenate([splitters, sampled]))[:4 * shards * RANGES]
        first = len(splitters) + 1 + np.cumsum(n_blocks) - n_blocks
        unit = Units(splitters, keys, n_blocks, first)
        units = counted(rows, unit)
        n_bytes = np.zeros(len(splitters) + 1 + int(n_blocks.sum()), np.int64)
        n_rows = n_bytes.copy()
        for u, b, n in units:
            n_bytes[u], n_rows[u] = b, n
        over = np.flatnonzero(n_bytes[:len(splitters) + 1] > OVERFULL * mean)
        rate *= 4
        if not len(over) or not len(sampled):
            break

    groups = [(i, n_bytes[f:f + m].tolist()) for i, (f, m) in enumerate(zip(first, n_blocks))]
    where, load = place_heavy(groups, shards, capacity)
    room = np.maximum(capacity - load, 0)
    room = np.cumsum(room) * (light / room.sum() if room.sum() else 1.0)
    ranges = n_bytes[:len(splitters) + 1]
    middle = np.cumsum(ranges) - ranges / 2
    to_shard = np.concatenate([np.minimum(np.searchsorted(room, middle, side="right"), shards - 1),
                               np.array([s for i in range(len(groups)) for s in where[i]], np.int64)]).astype(np.int64)
    order = np.argsort(to_shard, kind="stable")
    before = np.cumsum(n_rows[order]) - n_rows[order]
    start = np.searchsorted(to_shard[order], to_shard[order], side="left")
    offset = np.empty(len(order), np.int64)
    offset[order] = before - before[start] if len(order) else before
    shared = spark.sparkContext.broadcast((unit, to_shard, offset))

    def run(batches):
        unit, to_shard, offset = shared.value
        for batch in batches:
            u = unit(batch.column(3).to_numpy(), batch.column(4).to_numpy())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(u), pa.array(to_shard[u].astype(np.int32)), pa.array(offset[u])],
                names=["doc", "size", "crc", "key", "h", "unit", "shard", "before"])

    placed = rows.mapInArrow(run, "doc long, size long, crc long, key long, h long, unit long, shard int, before long")
    rank = F.row_number().over(Window.partitionBy("unit").orderBy("key", "doc", "size", "crc"))
    return placed.select("doc", "size", "crc", "shard", (F.col("before") + rank - 1).cast("long").alias("slot"))


def sample(rows: DataFrame, splitters: np.ndarray, heavy: np.ndarray, over, rate: float) -> np.ndarray:
    """Keys of light records, drawn with a chance in proportion to their size; ``over`` names the
    ranges to draw from."""

    def run(batches):
        for batch in batches:
            key = batch.column(3).to_numpy()
            size = batch.column(1).to_numpy()
            # a draw that depends on id and key only
            u = ((batch.column(4).to_numpy().view(np.uint64) ^ key.view(np.uint64))
                 * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(11)) / float(1 << 53)
            keep = u < size * rate
            if len(heavy):
                at = np.minimum(np.searchsorted(heavy, key), len(heavy) - 1)
                keep &= heavy[at] != key
            if over is not None:
                keep &= np.isin(np.searchsorted(splitters, key, side="right"), over)
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(key[keep]))], names=["key"])

    found = rows.mapInArrow(run, "key long").distinct().toPandas()
    return found["key"].to_numpy(np.int64)


def counted(rows: DataFrame, unit) -> list[tuple[int, int, int]]:
    """(unit, bytes, rows) of all records."""

    def run(batches):
        for batch in batches:
            u = unit(batch.column(3).to_numpy(), batch.column(4).to_numpy())
            names, at = np.unique(u, return_inverse=True)
            size = np.bincount(at, weights=batch.column(1).to_numpy().astype(float)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(size), pa.array(np.bincount(at))],
                                             names=["unit", "bytes", "n"])

    got = rows.mapInArrow(run, "unit long, bytes long, n long").groupBy("unit").agg(F.sum("bytes"), F.sum("n"))
    return [tuple(r) for r in got.collect()]
