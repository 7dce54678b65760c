"""Hard negatives by exact search in multiway hyperplane trees (GNAT).

Rows are indexed in shards. An inner node of a shard's tree has up to ``FANOUT`` split points far
from each other; every row goes to the subtree of its nearest one. Each split point stores the
range of its distances to the rows of every sibling subtree. Leaves are scanned exactly.

Inner products become distances by one more coordinate that puts all rows of a shard on a sphere
(and is zero for the query): larger scores are smaller distances, and a window of scores is an
annulus around the query. A subtree is left out if, by some split point's range, its rows lie
outside the annulus; the outer radius shrinks as better rows are found. Scores are integers and
compared exactly, distances only ever leave out with a margin for rounding.

Two searches follow each other: the best rows of the anchor's label (positives), and the best rows
of other labels in the window of scores below each positive. Queries travel in blocks, each group
of blocks meets each shard in a task of its own, and a shard answers with at most k rows a query.
"""

from __future__ import annotations

import pickle
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

SHARD_ROWS, SHARD_BYTES = 16_384, 16 << 20
BLOCK_ROWS, BLOCK_BYTES = 1_024, 4 << 20
BLOCKS = 8           # query blocks that meet a shard in one task
FANOUT, LEAF, DEPTH = 10, 96, 40
NONE = np.iinfo(np.int64).min
EXACT = float(1 << 53)

QUERY = "asker long, positive long, label string, vec array<bigint>, low long, high long"
BLOCK = "block long, askers binary, positives binary, labels array<string>, vectors binary, low binary, high binary"
FOUND = "asker long, positive long, score long, row long, id long"


def matrix(vectors: list) -> np.ndarray:
    """Integer rows, shorter ones padded with zeros."""
    out = np.zeros((len(vectors), max(map(len, vectors), default=0)), np.int64)
    for i, v in enumerate(vectors):
        out[i, :len(v)] = v
    return out


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of all rows of ``a`` and ``b``; beyond 64 bits they stay at its ends."""
    d = min(a.shape[1], b.shape[1])
    a, b = a[:, :d], b[:, :d]
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), np.int64)
    if float(np.abs(a.astype(float)).max()) * float(np.abs(b.astype(float)).max()) * d < EXACT:
        return (a.astype(float) @ b.astype(float).T).astype(np.int64)
    ends = np.iinfo(np.int64)
    return np.clip(a.astype(object) @ b.astype(object).T, ends.min + 1, ends.max).astype(np.int64)


class Tree:
    """Index of the rows of one shard; ``ids`` are in the order that decides ties."""

    def __init__(self, vectors: np.ndarray, seed: int = 1):
        real = vectors.astype(float)
        self.square = np.einsum("ij,ij->i", real, real)
        self.radius2 = float(self.square.max()) if len(real) else 0.0
        lift = np.sqrt(np.maximum(self.radius2 - self.square, 0))
        self._points = np.hstack([real, lift[:, None]])
        self._rng = np.random.default_rng(seed)
        self.root = self._node(np.arange(len(real)), 0)
        del self._points, self._rng

    def _distance(self, rows: np.ndarray, splits: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(2 * self.radius2 - 2 * (self._points[rows] @ self._points[splits].T), 0))

    def _node(self, rows: np.ndarray, depth: int):
        """A leaf (array of rows) or (split points, lowest, highest distances, subtrees); entry
        [i, j] of the ranges is between split point i and the rows of subtree j."""
        if len(rows) <= LEAF or depth == DEPTH:
            return rows
        tried = self._rng.choice(rows, min(len(rows), 4 * FANOUT), replace=False)
        between = self._distance(tried, tried)
        chosen = [0]
        while len(chosen) < min(FANOUT, len(tried)):
            gap = between[:, chosen].min(axis=1)
            if gap.max() <= 1e-6 * np.sqrt(self.radius2):
                break
            chosen.append(int(gap.argmax()))
        if len(chosen) == 1:
            return rows
        splits = tried[chosen]
        distance = self._distance(rows, splits)
        nearest = distance.argmin(axis=1)
        parts = [np.flatnonzero(nearest == j) for j in range(len(splits))]
        full = [j for j, part in enumerate(parts) if len(part)]
        if len(full) == 1:
            return rows
        low = np.stack([distance[parts[j]].min(axis=0) for j in full], axis=1)
        high = np.stack([distance[parts[j]].max(axis=0) for j in full], axis=1)
        return splits, low, high, [self._node(rows[parts[j]], depth + 1) for j in full]


class Search:
    """Best ``k`` rows per query with a score in its window and the label asked for."""

    def __init__(self, tree: Tree, vectors: np.ndarray, labels: np.ndarray, rows: np.ndarray,
                 asked: np.ndarray, asked_labels: np.ndarray, askers: np.ndarray, low: np.ndarray,
                 high: np.ndarray, k: int, same: bool):
        self.vectors, self.labels, self.rows = vectors, labels, rows
        self.asked, self.asked_labels, self.askers, self.k, self.same = asked, asked_labels, askers, k, same
        self.low, self.high = low, high
        real = asked.astype(float)
        square = np.einsum("ij,ij->i", real, real)
        self.sum = square + tree.radius2
        self.margin = 1e-6 * (np.sqrt(square) + np.sqrt(tree.radius2)) + 1e-9
        self.inner = np.sqrt(np.maximum(self.sum - 2 * high.astype(float), 0)) - self.margin
        self.score = np.full((len(asked), k), NONE, np.int64)
        self.at = np.full((len(asked), k), np.iinfo(np.int64).max, np.int64)
        self.scanned = 0
        self._visit(tree.root, np.arange(len(asked)))

    def _outer(self, q: np.ndarray) -> np.ndarray:
        """Rows farther from their query than this are in no result."""
        least = np.maximum(self.low[q], self.score[q, -1]).astype(float)
        return np.sqrt(np.maximum(self.sum[q] - 2 * least, 0)) + self.margin[q]

    def _visit(self, node, q: np.ndarray) -> None:
        if not len(q):
            return
        if isinstance(node, np.ndarray):
            if len(node):
                self._scan(node, q)
            return
        splits, low, high, subtrees = node
        distance = np.sqrt(np.maximum(self.sum[q][:, None] - 2 * products(self.asked[q], self.vectors[splits]).astype(float), 0))
        nearest = np.stack([np.maximum(distance - high[:, j], low[:, j] - distance).max(axis=1) for j in range(len(subtrees))], axis=1)
        farthest = np.stack([(distance + high[:, j]).min(axis=1) for j in range(len(subtrees))], axis=1)
        for j in np.argsort(nearest.mean(axis=0), kind="stable"):
            on = (nearest[:, j] <= self._outer(q)) & (farthest[:, j] >= self.inner[q])
            self._visit(subtrees[j], q[on])

    def _scan(self, leaf: np.ndarray, q: np.ndarray) -> None:
        self.scanned += len(leaf) * len(q)
        score = products(self.asked[q], self.vectors[leaf])
        alike = self.labels[leaf][None, :] == self.asked_labels[q][:, None]
        fits = (alike == self.same) & (score >= self.low[q][:, None]) & (score <= self.high[q][:, None])
        fits &= (score >= self.score[q, -1][:, None]) & (self.rows[leaf][None, :] != self.askers[q][:, None])
        who, what = np.nonzero(fits)
        if not len(who):
            return
        some = np.unique(q[who])
        asker = np.concatenate([q[who], np.repeat(some, self.k)])
        score = np.concatenate([score[who, what], self.score[some].ravel()])
        at = np.concatenate([leaf[what], self.at[some].ravel()])
        order = np.lexsort((at, ~score, asker))  # ~ turns the order round for every integer
        asker, score, at = asker[order], score[order], at[order]
        first = np.searchsorted(asker, some)
        take = first[:, None] + np.arange(self.k)
        self.score[some], self.at[some] = score[take], at[take]


def sharded(rows: DataFrame) -> DataFrame:
    """(shard, index) of all rows (row, id, label, vec): a tree with what its leaves need."""

    def build(held):
        row, ids, labels, vectors = (np.concatenate(x) if i < 2 else list(chain(*x)) for i, x in enumerate(zip(*held)))
        order = np.lexsort((row, ids))
        row, ids = row[order], ids[order]
        vectors = matrix([vectors[i] for i in order])
        names, code = np.unique(np.array([labels[i] for i in order], object), return_inverse=True)
        size = np.abs(vectors.astype(float)).max() if vectors.size else 0
        kind = np.int16 if size < 1 << 15 else np.int32 if size < 1 << 31 else np.int64
        return pickle.dumps((Tree(vectors), vectors.astype(kind), names.tolist(), code.astype(np.int32), row, ids), 5)

    def run(batches):
        from pyspark import TaskContext
        number, held, n, size = TaskContext.get().partitionId() << 32, [], 0, 0
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                vectors = part.column("vec").to_pylist()
                # NULL ids come last among equal scores
                ids = part.column("id").fill_null(np.iinfo(np.int64).max).to_numpy()
                held.append((part.column("row").to_numpy(), ids, part.column("label").to_pylist(), vectors))
                n += len(vectors)
                size += 8 * sum(map(len, vectors))
                if n >= SHARD_ROWS or size >= SHARD_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array([number]), pa.array([build(held)], pa.binary())], names=["shard", "index"])
                    number, held, n, size = number + 1, [], 0, 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([number]), pa.array([build(held)], pa.binary())], names=["shard", "index"])

    return rows.mapInArrow(run, "shard long, index binary")


def blocked(queries: DataFrame) -> DataFrame:
    """Queries (see ``QUERY``) in blocks of bounded rows and bytes (see ``BLOCK``)."""

    def pack(number, held):
        columns = list(zip(*held))
        asker, positive, low, high = (np.array(columns[i], np.int64).tobytes() for i in (0, 1, 4, 5))
        vectors = matrix(list(columns[3]))
        data = [[number], [asker], [positive], [list(columns[2])], [vectors.tobytes()], [low], [high]]
        types = [pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.string()), pa.binary(), pa.binary(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(data, types)],
                                          names=[f.split()[0] for f in BLOCK.split(", ")])

    def run(batches):
        from pyspark import TaskContext
        number, held, width = TaskContext.get().partitionId() << 32, [], 0
        for batch in batches:
            for query in zip(*[c.to_pylist() for c in batch.columns]):
                held.append(query)
                width = max(width, len(query[3]))
                if len(held) >= BLOCK_ROWS or len(held) * width * 8 >= BLOCK_BYTES:
                    yield pack(number, held)
                    number, held, width = number + 1, [], 0
        if held:
            yield pack(number, held)

    return queries.mapInArrow(run, BLOCK)


def best(shards: DataFrame, queries: DataFrame, k: int, same: bool) -> DataFrame:
    """(asker, positive, score, row, id, rank): the k best rows of every query, by score, then id
    (NULL last), then row."""
    blocks = written(blocked(queries), "negatives-blocks")
    n_blocks = blocks.count()
    if not n_blocks:
        return queries.sparkSession.createDataFrame([], FOUND + ", rank int")
    lots = -(-n_blocks // BLOCKS)
    numbers = written(shards.select("shard").withColumn("lot", F.explode(F.sequence(F.lit(0), F.lit(lots - 1)))), "negatives-meetings")
    lot = F.pmod(F.xxhash64("block"), F.lit(lots)).cast("int")
    left = shards.join(numbers, "shard") if lots > 1 else shards.withColumn("lot", F.lit(0))
    # every lot of blocks goes to every shard: an equi-join on the lot with the shards' numbers
    right = blocks.withColumn("lot", lot).join(numbers, "lot")

    def run(shard: pa.Table, lot: pa.Table) -> pa.Table:
        out = [pa.table([pa.array([], pa.int64())] * 5, names=["asker", "positive", "score", "row", "id"])]
        if shard.num_rows and lot.num_rows:
            tree, vectors, names, code, row, ids = pickle.loads(shard["index"][0].as_py())
            codes = {name: i for i, name in enumerate(names)}
            for block in lot.to_pylist():
                asker, positive, low, high = (np.frombuffer(block[c], np.int64) for c in ("askers", "positives", "low", "high"))
                label = np.array([codes.get(x, -1) for x in block["labels"]])
                asked = np.frombuffer(block["vectors"], np.int64).reshape(len(asker), -1)
                found = Search(tree, vectors, code, row, asked, label, asker, low, high, k, same)
                q, j = np.nonzero(found.score > NONE)
                at = found.at[q, j]
                null = ids[at] == np.iinfo(np.int64).max
                out.append(pa.table([pa.array(asker[q]), pa.array(positive[q]), pa.array(found.score[q, j]), pa.array(row[at]),
                                     pa.array(ids[at], mask=null)], names=out[0].column_names))
        return pa.concat_tables(out)

    found = left.groupBy("shard", "lot").cogroup(right.groupBy("shard", "lot")).applyInArrow(run, FOUND)
    order = Window.partitionBy("asker", "positive").orderBy(F.desc("score"), F.asc_nulls_last("id"), "row")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def mine(vectors: DataFrame, anchor: Column, low: int = 80, high: int = 100, positives: int = 5, negatives: int = 5,
         id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(anchor, positive, rank, negative, positive_score, negative_score).

    Vectors are arrays of integers, a row's score is its inner product with the anchor. Anchors are
    the rows for which ``anchor`` holds; their positives are the first ``positives`` other rows of
    their label, higher scores first, ties by smaller id, NULL ids last. Per anchor and positive
    come the first ``negatives`` rows of other labels with ``low * positive_score <=
    100 * score <= high * positive_score``, ranked from 1. Rows with a NULL label, vector or
    component take no part. Rows that repeat are rows of their own, also as anchors. Shorter vectors
    count as padded with zeros; scores beyond 64 bits stay at its ends. No anchor, no rows.
    """
    spark = vectors.sparkSession
    vec = F.col(vector_col).cast("array<bigint>")
    rows = written(vectors.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("id"),
                                  F.col(label_col).cast("string").alias("label"), vec.alias("vec"),
                                  F.coalesce(anchor, F.lit(False)).alias("asks"))
                   .filter(F.col("label").isNotNull() & F.col("vec").isNotNull() & F.forall("vec", lambda x: x.isNotNull())),
                   "negatives-rows")
    shards = written(sharded(rows.drop("asks")), "negatives-shards")
    ends = np.iinfo(np.int64)
    anchors = rows.filter("asks")
    wide = anchors.select(F.col("row").alias("asker"), F.lit(-1).cast("long").alias("positive"), "label", "vec",
                          F.lit(int(ends.min) + 1).alias("low"), F.lit(int(ends.max)).alias("high"))
    chosen = written(best(shards, wide, positives, True).select(
        "asker", F.col("row").alias("positive"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score")),
        "negatives-positives")
    # ceil and floor of the bounds in whole numbers
    bound = F.col("positive_score").cast("decimal(38,0)")
    lower = (-F.floor(-(bound * low) / F.lit(100).cast("decimal(3,0)"))).cast("long")
    upper = F.floor((bound * high) / F.lit(100).cast("decimal(3,0)")).cast("long")
    windows = (chosen.withColumns({"low": lower, "high": upper}).filter("low <= high")
               .join(anchors.select(F.col("row").alias("asker"), "label", "vec"), "asker")
               .select("asker", "positive", "label", "vec", "low", "high"))
    found = best(shards, windows, negatives, False).select("asker", "positive", "rank", F.col("id").alias("negative"),
                                                           F.col("score").alias("negative_score"))
    names = anchors.select(F.col("row").alias("asker"), F.col("id").alias("anchor"))
    return (found.join(chosen, ["asker", "positive"]).join(names, "asker")
            .select("anchor", F.col("positive_id").alias("positive"), "rank", "negative", "positive_score", "negative_score"))
