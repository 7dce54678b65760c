"""Exact Jaccard similarity join on word shingles, light sets by subsets, heavy sets by lists.

Two documents link when ``100 * |A & B| >= 80 * |A | B|``; for sizes a <= b that means an overlap
of at least ``need(a, b) = ceil(4 (a + b) / 9)``. Documents with equal sets are one class from
the start (``set_id``, a 64-bit sum over the shingle hashes mixed with the size); everything
below works on classes.

* Light sets (size up to a boundary) emit every subset of ``need`` shingles for every partner
  size. Sets that meet under a key for the sizes (a, b) overlap enough, so a star around one set
  of size a holds all their links: no pairs, no verification.
* Heavy sets are met by scanning inverted lists. Shingles are ordered by document frequency
  (frequent ones last) and a set enters the lists of its first ``n - ceil(0.8 n) + 1`` shingles;
  linked sets share one of those lists, and in the first one they share neither has spent more
  shingles than the pair may miss (``room``). Round one compares the members of a list with its
  leader, the set that spent least, and joins up what links. Round two compares the pairs of a
  list that round one left in different components. Light sets large enough to have heavy
  partners are listed too. Pairs are first held against parity signatures, whose distance never
  exceeds that of the sets, then verified on the texts.
* The boundary minimises estimated cost: subsets emitted below it, postings times the mean list
  length above it, both from counts of the whole input.

Frequency orders the lists but never decides a result, so it may be given for the (at most)
``MAX_FREQUENT`` most frequent shingles only, which bounds what is broadcast. Postings travel in
packed blocks by hash range; the list of a frequent shingle is split into chunks whose leaders
are compared as well.
"""

from __future__ import annotations

from itertools import combinations
from math import ceil, comb, log2

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import trimmed, trimmed_group, written
from .langid import text_bytes

SHINGLE = 5
FREQUENT = 48            # documents from which on a shingle counts as frequent
MAX_FREQUENT = 1_000_000
CHUNK = 20_000           # postings of one list that one task scans
BLOCK = 1_000_000        # hashes gathered before a block is emitted
MAX_BOUNDARY = 14

_rng = np.random.default_rng(20240229)
_BYTE = _rng.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
_BASE, _STEP = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1342543DE82EF95)


def need(a: int, b: int) -> int:
    """Shared shingles that sets of sizes a and b must have to link."""
    return -(-4 * (a + b) // 9)


def prefix(n):
    return n - -(-4 * n // 5) + 1


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


_POWERS = _powers(_BASE, 256)


def shingle_sets(column: pa.Array, chunk: int = 1 << 20):
    """For each text its index and its sorted distinct shingle hashes (uint64)."""
    data, starts, lengths = text_bytes(column)
    i = 0
    while i < len(lengths):
        j, size = i, 0
        while j < len(lengths) and (j == i or size + lengths[j] <= chunk):
            size += lengths[j]
            j += 1
        yield from _sets(data, starts[i:j], lengths[i:j], i)
        i = j


def word_hashes(data, starts, lengths):
    """Text number and 64-bit hash of every word, text after text; A-Z count as lower case."""
    total = int(lengths.sum())
    if total == 0:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    # texts of a batch lie one behind the other unless some are NULL with bytes behind them
    lo, hi = int(starts[0]), int(starts[-1] + lengths[-1])
    if hi - lo != total:
        buf = np.concatenate([data[s:s + n] for s, n in zip(starts, lengths)])
    else:
        buf = data[lo:hi]
    ends = np.cumsum(lengths)
    inside = ~_SPACE[buf]
    begin = inside.copy()
    begin[1:] &= ~inside[:-1]
    edges = (ends - lengths)[lengths > 0]
    begin[edges] = inside[edges]
    at = np.flatnonzero(inside)
    first_byte = np.flatnonzero(begin)
    if not len(first_byte):
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    word_of = np.searchsorted(at, first_byte)
    sizes = np.diff(np.append(word_of, len(at)))
    pos = np.arange(len(at)) - np.repeat(word_of, sizes)
    longest = int(sizes.max())
    powers = _POWERS if longest <= len(_POWERS) else _powers(_BASE, longest)
    words = _mix(np.add.reduceat(_BYTE[_FOLD[buf[at]]] * powers[pos], word_of))
    return np.searchsorted(ends, first_byte, side="right"), words


def _sets(data, starts, lengths, first):
    doc, words = word_hashes(data, starts, lengths)
    bounds = np.searchsorted(doc, np.arange(len(lengths) + 1))
    n = len(words)
    q = _powers(_STEP, SHINGLE)
    if n >= SHINGLE:
        rolled = words[:n - SHINGLE + 1].copy()
        for k in range(1, SHINGLE):
            rolled += words[k:n - SHINGLE + 1 + k] * q[k]
        rolled = _mix(rolled)
    for k in range(len(lengths)):
        a, b = int(bounds[k]), int(bounds[k + 1])
        if b - a >= SHINGLE:
            s = np.sort(rolled[a:b - SHINGLE + 1])
            yield first + k, s[np.concatenate([[True], s[1:] != s[:-1]])]
        elif b > a:
            one = (words[a:b] * q[:b - a]).sum(dtype=np.uint64, keepdims=True)
            yield first + k, _mix(one + np.uint64(b - a))
        else:
            yield first + k, np.empty(0, np.uint64)


def set_id(hashes: np.ndarray) -> int:
    """Signed 64-bit name of a set; equal sets have equal names."""
    total = _mix(hashes * _STEP + _BASE).sum(dtype=np.uint64, keepdims=True)
    return int(_mix(total + np.array([len(hashes)], np.uint64) * _STEP).view(np.int64)[0])


def parity(hashes: np.ndarray) -> bytes:
    """Parity of the hashes per bucket, in at least two bits per hash (a power of two, 64 or more).

    Two sets differ in at least as many hashes as their signatures differ in bits; a longer
    signature folds to a shorter one.
    """
    bits = 1 << max(6, int(2 * len(hashes) - 1).bit_length())
    odd = np.bincount((hashes & np.uint64(bits - 1)).astype(np.int64), minlength=bits).astype(np.uint8) & 1
    return np.packbits(odd, bitorder="little").tobytes()


def parity_distance(a: bytes, b: bytes) -> int:
    x, y = int.from_bytes(a, "little"), int.from_bytes(b, "little")
    n, m = 8 * len(a), 8 * len(b)
    while n > m:
        n //= 2
        x = (x >> n) ^ (x & ((1 << n) - 1))
    while m > n:
        m //= 2
        y = (y >> m) ^ (y & ((1 << m) - 1))
    return (x ^ y).bit_count()


def described(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc, set_id, n, sig) of every row; set_id and sig are NULL for the empty set."""
    source = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text"))

    def run(batches):
        for batch in batches:
            names, sizes, sigs = [], [], []
            for _, s in shingle_sets(batch.column(1)):
                names.append(set_id(s) if len(s) else None)
                sizes.append(len(s))
                sigs.append(parity(s) if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(names, pa.int64()), pa.array(sizes, pa.int64()), pa.array(sigs, pa.binary())],
                names=["doc", "set_id", "n", "sig"])

    return source.mapInArrow(trimmed(run), "doc long, set_id long, n long, sig binary")


def _blocks(keys: np.ndarray, payload: np.ndarray, bits: int):
    """Rows (bucket, block) of payload rows by the top bits of their sorted keys."""
    bucket = (keys >> np.uint64(64 - bits)).astype(np.int64)
    cut = np.flatnonzero(np.diff(bucket)) + 1
    lo = np.concatenate([[0], cut])
    hi = np.concatenate([cut, [len(keys)]])
    return bucket[lo], [payload[a:b].tobytes() for a, b in zip(lo, hi)]


def _low(keys: np.ndarray, bits: int) -> np.ndarray:
    """The 32 bits that follow the bucket bits."""
    return ((keys << np.uint64(bits)) >> np.uint64(32)).astype(np.uint32)


def frequent_shingles(docs: DataFrame, text_col: str, bits: int) -> tuple[np.ndarray, np.ndarray, float]:
    """Names and document frequencies of the most frequent shingles, and the mean list length
    that a posting of the others meets."""

    def emit(batches):
        held, size = [], 0
        for batch in batches:
            for _, s in shingle_sets(batch.column(0)):
                held.append(s)
                size += len(s)
                if size >= BLOCK:
                    yield flush(held)
                    held, size = [], 0
        if size:
            yield flush(held)

    def flush(held):
        keys = np.sort(np.concatenate(held))
        bucket, blocks = _blocks(keys, _low(keys, bits), bits)
        return pa.RecordBatch.from_arrays([pa.array(bucket, pa.int64()), pa.array(blocks, pa.binary())],
                                          names=["bucket", "block"])

    def count(key, table):
        low = np.sort(np.frombuffer(b"".join(table["block"].to_pylist()), np.uint32))
        cut = np.flatnonzero(np.concatenate([[True], low[1:] != low[:-1]]))
        n = np.diff(np.append(cut, len(low)))
        hot = n >= FREQUENT
        cold = n[~hot].astype(float)
        name = (np.uint64(key[0].as_py()) << np.uint64(32)) | low[cut[hot]].astype(np.uint64)
        return pa.table({"name": np.append(name.astype(np.int64), -1),
                         "df": np.append(n[hot], 0).astype(np.int64),
                         "s1": np.append(np.zeros(hot.sum()), cold.sum()),
                         "s2": np.append(np.zeros(hot.sum()), (cold * cold).sum())})

    counted = written(docs.select(text_col).mapInArrow(trimmed(emit), "bucket long, block binary")
                      .groupBy("bucket")
                      .applyInArrow(trimmed_group(count), "name long, df long, s1 double, s2 double"), "jaccard-df")
    sums = counted.filter("name = -1").agg(F.sum("s1"), F.sum("s2")).first()
    mean = (sums[1] or 0.0) / (sums[0] or 1.0)
    top = (counted.filter("name <> -1").orderBy(F.desc("df"), "name").limit(MAX_FREQUENT)
           .select("name", "df").toPandas())
    order = np.argsort(top.name.to_numpy(np.int64), kind="stable")
    return top.name.to_numpy(np.int64)[order], top.df.to_numpy(np.int64)[order], max(mean, 1.0)


def boundary(sizes: dict[int, int], mean_list: float) -> int:
    """Largest size treated as light, where the estimated cost is least."""

    def light(n, x):
        return sum(comb(n, need(n, m)) for m in range(ceil(0.8 * n), min(x, n * 5 // 4) + 1)
                   if need(n, m) <= min(n, m))

    def cost(x):
        low = sum(c * light(n, x) for n, c in sizes.items() if n <= x)
        return low + sum(c * prefix(n) * (1 + mean_list) for n, c in sizes.items()
                         if n > x and n <= MAX_BOUNDARY)

    return min(range(0, MAX_BOUNDARY + 1), key=lambda x: (cost(x), x))


def subset_keys(hashes: np.ndarray, x: int):
    """(key, partner-size pair's smaller size) of all subsets of a light set."""
    n = len(hashes)
    for m in range(ceil(0.8 * n), min(x, n * 5 // 4) + 1):
        c = need(n, m)
        if c > min(n, m):
            continue
        subsets = np.array(list(combinations(hashes.tolist(), c)), np.uint64)
        salt = np.uint64(min(n, m) * 64 + max(n, m))
        for key in _mix(_mix(subsets + salt).sum(axis=1, dtype=np.uint64) * _STEP + salt).view(np.int64):
            yield int(key), min(n, m)


def light_links(docs: DataFrame, text_col: str, x: int) -> DataFrame:
    """Links (a, b) among sets of at most x shingles: a star per subset key."""

    def run(batches):
        for batch in batches:
            keys, names, smaller = [], [], []
            for _, s in shingle_sets(batch.column(0)):
                if 4 <= len(s) <= x:
                    name = set_id(s)
                    for key, small in subset_keys(s, x):
                        keys.append(key)
                        names.append(name)
                        smaller.append(len(s) == small)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), pa.array(names, pa.int64()), pa.array(smaller, pa.bool_())],
                names=["key", "b", "smaller"])

    # a text of a light set may be long in bytes, but not in words that differ
    rows = docs.select(text_col).mapInArrow(trimmed(run), "key long, b long, smaller boolean")
    rows = written(rows.groupBy("key", "b").agg(F.max("smaller").alias("smaller")), "jaccard-subsets")
    centre = (rows.groupBy("key").agg(F.min(F.when(F.col("smaller"), F.col("b"))).alias("a"),
                                      F.count("*").alias("members"))
              .filter("members > 1 AND a IS NOT NULL").select("key", "a"))
    return rows.join(centre, "key").filter("a <> b").select("a", "b").distinct()


def scanned_lists(docs: DataFrame, text_col: str, x: int, bits: int, names: np.ndarray,
                  freq: np.ndarray) -> DataFrame:
    """Inverted lists with two or more sets: (list, members, sizes, spent), the member that spent
    the fewest shingles before this one first; a list of a frequent shingle comes in chunks."""
    shared = docs.sparkSession.sparkContext.broadcast((names, freq))
    item = np.dtype([("low", "<u4"), ("n", "<u4"), ("spent", "<u4"), ("set", "<i8")])

    def emit(batches):
        hot_names, hot_freq = shared.value
        held, size = [], 0
        for batch in batches:
            for _, s in shingle_sets(batch.column(0)):
                n = len(s)
                if n < 4 or n * 5 // 4 <= x:
                    continue
                p = prefix(n)
                chosen, df = first_shingles(s, p, hot_names, hot_freq, bits)
                held.append((chosen, df, n, set_id(s)))
                size += p
                if size >= BLOCK:
                    yield flush(held)
                    held, size = [], 0
        if size:
            yield flush(held)

    def flush(held):
        keys = np.concatenate([h[0] for h in held])
        df = np.concatenate([h[1] for h in held])
        reps = [len(h[0]) for h in held]
        body = np.empty(len(keys), item)
        body["low"] = _low(keys, bits)
        body["n"] = np.repeat(np.array([h[2] for h in held]), reps)
        body["spent"] = np.concatenate([np.arange(r) for r in reps])
        body["set"] = np.repeat(np.array([h[3] for h in held], np.int64), reps)
        bucket = (keys >> np.uint64(64 - bits)).astype(np.int64)
        # lists above CHUNK are dealt out to several buckets by the set
        parts = -(-df // CHUNK)
        salt = np.where(parts > 1, (body["set"].view(np.uint64) % np.maximum(parts, 1).astype(np.uint64)).astype(np.int64), 0)
        where = bucket + (salt << np.int64(32))
        order = np.lexsort((body["set"], body["low"], where))
        body, where = body[order], where[order]
        again = np.concatenate([[False], (where[1:] == where[:-1]) & (body["set"][1:] == body["set"][:-1])
                                & (body["low"][1:] == body["low"][:-1])])
        body, where = body[~again], where[~again]  # copies within the block
        cut = np.flatnonzero(np.diff(where)) + 1
        lo, hi = np.concatenate([[0], cut]), np.concatenate([cut, [len(where)]])
        return pa.RecordBatch.from_arrays(
            [pa.array(where[lo], pa.int64()), pa.array([body[a:b].tobytes() for a, b in zip(lo, hi)], pa.binary())],
            names=["bucket", "block"])

    def scan(key, block):
        body = np.frombuffer(b"".join(block.column("block").to_pylist()), item)
        body = body[np.lexsort((body["set"], body["low"]))]
        same = np.concatenate([[False], (body["low"][1:] == body["low"][:-1]) & (body["set"][1:] == body["set"][:-1])])
        body = body[~same]
        body = body[np.lexsort((body["set"], body["n"], body["spent"], body["low"]))]
        cut = np.flatnonzero(np.concatenate([[True], body["low"][1:] != body["low"][:-1]]))
        end = np.append(cut[1:], len(body))
        bucket = key[0].as_py() & 0xFFFFFFFF
        hot_names, hot_freq = shared.value
        ids = ((np.uint64(bucket) << np.uint64(32)) | body["low"][cut].astype(np.uint64)).astype(np.int64)
        keep = end - cut > 1
        if len(hot_names):  # a chunk of one still has other chunks beside it
            at = np.minimum(np.searchsorted(hot_names, ids), len(hot_names) - 1)
            keep |= (hot_names[at] == ids) & (hot_freq[at] > CHUNK)
        body = body[np.repeat(keep, end - cut)]
        offsets = pa.array(np.concatenate([[0], np.cumsum((end - cut)[keep])]), pa.int32())
        return pa.table({
            "list": pa.array(ids[keep]),
            "members": pa.ListArray.from_arrays(offsets, pa.array(np.ascontiguousarray(body["set"]))),
            "sizes": pa.ListArray.from_arrays(offsets, pa.array(body["n"].astype(np.int32))),
            "spent": pa.ListArray.from_arrays(offsets, pa.array(body["spent"].astype(np.int32)))})

    rows = docs.select(text_col).mapInArrow(trimmed(emit), "bucket long, block binary")
    return written(rows.groupBy("bucket").applyInArrow(
        trimmed_group(scan), "list long, members array<long>, sizes array<int>, spent array<int>"), "jaccard-lists")


def first_shingles(s: np.ndarray, p: int, hot_names: np.ndarray, hot_freq: np.ndarray, bits: int):
    """The first p shingles of a sorted set in the global order, and their frequencies (0: not
    among the frequent ones)."""
    df = np.zeros(len(s), np.int64)
    if len(hot_names):
        name = (((s >> np.uint64(64 - bits)) << np.uint64(32)) | _low(s, bits).astype(np.uint64)).astype(np.int64)
        at = np.minimum(np.searchsorted(hot_names, name), len(hot_names) - 1)
        df = np.where(hot_names[at] == name, hot_freq[at], 0)
    if not df.any():
        return s[:p], df[:p]
    order = np.lexsort((s, df))[:p]
    return s[order], df[order]


def room(n: str, spent: str, m: str, spent_m: str) -> str:
    """SQL: sets of n and m shingles may link although so many were spent before this list."""
    need = f"((4 * ({n} + {m}) + 8) div 9)"
    return f"({spent} <= {n} - {need} AND {spent_m} <= {m} - {need})"


def star_pairs(lists: DataFrame) -> DataFrame:
    """Candidate pairs of round one: each member with its chunk's leader, each chunk's leader with
    its list's."""
    inner = (lists.select(F.col("members")[0].alias("a"), F.col("sizes")[0].alias("n0"), F.col("spent")[0].alias("s0"),
                          F.explode(F.arrays_zip("members", "sizes", "spent")).alias("m"))
             .selectExpr("a", "n0", "s0", "m.members AS b", "m.sizes AS n", "m.spent AS s")
             .filter(f"a <> b AND {room('n0', 's0', 'n', 's')}").select("a", "b"))
    heads = lists.select("list", F.struct(F.col("spent")[0].alias("s"), F.col("sizes")[0].alias("n"),
                                          F.col("members")[0].alias("v")).alias("h"))
    first = heads.groupBy("list").agg(F.min("h").alias("f"), F.count("*").alias("c")).filter("c > 1")
    across = (heads.join(first, "list").filter(f"h.v <> f.v AND {room('h.n', 'h.s', 'f.n', 'f.s')}")
              .selectExpr("f.v AS a", "h.v AS b"))
    return (inner.unionByName(across).selectExpr("least(a, b) AS a", "greatest(a, b) AS b").distinct())


def cross_pairs(lists: DataFrame, component: DataFrame) -> DataFrame:
    """Pairs of a list whose sets are in different components and may link."""
    member = (lists.select("list", F.explode(F.arrays_zip("members", "sizes", "spent")).alias("m"))
              .selectExpr("list", "m.members AS v", "m.sizes AS n", "m.spent AS s"))
    member = (member.join(component.withColumnRenamed("v", "w"), F.col("v") == F.col("w"), "left")
              .selectExpr("list", "v", "n", "s", "coalesce(c, v) AS c"))
    open_lists = (member.groupBy("list").agg(F.min("c").alias("lo"), F.max("c").alias("hi"))
                  .filter("lo <> hi").select("list"))
    member = written(member.join(open_lists, "list", "left_semi"), "jaccard-open")
    other = member.selectExpr("list AS list2", "v AS v2", "n AS n2", "s AS s2", "c AS c2")
    return (member.join(other, (F.col("list") == F.col("list2")) & (F.col("c") != F.col("c2"))
                        & (F.col("v") < F.col("v2")) & F.expr(room("n", "s", "n2", "s2")))
            .selectExpr("v AS a", "v2 AS b").distinct())


def likely(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs (a, b) whose parity signatures do not rule a link out."""
    both = (pairs.join(classes.selectExpr("set_id AS a", "n AS n_a", "sig AS sig_a"), "a")
            .join(classes.selectExpr("set_id AS b", "n AS n_b", "sig AS sig_b"), "b"))

    def run(batches):
        for batch in batches:
            total = batch.column(2).to_numpy() + batch.column(3).to_numpy()
            far = np.array([parity_distance(x.as_py(), y.as_py()) for x, y in zip(batch.column(4), batch.column(5))],
                           np.int64)
            # linked sets of sizes n and m differ in at most (n + m) / 9 shingles
            keep = pa.array(np.flatnonzero(9 * far <= total))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(keep), batch.column(1).take(keep)], names=["a", "b"])

    return both.select("a", "b", "n_a", "n_b", "sig_a", "sig_b").mapInArrow(trimmed(run), "a long, b long")


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sets link, from the texts (set_id, text) of their classes."""
    left = pairs.join(texts.selectExpr("set_id AS a", "text AS text_a"), "a")
    both = left.join(texts.selectExpr("set_id AS b", "text AS text_b"), "b")

    def run(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                yield links(whole.slice(at, 500))

    def links(batch):
        a, b = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        sets = {}
        for names, column in ((a, batch.column(2)), (b, batch.column(3))):
            first = {}
            for i, name in enumerate(names):
                if name not in sets:
                    first.setdefault(name, i)
            picked = column.take(pa.array(list(first.values()), pa.int64()))
            sets.update((name, s) for name, (_, s) in zip(first, shingle_sets(picked)))
        keep = []
        for i in range(len(a)):
            x, y = sets[a[i]], sets[b[i]]
            union = len(np.unique(np.concatenate([x, y])))
            keep.append(100 * (len(x) + len(y) - union) >= 80 * union)
        at = pa.array(np.flatnonzero(keep))
        return pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at)], names=["a", "b"])

    return both.select("a", "b", "text_a", "text_b").mapInArrow(trimmed(run), "a long, b long")


def components(edges: DataFrame, name: str = "jaccard-cc") -> DataFrame:
    """(v, c): every vertex of the edges (a, b) and the smallest vertex of its component.

    Smallest neighbouring label, then the label of the label, until nothing changes; every step
    is a written table.
    """
    both = written(edges.select("a", "b").unionByName(edges.selectExpr("b AS a", "a AS b"))
                   .filter("a <> b").distinct(), f"{name}-edges")
    label = written(both.groupBy("a").agg(F.min("b").alias("m"))
                    .selectExpr("a AS v", "least(a, m) AS c"), name)
    while True:
        near = (both.join(label.selectExpr("v AS b", "c"), "b").groupBy("a").agg(F.min("c").alias("m")))
        low = (label.join(near.withColumnRenamed("a", "v"), "v")
               .selectExpr("v", "c AS old", "least(c, m) AS c"))
        low = written(low, name)
        jump = low.selectExpr("v AS c", "c AS c2")
        new = written(low.join(jump, "c", "left").selectExpr("v", "old", "least(c, coalesce(c2, c)) AS c"), name)
        if new.filter("c <> old").isEmpty():
            return new.select("v", "c")
        label = new.select("v", "c")


def similarity_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc, n, component) for every row: size of its shingle set and the smallest id among the
    rows reachable by links.

    Rows without words (NULL, empty or white text) have n = 0 and are linked with nothing: their
    component is their own id. Repeated rows and equal sets share a component. A row with a NULL
    id takes part; it cannot be the smallest id unless its class has no other.
    """
    spark = docs.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    bits = max(4, ceil(log2(4 * partitions)))
    rows = written(described(docs, id_col, text_col), "jaccard-docs")
    classes = written(rows.filter("n > 0").groupBy("set_id")
                      .agg(F.min("doc").alias("doc"), F.first("n").alias("n"), F.min("sig").alias("sig")),
                      "jaccard-classes")
    rows = rows.drop("sig")
    sizes = {r["n"]: r["count"] for r in
             classes.filter(F.col("n") <= MAX_BOUNDARY).groupBy("n").count().collect()}
    names, freq, mean = frequent_shingles(docs, text_col, bits)
    x = boundary(sizes, mean)
    lists = scanned_lists(docs, text_col, x, bits, names, freq)
    pairs = written(star_pairs(lists), "jaccard-stars")
    links = compared(docs, pairs, classes, text_col)
    if x >= 4:
        links = links.unionByName(light_links(docs, text_col, x))
    links = written(links, "jaccard-links")
    component = components(links)
    rest = cross_pairs(lists, component).join(pairs, ["a", "b"], "left_anti")
    more = written(compared(docs, rest, classes, text_col), "jaccard-links")
    if not more.isEmpty():
        component = components(links.unionByName(more))
    named = (classes.join(component, classes.set_id == component.v, "left")
             .selectExpr("set_id", "doc", "coalesce(c, set_id) AS c"))
    smallest = named.groupBy("c").agg(F.min("doc").alias("component"))
    named = written(named.join(smallest, "c").select("set_id", "component"), "jaccard-named")
    return (rows.join(named, "set_id", "left")
            .select("doc", "n", F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("doc")).alias("component")))


def compared(docs: DataFrame, pairs: DataFrame, classes: DataFrame, text_col: str) -> DataFrame:
    """The pairs that link, by signature and then by text."""
    pairs = written(likely(pairs, classes), "jaccard-likely")
    return verified(pairs, class_texts(docs, pairs, text_col))


def class_texts(docs: DataFrame, pairs: DataFrame, text_col: str) -> DataFrame:
    """(set_id, text) with one text for every class in a pair.

    Which classes these are is first looked up in a bitmap of 2^23 bits, whatever their number;
    the join after it is exact.
    """
    listed = pairs.select(F.explode(F.array("a", "b")).alias("set_id")).distinct()
    bit = F.pmod("set_id", F.lit(1 << 23))
    words = (listed.select(bit.alias("p")).groupBy(F.expr("p div 32768").alias("w"))
             .agg(F.bitmap_construct_agg(F.col("p") % 32768).alias("b")).collect())
    bitmap = np.zeros(1 << 20, np.uint8)
    for w, b in words:
        bitmap[w * 4096:w * 4096 + len(b)] = np.frombuffer(bytes(b), np.uint8)
    shared = docs.sparkSession.sparkContext.broadcast(bitmap)

    def run(batches):
        bits = shared.value
        for batch in batches:
            names, rows = [], []
            for i, s in shingle_sets(batch.column(0)):
                if len(s):
                    name = set_id(s)
                    p = name % (1 << 23)
                    if bits[p >> 3] >> (p & 7) & 1:
                        names.append(name)
                        rows.append(i)
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.int64()), batch.column(0).take(pa.array(rows, pa.int64()))],
                names=["set_id", "text"])

    found = (docs.select(text_col).mapInArrow(trimmed(run), "set_id long, text string")
             .groupBy("set_id").agg(F.min("text").alias("text")))
    return written(found.join(listed, "set_id", "left_semi"), "jaccard-texts")
