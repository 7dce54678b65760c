"""Packing token streams into fixed windows with the sources in target proportions.

Every source is a queue of its documents' tokens. Deficit round-robin serves quanta of
``QUANTUM`` tokens: each queue's deficit grows with its target proportion, and the queue whose
deficit first reaches half a quantum is served next and pays a quantum. Quantum k of a queue with
rate r is thus served at time (2k + 1) / r (ties by the order of the sources), and what all other
queues have been served by then can be counted: the position of every quantum in the packed
stream, with the deficits that earlier windows and partitions left, follows from the queue sizes
alone. So no window waits for another one, no document is shuffled, and every window carries each
source to within a quantum of its target. A queue that runs dry leaves its share to the others.

The stream is cut into windows of ``window`` tokens; the rest that does not fill a window is cut
into sequences whose lengths are powers of two, which need no padding.
"""

from __future__ import annotations

import string
import sys
import zlib
from collections.abc import Mapping
from itertools import accumulate, chain, pairwise
from typing import Optional

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import held, trimmed, written

WINDOW = 2048
QUANTUM = 64
END_OF_DOCUMENT = 1
MAX_BROADCAST_ROWS = 500_000
MARKS = string.punctuation.replace("'", "")  # an apostrophe may begin a piece of its own
MAX_WORDS = 700_000  # entries of the word cache of a Python worker


class Encoder:
    """Ids of whole texts, through a cache of words.

    The tokenizer drops white space and never joins characters across it, so the ids of a text
    are those of its words. Words of Latin-1 letters, and those with marks behind them, are
    looked up by their lower-case letters; all others go to the tokenizer as they are.
    """

    def __init__(self, path: str):
        import os
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.letters = self._letters()
        self.words: dict[str, bytes] = {}

    def raw(self, words: list[str]) -> list[bytes]:
        return self._packed([e.ids for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)])

    def direct(self, words: list[str]) -> list[bytes]:
        """Ids of words of ``self.letters``, which only the tokenizer's model has to see: without the steps
        before it and what it notes about each token, an id costs a third."""
        ids = self.tokenizer.model.tokenize
        return self._packed([[t.id for t in ids(w.translate(self.letters))] for w in words])

    def _packed(self, ids: list[list[int]]) -> list[bytes]:
        data = np.array(list(chain.from_iterable(ids)), self.dtype).tobytes()
        ends = list(accumulate([len(x) * self.dtype.itemsize for x in ids], initial=0))
        return [data[a:b] for a, b in pairwise(ends)]

    def _letters(self) -> dict[int, str]:
        """Lower-case Latin-1 letters that the tokenizer takes as they are, and what its model gets for them;
        none unless it takes a word of all of them as one piece."""
        rules, cut = self.tokenizer.normalizer, self.tokenizer.pre_tokenizer
        known = [c for c in map(chr, range(256)) if c.isalpha() and c == c.lower()]
        if rules is None or cut is None or rules.normalize_str("".join(known)) != "".join(known):
            return {}
        pieces = {c: "".join(p for p, _ in cut.pre_tokenize_str(c)) for c in known}
        whole = [p for p, _ in cut.pre_tokenize_str("".join(known))]
        return {ord(c): p for c, p in pieces.items()} if whole == ["".join(pieces.values())] else {}

    @staticmethod
    def split(word: str) -> tuple[str, ...]:
        """Parts whose ids make up the word's ids; each is a word as well."""
        low = word.lower()
        if low.isalpha():
            return (low,) if low.isascii() or max(low) < "Ā" else (word,)
        body = low.rstrip(MARKS)
        if body.isalpha() and (body.isascii() or max(body) < "Ā"):
            return body, low[len(body):]
        return (word,)

    def learn(self, words) -> None:
        """Keep the ids of words that are not known yet, and those of their parts."""
        known, split = self.words, [(w, self.split(w)) for w in words]
        parts = {p for _, s in split for p in s if p not in known}
        plain = [p for p in parts if self.letters and p.islower() and p.isalpha() and (p.isascii() or max(p) < "Ā")]
        other = list(parts.difference(plain))
        known.update(zip(plain, self.direct(plain)))
        known.update(zip(other, self.raw(other)))
        for w, s in split:
            if s[0] != w:
                known[w] = b"".join([known[p] for p in s])

    def encode(self, text: str) -> bytes:
        """Ids of a text as little-endian integers."""
        words = text.replace("\n", " ").split(" ")
        got = list(map(self.words.get, words))
        if None in got:
            new = {w for w, ids in zip(words, got) if ids is None}
            if len(self.words) + len(new) > MAX_WORDS:
                self.words, new = {}, set(words)
            self.learn(new)
            got = [self.words[w] for w in words]
        return b"".join(got)


OWNER = "packing"


def encoder(path: str) -> Encoder:
    return held(OWNER, sys.intern(path), lambda: Encoder(path))


def tokenized(docs: DataFrame, vocabulary: str, end: int = END_OF_DOCUMENT, id_col: str = "doc_id",
              text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(doc, source, part, before, n, ids): ids of each document with the end id, and how many
    tokens of its source come before it in its partition. NULL texts are empty."""
    source = docs.select(F.col(id_col).cast("long").alias("doc"),
                         F.col(source_col).cast("string").alias("source"), F.col(text_col).alias("text"))

    def run(batches):
        from pyspark import TaskContext
        enc = encoder(vocabulary)
        last = np.array([end], enc.dtype).tobytes()
        part, held = TaskContext.get().partitionId(), {}
        for batch in batches:
            before, n, ids = [], [], []
            names = batch.column(1).to_pylist()
            for s, text in zip(names, batch.column(2)):
                t = text.as_py()
                b = (enc.encode(t) if t else b"") + last
                k = len(b) // enc.dtype.itemsize
                before.append(held.get(s, 0))
                held[s] = held.get(s, 0) + k
                n.append(k)
                ids.append(b)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([part] * len(n), pa.int32()),
                 pa.array(before, pa.int64()), pa.array(n, pa.int64()), pa.array(ids, pa.binary())],
                names=["doc", "source", "part", "before", "n", "ids"])

    return source.mapInArrow(trimmed(run, OWNER), "doc long, source string, part int, before long, n long, ids binary")


class Schedule:
    """Positions in the packed stream of the quanta of every queue."""

    def __init__(self, totals: list[int], rates: Optional[list[int]] = None, quantum: int = QUANTUM,
                 window: int = WINDOW):
        self.totals, self.quantum, self.window = totals, quantum, window
        self.rates = totals if rates is None else [r if t else 0 for r, t in zip(rates, totals)]
        self.total = sum(totals)
        self.full = self.total // window
        rest, ends, at = self.total - self.full * window, [], self.full * window
        for bit in reversed(range(rest.bit_length())):
            if rest >> bit & 1:
                at += 1 << bit
                ends.append(at)
        self.tail = np.array(ends, np.int64)
        # products of positions and rates must fit, else Python's integers are used
        top = 2 * (max(totals, default=0) // quantum + 1) * max(self.rates, default=0)
        self.kind = np.int64 if top < 1 << 62 else object

    def start(self, queue: np.ndarray, k: np.ndarray) -> np.ndarray:
        """Stream position of quantum k of a queue."""
        at = np.zeros(len(k), np.int64)
        rates = np.array(self.rates, self.kind)
        mine = rates[queue]
        odd = 2 * k.astype(self.kind) + 1
        for other, (rate, total) in enumerate(zip(self.rates, self.totals)):
            if not total:
                continue
            x = odd * rate
            # quanta of the other queue with a smaller time, and with an equal one if it comes first
            before = np.where(other < queue, (x // mine + 1) // 2, -(-x // mine) // 2)
            served = np.minimum(before * self.quantum, total)
            at += np.where(queue == other, k * self.quantum, served.astype(np.int64)).astype(np.int64)
        return at

    def sequence(self, at: np.ndarray):
        """Sequence, its first position and the position behind it, for stream positions."""
        seq = at // self.window
        first, end = seq * self.window, (seq + 1) * self.window
        late = seq >= self.full
        if late.any():
            j = np.searchsorted(self.tail, at[late], side="right")
            bounds = np.concatenate([[self.full * self.window], self.tail])
            seq[late], first[late], end[late] = self.full + j, bounds[j], bounds[j + 1]
        return seq, first, end

    def pieces(self, queue: np.ndarray, begin: np.ndarray, n: np.ndarray):
        """Pieces of token ranges [begin, begin + n) of queues: (row, start in the range, length,
        sequence, offset), by row and start."""
        q = self.quantum
        first = begin // q
        count = (begin + n - 1) // q - first + 1
        row = np.repeat(np.arange(len(n)), count)
        k = first[row] + np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
        lo = np.maximum(k * q, begin[row])
        hi = np.minimum((k + 1) * q, (begin + n)[row])
        at = self.start(queue[row], k) + lo - k * q
        start, length = lo - begin[row], hi - lo
        out = []
        while len(row):
            seq, origin, end = self.sequence(at)
            fits = np.minimum(length, end - at)
            out.append((row, start, fits, seq, at - origin))
            more = fits < length
            row, start, length, at = row[more], (start + fits)[more], (length - fits)[more], (at + fits)[more]
        if not out:
            return (np.empty(0, np.int64),) * 5
        cols = [np.concatenate(c) for c in zip(*out)]
        order = np.lexsort((cols[1], cols[0]))
        return tuple(c[order] for c in cols)


PIECE = ("doc long, source string, start long, length long, ids_crc32 long, doc_tokens long, "
         "sequence_id long, offset long")


def pack(docs: DataFrame, vocabulary: str, proportions: Optional[Mapping[Optional[str], float]] = None,
         window: int = WINDOW, quantum: int = QUANTUM, end: int = END_OF_DOCUMENT, with_ids: bool = False,
         id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """Pieces of all documents: (doc, source, start, length, ids_crc32, doc_tokens, sequence_id,
    offset) and, with ``with_ids``, ``ids``.

    ``proportions`` are the target shares of the sources (default: their share of all tokens, at
    which all queues end together); a source that is not named gets the smallest share. Repeated
    rows are packed each; a NULL or empty text is its end id alone; NULL sources are one queue.
    """
    rows = written(tokenized(docs, vocabulary, end, id_col, text_col, source_col), "packing-ids")
    parts = rows.groupBy("part", "source").agg(F.sum("n").alias("m"))
    by_part = Window.partitionBy("source").orderBy("part")
    parts = written(parts.withColumn("offset", F.sum("m").over(by_part) - F.col("m")), "packing-offsets")
    queues = parts.groupBy("source").agg(F.sum("m").alias("m")).orderBy(F.col("source").asc_nulls_last()).collect()
    names, totals = [r["source"] for r in queues], [int(r["m"]) for r in queues]
    rates = None
    if proportions is not None:
        least = min([v for v in proportions.values() if v > 0], default=1.0)
        rates = [max(1, round(1_000_000 * (proportions.get(s) or least))) for s in names]
    plan = Schedule(totals, rates, quantum, window)
    index = {s: i for i, s in enumerate(names)}
    offsets = parts.selectExpr("part AS p", "source AS s", "offset")
    if parts.count() <= MAX_BROADCAST_ROWS:  # one row per partition and source
        offsets = F.broadcast(offsets)
    placed = (rows.join(offsets, (F.col("part") == F.col("p")) & F.col("source").eqNullSafe(F.col("s")))
              .select("doc", "source", (F.col("offset") + F.col("before")).alias("begin"), "n", "ids"))

    def run(batches):
        for batch in batches:
            sources = batch.column(1).to_pylist()
            n = batch.column(3).to_numpy()
            blobs = [b.as_buffer() for b in batch.column(4)]
            row, start, length, seq, offset = plan.pieces(
                np.array([index[s] for s in sources], np.int64), batch.column(2).to_numpy(), n)
            crc, ids, last, data = [], [], -1, None
            for r, a, m in zip(row.tolist(), start.tolist(), length.tolist()):
                if r != last:
                    width = len(blobs[r]) // int(n[r])
                    data = np.frombuffer(blobs[r], "<u2" if width == 2 else "<u4").astype("<u4")
                    last = r
                part = data[a:a + m]
                crc.append(zlib.crc32(part))
                if with_ids:
                    ids.append(part.astype(np.int32))
            at = pa.array(row)
            cols = [batch.column(0).take(at), batch.column(1).take(at), pa.array(start), pa.array(length),
                    pa.array(crc, pa.int64()), pa.array(n[row]), pa.array(seq), pa.array(offset)]
            fields = ["doc", "source", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
            if with_ids:
                cols.append(pa.array(ids, pa.list_(pa.int32())))
                fields.append("ids")
            yield pa.RecordBatch.from_arrays(cols, names=fields)

    return placed.mapInArrow(trimmed(run), PIECE + (", ids array<int>" if with_ids else ""))


def sequences(pieces: DataFrame) -> DataFrame:
    """(sequence_id, ids, docs) from pieces with ids; a sequence is at most a window long."""
    ordered = F.array_sort(F.collect_list(F.struct("offset", "doc", "ids")))
    return (pieces.groupBy("sequence_id").agg(ordered.alias("p"))
            .select("sequence_id", F.flatten(F.transform("p", lambda x: x["ids"])).alias("ids"),
                    F.transform("p", lambda x: x["doc"]).alias("docs")))
