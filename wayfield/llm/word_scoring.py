"""Document scores by cross-entropy difference of two word models that grow with the corpus.

A model of the target texts and one of all texts share vocabulary, order and smoothing, and
background counts are scaled to the target's. Tokens are words: runs of letters,
marks and digits of the lower-cased text; every other sign, and every character of a script
written without spaces, is a word by itself. No word is left out of the vocabulary. The models are
bigrams interpolated with unigrams; each text begins and ends with a boundary.

Texts are cut once into written blocks. A block's distinct n-grams and their counts, which are the
partial sums, go sorted by a 64-bit hash to the hash range they belong to. There the sums over all
blocks are taken and go back to the blocks in the same order, where each text's losses are added
up. An n-gram comes once from each block however frequent it is, so that no key is hot.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import written

PRIOR = 24.0             # tokens' worth of belief in the lower order
BLOCK = 1 << 24          # bytes of text
ROW = 64                 # bytes a row counts besides its text
LEAST_RANGES = 256
RANGE_BYTES = 1 << 25    # text whose n-grams share one hash range
CHUNK = 1 << 18          # tokens looked up at a time
SPLIT = r"([\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}]|[^\p{L}\p{M}\p{N}\s])"
BOUNDARY = np.uint64(0x9E3779B97F4A7C15)
MIX = np.uint64(0xFF51AFD7ED558CCD)


SCORED = T.StructType([T.StructField("n_tokens", T.LongType()), T.StructField("loss_target", T.DoubleType()),
                       T.StructField("loss_background", T.DoubleType()), T.StructField("score", T.DoubleType())])


def packed(*arrays: np.ndarray) -> bytes:
    """Arrays of one length as compressed bytes, lowest byte of all numbers first."""
    planes = [np.ascontiguousarray(a.view(np.uint8).reshape(len(a), a.dtype.itemsize).T).tobytes() for a in arrays]
    return pa.compress(b"".join(planes), "zstd", asbytes=True)


def unpacked(data: bytes, n: int, *kinds) -> list[np.ndarray]:
    widths = [np.dtype(k).itemsize for k in kinds]
    raw = np.frombuffer(pa.decompress(data, n * sum(widths), "zstd", asbytes=True), np.uint8)
    out, at = [], 0
    for kind, width in zip(kinds, widths):
        out.append(np.ascontiguousarray(raw[at:at + n * width].reshape(width, n).T).view(kind).ravel())
        at += n * width
    return out


def cut(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(block, ids, size, texts): blocks of about ``BLOCK`` bytes of neighbouring rows."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = T.StructType([T.StructField("block", T.LongType()), T.StructField("ids", T.ArrayType(rows.schema["id"].dataType)),
                           T.StructField("size", T.LongType()), T.StructField("texts", T.BinaryType())])

    def block(number, held, size):
        ids = pa.concat_arrays([i for i, _ in held])
        texts = pa.concat_arrays([t for _, t in held])
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, pa.schema([("text", texts.type)]),
                               options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
            out.write_batch(pa.RecordBatch.from_arrays([texts], ["text"]))
        return pa.RecordBatch.from_arrays(
            [pa.array([number], pa.int64()), pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
             pa.array([size], pa.int64()), pa.array([sink.getvalue().to_pybytes()], pa.binary())],
            names=schema.names)

    def run(batches):
        number = TaskContext.get().partitionId() << 32
        held, size = [], 0
        for batch in batches:
            text = batch.column(1)
            ends = np.cumsum(pc.fill_null(pc.binary_length(text), 0).to_numpy(zero_copy_only=False).astype(np.int64) + ROW)
            begin = 0
            while begin < batch.num_rows:
                before = int(ends[begin - 1]) if begin else 0
                end = min(int(np.searchsorted(ends, before + BLOCK - size)) + 1, batch.num_rows)
                held.append((batch.column(0).slice(begin, end - begin), text.slice(begin, end - begin)))
                size += int(ends[end - 1]) - before
                begin = end
                if size >= BLOCK:
                    yield block(number, held, size)
                    number, held, size = number + 1, [], 0
        if held:
            yield block(number, held, size)

    return rows.mapInArrow(run, schema)


def read(texts: bytes):
    """Hash of every token, texts after one another with a boundary behind each that has words,
    and the number of tokens of each text."""
    with pa.ipc.open_stream(pa.py_buffer(texts)) as stream:
        text = stream.read_next_batch().column(0)
    n = len(text)
    # behind a last text that ends in white space, splitting looks at the byte that follows in memory
    words = pc.utf8_split_whitespace(pc.utf8_rtrim_whitespace(pc.replace_substring_regex(
        pc.utf8_lower(pc.fill_null(text, "")), pattern=SPLIT, replacement=r" \1 ")))
    row = pc.list_parent_indices(words).to_numpy().astype(np.int64)
    coded = words.flatten().dictionary_encode()
    code = coded.indices.to_numpy()
    names = coded.dictionary.to_pylist()
    hashes = np.frombuffer(b"".join(hashlib.blake2b(w.encode(), digest_size=8).digest() for w in names), np.uint64)
    if "" in names:
        real = code != names.index("")
        row, code = row[real], code[real]
    sizes = np.bincount(row, minlength=n)
    texts_with = sizes > 0
    out = np.full(len(row) + int(texts_with.sum()), BOUNDARY)
    if len(row):
        out[np.arange(len(row)) + (np.cumsum(texts_with) - texts_with)[row]] = hashes[code]
    return out, sizes + texts_with


def words_of(tokens: np.ndarray) -> np.ndarray:
    """Odd numbers for words."""
    return tokens | np.uint64(1)


def predecessors(tokens: np.ndarray) -> np.ndarray:
    """The word before each; a boundary is before the first word of each text."""
    return np.concatenate([np.array([BOUNDARY]), tokens[:-1]])[:len(tokens)]


def pairs_of(tokens: np.ndarray) -> np.ndarray:
    """Even numbers for words behind their predecessors."""
    two = predecessors(tokens)
    two ^= two >> np.uint64(29)
    two *= MIX
    two += tokens
    two ^= two >> np.uint64(32)
    two *= MIX
    two ^= two >> np.uint64(29)
    two &= ~np.uint64(1)
    return two


ORDERS = (words_of, pairs_of)


def distinct(tokens: np.ndarray, ranges: int):
    """Sorted distinct n-grams of a block and where each hash range begins among them."""
    parts = []
    for order in ORDERS:
        part = order(tokens)
        part.sort()
        parts.append(part[np.append(True, part[1:] != part[:-1])[:len(part)]])
    grams = np.concatenate(parts)
    grams.sort()
    bits = np.uint64(64 - (ranges.bit_length() - 1))
    return grams, np.searchsorted(grams, np.arange(ranges).astype(np.uint64) << bits).tolist() + [len(grams)]


def places(grams: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Where each n-gram is among the sorted ``grams``; looked up in order, which spares the cache."""
    order = np.argsort(own)
    out = np.empty(len(own), np.int64)
    out[order] = np.searchsorted(grams, own[order])
    return out


def counted(marked: DataFrame, ranges: int) -> DataFrame:
    """(range, block, n, grams): a block's n-grams of one hash range with their counts in the
    target and in all texts."""

    def counts(texts, marks):
        tokens, sizes = read(texts)
        grams, begin = distinct(tokens, ranges)
        good = np.zeros(len(sizes), bool)
        good[marks] = True
        good = np.repeat(good, sizes)
        target, every = np.zeros(len(grams), np.uint32), np.zeros(len(grams), np.uint32)
        for order in ORDERS:
            for a in range(0, len(tokens), CHUNK):  # the token before a chunk belongs to its first pair
                own = order(tokens[max(a - 1, 0):a + CHUNK])[min(a, 1):]
                at = places(grams, own)
                np.add.at(every, at, np.uint32(1))
                np.add.at(target, at[good[a:a + CHUNK]], np.uint32(1))
        return grams, begin, target, every

    def run(batches):
        for batch in batches:
            for b, texts, marks in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                grams, begin, target, every = counts(texts.as_py(), marks.as_py() or [])
                data = []
                for i in range(ranges):
                    s = slice(begin[i], begin[i + 1])
                    g = grams[s]
                    data.append(packed(np.diff(g, prepend=np.uint64(0)), target[s], every[s]))
                n = np.diff(begin)
                del grams, target, every
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(ranges)), pa.array(np.full(ranges, b)), pa.array(n),
                     pa.array(data, pa.binary())], names=["range", "block", "n", "grams"])
                del data
                pa.default_memory_pool().release_unused()

    return marked.select("block", "texts", "marks").mapInArrow(run, "range long, block long, n long, grams binary")


SUMS = "range long, block long, n long, words long, tokens long, target_tokens long, sums binary"


def summed(parts: DataFrame) -> DataFrame:
    """Per hash range and block: the sums over all blocks for the block's n-grams, in their order,
    and the range's number of words and of their tokens."""

    def run(table):
        blocks, n = table.column("block").to_pylist(), table.column("n").to_pylist()
        got = [unpacked(d.as_py(), k, np.uint64, np.uint32, np.uint32) for d, k in zip(table.column("grams"), n)]
        own = [np.cumsum(g[0], dtype=np.uint64) for g in got]
        grams, at = np.unique(np.concatenate(own), return_inverse=True)
        target, every = (np.bincount(at, np.concatenate([g[k] for g in got]), len(grams)).astype(np.int64) for k in (1, 2))
        word = (grams & np.uint64(1)).astype(bool)
        size = len(blocks)
        ends = np.cumsum(n)
        sums = [packed(target[at[e - k:e]], every[at[e - k:e]]) for e, k in zip(ends, n)]
        return pa.table({
            "range": table.column("range").to_pylist(), "block": blocks, "n": n,
            "words": pa.array(np.full(size, int(word.sum()))), "tokens": pa.array(np.full(size, int(every[word].sum()))),
            "target_tokens": pa.array(np.full(size, int(target[word].sum()))), "sums": pa.array(sums, pa.binary())})

    return parts.groupBy("range").applyInArrow(run, SUMS)


def losses(tokens, ranges: int, sums: pa.Table):
    """Loss (nats) of every token under the model of the target and under that of all texts."""
    sums = sums.sort_by("range")
    words, total, target_total = (int(pc.sum(sums.column(c)).as_py()) for c in ("words", "tokens", "target_tokens"))
    got = [unpacked(d.as_py(), k, np.int64, np.int64) for d, k in zip(sums.column("sums"), sums.column("n").to_pylist())]
    counts = [np.concatenate([g[k] for g in got]) for k in (0, 1)]
    del got
    grams, _ = distinct(tokens, ranges)
    factors = (1.0, target_total / total)
    out = [np.empty(len(tokens)) for _ in counts]
    for a in range(0, len(tokens), CHUNK):
        own = tokens[max(a - 1, 0):a + CHUNK]
        # the word before the first of a chunk is the last of the chunk before it, or a boundary
        word = places(grams, words_of(own if a else np.append(BOUNDARY, own)))
        at = word[1:], places(grams, pairs_of(own)[min(a, 1):]), word[:-1]
        for loss, count, factor in zip(out, counts, factors):
            c1, c2, ch = (count[p] * factor for p in at)
            p = (c1 + PRIOR / words) / (target_total + PRIOR)
            loss[a:a + CHUNK] = -np.log((c2 + PRIOR * p) / (ch + PRIOR))
    return out


def score(docs: DataFrame, target_ids: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: its id with ``n_tokens``, mean losses and ``score`` =
    loss_background - loss_target.

    The target is the documents whose id is in the one-column ``target_ids``; NULL ids are no
    target, repeated rows count each time. The end of a text counts as a token. A text without
    words has 0 tokens and NULL losses, and scores 0; without target rows all scores are 0.
    """
    blocks = written(cut(docs, id_col, text_col), "lm-blocks", rows_per_file=1)
    size = blocks.agg(F.sum("size")).first()[0] or 0
    ranges = LEAST_RANGES
    while ranges * RANGE_BYTES < size:
        ranges *= 2
    targets = target_ids.toDF("__id").filter("__id IS NOT NULL").distinct().hint("merge")
    ids = blocks.select("block", F.posexplode("ids").alias("at", "id")).filter("id IS NOT NULL")
    # at most as many places as a block has rows
    marks = (ids.join(targets, F.col("id") == F.col("__id"), "left_semi").groupBy("block")
             .agg(F.collect_list("at").alias("marks")).withColumnRenamed("block", "__block").hint("merge"))
    marked = blocks.join(marks, F.col("block") == F.col("__block"), "left")
    sums = summed(counted(marked, ranges))
    id_type = blocks.schema["ids"].dataType.elementType
    schema = T.StructType([T.StructField(id_col, id_type), *SCORED.fields])

    def run(block, own):
        if not block.num_rows:
            return pa.table({f: [] for f in schema.names})
        ids = block.column("ids").combine_chunks().flatten()
        tokens, n = read(block.column("texts")[0].as_py())
        mean = np.zeros((2, len(n)))
        some = n > 0
        if len(tokens):
            first = (np.cumsum(n) - n)[some]
            for k, loss in enumerate(losses(tokens, ranges, own)):
                mean[k, some] = np.add.reduceat(loss, first) / n[some]
        return pa.table([ids, pa.array(n.astype(np.int64)), pa.array(mean[0], mask=~some), pa.array(mean[1], mask=~some),
                         pa.array(np.where(some, mean[1] - mean[0], 0.0))], names=schema.names)

    return (blocks.select("block", "ids", "texts").groupBy("block").cogroup(sums.groupBy("block"))
            .applyInArrow(run, schema))
