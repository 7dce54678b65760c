"""Spelling variants: words at edit distance one, found by search schemes over FM-indexes.

A word is cut into two halves. An edit of one code point leaves one of them as it is, so there are
two schemes: match the first half exactly and extend to the right, or match the second half exactly
and extend to the left, allowing one error (a replaced code point, or one more) on the way to the
delimiter. Both directions have their own FM-index: one over the words, one over the reversed words.
A scheme is anchored at its delimiter and never turns round, so its interval of suffix ranks is
kept in the index of its own direction alone. A word searches its equals and its longer neighbours;
what it finds among the longer ones counts for both.

Words meet in groups: the half that must match exactly names the group, so the vocabulary is split
over the cluster and each group indexes its own words. Halves that very many words share are split
into chunks of ``CHUNK`` words, and their queries go to every chunk. Groups return one row per word
(near words and the best of them), never pairs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

# letters of the contract, as a regular expression of Java
LETTERS = r"[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
GROUP = 60_000       # indexed words per group, on average
CHUNK = 50_000       # words of one half per index
QUERIES = 20_000     # searched at a time
SMALL = 48           # symbols of an interval up to this size are read one by one

RESULT = "word string, n_near long, least_n long, form string"


def occurrences(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", noise: int = 31) -> DataFrame:
    """(word, n): every run of letters of all texts, A-Z in lower case, with its count.

    Where ``noise`` divides h, the crc32 of ``<id>:<run>``, the run loses its code point
    h % length, which may leave the empty word. NULL texts have no runs; with a NULL id no run
    loses anything. Repeated rows count again.
    """
    run = F.explode(F.regexp_extract_all(F.col(text_col), F.lit(LETTERS), F.lit(0)))
    runs = (docs.select(F.col(id_col).cast("string").alias("id"), run.alias("run"))
            .select("id", F.translate("run", UPPER, LOWER).alias("run"))
            .withColumn("h", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))))
    at = "cast(h % length(run) as int)"
    cut = F.expr(f"concat(substring(run, 1, {at}), substring(run, {at} + 2))")
    word = F.when(F.col("h") % noise == 0, cut).otherwise(F.col("run"))
    return runs.groupBy(word.alias("word")).agg(F.count(F.lit(1)).alias("n"))


class SuffixRanks:
    """FM-index of the sequences ``flat[start:start + length]``, which are distinct and are read
    from their first symbol on; symbol 0 delimits.

    The indexed text holds them backwards, so that reading on is a backward step. ``keys`` has
    symbol * size + rank for the symbol before every suffix in rank order: a search in it gives
    the number of smaller symbols plus the occurrences before a rank.
    """

    def __init__(self, flat: np.ndarray, start: np.ndarray, length: np.ndarray):
        self.n = len(start)
        ends = np.cumsum(length + 1)
        self.size = int(ends[-1]) if self.n else 0
        text = np.zeros(self.size, np.int64)
        owner = np.repeat(np.arange(self.n), length)
        within = np.arange(len(owner)) - np.repeat(np.cumsum(length) - length, length)
        # 0, last symbol .. first symbol, 0, ...; after the last sequence the text starts again
        text[ends[owner] - 1 - within] = flat[start[owner] + within]
        order = self._sorted(text)
        before = text[order - 1]
        # a rank below n is a delimiter's suffix: the sequence that is read up to it ends there
        self.word = np.searchsorted(ends, order[:self.n], side="right")
        by_symbol = np.argsort(before, kind="stable")
        self.keys = before[by_symbol] * self.size + by_symbol
        self.symbols = np.unique(before)
        self.before = before

    def _sorted(self, text: np.ndarray) -> np.ndarray:
        """Rotations of ``text`` in order, by doubling the symbols compared."""
        if not self.size:
            return np.empty(0, np.int64)
        bits = max(1, int(text.max()).bit_length())
        width = max(1, 62 // bits)
        key = np.zeros(self.size, np.int64)
        for i in range(width):
            key = (key << bits) | np.roll(text, -i)
        while True:
            order = np.argsort(key, kind="stable")
            sorted_key = key[order]
            new = np.concatenate([[0], np.cumsum(sorted_key[1:] != sorted_key[:-1])])
            if new[-1] == self.size - 1 or width >= self.size:
                return order
            rank = np.empty(self.size, np.int64)
            rank[order] = new
            key = rank * self.size + np.roll(rank, -width)
            width *= 2

    def step(self, lo, hi, symbol):
        """Intervals of the sequences read so far followed by ``symbol``."""
        base = symbol * self.size
        return np.searchsorted(self.keys, base + lo), np.searchsorted(self.keys, base + hi)

    def branches(self, lo, hi):
        """(state, symbol, lo, hi) for every symbol other than the delimiter that can follow."""
        interval, of = np.unique(lo * (self.size + 1) + hi, return_inverse=True)
        a, b = interval // (self.size + 1), interval % (self.size + 1)
        few = b - a <= SMALL
        owner, at = spread(a[few], b[few])
        seen = np.unique(np.flatnonzero(few)[owner] * (int(self.symbols[-1]) + 1) + self.before[at])
        who, symbol = np.divmod(seen, int(self.symbols[-1]) + 1)
        many = np.flatnonzero(~few)
        who = np.concatenate([who, np.repeat(many, len(self.symbols))])
        symbol = np.concatenate([symbol, np.tile(self.symbols, len(many))])
        c, d = self.step(a[who], b[who], symbol)
        keep = (d > c) & (symbol > 0)
        who, symbol, c, d = who[keep], symbol[keep], c[keep], d[keep]
        by = np.argsort(who, kind="stable")
        first = np.searchsorted(who[by], np.arange(len(interval) + 1))
        state, at = spread(first[of], first[of + 1])
        pick = by[at]
        return state, symbol[pick], c[pick], d[pick]

    def near(self, flat: np.ndarray, start: np.ndarray, length: np.ndarray, exact: np.ndarray):
        """(query, sequence) pairs: the query without its first ``exact`` symbols becomes the
        sequence without these by one replaced or one additional symbol."""
        q = np.arange(len(start))
        lo, hi = np.zeros(len(q), np.int64), np.full(len(q), self.n, np.int64)
        for t in range(int(exact.max()) if len(q) else 0):
            on = exact[q] > t
            c, d = self.step(lo[on], hi[on], flat[start[q[on]] + t])
            lo[on], hi[on] = c, d
            alive = hi > lo
            q, lo, hi = q[alive], lo[alive], hi[alive]
        t = exact[q].astype(np.int64)
        wrong = tuple(np.empty(0, np.int64) for _ in range(4))
        found = []
        while len(q) or len(wrong[0]):
            # one error was made: the rest of the query, then the delimiter
            wq, wt, wlo, whi = wrong
            rest = wt < length[wq]
            symbol = np.where(rest, flat[np.minimum(start[wq] + wt, len(flat) - 1)], 0)
            c, d = self.step(wlo, whi, symbol)
            ended = ~rest & (d > c)
            found.append((wq[ended], self.word[c[ended]]))
            on = rest & (d > c)
            wrong = wq[on], wt[on] + 1, c[on], d[on]
            # no error yet
            state, symbol, c, d = self.branches(lo, hi)
            sq, st = q[state], t[state]
            rest = st < length[sq]
            right = rest & (symbol == flat[np.minimum(start[sq] + st, len(flat) - 1)])
            replaced = rest & ~right
            wrong = tuple(np.concatenate(x) for x in zip(
                wrong, (sq[replaced], st[replaced] + 1, c[replaced], d[replaced]),
                (sq[~right], st[~right], c[~right], d[~right])))
            q, t, lo, hi = sq[right], st[right] + 1, c[right], d[right]
        if not found:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        both = np.unique(np.concatenate([a for a, _ in found]) * max(1, self.n) + np.concatenate([b for _, b in found]))
        return np.divmod(both, max(1, self.n))


def spread(start: np.ndarray, end: np.ndarray):
    """All numbers of the ranges [start, end) with the range that each is of."""
    n = end - start
    owner = np.repeat(np.arange(len(n)), n)
    return owner, np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n) + start[owner]


def coded(words: pa.Array):
    """Code points of all words end to end, their starts and lengths."""
    texts = words.to_pylist()
    flat = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    length = np.array([len(t) for t in texts], np.int64)
    return flat, np.cumsum(length) - length, length


def backwards(flat, start, length):
    owner, at = spread(start, start + length)
    return flat[2 * start[owner] + length[owner] - 1 - at]


def meet(table: pa.Table) -> pa.RecordBatch:
    """Near words among the indexed words and the queries of one group, see ``RESULT``."""
    left = table["side"][0].as_py() == "first"
    query = table["query"].to_numpy()
    words, counts = table["word"].combine_chunks(), table["n"].to_numpy()
    # an indexed word may come by two halves, a query comes once
    names = words.filter(pa.array(~query)).dictionary_encode()
    indexed, at = np.unique(names.indices.to_numpy(), return_index=True)
    vocabulary, n_index = names.dictionary.take(pa.array(indexed)), counts[~query][at]
    asked, n_asked = words.filter(pa.array(query)), counts[query]
    out = []
    if len(vocabulary) and len(asked):
        flat, start, length = coded(vocabulary)
        symbols, flat = np.unique(flat, return_inverse=True)
        flat = flat + 1
        index = SuffixRanks(flat if left else backwards(flat, start, length), start, length)
        for a in range(0, len(asked), QUERIES):
            out.append(_searched(index, asked[a:a + QUERIES], n_asked[a:a + QUERIES], vocabulary, n_index,
                                 (flat, start, length), symbols, left))
    if not out:
        return pa.RecordBatch.from_arrays([pa.array([], t) for t in (pa.string(), pa.int64(), pa.int64(), pa.string())],
                                          names=["word", "n_near", "least_n", "form"])
    word, other, n = (pa.concat_arrays([o[i] for o in out]) for i in range(3))
    return _best(word, other, n.to_numpy())


def _searched(index, asked, n_asked, vocabulary, n_index, held, symbols, left):
    """(word, near word, count of the near word) of one lot of queries."""
    q_flat, q_start, q_length = coded(asked)
    at = np.minimum(np.searchsorted(symbols, q_flat), len(symbols) - 1)
    own = np.where(symbols[at] == q_flat, at + 1, len(symbols) + 1)  # a symbol that no indexed word has
    half = q_length // 2
    query, found = index.near(own if left else backwards(own, q_start, q_length), q_start, q_length,
                              half if left else q_length - half)
    flat, start, length = held
    if not left:  # where the first halves agree, the other scheme has the pair
        same = np.ones(len(query), bool)
        for t in range(int(half.max()) if len(query) else 0):
            on = np.flatnonzero(same & (half[query] > t))
            same[on] = own[q_start[query[on]] + t] == flat[start[found[on]] + t]
        query, found = query[~same], found[~same]
    longer = length[found] > q_length[query]
    word = pa.concat_arrays([asked.take(pa.array(query)), vocabulary.take(pa.array(found[longer]))])
    other = pa.concat_arrays([vocabulary.take(pa.array(found)), asked.take(pa.array(query[longer]))])
    return word, other, pa.array(np.concatenate([n_index[found], n_asked[query[longer]]]))


def _best(word: pa.Array, other: pa.Array, n: np.ndarray) -> pa.RecordBatch:
    """Per word: how many others, and the one of largest count, the smallest of equals."""
    key, rank = (pc.rank(x, tiebreaker="dense").to_numpy() for x in (word, other))
    order = np.lexsort((rank, -n, key))
    cut = np.flatnonzero(np.concatenate([[True], np.diff(key[order]) != 0])) if len(order) else order
    first = order[cut]
    return pa.RecordBatch.from_arrays(
        [word.take(pa.array(first)), pa.array(np.diff(np.append(cut, len(order))).astype(np.int64)),
         pa.array(-n[first].astype(np.int64)), other.take(pa.array(first))], names=["word", "n_near", "least_n", "form"])


def _halves(side: str, length: Column) -> Column:
    """Length of the half of a word of this length that the scheme matches exactly."""
    short = F.floor(length / 2).cast("int")
    return short if side == "first" else (length - short).cast("int")


def routed(words: DataFrame) -> DataFrame:
    """(side, half, query, word, n): words as queries, and as indexed words under the halves that
    queries of their own length and of one less have."""
    parts = []
    length = F.length("word")
    for side in ("first", "second"):
        def named(size):
            return F.left("word", size) if side == "first" else F.right("word", size)
        own, shorter = _halves(side, length), _halves(side, length - 1)
        keys = F.when(own == shorter, F.array(named(own))).otherwise(F.array(named(own), named(shorter)))
        parts += [words.select(F.lit(side).alias("side"), named(own).alias("half"), F.lit(True).alias("query"), "word", "n"),
                  words.select(F.lit(side).alias("side"), F.explode(keys).alias("half"), F.lit(False).alias("query"),
                               "word", "n")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


def near_words(words: DataFrame, group: int = GROUP, chunk: int = CHUNK) -> DataFrame:
    """(word, n_near, best_n, best): every word that has near words among ``words`` (word, n),
    which are distinct and of two code points or more; the best is the near word of largest n,
    ties by code points."""
    rows = routed(words)
    indexed = rows.filter("not query")
    groups = max(1, -(-indexed.count() // (2 * group)))
    hot = written(indexed.groupBy("side", "half").count().filter(F.col("count") > chunk)
                  .select("side", "half", F.ceil(F.col("count") / chunk).cast("int").alias("chunks")), "spelling-hot")
    if hot.isEmpty():
        dealt = rows.withColumn("part", F.lit(0))
    else:
        near = F.broadcast(hot) if hot.count() <= 50_000 else hot
        every = F.sequence(F.lit(0), F.col("chunks") - 1)
        one = F.array(F.pmod(F.xxhash64("word"), F.col("chunks")).cast("int"))
        dealt = (rows.join(near, ["side", "half"], "left")
                 .withColumn("part", F.explode(F.when(F.col("chunks").isNull(), F.array(F.lit(0)))
                                               .otherwise(F.when(F.col("query"), every).otherwise(one)))))
    # a chunk of a hot half is a group of its own, the other halves share groups
    is_hot = F.lit(False) if "chunks" not in dealt.columns else F.col("chunks").isNotNull()
    dealt = dealt.select("side", F.when(is_hot, F.col("half")).alias("own"), "part",
                         F.when(is_hot, F.lit(-1)).otherwise(F.pmod(F.xxhash64("half"), F.lit(groups))).alias("bucket"),
                         "query", "word", "n")

    def run(table: pa.Table) -> pa.Table:
        return pa.Table.from_batches([meet(table)])

    found = dealt.groupBy("side", "own", "part", "bucket").applyInArrow(run, RESULT)
    return (found.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(F.struct("least_n", "form")).alias("best"))
            .select("word", "n_near", (-F.col("best.least_n")).alias("best_n"), F.col("best.form").alias("best")))


def variants(words: DataFrame, ratio: int = 10) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every row of ``words`` (word, n).

    The form is the best near word (see ``near_words``) if its n is at least ``ratio`` times the
    word's, else NULL; the root is where forms lead, the word itself without a form. Words are
    distinct; NULL words and words of one code point come out without near words.
    """
    if ratio < 2:
        raise ValueError("with a ratio below 2 forms could lead in a circle")
    words = words.select("word", F.col("n").cast("long").alias("n"))
    best = near_words(words.filter(F.length("word") >= 2))
    formed = F.col("best_n") >= ratio * F.col("n")
    named = written(words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(formed, F.col("best")).alias("form"), F.when(formed, F.col("best_n")).alias("form_n")), "spelling-forms")
    link = named.filter("form IS NOT NULL").select("word", F.col("form").alias("root"))
    while True:  # counts grow by the ratio at each form: a handful of doublings
        onward = link.select(F.col("word").alias("root"), F.col("root").alias("next"))
        new = written(link.join(onward, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "spelling-roots")
        link = new.select("word", "root")
        if new.filter("moved").isEmpty():
            break
    return (named.join(link, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))


def spelling_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = 7,
                    min_count: int = 2, ratio: int = 10, noise: int = 31) -> DataFrame:
    """``variants`` of the words of all texts with at least so many code points and occurrences.

    NULL and empty texts add no words, very long runs are words like others, repeated rows count
    again, an empty table gives no rows; columns other than the two named do not matter.
    """
    kept = (F.length("word") >= max(2, min_length)) & (F.col("n") >= min_count)
    return variants(written(occurrences(docs, id_col, text_col, noise).filter(kept), "spelling-words"), ratio)
