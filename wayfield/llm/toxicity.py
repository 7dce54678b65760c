"""Toxicity by a noisy channel: undo leetspeak, spacing and repetition, then score what was meant.

Channel. A word is read as a lattice: every character offers the letters it may stand for, its
deletion if it is punctuation, and runs of one letter offer one or two of it. A run of single
characters with white space between them is one word of the lattice whose gaps are either kept
or deleted. Viterbi decoding under a character language model picks the restored text.

Score. A logistic regression over the presence of restored words. Its words, its weights and the
language model are fitted on all labelled rows that are not held out: words and n-grams are counted
by Spark, and every Newton step of the regression is a sum over the rows, partition by partition.

Scoring skips lattices from which no path can spell a word of the model: both sides are mapped to
a skeleton (one letter per class of confusables, runs collapsed), and a word whose skeletons are
not among the model's cannot change the score. ``restore`` decodes every lattice.
"""

from __future__ import annotations

import heapq
import math
import re
from dataclasses import dataclass, field
from itertools import product
from os.path import commonprefix

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import append_columns, held, prefixed, remainder, trimmed, written

# What a character may stand for besides itself.
CONFUSABLE = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b",
    "9": "g", "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c", "<": "c", "{": "c",
    "[": "c", "€": "e", "£": "l", "¥": "y", "¢": "c", "§": "s", "*": "aeiou", "#": "h", "%": "x",
    "^": "a", "&": "a", "à": "a", "á": "a", "â": "a", "ä": "a", "å": "a", "è": "e", "é": "e",
    "ê": "e", "ë": "e", "ì": "i", "í": "i", "î": "i", "ï": "i", "ò": "o", "ó": "o", "ô": "o",
    "ö": "o", "ø": "o", "ù": "u", "ú": "u", "û": "u", "ü": "u", "ñ": "n", "ç": "c", "ÿ": "y",
    "а": "a", "е": "e", "і": "i", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "ѕ": "s",
    "ɪ": "i", "ı": "i", "ο": "o", "α": "a", "ε": "e", "ι": "i", "τ": "t", "ρ": "p", "ν": "v",
}
PUNCTUATION = set(".,;:!?'\"-_*~`|/\\()[]{}<>#$%&+=^@€£¥¢§·•…’‘“”«»–—​‌‍­")
SPACED = re.compile(r"(?<!\S)\S(?:\s+\S){2,}(?!\S)")
EDGES = "".join(PUNCTUATION)

# channel costs, in nats
COST_SUBSTITUTE, COST_ACCENT, COST_DELETE, COST_KEEP_MARK = 1.0, 2.5, 1.2, 1.6
COST_COLLAPSE, COST_GAP = 0.5, 0.7

# letters that share a confusable sign fall into one class, named by its first letter
_CLASS = {"l": "i"}


def _skeleton_maps():
    swap, drop = {}, {}
    for c, targets in CONFUSABLE.items():
        t = targets[0]
        swap[ord(c)] = _CLASS.get(t, t)
    for c in PUNCTUATION:
        drop[ord(c)] = None
    swap[ord("l")] = "i"
    swap[ord("b")] = swap[ord("g")] = swap[ord("6")] = "g"
    swap[ord("8")] = "g"
    swap.pop(ord("*"))
    return {**drop, **swap}


_MIXED = _skeleton_maps()
_RUNS = re.compile(r"(.)\1+", re.S)


_MARKS = re.compile("((" + "|".join(map(re.escape, sorted(
    c for c in CONFUSABLE if c in PUNCTUATION))) + r")\2*)")
MAX_MARK_RUNS = 6
_ANY = "\ue000"  # what a star may stand for: a vowel or nothing


def skeletons(word: str) -> set[str] | None:
    """Skeletons of all readings of a lower-case word: each run of a mark that may be a letter is
    read as one or dropped. None if there are too many runs to list them."""
    runs = _MARKS.split(word)
    letters, marks = runs[::3], runs[2::3]
    if len(marks) > MAX_MARK_RUNS:
        return None
    out = set()
    for kept in product((False, True), repeat=len(marks)):
        text = letters[0]
        for m, k, rest in zip(marks, kept, letters[1:]):
            text += (_ANY if m == "*" else m if k else "") + rest
        out.add(_RUNS.sub(r"\1", text.translate(_MIXED)))
    return out


def _reading(c: str) -> tuple[str, bool]:
    """The skeleton letter that a character may be read as, if any, and whether it may be dropped."""
    return _ANY if c == "*" else c.translate(_MIXED), c in PUNCTUATION


@dataclass
class LanguageModel:
    """Interpolated character 4-gram model; ``counts`` maps an n-gram to its count."""

    counts: dict[str, int]
    order: int = 4
    total: int = 0
    followers: dict[str, int] = field(default_factory=dict)
    sums: dict[str, int] = field(default_factory=dict)

    def __post_init__(self):
        for gram, n in self.counts.items():
            self.sums[gram[:-1]] = self.sums.get(gram[:-1], 0) + n
            self.followers[gram[:-1]] = self.followers.get(gram[:-1], 0) + 1
        self.memo = {}

    def logp(self, context: str, c: str) -> float:
        got = self.memo.get((context, c))
        if got is None:
            got = self.memo[context, c] = math.log(self._p(context, c))
        return got

    def _p(self, context: str, c: str) -> float:
        # Witten-Bell smoothing down to a uniform distribution over 64 characters
        lower = self._p(context[1:], c) if context else 1 / 64
        n, kinds = self.sums.get(context, 0), self.followers.get(context, 0)
        return (self.counts.get(context + c, 0) + kinds * lower) / (n + kinds) if n else lower


def grams(word: str, order: int = 4):
    """n-grams of a word between its boundary signs, of all orders up to ``order``."""
    s = "^" * (order - 1) + word + "$"
    for i in range(order - 1, len(s)):
        for n in range(order):
            yield s[i - n:i + 1]


def lattice(word: str, spaced: bool = False) -> list[list[tuple[str, float]]]:
    """One list of (output, cost) per position of a lower-case word."""
    slots, i = [], 0
    while i < len(word):
        c = word[i]
        j = i
        while j < len(word) and word[j] == c:
            j += 1
        run = j - i
        if c.isspace():
            slots.append([("", 0.0 if spaced else COST_GAP), (" ", COST_GAP)])
        else:
            reads = [(c, 0.0 if c.isalnum() and c not in CONFUSABLE else
                      COST_SUBSTITUTE if c.isdigit() else 0.3 if c.isalpha() else COST_KEEP_MARK)]
            reads += [(t, COST_ACCENT if c.isalpha() and ord(c) < 0x250 else COST_SUBSTITUTE)
                      for t in CONFUSABLE.get(c, "")]
            if c in PUNCTUATION:
                reads.append(("", COST_DELETE))
            if run == 1:
                slots.append(reads)
            else:
                slots.append([(t * k, cost + (COST_COLLAPSE if k < run else 0.0))
                              for t, cost in reads for k in ((1, 2) if t else (1,))]
                             + ([(c * run, 0.0)] if 2 < run <= 4 else []))
        i = j
    return slots


def viterbi(slots, lm: LanguageModel) -> str:
    """The path through the lattice with the least cost under channel and language model."""
    width = lm.order - 1
    best, done = {"^" * width: (0.0, "")}, []
    for k, slot in enumerate(slots):
        if k % 64 == 63:  # what all paths have in common is settled, so that texts stay short
            same = len(commonprefix([text for _, text in best.values()]))
            done.append(next(iter(best.values()))[1][:same])
            best = {ctx: (cost, text[same:]) for ctx, (cost, text) in best.items()}
        nxt = {}
        for context, (cost, text) in best.items():
            for out, extra in slot:
                c, ctx = cost + extra, context
                for ch in out:
                    if ch == " ":
                        c -= lm.logp(ctx, "$")
                        ctx = "^" * width
                    else:
                        c -= lm.logp(ctx, ch)
                        ctx = (ctx + ch)[-width:]
                old = nxt.get(ctx)
                if old is None or c < old[0] or (c == old[0] and text + out < old[1]):
                    nxt[ctx] = (c, text + out)
        if len(nxt) > 64:  # contexts that cost far more than the best never win
            keep = heapq.nsmallest(64, nxt.items(), key=lambda kv: (kv[1][0], kv[0]))
            nxt = dict(keep)
        best = nxt
    return "".join(done) + min(((cost - lm.logp(ctx, "$"), text) for ctx, (cost, text) in best.items()))[1]


def ambiguous(word: str) -> bool:
    """Whether the lattice of a lower-case word has more than one path worth a decoding."""
    return not word.isalpha() or bool(_RUNS.search(word)) or not word.isascii()


@dataclass
class Model:
    lm: LanguageModel
    weights: dict[str, float]
    bias: float

    def __post_init__(self):
        self.by_skeleton = {}
        for w in self.weights:
            self.by_skeleton.setdefault(next(iter(skeletons(w))), []).append(w)
        self.longer = {}
        for s in self.by_skeleton:
            for i in range(len(s)):
                self.longer.setdefault(s[:i], set()).add(s[:i + 1])
        self.decoded, self.known = {}, {}

    def decode(self, word: str, spaced: bool = False) -> str:
        got = self.decoded.get((word, spaced))
        if got is None:
            got = viterbi(lattice(word, spaced), self.lm)
            if len(word) <= 256:
                if len(self.decoded) > 200_000:
                    self.decoded.clear()
                self.decoded[word, spaced] = got
        return got

    def restored(self, word: str) -> str:
        """One lower-case word as it was meant, without marks at its ends."""
        plain = word.strip(EDGES)
        if not ambiguous(plain) and plain:
            return plain
        # the ends may hide letters ("$tupid"); a reading that spells a model word wins
        whole = self.decode(word)
        return whole if whole in self.weights or not plain else self.decode(plain)

    def _hit(self, word: str):
        plain = word.strip(EDGES)
        if plain in self.weights:
            return plain
        if word.isalpha() and word.isascii() and not _RUNS.search(word):
            return None
        shapes = skeletons(word) if len(word) <= 64 else None
        if self._spells(word) if shapes is None else any(map(self._known, shapes)):
            got = self.restored(word)
            return got if got in self.weights else None
        return None

    def _known(self, shape: str) -> bool:
        if _ANY not in shape:
            return shape in self.by_skeleton
        pattern = re.compile(re.escape(shape).replace(_ANY, ".?"))
        return any(map(pattern.fullmatch, self.by_skeleton))

    def _spells(self, text: str) -> bool:
        """Whether some reading of the text spells a model word's skeleton from one piece of white
        space to another, the white space between them dropped: what ``skeletons`` lists, read
        letter by letter for texts of any length and with any number of marks."""
        at, last, spaced = {""}, "", any(map(str.isspace, text))
        for c in text:
            if c.isspace():
                if any(s in self.by_skeleton for s in at):
                    return True
                at.add("")
            elif c != last:
                letter, dropped = _reading(c)
                nxt = set(at) if dropped or not letter else set()
                for s in at:
                    if letter == _ANY:
                        nxt |= self.longer.get(s, set())
                    elif letter:
                        nxt |= {s} if s.endswith(letter) else {s + letter} & self.longer.get(s, set())
                at = nxt
                if not at and not spaced:
                    return False
            last = c
        return any(s in self.by_skeleton for s in at)

    def hits(self, text: str) -> set[str]:
        """Model words in the restored text."""
        low = text.lower()
        known, found = self.known, set()
        for w in set(low.split()):
            if w in known:
                h = known[w]
            else:
                if len(known) > 400_000:
                    known.clear()
                h = known[w] = self._hit(w)
            if h is not None:
                found.add(h)
        if self.weights:
            for m in SPACED.finditer(low):
                run = m.group()
                if self._spells(run):
                    for piece in _pieces(run):
                        found.update(x for x in self.decode(piece, True).split() if x in self.weights)
        return found

    def score(self, text) -> tuple[float, set[str]]:
        found = self.hits(text) if text else set()
        z = self.bias + sum(self.weights[w] for w in sorted(found))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z)))), found


def _pieces(run: str, size: int = 96, step: int = 48):
    """Overlapping windows of a long run of single characters, so that decoding stays short."""
    chars = run.split()
    if len(chars) <= size:
        return [" ".join(chars)]
    return [" ".join(chars[i:i + size]) for i in range(0, len(chars) - step, step)]


# -- fitting -----------------------------------------------------------------------------------
def labelled_rows(docs: DataFrame, labels: DataFrame, label: str, id_col: str, text_col: str) -> DataFrame:
    """(__text, __y) of all labelled rows that are not held out; of several labels of an id the larger."""
    usable = (labels.select(F.col(id_col).alias("__id"), F.col(label).cast("int").alias("__y"))
              .filter(F.col("__y").isin(0, 1) & (remainder("__id", 5) != 0))
              .groupBy("__id").agg(F.max("__y").alias("__y")))
    texts = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text")).filter(remainder("__id", 5) != 0)
    # labels grow with the documents: the same plan at every size, not a broadcast at small ones
    return texts.hint("merge").join(usable, "__id").select("__text", "__y")


STAT_WORDS = 200_000  # distinct words whose counts a task holds at a time
FIT_PARTS, FIT_ROWS = 16, 4096  # partitions of the rows of the regression, and rows of a dense block


def _stats(batches):
    """Documents with and without the label for each word, and n-gram counts, in parts that add up."""
    import pyarrow as pa

    def told():
        gram_counts: dict[str, int] = {}
        for w, by_label in words.items():
            for g in grams(w):
                gram_counts[g] = gram_counts.get(g, 0) + sum(by_label)
        kind = ["w"] * len(words) + ["g"] * len(gram_counts) + ["n"]
        key = list(words) + list(gram_counts) + [""]
        zero = [v[0] for v in words.values()] + list(gram_counts.values()) + [n[0]]
        one = [v[1] for v in words.values()] + [0] * len(gram_counts) + [n[1]]
        return pa.RecordBatch.from_arrays(
            [pa.array(kind, pa.string()), pa.array(key, pa.string()), pa.array(zero, pa.int64()),
             pa.array(one, pa.int64())], names=["kind", "key", "zero", "one"])

    words: dict[str, list[int]] = {}
    n = [0, 0]
    for batch in batches:
        for text, y in zip(batch.column(0), batch.column(1).to_pylist()):
            n[y] += 1
            for w in {x.strip(EDGES) for x in (text.as_py() or "").lower().split()}:
                if not 1 < len(w) <= 40 or not w.isalpha():
                    continue
                words.setdefault(w, [0, 0])[y] += 1
            if len(words) > STAT_WORDS:
                yield told()
                words, n = {}, [0, 0]
    yield told()


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", max_words: int = 300,
        max_grams: int = 300_000, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Language model, words and weights from all labelled rows that are not held out.

    Rows with NULL id or label are not used; rows without both labels give a model without
    words, whose score is the share of positive labels.
    """
    rows = written(labelled_rows(docs, labels, label, id_col, text_col), "toxicity-fit")
    counts = (rows.select("__text", "__y")
              .mapInArrow(trimmed(_stats), "kind string, key string, zero long, one long")
              .groupBy("kind", "key").agg(F.sum("zero").alias("zero"), F.sum("one").alias("one")))
    counts = written(counts, "toxicity-counts")
    sizes = counts.filter("kind = 'n'").agg(F.sum("zero"), F.sum("one")).first()
    n0, n1 = int(sizes[0] or 0), int(sizes[1] or 0)
    top = (counts.filter("kind = 'g'").orderBy(F.desc("zero"), "key").limit(max_grams)
           .select("key", "zero").toPandas())
    lm = LanguageModel(dict(zip(top.key, top.zero.astype(int))))
    if not n0 or not n1:
        p = (n1 + 0.5) / (n0 + n1 + 1)
        return Model(lm, {}, math.log(p / (1 - p)))
    # signed root of the G statistic ranks the words; both directions may carry weight
    rate = (F.col("one") / n1 - F.col("zero") / n0)
    spread = F.sqrt((F.col("one") + F.col("zero") + 1.0) / (n0 + n1)) * math.sqrt(1 / n0 + 1 / n1)
    chosen = (counts.filter("kind = 'w'").filter(F.col("one") + F.col("zero") >= 3)
              .withColumn("z", rate / spread).filter(F.col("z") > 3.0)
              .orderBy(F.desc("z"), "key").limit(max_words).select("key").toPandas().key)
    words = sorted(chosen)
    probe = Model(lm, {w: 1.0 for w in words}, 0.0)
    index = {w: i for i, w in enumerate(words)}

    def presence(text):
        return [[sorted(index[h] for h in probe.hits(t)) if t else [] for t in text.to_pylist()]]

    found = append_columns(rows, presence, ["__text"], T.StructType(
        [T.StructField("found", T.ArrayType(T.IntegerType()))]))
    # documents with the same words and label count together
    patterns = found.groupBy("found", "__y").agg(F.count(F.lit(1)).cast("double").alias("rows"))
    patterns = written(patterns.repartition(FIT_PARTS, "found", "__y").sortWithinPartitions("found", "__y"), "toxicity-patterns")
    w = logistic(patterns, len(words), n0, n1)
    return Model(lm, dict(zip(words, w[:-1].tolist())), float(w[-1]))


def _slopes(w: np.ndarray, by_label: tuple[float, float]):
    """Gradient and curvature of the loss at ``w``, summed over a partition: one row."""

    def run(batches):
        import pyarrow as pa
        g, h, first = np.zeros(len(w)), np.zeros((len(w), len(w))), None
        for batch in batches:
            found, labels, counts = (batch.column(i) for i in range(3))
            for at in range(0, len(batch), FIT_ROWS):
                some, y = found.slice(at, FIT_ROWS), labels.slice(at, FIT_ROWS).to_numpy()
                x = np.zeros((len(some), len(w)))
                x[:, -1] = 1.0
                lengths = some.value_lengths().to_numpy()
                x[np.repeat(np.arange(len(some)), lengths), some.flatten().to_numpy()] = 1.0
                weight = counts.slice(at, FIT_ROWS).to_numpy() * np.where(y > 0, by_label[1], by_label[0])
                p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
                g += x.T @ (weight * (p - y))
                h += (x * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x
                if first is None:  # tells the partitions apart: sums are added in a fixed order
                    first = f"{some[0].as_py()} {y[0]}"
        if first is not None:
            yield pa.RecordBatch.from_arrays([pa.array([first]), pa.array([g.tobytes()], pa.binary()),
                                              pa.array([h.tobytes()], pa.binary())], names=["first", "g", "h"])
    return run


def logistic(patterns: DataFrame, words: int, n0: int, n1: int, ridge: float = 0.001, steps: int = 60):
    """Ridge logistic regression by Newton's method, both labels of equal weight, over rows (found, label,
    count). What reaches the driver is one gradient and matrix per partition, of the model's size."""
    by_label = (0.5 / n0, 0.5 / n1)
    pen = np.full(words + 1, ridge / 50)
    pen[-1] = 1e-6
    w = np.zeros(words + 1)
    for _ in range(steps):
        parts = sorted(patterns.mapInArrow(_slopes(w, by_label), "first string, g binary, h binary").collect())
        g = sum((np.frombuffer(p["g"]) for p in parts), pen * w)
        h = sum((np.frombuffer(p["h"]).reshape(len(w), -1) for p in parts), np.diag(pen))
        step = np.linalg.solve(h, g)
        w = w - step
        if np.abs(step).max() < 1e-6:
            break
    return w


# -- applying ----------------------------------------------------------------------------------
SCORED = T.StructType([
    T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType()),
    T.StructField("toxic_words", T.ArrayType(T.StringType())),
])


def score(docs: DataFrame, model: Model, text_col: str = "text", prefix: str = "") -> DataFrame:
    """``docs`` with ``score``, ``predicted`` and the restored model words found in each text.

    NULL and empty texts get the score of a text without model words. ``prefix`` goes before the
    new names; columns that have these names already are replaced, all others are kept. Repeated
    rows are scored alike.
    """
    shared = docs.sparkSession.sparkContext.broadcast((model.lm.counts, model.weights, model.bias))

    def run(text):
        m = _loaded(shared)
        scores, words = [], []
        for t in text:
            s, found = m.score(t.as_py())
            scores.append(s)
            words.append(sorted(found))
        return scores, [int(s >= 0.5) for s in scores], words

    return append_columns(docs, run, [text_col], prefixed(SCORED, prefix), OWNER)


def restore(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with ``restored``: every lattice decoded, NULL for a NULL text."""
    shared = docs.sparkSession.sparkContext.broadcast((model.lm.counts, model.weights, model.bias))

    def whole(m, text):
        low = text.lower()
        out, at = [], 0
        for run in SPACED.finditer(low):
            out += [m.restored(w) for w in low[at:run.start()].split()]
            out.append(m.decode(" ".join(run.group().split()), True))
            at = run.end()
        return " ".join([w for w in out + [m.restored(w) for w in low[at:].split()] if w])

    def run(text):
        m = _loaded(shared)
        return [[None if t is None else whole(m, t) for t in text.to_pylist()]]

    return append_columns(docs, run, [text_col],
                          T.StructType([T.StructField("restored", T.StringType())]), OWNER)


OWNER = "toxicity"


def _loaded(shared) -> Model:
    """The model of a broadcast, built once per Python worker."""

    def build():
        counts, weights, bias = shared.value
        return Model(LanguageModel(counts), weights, bias)

    return held(OWNER, shared, build)
