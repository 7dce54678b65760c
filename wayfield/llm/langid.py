"""Language identification by a bidirectional gated recurrent network over bytes.

Two gated recurrent layers read windows of bytes, one forwards and one backwards; every position
gets a distribution over the languages, and the mean of these distributions over all positions of
a text is the text's distribution. The network is trained with backpropagation through time and
Adam in numpy, on windows of at most ``max_fit_rows`` rows, spread over each text. Prediction
reads every byte of every text: texts are cut into windows of ``WINDOW`` bytes that run through
the network side by side.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import append_columns, prefixed

UNKNOWN = "und"
WINDOW = 128
TRAIN_WINDOW = 64
HIDDEN = 8
LETTER = re.compile(r"[^\W\d_]")

# upper-case A-Z are read as lower-case, and NUL as 1: 0 stands for no byte
FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32
FOLD[0] = 1


@dataclass
class Layer:
    """Gated recurrent layer; ``inputs`` (3H x 256) holds the byte's share of reset gate, update
    gate and candidate, ``gates`` (2H x H) and ``state`` (H x H) the state's share."""

    inputs: np.ndarray
    gates: np.ndarray
    state: np.ndarray

    def run(self, x: np.ndarray, keep: bool = False):
        """States (time x H x batch) for bytes (time x batch); with ``keep`` also what training
        needs. Where there is no byte (0) the state is that of the start."""
        hid = self.state.shape[0]
        h = np.zeros((hid, x.shape[1]), np.float32)
        states = np.empty((x.shape[0], hid, x.shape[1]), np.float32)
        tape = []
        half = np.float32(0.5)
        real = (x != 0).astype(np.float32) if (x == 0).any() else None
        for t in range(x.shape[0]):
            e = self.inputs.take(x[t], axis=1)
            g = self.gates @ h
            g += e[:2 * hid]
            g *= half
            np.tanh(g, out=g)
            g *= half
            g += half
            r, z = g[:hid], g[hid:]
            rh = r * h
            n = self.state @ rh
            n += e[2 * hid:]
            np.tanh(n, out=n)
            if keep:
                tape.append((h, g, rh, n))
            d = n - h
            d *= z
            h = h + d
            if real is not None:
                h *= real[t]
            states[t] = h
        return (states, tape) if keep else states

    def back(self, x: np.ndarray, tape, d_states: np.ndarray):
        """Gradients of the three weights, through time."""
        hid = self.state.shape[0]
        d_inputs_t = np.empty((x.shape[0], 3 * hid, x.shape[1]), np.float32)
        d_gates, d_state = np.zeros_like(self.gates), np.zeros_like(self.state)
        dh = np.zeros_like(d_states[0])
        for t in range(x.shape[0] - 1, -1, -1):
            h, g, rh, n = tape[t]
            r, z = g[:hid], g[hid:]
            dh = (dh + d_states[t]) * (x[t] != 0)
            a_n = dh * z * (1 - n * n)
            d_rh = self.state.T @ a_n
            d_g = np.concatenate([d_rh * h, dh * (n - h)]) * g * (1 - g)
            d_state += a_n @ rh.T
            d_gates += d_g @ h.T
            d_inputs_t[t, :2 * hid], d_inputs_t[t, 2 * hid:] = d_g, a_n
            dh = dh * (1 - z) + d_rh * r + self.gates.T @ d_g
        one_hot = np.zeros((x.size, 256), np.float32)
        one_hot[np.arange(x.size), x.ravel()] = 1
        flat = d_inputs_t.transpose(1, 0, 2).reshape(3 * hid, -1)
        return flat @ one_hot, d_gates, d_state


@dataclass
class Network:
    languages: list[str]
    forward: Layer
    backward: Layer
    out: np.ndarray    # languages x 2H
    bias: np.ndarray   # languages x 1

    @staticmethod
    def new(languages: list[str], hidden: int = HIDDEN, seed: int = 7) -> Network:
        rng = np.random.default_rng(seed)

        def w(*shape, scale):
            return rng.normal(0, scale, shape).astype(np.float32)

        def layer():
            return Layer(w(3 * hidden, 256, scale=0.3), w(2 * hidden, hidden, scale=0.3),
                         w(hidden, hidden, scale=0.3))

        return Network(languages, layer(), layer(), w(len(languages), 2 * hidden, scale=0.3),
                       np.zeros((len(languages), 1), np.float32))

    def weights(self):
        return [self.forward.inputs, self.forward.gates, self.forward.state,
                self.backward.inputs, self.backward.gates, self.backward.state,
                self.out, self.bias]

    def positions(self, x: np.ndarray) -> np.ndarray:
        """Probability of each language at each position (time x languages x batch)."""
        hid = self.forward.state.shape[0]
        p = self.out[:, :hid] @ self.forward.run(x)
        p += self.out[:, hid:] @ self.backward.run(x[::-1])[::-1]
        p += self.bias
        p -= p.max(axis=1, keepdims=True)
        np.exp(p, out=p)
        p /= p.sum(axis=1, keepdims=True)
        return p

    def gradients(self, x, mask, y):
        """Loss and gradients of the mean cross entropy over the positions in ``mask``."""
        hid = self.forward.state.shape[0]
        f, tape_f = self.forward.run(x, keep=True)
        b, tape_b = self.backward.run(x[::-1], keep=True)
        both = np.concatenate([f, b[::-1]], axis=1)
        p = self.out @ both + self.bias
        p -= p.max(axis=1, keepdims=True)
        np.exp(p, out=p)
        p /= p.sum(axis=1, keepdims=True)
        weight = (mask / max(mask.sum(), 1)).astype(np.float32)
        at = np.arange(x.shape[1])
        loss = float(-(np.log(p[:, y, at] + 1e-9) * weight).sum())
        p[:, y, at] -= 1
        p *= weight[:, None, :]
        d_out = np.einsum("tlb,thb->lh", p, both, optimize=True)
        d_both = self.out.T @ p
        grads = [*self.forward.back(x, tape_f, d_both[:, :hid]),
                 *self.backward.back(x[::-1], tape_b, d_both[::-1, hid:]),
                 d_out, p.sum(axis=(0, 2))[:, None]]
        return loss, grads

    def train(self, windows: np.ndarray, lengths: np.ndarray, labels: np.ndarray,
              steps: int = 260, batch: int = 192, rate: float = 0.02, seed: int = 11) -> list[float]:
        """Adam with a rate that falls to a tenth; each language is drawn equally often."""
        rng = np.random.default_rng(seed)
        share = np.bincount(labels, minlength=len(self.languages)).astype(float)
        chance = 1 / share[labels]
        chance /= chance.sum()
        params = self.weights()
        m, v = [np.zeros_like(w) for w in params], [np.zeros_like(w) for w in params]
        losses = []
        for k in range(1, steps + 1):
            pick = rng.choice(len(labels), size=batch, p=chance)
            x = np.ascontiguousarray(windows[pick].T)
            mask = np.arange(windows.shape[1])[:, None] < lengths[pick][None, :]
            loss, grads = self.gradients(x, mask, labels[pick])
            losses.append(loss)
            norm = np.sqrt(sum(float((g * g).sum()) for g in grads))
            scale = min(1.0, 1.0 / (norm + 1e-12))
            lr = rate * (1 - 0.9 * k / steps)
            for w, g, m1, v1 in zip(params, grads, m, v):
                g = g * np.float32(scale)
                m1 += 0.1 * (g - m1)
                v1 += 0.01 * (g * g - v1)
                w -= (lr * (m1 / (1 - 0.9 ** k)) / (np.sqrt(v1 / (1 - 0.99 ** k)) + 1e-8)).astype(np.float32)
        return losses


def text_bytes(column: pa.Array):
    """Byte buffer, starts and lengths of a string column; NULL has length 0."""
    n = len(column)
    wide = pa.types.is_large_string(column.type)
    raw = column.buffers()
    if n == 0 or raw[2] is None:
        return np.zeros(1, np.uint8), np.zeros(n, np.int64), np.zeros(n, np.int64)
    off = np.frombuffer(raw[1], np.int64 if wide else np.int32)[column.offset:column.offset + n + 1]
    off = off.astype(np.int64)
    lengths = np.diff(off)
    if column.null_count:
        lengths = np.where(np.asarray(column.is_valid()), lengths, 0)
    data = np.frombuffer(raw[2], np.uint8)
    return (data if len(data) else np.zeros(1, np.uint8)), off[:-1], lengths


def pooled(net: Network, data, starts, lengths, batch: int = 4096) -> np.ndarray:
    """Mean position probabilities (texts x languages) of all bytes of all texts."""
    n_win = -(-lengths // WINDOW)
    doc = np.repeat(np.arange(len(lengths)), n_win)
    nth = np.arange(len(doc)) - np.repeat(np.cumsum(n_win) - n_win, n_win)
    begin = starts[doc] + nth * WINDOW
    size = np.minimum(lengths[doc] - nth * WINDOW, WINDOW)
    order = np.argsort(-size, kind="stable")  # short windows side by side cost few steps
    sums = np.zeros((len(net.languages), len(lengths)))
    for i in range(0, len(doc), batch):
        pick = order[i:i + batch]
        steps = int(size[pick].max())
        at = np.arange(steps)[:, None]
        mask = at < size[pick][None, :]
        x = np.where(mask, FOLD[data.take(begin[pick][None, :] + at, mode="clip")], 0).astype(np.uint8)
        p = net.positions(x)
        p *= mask[:, None, :]
        total = p.sum(axis=0)
        for k in range(len(net.languages)):
            sums[k] += np.bincount(doc[pick], weights=total[k], minlength=len(lengths))
    return (sums / np.maximum(lengths, 1)).T


def shares(sizes: dict[str, int], rows: int) -> dict[str, int]:
    """Rows of each language: equal shares of ``rows``, where what a small language leaves goes to
    the others, and one row at least."""
    out = {}
    for k, (lang, n) in enumerate(sorted(sizes.items(), key=lambda x: (x[1], x[0]))):
        out[lang] = min(n, max(1, (rows - sum(out.values())) // (len(sizes) - k)))
    return out


def fit(docs: DataFrame, max_fit_rows: int = 6000, id_col: str = "doc_id", text_col: str = "text",
        lang_col: str = "lang") -> Network:
    """A network for all languages that rows with text have.

    It is trained on at most ``max_fit_rows`` of these rows, each language by its own sample (one
    row per language where there are more languages than that). Four windows per row, spread over its text, go to the driver (at most 4 x 64 bytes a row).
    Without such rows the network knows no language.
    """
    text = F.col(text_col)
    usable = docs.filter(F.col(lang_col).isNotNull() & (F.length(text) > 0))
    draw = F.pmod(F.xxhash64(id_col, text_col), F.lit(1 << 30))
    # one row per language
    found = usable.groupBy(F.col(lang_col).alias("lang")).agg(F.count("*").alias("n"), F.min(draw).alias("least")).collect()
    if not found:
        return Network.new([])
    share = shares({r["lang"]: r["n"] for r in found}, max_fit_rows)
    # more than the share passes the bar, and the least drawn number always does
    bars = [(r["lang"], max(r["least"] + 1, (1 << 30) * (share[r["lang"]] + 4 * int(share[r["lang"]] ** 0.5) + 20) // r["n"]),
             share[r["lang"]]) for r in found]
    bars = F.broadcast(docs.sparkSession.createDataFrame(bars, "__lang string, __bar long, __share long"))
    nth = F.row_number().over(Window.partitionBy("lang").orderBy("draw", "h", "w0"))
    step = F.greatest(F.length(text) - TRAIN_WINDOW, F.lit(0)) / 3
    rows = (usable.join(bars, (F.col(lang_col) == F.col("__lang")) & (draw < F.col("__bar")))
            .select(F.col(lang_col).alias("lang"), F.xxhash64(id_col).alias("h"), draw.alias("draw"), "__share",
                    *[F.substring(text, F.floor(step * i).cast("int") + 1, F.lit(TRAIN_WINDOW)).alias(f"w{i}")
                      for i in range(4)])
            .withColumn("nth", nth).filter("nth <= __share").drop("draw", "nth", "__share").toPandas())
    languages = sorted(rows.lang.unique())
    net = Network.new(languages)
    rows = rows.sort_values(["h", "lang", "w0"], kind="stable")
    cut = [[s.encode()[:TRAIN_WINDOW] for s in rows[f"w{i}"]] for i in range(4)]
    flat = [b for part in cut for b in part]
    windows = np.zeros((len(flat), TRAIN_WINDOW), np.uint8)
    for i, b in enumerate(flat):
        windows[i, :len(b)] = FOLD[np.frombuffer(b, np.uint8)]
    index = {x: i for i, x in enumerate(languages)}
    labels = np.tile(np.array([index[x] for x in rows.lang]), 4)
    net.train(windows, np.array([len(b) for b in flat]), labels)
    return net


PREDICTED = T.StructType([T.StructField("lang_pred", T.StringType()),
                          T.StructField("score", T.DoubleType())])


def predict(docs: DataFrame, net: Network, text_col: str = "text", prefix: str = "") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, the pooled probability of that language.

    A text that is NULL or has no letter is ``und`` with score 0, as is every text when the
    network knows no language. Ties go to the language that sorts first. ``prefix`` goes before
    the new names; columns that have these names already are replaced, all others are kept.
    """
    shared = docs.sparkSession.sparkContext.broadcast(net)

    def run(column):
        model = shared.value
        lettered = [bool(t and LETTER.search(t)) for t in column.to_pylist()]
        if not model.languages:
            return [UNKNOWN] * len(column), [0.0] * len(column)
        p = pooled(model, *text_bytes(column))
        best = p.argmax(axis=1)
        return ([model.languages[b] if ok else UNKNOWN for b, ok in zip(best, lettered)],
                [float(p[i, b]) if ok else 0.0 for i, (b, ok) in enumerate(zip(best, lettered))])

    return append_columns(docs, run, [text_col], prefixed(PREDICTED, prefix))
