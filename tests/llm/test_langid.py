import random

import numpy as np
import pyarrow as pa
import pytest

from wayfield.llm import langid as L

WORDS = {"aa": ["ket", "lomp", "dras", "kk"], "bb": ["ñu", "éa", "oui", "sée"], "cc": ["the", "ing", "and", "wh"]}


def corpus(n=360, seed=1):
    rng = random.Random(seed)
    return [(i, " ".join(rng.choice(WORDS[lang]) + rng.choice(WORDS[lang]) for _ in range(rng.randrange(4, 60))), lang)
            for i in range(n) for lang in [sorted(WORDS)[i % 3]]]


@pytest.fixture(scope="module")
def fitted(spark):
    df = spark.createDataFrame(corpus() + [(9000, None, "aa"), (9001, "12 34", None)], "doc_id long, text string, lang string")
    return df.cache(), L.fit(df.filter("doc_id % 4 <> 2"))


def test_gradients():
    rng = np.random.default_rng(0)
    net = L.Network.new(["a", "b", "c"], hidden=3)
    x = rng.integers(97, 110, (9, 5)).astype(np.uint8)
    mask = np.arange(9)[:, None] < np.array([9, 9, 4, 7, 1])[None]
    y = np.array([0, 1, 2, 1, 0])
    _, grads = net.gradients(x, mask, y)
    for w, g in zip(net.weights(), grads):
        for i in [np.unravel_index(np.abs(g).argmax(), g.shape)]:
            old, e = w[i], 1e-2
            w[i] = old + e
            up = net.gradients(x, mask, y)[0]
            w[i] = old - e
            down = net.gradients(x, mask, y)[0]
            w[i] = old
            assert (up - down) / (2 * e) == pytest.approx(g[i], rel=0.02, abs=1e-4)


def test_held_out_accuracy(fitted):
    df, net = fitted
    got = [r for r in L.predict(df, net).collect() if r.doc_id < 9000 and r.doc_id % 4 == 2]
    assert np.mean([r.lang_pred == r.lang for r in got]) > 0.97 and all(0 <= r.score <= 1 for r in got)


def test_batched_windows_equal_one_by_one(fitted):
    net = fitted[1]
    texts = ["", "a", "ketlomp " * 40, "ñu" * 200, "X" * 128, "the " * 33] + [None]
    data, start, n = L.text_bytes(pa.array(texts))
    together = L.pooled(net, data, start, n)
    for i, t in enumerate(texts):
        raw = (t or "").encode()
        sums = np.zeros(3)
        for at in range(0, len(raw), L.WINDOW):
            x = L.FOLD[np.frombuffer(raw[at:at + L.WINDOW], np.uint8)][:, None]
            sums += net.positions(x)[:, :, 0].sum(axis=0)
        assert together[i] == pytest.approx(sums / max(1, len(raw)), abs=1e-4)


def test_edges(spark, fitted):
    net = fitted[1]
    rows = [(1, None), (2, ""), (3, "12 %%"), (4, "the ing " * 20_000), (5, "é"), (5, "é"), (None, "thewh ingand")]
    df = spark.createDataFrame([(*r, "x", 3) for r in rows], "doc_id long, text string, lang_pred string, score int")
    got = L.predict(df, net).collect()
    assert [r.lang_pred for r in got[:3]] == ["und"] * 3 and [r.score for r in got[:3]] == [0.0] * 3
    assert got[3].lang_pred == "cc" and got[6].lang_pred == "cc" and got[4][1:] == got[5][1:]
    kept = L.predict(df, net, prefix="p_").collect()
    assert [r.score for r in kept] == [3] * 7
    nothing = L.fit(df.withColumn("lang", df.lang_pred).limit(0))
    assert {r.lang_pred for r in L.predict(df, nothing).collect()} == {"und"}
    assert L.predict(df.limit(0), net).count() == 0


def test_rare_languages_are_learnt(spark):
    rows = corpus(4000) + [(10_000 + i, "zox quv yij " * (3 + i % 5), "zz") for i in range(6)] + [(None, "øø åå ææ", "yy")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    net = L.fit(df, max_fit_rows=300)
    assert net.languages == ["aa", "bb", "cc", "yy", "zz"]
    got = L.predict(df.filter("doc_id >= 9000"), net).collect()
    assert {r.lang_pred for r in got} == {"zz"}


def test_shares():
    assert L.shares({"a": 10, "b": 1000, "c": 5000}, 600) == {"a": 10, "b": 295, "c": 295}
    assert L.shares({"a": 3, "b": 4}, 100) == {"a": 3, "b": 4} and L.shares({"a": 3, "b": 4}, 1) == {"a": 1, "b": 1}
    assert L.shares({}, 10) == {}
