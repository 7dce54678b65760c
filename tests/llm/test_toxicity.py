import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from wayfield.llm import toxicity as X
from wayfield.llm.common import crc32

PLAIN = "the and of with that report about river garden people were going home after lunch while music played".split()
BAD = ["idiot", "stupid", "loser", "worthless"]


def corpus(n=1200, seed=2):
    rng = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        words = [rng.choice(PLAIN) for _ in range(rng.randrange(8, 40))]
        toxic = i % 4 == 0
        if toxic:
            for _ in range(rng.randrange(1, 3)):
                words.insert(rng.randrange(len(words)), rng.choice(BAD))
        docs.append((i, " ".join(words)))
        if i % 5 != 4:
            labels.append((i, int(toxic)))
    return docs, labels


@pytest.fixture(scope="module")
def fitted(spark):
    docs, labels = corpus()
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3).cache()
    lab = spark.createDataFrame(labels + [(7, None), (None, 1)], "doc_id long, toxic int")
    return df, lab, X.fit(df, lab)


def test_held_out_accuracy(fitted):
    df, _, model = fitted
    got = [r for r in X.score(df, model).collect() if crc32(str(r.doc_id).encode()) % 5 == 0]
    assert len(got) > 150 and all(r.predicted == int(r.doc_id % 4 == 0) and 0 <= r.score <= 1 for r in got)


@pytest.mark.parametrize("text,word", [
    ("you 1d10t !", "idiot"), ("so $tup1d", "stupid"), ("what a l0ser.", "loser"), ("stuuuupid plan", "stupid"),
    ("an i d i o t here", "idiot"), ("L O S E R", "loser"), ("w0r7hl355 music", "worthless"), ("i.d.i.o.t", "idiot"),
    ("l-o-s-e-r", "loser"), ("W o r t h l e s s", "worthless"), ("st*pid", "stupid"), ("idiot###", "idiot"),
    ("s t u p i d i d i o t", "stupid"), ("STUPID!!", "stupid"), ("іdіоt", "idiot")])
def test_disguises_are_undone(fitted, text, word):
    score, words = fitted[2].score("the garden " + text + " people were going")
    assert word in words and score >= 0.5


@pytest.mark.parametrize("text", [
    "the&&& garden%%% people$$$", "call 555 1010 now", "a b c d e f g", "GARDEN!! PEOPLE!!", "| river | music |", "x = 10 + 1", ""])
def test_clean_texts_stay_clean(fitted, text):
    assert fitted[2].score(text)[0] < 0.5


def test_pruned_scoring_equals_decoding_everything(fitted):
    model = fitted[2]
    rng = random.Random(9)
    swap = {v: k for k, t in X.CONFUSABLE.items() for v in t if k.isascii()}
    for _ in range(300):
        word = rng.choice(PLAIN + BAD)
        w = "".join(rng.choice([c, c, swap.get(c, c), c + c + c]) for c in word) + rng.choice(["", "!!", "."])
        got = model.restored(w)
        assert model._hit(w) == (got if got in model.weights else None)


@pytest.mark.parametrize("text,word", [
    ("stup" + "i" * 80 + "d", "stupid"), ("l" + "0" * 200 + "ser", "loser"), ("i" + ".-" * 40 + "diot", "idiot"),
    ("s t * p i d", "stupid"), ("$ | t | u | p | i | d", "stupid"), ("l * s 3 r", "loser")])
def test_long_and_spaced_disguises_are_undone(fitted, text, word):
    score, words = fitted[2].score("the garden " + text + " people were going")
    assert word in words and score >= 0.5


def test_pruned_spaced_runs_equal_decoding_everything(fitted):
    model = fitted[2]
    rng = random.Random(10)
    swap = {v: k for k, t in X.CONFUSABLE.items() for v in t if k.isascii() and k != "*"}
    for _ in range(300):
        word = rng.choice(PLAIN + BAD + ["".join(rng.choices("abeilost", k=7))])
        letters = [rng.choice([c, c, swap.get(c, c), "*" if c in "aeiou" else c]) for c in word]
        run = rng.choice([" ", " | ", " . "]).join(letters)
        want = {x for p in X._pieces(run) for x in model.decode(p, True).split() if x in model.weights}
        if X.SPACED.fullmatch(run):
            assert model.hits(run) == want | {h for h in map(model._hit, run.split()) if h}


def test_long_words_equal_short_ones(fitted):
    model = fitted[2]
    rng = random.Random(11)
    for _ in range(200):
        w = "".join(rng.choice([c, c * 40, "." + c, c + "!" * 30]) for c in rng.choice(PLAIN + BAD)) + rng.choice(["", "-~" * 20])
        got = model.restored(w)
        assert model._hit(w) == (got if got in model.weights else None)


def test_restored_text(spark, fitted):
    rows = [(1, "The 1d10t went h0me"), (2, None), (3, ""), (4, "an i d i o t ok")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.restored for r in X.restore(df, fitted[2]).collect()}
    assert got == {1: "the idiot went home", 2: None, 3: "", 4: "an idiot ok"}


def test_edges(spark, fitted):
    model = fitted[2]
    rows = [(None, None, 5.0), (1, "idiot", 6.0), (1, "idiot", 6.0), (2, "going home " * 30_000 + "1d10t", 7.0), (3, "i " * 5000, 1.0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, score double")
    got = X.score(df, model).collect()
    assert [r.predicted for r in sorted(got, key=lambda r: (r.doc_id or 0))] == [0, 1, 1, 1, 0]
    assert X.score(df, model, prefix="p_").columns == ["doc_id", "text", "score", "p_score", "p_predicted", "p_toxic_words"]
    empty = df.limit(0)
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    for docs in (empty, df):  # nothing to learn from: no word counts
        m = X.fit(docs, labels)
        assert not m.weights and {r.predicted for r in X.score(df, m).collect()} <= {0, 1}
    assert X.score(empty, model).count() == 0


def test_all_labelled_rows_are_learnt_from(spark):
    """A word that few of many labelled rows have is found: it would be missed in a sample of them."""
    usable = [i for i in range(21_000) if crc32(str(i).encode()) % 5]
    rare = set(usable[1000:1028:2])
    texts = {i: "the garden people" + (" loser" if i % 2 else "") for i in usable}
    texts.update((i, "the garden scoundrel") for i in rare)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i in rare or i % 2)) for i in usable], "doc_id long, toxic int")
    model = X.fit(docs, labels)
    assert len(rare) == 14 and len(usable) > 16_000
    assert {"loser", "scoundrel"} <= set(model.weights)
    assert model.score("you sc0undrel")[0] >= 0.5 > model.score("the garden")[0]


def test_counts_in_parts_add_up(monkeypatch):
    rows = [("Idiot the garden", 1), (None, 0), ("the the river", 0), ("people, were going home", 0)] * 3
    batch = pa.RecordBatch.from_arrays([pa.array([t for t, _ in rows]), pa.array([y for _, y in rows])], names=["t", "y"])

    def total():
        out = Counter()
        for part in X._stats([batch, batch]):
            for kind, key, zero, one in zip(*(c.to_pylist() for c in part.columns)):
                out[kind, key, 0] += zero
                out[kind, key, 1] += one
        return out

    whole = total()
    monkeypatch.setattr(X, "STAT_WORDS", 2)
    assert total() == whole and whole["n", "", 1] == 6 and whole["w", "the", 0] == 6


def test_newton_in_partitions(spark):
    """The weights are those of all rows in one matrix, whatever the partitions."""
    rng = random.Random(4)
    rows = [(sorted(rng.sample(range(5), rng.randrange(4))), rng.randrange(2), float(rng.randrange(1, 4))) for _ in range(200)]
    n = [sum(c for _, y, c in rows if y == k) for k in (0, 1)]
    df = spark.createDataFrame(rows, "found array<int>, y int, rows double")
    got = X.logistic(df.repartition(7), 5, *n)
    x = np.array([[float(i in f) for i in range(5)] + [1.0] for f, _, _ in rows])
    y, c = np.array([r[1] for r in rows]), np.array([r[2] for r in rows])
    weight, pen = c * np.where(y > 0, 0.5 / n[1], 0.5 / n[0]), np.array([0.001 / 50] * 5 + [1e-6])
    assert np.abs(x.T @ (weight * (1 / (1 + np.exp(-(x @ got))) - y)) + pen * got).max() < 1e-9
