"""Similarity classes against all pairs on small tables."""

import random
import re

import pytest

from wayfield.llm import jaccard as J


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)}


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * len(sets[i] | sets[j]):
                parent[find(i)] = find(j)
    groups = {}
    for i, (d, _) in enumerate(rows):
        groups.setdefault(find(i), []).append(d)
    return sorted(((d, len(sets[i]), min((x for x in groups[find(i)] if x is not None), default=None)
                    if sets[i] else d) for i, (d, _) in enumerate(rows)), key=repr)


def corpus(seed, n=260):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    passage = [rng.choice(vocab) for _ in range(60)]
    rows, base = [], []
    for i in range(n):
        kind = rng.random()
        if base and kind < 0.35:
            words = list(rng.choice(base))
            for _ in range(rng.choice([0, 1, 1, 2, 4])):
                words[rng.randrange(len(words))] = rng.choice(vocab)
            if rng.random() < 0.3:
                words = words[:max(1, len(words) - rng.randrange(4))]
        elif kind < 0.5:
            words = [rng.choice(vocab) for _ in range(rng.randrange(1, 14))]
        elif kind < 0.7:
            words = passage + [rng.choice(vocab) for _ in range(rng.randrange(0, 40))]
        else:
            words = [rng.choice(vocab) for _ in range(rng.choice([5, 8, 12, 16, 20, 60, 200]))]
        base.append(words)
        rows.append((i * 3 + 1, rng.choice([" ", "\n", " \t"]).join(w.upper() if rng.random() < 0.1 else w for w in words)))
    return rows


def classes(spark, rows, schema="doc_id long, text string"):
    got = J.similarity_classes(spark.createDataFrame(rows, schema).repartition(3)).collect()
    return sorted(((r.doc, r.n, r.component) for r in got), key=repr)


@pytest.mark.parametrize("seed,frequent,bound", [(1, 48, None), (2, 4, 10), (3, 6, 0)])
def test_brute(spark, monkeypatch, seed, frequent, bound):
    monkeypatch.setattr(J, "FREQUENT", frequent)
    monkeypatch.setattr(J, "CHUNK", 8)
    if bound is not None:
        monkeypatch.setattr(J, "boundary", lambda *_: bound)
    rows = corpus(seed)
    assert classes(spark, rows) == brute(rows)


def test_edges(spark):
    long = " ".join(f"x{i}" for i in range(30_000))
    rows = [(5, None), (6, ""), (7, " \n\t "), (8, "one two"), (3, "ONE  two"), (9, "one"), (None, "one two"),
            (11, long), (12, long + " more"), (13, "a b c d e"), (13, "a b c d e"), (14, "é B c d e"),
            (14, "totally different text here now"), (15, "totally different text here now")]
    assert classes(spark, rows) == brute(rows)


def test_empty_and_extra_columns(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, n int, set_id string, component long, a int")
    assert J.similarity_classes(empty).count() == 0
    extra = spark.createDataFrame([(1, "p q r s t u", 4, "x", 9, 1)], empty.schema)
    assert [tuple(r) for r in J.similarity_classes(extra).collect()] == [(1, 2, 1)]


def test_need_is_the_threshold():
    for a in range(1, 60):
        for b in range(a, 75):
            least = min((c for c in range(a + 1) if 100 * c >= 80 * (a + b - c)), default=None)
            assert least is None and J.need(a, b) > a or least == J.need(a, b)
