import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from wayfield.llm import spelling as S


def near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(n, ratio=10):
    form, out = {}, {}
    for w in n:
        close = [v for v in n if near(w, v)]
        best = min(close, key=lambda v: (-n[v], v), default=None)
        form[w] = best if close and n[best] >= ratio * n[w] else None
        out[w] = len(close)
    rows = set()
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        rows.add((w, form[w], root, n[w], out[w], n[form[w]] if form[w] else None))
    return rows


def random_words(seed, size, letters, longest):
    rng = random.Random(seed)
    words = set()
    while len(words) < size:
        words.add("".join(rng.choice(letters) for _ in range(rng.randrange(2, longest))))
    return {w: int(10 ** rng.uniform(0, 5)) for w in sorted(words)}


@pytest.mark.parametrize("seed,letters,longest,group,chunk", [
    (1, "aabÿ", 8, 60_000, 50_000), (2, "abcdÀ", 9, 20, 50_000), (3, "ab", 9, 25, 6), (4, "a😀b", 6, 10, 3)])
def test_brute(spark, monkeypatch, seed, letters, longest, group, chunk):
    monkeypatch.setattr(S.near_words, "__defaults__", (group, chunk))
    n = random_words(seed, 220, letters, longest)
    rows = [(w, c, "x") for w, c in n.items()]
    got = S.variants(spark.createDataFrame(rows, "word string, n long, form string"))
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, brute(n)))


def test_index_steps():
    """Intervals of the index hold as many sequences as begin so."""
    words = sorted(random_words(5, 150, "abc", 7))
    flat = np.array([ord(c) - 96 for w in words for c in w])
    length = np.array([len(w) for w in words])
    index = S.SuffixRanks(flat, np.cumsum(length) - length, length)
    for read in ["a", "ab", "cab", "bb", "acba"]:
        lo, hi = np.array([0]), np.array([len(words)])
        for c in read:
            lo, hi = index.step(lo, hi, np.array([ord(c) - 96]))
        assert hi[0] - lo[0] == sum(w.startswith(read) for w in words)


def test_documents(spark):
    rng = random.Random(7)
    vocabulary = ["orantion", "Thanedble", "ciónado", "semiñque", "÷×äÖüßabc", "short", "x"]
    texts = [(i, " ".join(rng.choice(vocabulary) + rng.choice(["", "1", "-", "!"]) for _ in range(rng.randrange(60))))
             for i in range(120)]
    texts += [(500, None), (501, ""), (502, "1 2 3"), (None, "orantion orantion"), texts[3], texts[3],
              (503, "orantion " * 30_000), (504, "Q" * 5000 + " " + "q" * 4999 + "z " + "q" * 5000)]
    count = Counter()
    for i, t in texts:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = re.sub("[A-Z]", lambda m: m.group().lower(), run)
            h = zlib.crc32(f"{i}:{run}".encode())
            if i is not None and h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            count[run] += 1
    want = brute({w: c for w, c in count.items() if len(w) >= 7 and c >= 2})
    docs = spark.createDataFrame([(*t, "y", 1) for t in texts], "doc_id long, text string, word string, n int")
    got = S.spelling_groups(docs.repartition(5))
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want))
    assert any(r[1] for r in want)


def test_long_and_empty(spark):
    """A run of 5,000 letters is a word like others; empty tables and NULL words."""
    n = {"q" * 5000: 50, "q" * 4999 + "z": 3, "q" * 5001: 2, "abcdefgh": 4}
    got = S.variants(spark.createDataFrame(list(n.items()), "word string, n long"))
    assert {tuple(r) for r in got.collect()} == brute(n)
    assert S.spelling_groups(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    odd = S.variants(spark.createDataFrame([(None, 3), ("a", 2), ("b", 90)], "word string, n long")).collect()
    assert {(r.word, r.form, r.root, r.n_near) for r in odd} == {(None, None, None, 0), ("a", None, "a", 0), ("b", None, "b", 0)}
    with pytest.raises(ValueError):
        S.variants(spark.createDataFrame([], "word string, n long"), ratio=1)
