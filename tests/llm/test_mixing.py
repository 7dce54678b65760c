import numpy as np
import pytest

from wayfield.llm import mixing as M


def goals(sizes, weights=(5, 2, 1), share=1.5, limit=2.0):
    """Share by weight, cap, share the excess again, until none is above."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    capped, left = {}, share * sum(sizes.values())
    while True:
        open_ = [s for s in names if s not in capped]
        total = sum(w[s] for s in open_)
        over = [s for s in open_ if (left - sum(capped.values())) * w[s] / total > limit * sizes[s] + 1e-9]
        if not over:
            rest = left - sum(capped.values())
            return {**capped, **{s: rest * w[s] / total for s in open_}}
        capped.update({s: limit * sizes[s] for s in over})


@pytest.mark.parametrize("sizes", [
    {"a": 100, "b": 100, "c": 100}, {"a": 10, "b": 1000, "c": 5, "é": 40, None: 300, "Z": 0},
    {None: 7}, {f"s{i}": 10 * i + 1 for i in range(23)}])
def test_targets(spark, sizes):
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in M.targets(df).collect()}
    want = goals(sizes)
    assert got.keys() == want.keys()
    for s in want:
        assert got[s] == pytest.approx(want[s])


def test_pivot_keeps_words_and_expectation():
    rng = np.random.default_rng(1)
    words = rng.integers(1, 50, 40).astype(float)
    p = np.full(40, 0.3)
    total, mean = (words * p).sum(), np.zeros(40)
    for _ in range(3000):
        out = M.pivot(p, words, rng.random(40))
        assert ((out > 0) & (out < 1)).sum() <= 1
        assert (words * out).sum() == pytest.approx(total)
        mean += out
    assert np.abs(mean / 3000 - 0.3).max() < 0.05


def test_mix(spark, monkeypatch):
    monkeypatch.setattr(M, "CHUNK_ROWS", 16)
    rows = [(i, "w " * (i % 37 + 1), f"s{i % 4}" if i % 3 else "hot") for i in range(900)]
    rows += [(None, "x y", None), (5000, None, "s1"), (5001, "", "s1"), (5002, "a b c", "s2"), (5002, "a b c", "s2")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    first = M.mix(df).collect()
    assert sum(r.copies_of for r in first) == len(rows)
    sizes, taken, want = {}, {}, {}
    for r in first:
        assert 0 <= r.copies <= 2
        sizes[r.source] = sizes.get(r.source, 0) + r.size * r.copies_of
        taken[r.source] = taken.get(r.source, 0) + r.size * r.copies_of * r.copies
        want[r.source] = r.target
        assert r.source_size >= r.size
    for s, t in goals(sizes).items():
        assert want[s] == pytest.approx(t) and abs(taken[s] - t) <= 40
    again = M.mix(df.repartition(2)).collect()
    assert sorted(map(repr, first)) == sorted(map(repr, again))
    out = M.apply_mix(df.withColumn("size", df.doc_id), M.mix(df))
    assert out.columns == ["doc_id", "text", "source", "size"]
    assert out.count() == sum(r.copies * r.copies_of for r in first)


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string, source string")
    assert M.mix(df).count() == 0
    df = spark.createDataFrame([(1, None, None), (2, " ", "a")], df.schema)
    assert {(r.doc, r.size, r.target, r.copies) for r in M.mix(df).collect()} == {(1, 0, 0.0, 0), (2, 0, 0.0, 0)}
