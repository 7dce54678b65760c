import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from wayfield.llm import hard_negatives as H

SCHEMA = "vec_id long, embedding array<long>, label int, anchor string, rank int"


def brute(rows, step=10, low=80, high=100, k=5):
    rows = [r for r in rows if r[2] is not None and r[1] is not None and None not in r[1]]

    def first(i, keep):
        scored = [(sum(x * y for x, y in zip(rows[i][1], r[1])), r[0], j) for j, r in enumerate(rows) if j != i]
        return sorted((s for s in scored if keep(s)), key=lambda s: (-s[0], s[1] is None, s[1] or 0, s[2]))[:k]

    out = []
    for i, r in enumerate(rows):
        if r[0] is None or r[0] % step:
            continue
        for score, positive, _ in first(i, lambda s: rows[s[2]][2] == r[2]):
            window = first(i, lambda s: rows[s[2]][2] != r[2] and low * score <= 100 * s[0] <= high * score)
            out += [(r[0], positive, n + 1, w[1], score, w[0]) for n, w in enumerate(window)]
    return sorted(out, key=repr)


def got(spark, rows, step=10, **options):
    df = spark.createDataFrame([(*r, "a", 1) for r in rows], SCHEMA).repartition(3)
    return sorted((tuple(r) for r in H.mine(df, F.col("vec_id") % step == 0, **options).collect()), key=repr)


def vectors(seed, n, dim, size, labels=3):
    rng = np.random.default_rng(seed)
    return [(i, rng.integers(-size, size + 1, dim).tolist(), int(rng.integers(labels))) for i in range(n)]


@pytest.mark.parametrize("shard,block,blocks,size", [(16_384, 1024, 8, 3), (60, 7, 2, 40), (25, 3, 1, 1)])
def test_brute(spark, monkeypatch, shard, block, blocks, size):
    """Many ties where components are small; several shards, blocks and lots."""
    for name, value in (("SHARD_ROWS", shard), ("BLOCK_ROWS", block), ("BLOCKS", blocks), ("LEAF", 6), ("FANOUT", 4)):
        monkeypatch.setattr(H, name, value)
    rows = vectors(1, 260, 5, size)
    rows += [(1000 + i, rows[7][1], 0) for i in range(30)] + [(None, rows[7][1], 1), (None, rows[9][1], 2)]
    assert got(spark, rows) == brute(rows)


def test_odd_rows(spark):
    rows = [(0, [3, 4], 1), (10, [3, 4], 1), (0, [3, 4], 1), (1, [3, 3], 2), (2, [3, 3], 2), (3, None, 1), (4, [1, None], 1),
            (5, [3, 4], None), (6, [], 2), (7, [3, 4, 5], 3), (20, [], 1), (30, [0, 0], 2), (40, [-3, -4], 2), (8, [2, 4], 2),
            (50, [1 << 40, 1], 3), (9, [1 << 21, 7], 1), (60, [(1 << 62) + 1, 3], 5), (11, [1 << 62, 3], 5)]
    small = [r for r in rows if r[0] not in (60, 11)]
    assert got(spark, small) == brute(small)
    assert got(spark, rows)  # scores beyond 64 bits stay at the ends


def test_empty(spark):
    assert got(spark, []) == [] == got(spark, [(1, [1, 2], 3)])
    assert got(spark, [(10, [1, 2], 3)]) == []


def test_other_windows(spark):
    rows = vectors(2, 120, 4, 9)
    assert got(spark, rows, step=7, low=50, high=130, positives=2, negatives=9) == [
        r for r in brute_wide(rows)]


def brute_wide(rows):
    out = brute(rows, 7, 50, 130, 9)
    kept = {}
    for r in rows:
        if r[0] % 7 == 0:
            near = sorted(((sum(x * y for x, y in zip(r[1], o[1])), o[0]) for o in rows if o[0] != r[0] and o[2] == r[2]),
                          key=lambda s: (-s[0], s[1]))[:2]
            kept[r[0]] = {p for _, p in near}
    return [r for r in out if r[1] in kept[r[0]]]


def test_ranges_leave_rows_out():
    """On clustered rows most of the leaves are never scanned, and nothing is lost by it."""
    rng = np.random.default_rng(4)
    centres = rng.integers(-250, 250, (60, 8))
    rows = np.repeat(centres, 100, axis=0) + rng.integers(-5, 6, (6000, 8))
    tree = H.Tree(rows)
    asked = rows[::100]
    high = np.einsum("ij,ij->i", asked, asked)
    search = H.Search(tree, rows, np.zeros(6000, int), np.arange(6000), asked, np.ones(60, int), np.full(60, -1),
                      high * 9 // 10, high, 5, False)
    scores = asked @ rows.T
    for i in range(60):
        fits = [(-s, j) for j, s in enumerate(scores[i]) if high[i] * 9 // 10 <= s <= high[i]]
        want = [(-s, j) for s, j in sorted(fits)[:5]]
        assert list(zip(search.score[i], search.at[i]))[:len(want)] == want
    assert search.scanned < 0.3 * 60 * 6000


def test_bounds_are_exact():
    assert H.products(np.array([[1 << 40, 3]]), np.array([[1 << 20, 1]])).tolist() == [[(1 << 60) + 3]]
    assert math.isclose(H.Tree(np.zeros((0, 3), int)).radius2, 0)
