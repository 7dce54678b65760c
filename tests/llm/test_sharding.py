import random
import zlib
from collections import defaultdict

from wayfield.llm import sharding as S


def check(got, rows, shards, heavy_ok=()):
    assert len(got) == len(rows)
    total = sum(len((t or "").encode()) + 16 for _, t in rows)
    load, slots = defaultdict(int), defaultdict(list)
    for r in got:
        assert 0 <= r.shard < shards
        load[r.shard] += r.size
        slots[r.shard].append(r.slot)
    assert sum(load.values()) == total
    for s in slots.values():
        assert sorted(s) == list(range(len(s)))
    return [load[s] / (total / shards) for s in range(shards)]


def test_groups_and_balance(spark):
    rng = random.Random(8)
    rows = [(i, "".join(rng.choice("abcdéf ") for _ in range(rng.randrange(20, 400)))) for i in range(6000)]
    hot, mid = "hot copy " * 20, "mid copy " * 30
    rows += [(10_000 + i, hot) for i in range(3000)] + [(20_000 + i, mid) for i in range(40)]
    rows += [(30_000 + i, rng.choice([None, ""])) for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = S.shard(df, 8).collect()
    loads = check(got, rows, 8)
    assert max(loads) < 1.03 and min(loads) > 0.97
    shard_of, texts = {r.doc: r.shard for r in got}, dict(rows)
    by_text = defaultdict(set)
    for d, t in texts.items():
        by_text[t or ""].add(shard_of[d])
        r = t or ""
    assert all(len(s) == 1 for t, s in by_text.items() if t != hot)
    assert 2 <= len(by_text[hot]) <= 5
    assert {(r.doc, r.crc, r.size) for r in got} == {
        (d, zlib.crc32((t or "").encode()), len((t or "").encode()) + 16) for d, t in rows}
    again = S.shard(df.repartition(2), 8).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again))


def test_overfull_ranges_are_subdivided(spark, monkeypatch):
    monkeypatch.setattr(S, "RANGES", 4)
    rng = random.Random(2)
    rows = [(i, "x" * rng.randrange(1, 50) + str(i)) for i in range(5000)]
    loads = check(S.shard(spark.createDataFrame(rows, "doc_id long, text string"), 6).collect(), rows, 6)
    assert max(loads) < 1.3


def test_edges(spark):
    schema = "doc_id long, text string, size int, shard int, key int"
    assert S.shard(spark.createDataFrame([], schema)).count() == 0
    rows = [(None, None), (1, "a"), (1, "a"), (2, "z" * 100_000), (3, "")]
    df = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], schema)
    got = S.shard(df, 3).collect()
    check(got, rows, 3)
    assert len({r.shard for r in got if r.size == 17}) == 1
