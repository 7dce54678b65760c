import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from wayfield.llm import fingerprints as X


def shingles(text):
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", (text or "").lower()) if x]
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def likeness(a, b):
    a, b = shingles(a), shingles(b)
    return 1.0 if not a and not b else len(a & b) / len(a | b) if a and b else 0.0


def corpus():
    rng = random.Random(4)
    vocab = ["alpha", "Beta", "γάμμα", "🙂", "x", "yy z"] + [f"w{i}" for i in range(60)]
    rows = []
    for i in range(300):
        text = "".join(rng.choice(vocab) + rng.choice([" ", "\n", "  ", "\t"]) for _ in range(rng.randrange(0, 60)))
        rows.append((rng.randrange(10**6) if i % 10 else i * 10**12, text))
    rows = list({d: (d, t) for d, t in rows}.values())
    rows.append((-5, None))
    rows.append((10**15, "edge " * 3000))
    rows.append((10**15 + 1, rows[3][1]))
    return rows


@pytest.mark.parametrize("bucket", [512, 3])
def test_brute(spark, monkeypatch, bucket):
    monkeypatch.setattr(X, "BUCKET_ROWS", bucket)
    rows = corpus()
    k = 5000
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4).withColumn("sketch", F.lit(1))
    got = X.fingerprinted(df, k).select(
        "id", "n_chars", "edited_sha256", X.resemblance(F.col("sketch"), F.col("edited_sketch"), k).alias("e"),
        X.resemblance(F.col("sketch"), F.col("next_sketch"), k).alias("n"),
        X.distinct_shingles(F.col("sketch"), k).alias("d")).collect()
    assert len(got) == len(rows)
    got = {r.id: r for r in got}
    ordered = sorted(rows, key=lambda r: -r[0])
    for (d, text), (_, after) in zip(ordered, ordered[1:] + ordered[:1]):
        text, after = text or "", after or ""
        half = len(text) // 2
        edited = text[:len(text) - half] + after[:half]
        r = got[d]
        assert r.n_chars == len(text)
        assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert r.e == pytest.approx(likeness(text, edited)) and r.n == pytest.approx(likeness(text, after))
        assert r.d == len(shingles(text))


def test_estimates(spark):
    a = " ".join(f"t{i}" for i in range(4000))
    b = " ".join(f"t{i}" for i in range(1000, 5000))
    c = " ".join(f"t{i}" for i in range(1000))
    rows = [("a", a), ("b", b), ("c", c)]
    s = {r.g: r.s for r in X.with_sketch(spark.createDataFrame(rows, "g string, text string"), "text", "s").collect()}
    both = spark.createDataFrame([(s["a"], s["b"], s["c"])], "a array<long>, b array<long>, c array<long>")
    r = both.select(X.resemblance(F.col("a"), F.col("b")).alias("j"), X.containment(F.col("c"), F.col("a")).alias("in_a"),
                    X.distinct_shingles(F.col("a")).alias("n"), X.merged(F.col("a"), F.col("b")).alias("u")).first()
    assert abs(r.j - 0.6) < 0.15 and r.in_a > 0.7 and abs(r.n / 3996 - 1) < 0.3
    whole = X.merge_all(spark.createDataFrame([(1, s["a"]), (1, s["b"]), (2, s["c"])], "g int, s array<long>"), "s", "g")
    assert {x.g: x.s for x in whole.collect()} == {1: r.u, 2: s["c"]}


def test_edges(spark):
    schema = "doc_id long, text string"
    assert X.fingerprinted(spark.createDataFrame([], schema)).count() == 0
    one = X.fingerprinted(spark.createDataFrame([(1, "abcd")], schema)).first()
    assert one.edited_sha256 == hashlib.sha256(b"abab").hexdigest()
    rows = [(2, "a b"), (2, "a b"), (None, "a  B"), (None, None), (3, "")]
    got = X.fingerprinted(spark.createDataFrame(rows, schema)).collect()
    assert len(got) == 5
    assert len({tuple(r.sketch) for r in got if r.n_chars > 2}) == 1
