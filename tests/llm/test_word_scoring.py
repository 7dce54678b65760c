import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from wayfield.llm import word_scoring as W
from wayfield.llm.common import written
from wayfield.llm.queries import QUERIES


def words(text):
    return re.findall(r"[一-鿿]|[^\W_一-鿿]+|[^\w\s]|_", (text or "").lower())


def brute(rows, target):
    """Losses of all rows, one dictionary per order and model."""
    one, two = [Counter(), Counter()], [Counter(), Counter()]
    for d, t in rows:
        w = words(t)
        s = [None, *w, None] if w else []
        for k in (0, 1):
            if k or d in target:
                one[k].update(s[1:])
                two[k].update(zip(s, s[1:]))
    n = sum(one[0].values())
    scale = n / max(1, sum(one[1].values()))
    out = []
    for d, t in rows:
        w = words(t)
        s = [None, *w, None] if w else []
        got = []
        for k in (0, 1):
            f, loss = scale if k else 1, 0.0
            for h, x in zip(s, s[1:]):
                p = (one[k][x] * f + W.PRIOR / len(one[1])) / (n + W.PRIOR)
                loss -= math.log((two[k][h, x] * f + W.PRIOR * p) / (one[k][h] * f + W.PRIOR))
            got.append(loss / (len(s) - 1) if s else None)
        out.append((d, max(0, len(s) - 1), *got))
    return out


def test_brute(spark, monkeypatch):
    rng = random.Random(3)
    vocab = ["the", "and", "ÉCLAT", "of", "ñu", "东", "京东", "a.b", "x_y", "Ελλάς", "The"] + [f"w{i}" for i in range(200)]
    rows = [(i, rng.choice([" ", "\n", " \t "]).join(rng.choice(vocab) for _ in range(rng.randrange(1, 60))))
            for i in range(150)] + [(500, None), (501, ""), (502, " \n"), (503, "long text " * 5000), (7, "twice"), (None, "w1 w2")]
    target = set(range(0, 150, 3))
    df = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, score string").repartition(3)
    ids = spark.createDataFrame([(i,) for i in target] * 2 + [(None,)], "doc_id long")
    for block in (W.BLOCK, 900):  # one block per task, and many
        monkeypatch.setattr(W, "BLOCK", block)
        got = sorted((tuple(r) for r in W.score(df, ids).collect()), key=repr)
        want = sorted(brute(rows, target), key=repr)
        assert len(got) == len(want)
        for g, w in zip(got, want):
            assert g[:2] == w[:2]
            if w[1]:
                assert g[2:4] == pytest.approx(w[2:]) and g[4] == pytest.approx(w[3] - w[2], abs=1e-9)
            else:
                assert g[2:] == (None, None, 0.0)


def test_rare_scripts_are_told_apart(spark, tmp_path):
    """Characters that are rare in the corpus are words like all others."""
    rows = [(i, "the quick brown fox jumps over a lazy dog 0123456789 abc xyz éàüöäñçß,.;:!?") for i in range(300)]
    rows += [(1000, "东京大学"), (1001, "北海道人"), (1002, "东京大学")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1002, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    got = {r.doc_id: r for r in QUERIES["op6_lm_scoring"](spark, str(tmp_path)).collect()}
    assert got[1000].loss_background < got[1001].loss_background
    assert got[1000].score > got[1001].score


def test_without_target_and_empty(spark):
    df = spark.createDataFrame([(1, "abc d"), (1, "abc d"), (None, "x")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long")
    assert [r.score for r in W.score(df, none).collect()] == [0.0] * 3
    assert W.score(df.limit(0), none).count() == 0


def test_words_do_not_depend_on_memory_behind_them():
    """Texts that fill their buffer to the end, among buffers of bytes that no text begins with."""
    def tokens(*texts):
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, pa.schema([("text", pa.string())])) as out:
            out.write_batch(pa.RecordBatch.from_arrays([pa.array(texts)], ["text"]))
        return W.read(sink.getvalue().to_pybytes())[0].tolist()

    last, kept = tokens("b.")[1:], []
    for _ in range(40):
        full = [pa.allocate_buffer(64) for _ in range(200)]
        for buffer in full:
            np.frombuffer(buffer, np.uint8)[:] = 0xFF
        kept.append(full[::2])  # the others are free again
        del full, buffer
        for size in range(50, 70):  # spaces around the sign come to it
            assert tokens("a" * size + " b.")[2:] == last


def test_blocks_are_files(spark, monkeypatch):
    """Parquet is read thousands of rows of a file at a time, so a file holds one block."""
    monkeypatch.setattr(W, "BLOCK", 500)
    found = []
    monkeypatch.setattr(W, "written", lambda *a, **k: found.append(written(*a, **k)) or found[-1])
    rows = [(i, f"word{i} " * 20) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(2)
    assert W.score(df, df.select("doc_id").limit(5)).count() == 60
    blocks = found[0].groupBy(F.input_file_name()).count().collect()
    assert len(blocks) > 10 and {r["count"] for r in blocks} == {1}
