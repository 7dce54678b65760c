import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from wayfield.llm import packing as P

PATH = public_tokenizers.path("word_bpe_49k.json")


def direct(text):
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return t.encode(text or "", add_special_tokens=False).ids + [1]


WORDS = ("The the, THE!! ünï éeux çé naïve don't I'll it's 12ab3 <|endoftext|> á ªµº Straße İstanbul "
         "ΣΑΣ x y   tab\tbed 東京 🙂🙂 $$$ the&&& ét. ǅ ﬁne É. 1/2 ½ ² _a_ hello.world a.b,").split(" ")


def test_encoder_equals_tokenizer():
    enc = P.Encoder(PATH)
    rng = np.random.default_rng(3)
    for _ in range(300):
        text = "".join(w + str(rng.choice([" ", "\n", "  ", " \n", "\t", "\r\n"])) for w in rng.choice(WORDS, 12))
        assert np.frombuffer(enc.encode(text), enc.dtype).tolist() == direct(text)[:-1]


def test_plain_words_need_only_the_model(monkeypatch):
    enc, asked = P.Encoder(PATH), []
    raw = enc.raw
    monkeypatch.setattr(enc, "raw", lambda words: asked.extend(words) or raw(words))
    for text in ("the naïve Straße THE!! éeux, ª µº", "the%%% don't naïve??! x_ _x 'the", "the ÉEUX"):
        assert np.frombuffer(enc.encode(text), enc.dtype).tolist() == direct(text)[:-1]
    assert sorted(asked) == sorted(["!!", ",", "%%%", "don't", "??!", "_", "_x", "'the"])


def test_full_cache_starts_again(monkeypatch):
    monkeypatch.setattr(P, "MAX_WORDS", 5)
    enc = P.Encoder(PATH)
    for text in ("a b c", "C d! e a", "one two three four five six", "a b"):
        assert np.frombuffer(enc.encode(text), enc.dtype).tolist() == direct(text)[:-1]
    assert set(enc.words) == {"a", "b"}


@pytest.mark.parametrize("totals,rates", [
    ([100, 3000, 7, 5000], None), ([4096], None), ([1, 1, 1], None), ([900, 0, 5000], [5, 1, 2]), ([2047 * 9, 13], None)])
def test_schedule_is_a_permutation(totals, rates):
    s = P.Schedule(totals, rates, quantum=16, window=256)
    taken = np.zeros(s.total, int)
    fill = Counter()
    for q, t in enumerate(totals):
        if not t:
            continue
        row, start, length, seq, off = s.pieces(np.array([q]), np.array([0]), np.array([t]))
        assert (row == 0).all() and length.sum() == t and (np.cumsum(length) - length == start).all()
        for a, m in zip(np.where(seq < s.full, seq * 256, 0) + off, length):
            pass
        for sq, o, m in zip(seq, off, length):
            base = sq * 256 if sq < s.full else s.full * 256 if sq == s.full else s.tail[sq - s.full - 1]
            taken[base + o:base + o + m] += 1
            fill[sq] += m
    assert (taken == 1).all()
    assert all(n == 256 if sq < s.full else n & (n - 1) == 0 for sq, n in fill.items())


def test_huge_queues_use_exact_integers():
    big = [3 * 10**13, 7 * 10**12 + 5]
    s = P.Schedule(big, window=2048)
    assert s.kind is object
    k = np.array([0, 10**9, 4 * 10**11])
    at = s.start(np.zeros(3, int), k)
    assert all(abs(a - 64 * x * sum(big) / big[0]) <= 128 for a, x in zip(at.tolist(), k.tolist()))


def packed(df, **kw):
    return P.pack(df, PATH, with_ids=True, **kw)


def test_pack(spark):
    rng = np.random.default_rng(5)
    rows = [(i, " ".join(rng.choice(WORDS, int(rng.integers(0, 400)))), ["a", "b", None][i % 3]) for i in range(120)]
    rows += [(7, rows[7][1], "b"), (None, "null id", "a"), (900, None, "rare"), (901, "", "a"),
             (902, "long " * 9000, "a")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    got = packed(df.withColumn("offset", df.doc_id)).collect()
    per_doc, per_seq = defaultdict(list), defaultdict(list)
    for r in got:
        per_doc[r.doc].append(r)
        per_seq[r.sequence_id].append(r)
        assert zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 and len(r.ids) == r.length > 0
    for doc, text, _ in rows:
        want = direct(text)
        mine = sorted(per_doc[doc], key=lambda r: r.start)
        times = Counter(d for d, *_ in rows)[doc]
        assert sum(r.length for r in mine) == times * len(want) and all(r.doc_tokens == len(want) for r in mine)
        if times == 1:
            assert [x for r in mine for x in r.ids] == want and mine[0].start == 0
    total = sum(r.length for r in got)
    shares = Counter()
    for r in got:
        shares[r.source] += r.length
    for seq, part in per_seq.items():
        at = 0
        for r in sorted(part, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at == 2048 if seq < total // 2048 else at & (at - 1) == 0
        if at == 2048:  # the target, give or take a quantum at either end
            for s, n in shares.items():
                assert abs(sum(r.length for r in part if r.source == s) - 2048 * n / total) <= 2 * 64
    assert sorted(per_seq) == list(range(len(per_seq)))
    whole = P.sequences(packed(df)).collect()
    assert sum(len(r.ids) for r in whole) == total and max(len(r.ids) for r in whole) == 2048


def test_proportions_and_empty(spark):
    rows = [(i, "word " * 300, "ab"[i % 2]) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    first = [r for r in packed(df, proportions={"a": 0.8, "b": 0.2}).collect() if r.sequence_id < 4]
    share = sum(r.length for r in first if r.source == "a") / sum(r.length for r in first)
    assert abs(share - 0.8) < 0.02
    assert packed(df.limit(0)).count() == 0
