import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from polarity.llm import kneser_ney as K


def tokens(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", low) + ["</s>"]


def brute(train, texts):
    """Base and Kneser-Ney scores from plain dictionaries."""
    uni, bi = Counter(), Counter()
    for t in train:
        ws = tokens(t)
        uni.update(ws)
        bi.update(zip(["<s>"] + ws, ws))
    n, vocab = sum(uni.values()), len(uni)
    after, ctx, kinds = Counter(), Counter(), defaultdict(Counter)
    for (v, w), c in bi.items():
        after[w] += 1
        ctx[v] += c
        kinds[v][min(c, 3)] += 1

    def cc(counts):
        k = Counter(counts.values())
        return [k[i] for i in (1, 2, 3, 4)]
    d_low, d_high = K.discounts(*cc(after)), K.discounts(*cc(bi))
    spare = sum(d_low[min(c, 3)] for c in after.values()) / len(bi) if bi else 1.0

    def low(w):
        c = after[w]
        return max(c - d_low[min(c, 3)], 0) / max(len(bi), 1) + spare / (vocab + 1)
    out = []
    for t in texts:
        ws = tokens(t)
        base = sum(math.log10((uni[w] + 1) / (n + vocab + 1)) for w in ws)
        kn = 0.0
        for v, w in zip(["<s>"] + ws, ws):
            c = bi[(v, w)]
            if ctx[v]:
                back = sum(d_high[k] * m for k, m in kinds[v].items()) / ctx[v]
                kn += math.log10(max(c - d_high[min(c, 3)], 0) / ctx[v] + back * low(w))
            else:
                kn += math.log10(low(w))
        out.append((len(ws), sum(uni[w] > 0 for w in ws), base, kn))
    return out, n, vocab


TEXTS = ["the cat sat on the mat", "The cat sat on a hat", "a dog sat on the mat", None, "",
         " \n\t", "the " * 700, "é É unknownword", "the cat", "the cat", "x\x0by\x1cz"]


@pytest.mark.parametrize("bucket,shard", [(4_000_000, 1_000_000), (40, 2), (200, 1)])
def test_against_brute_force(spark, monkeypatch, bucket, shard):
    monkeypatch.setattr(K, "BUCKET_TOKENS", bucket)
    monkeypatch.setattr(K, "FLUSH", bucket)
    monkeypatch.setattr(K, "CHUNK", bucket)
    monkeypatch.setattr(K, "SHARD_WORDS", shard)
    train = TEXTS[:8] + TEXTS[:3]
    df = spark.createDataFrame([(t,) for t in train], "text string").repartition(3)
    model = K.train(df)
    rows = [(i, t, "own") for i, t in enumerate(TEXTS)]
    out = K.score(spark.createDataFrame(rows, "doc_id long, text string, tokens string"), model)
    assert out.columns[:3] == ["doc_id", "text", "tokens"]
    got = {r.doc_id: r for r in out.collect()}
    want, n, vocab = brute(train, TEXTS)
    assert (model["tokens"], model["vocabulary"]) == (n, vocab)
    for i, (count, known, base, kn) in enumerate(want):
        r = got[i]
        assert (r.n_tokens, r.n_known) == (count, known)
        assert r.base_score == pytest.approx(base, rel=1e-9)
        assert r.score == pytest.approx(kn, rel=1e-9)


def test_probabilities_sum_to_one(spark):
    """After any context, known words, the end and one unknown word share 1."""
    model = K.train(spark.createDataFrame([(t,) for t in TEXTS[:3]], "text string"))
    words = sorted({w for t in TEXTS[:3] for w in tokens(t)} - {"</s>"})
    raw = " ".join(words + ["neverseen"]).encode()
    h = K.W.word_hashes(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]), True)[0]
    after = np.append(h, K.END)
    for context in [K.START, *h]:
        if context == K.START:
            s, alone = np.stack([np.full(len(after), K.START), after], 1).ravel(), 0.0
            both = K.score_block(model, s, np.arange(0, len(s) + 1, 2))[3]
        else:  # rows of start, context and word
            s = np.stack([np.full(len(after), K.START), np.full(len(after), context), after],
                         1).ravel()
            both = K.score_block(model, s, np.arange(0, len(s) + 1, 3))[3]
            alone = K.score_block(model, np.array([K.START, context]), np.array([0, 2]))[3]
        assert (10 ** (both - alone)).sum() == pytest.approx(1, rel=1e-9)


def test_nothing_to_learn_from(spark):
    model = K.train(spark.createDataFrame([], "text string"))
    rows = K.score(spark.createDataFrame([("a b",), (None,)], "text string"), model).collect()
    assert [(r.n_tokens, r.n_known, r.base_score, r.score) for r in rows] == [(3, 0, 0.0, 0.0),
                                                                              (1, 0, 0.0, 0.0)]


def test_no_rows_to_score(spark):
    model = K.train(spark.createDataFrame([("a b",)], "text string"))
    assert K.score(spark.createDataFrame([], "text string"), model).collect() == []


def test_counts_pack_and_unpack():
    c = np.array([1, 254, 255, 256, 10 ** 12, 3])
    w = np.arange(6, dtype=np.uint64)
    got = K.unpack(K.pack([w, *K._small(c)]))
    assert (got[0] == w).all() and (K._large(got[1:]) == c).all()
