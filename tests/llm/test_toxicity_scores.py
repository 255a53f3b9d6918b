"""Toxicity scores against a window-by-window version in plain numbers, and
bit for bit whatever texts are scored together."""

import math
import random

import numpy as np
import pyarrow as pa
import pytest

from polarity.llm import toxicity as T


def corpus(n, seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("bakotirelushané") for _ in range(rng.randrange(1, 9)))
    texts = []
    for i in range(n):
        ws = [word() for _ in range(rng.choice([1, 5, 31, 33, 60, 150]))]
        if i % 4 == 0:
            ws[rng.randrange(len(ws))] = "Grumpf"
        texts.append(rng.choice([" ", ", ", "\n"]).join(ws))
    return texts, [int(i % 4 == 0) for i in range(n)]


@pytest.fixture(scope="module")
def model():
    return T.fit(*corpus(300, 1), epochs=3)


ODD = [None, "", "\n", "one", "a" * 3000, "grumpf " * 300, "é" * 40, "12 34 5x"]


def brute_score(model, text):
    """Each window of 32 words from every 16th word on, its states one by one."""
    p = {k: v.astype(float).tolist() for k, v in model["net"].items()}
    raw = np.frombuffer((text or "").encode(), np.uint8)
    x = T.token_inputs(model, raw, np.array([0, len(raw)]))[0].astype(float).tolist()
    sig = lambda v: 1 / (1 + math.exp(-v))
    hid = range(T.HIDDEN)

    def states(xs, d):
        h, out = [0.0] * T.HIDDEN, []
        for v in xs:
            a = [sum(v[i] * p[f"w{d}"][i][j] for i in range(T.DIM)) + p[f"b{d}"][j]
                 for j in range(3 * T.HIDDEN)]
            g = [sum(h[i] * p[f"u{d}"][i][j] for i in hid) for j in range(3 * T.HIDDEN)]
            z = [sig(a[j] + g[j]) for j in hid]
            r = [sig(a[T.HIDDEN + j] + g[T.HIDDEN + j]) for j in hid]
            c = [math.tanh(a[2 * T.HIDDEN + j] + r[j] * g[2 * T.HIDDEN + j]) for j in hid]
            h = [(1 - z[j]) * c[j] + z[j] * h[j] for j in hid]
            out.append(h)
        return out

    best, start = None, 0
    while True:
        xs = x[start:start + 32]
        if xs:
            f, b = states(xs, "f"), states(xs[::-1], "b")[::-1]
            e = [math.exp(sum(f[t][j] * p["af"][j] + b[t][j] * p["ab"][j] for j in hid))
                 for t in range(len(xs))]
            logit = sum(e[t] / sum(e) * sum(f[t][j] * p["of"][j] + b[t][j] * p["ob"][j] for j in hid)
                        for t in range(len(xs))) + p["o"][0]
        else:
            logit = p["o"][0]
        best = logit if best is None else max(best, logit)
        if start + 32 >= len(x):
            return sig(best)
        start += 16


def test_scores_equal_a_plain_version(model):
    texts = corpus(40, 2)[0] + ODD
    got, _ = T.score_texts(model, pa.array(texts, pa.string()))
    assert got == pytest.approx([brute_score(model, t) for t in texts], abs=1e-4)


def test_equal_texts_score_equal_to_the_last_bit(model, monkeypatch):
    texts = corpus(500, 3)[0] + ODD
    score = lambda ts: T.score_texts(model, pa.array(ts, pa.string()))[0]
    whole = score(texts)
    assert (score(texts * 3) == np.tile(whole, 3)).all()
    order = np.random.default_rng(1).permutation(len(texts))
    assert (score([texts[i] for i in order]) == whole[order]).all()
    for size in (1, 7, 64, 301):
        some = range(0, len(texts), size) if size > 1 else range(0, len(texts), 9)
        for a in some:
            assert (score(texts[a:a + size]) == whole[a:a + size]).all()
    monkeypatch.setattr(T, "CHUNK", 5000)
    assert (score(texts) == whole).all()


def test_a_window_scores_alike_at_every_place_of_a_block(model):
    rng = np.random.default_rng(2)
    x = rng.standard_normal((T.WINDOW, T.BLOCK, T.DIM)).astype(np.float32)
    length = rng.integers(0, T.WINDOW + 1, T.BLOCK)
    x[np.arange(T.WINDOW)[:, None] >= length] = 0
    order = rng.permutation(T.BLOCK)
    there = T.forward(model["net"], x[:, order], length[order])
    assert (T.forward(model["net"], x, length)[order] == there).all()
