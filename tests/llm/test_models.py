"""Toxicity network and neighbour voting: gradients, exactness, held-out rows."""

import random

import numpy as np
import pyarrow as pa
import pytest

from polarity.llm import quality_knn as Q
from polarity.llm import toxicity as T
from polarity.llm.common import fold


def corpus(n=500, seed=3):
    """Clean and rude texts; half of the rude ones hide one rude word in a
    long text, some with new endings."""
    rng = random.Random(seed)
    syll = ["ba", "ko", "ti", "re", "lu", "sha", "né", "on"]
    word = lambda: "".join(rng.choice(syll) for _ in range(rng.randrange(1, 4)))
    texts, labels = [], []
    for i in range(n):
        ws = [word() for _ in range(rng.choice([5, 20, 60, 150]))]
        y = i % 4 == 0
        if y:
            for _ in range(rng.choice([1, 3])):
                ws[rng.randrange(len(ws))] = rng.choice(["Grumpf", "zkrat,", "snorvel" + word()])
        texts.append(" ".join(ws))
        labels.append(int(y))
    return texts, labels


@pytest.fixture(scope="module")
def model():
    return T.fit(*corpus(1500), epochs=12)


def test_gradients_match_differences():
    rng = np.random.default_rng(0)
    m = T._init(np.arange(5, dtype=np.uint64), np.zeros(5, np.float32),
                np.random.Generator(np.random.PCG64(1)))
    p = {k: v.astype(np.float64) for k, v in m["net"].items()}
    x, length = rng.normal(size=(6, 3, T.DIM)), np.array([6, 2, 0])
    x[np.arange(6)[:, None] >= length] = 0
    d = rng.normal(size=3)
    logit, state = T.forward(p, x, length, keep=True)
    grads, dx = T.backward(p, x, length, state, d)
    loss = lambda: float(T.forward(p, x, length) @ d)
    for k, g in {**grads, "x": dx}.items():
        target = x if k == "x" else p[k]
        for at in list(np.ndindex(target.shape))[::max(1, target.size // 12)]:
            if k == "x" and at[0] >= length[at[1]]:
                continue
            keep = target[at]
            target[at] = keep + 1e-4
            up = loss()
            target[at] = keep - 1e-4
            down = loss()
            target[at] = keep
            assert g[at] == pytest.approx((up - down) / 2e-4, rel=2e-2, abs=2e-3), (k, at)


def test_windows_cover_every_word():
    for n in (0, 1, 16, 31, 32, 33, 48, 49, 500):
        row, start, length = T.windows(np.zeros(n, np.int64), 1)
        seen = {i for s, k in zip(start, length) for i in range(s, s + k)}
        assert seen == set(range(n)) and len(row) >= 1 and length.max() <= T.WINDOW


def test_held_out_texts_are_told_apart(model):
    texts, labels = corpus(seed=77)
    s, n = T.score_texts(model, pa.array(texts))
    y = np.array(labels)
    assert ((s >= 0.5) == y).mean() > 0.95 and (n >= 1).all()


def test_scores_do_not_depend_on_neighbours(model, monkeypatch):
    texts = corpus(40, seed=5)[0] + ["", None, "one", "x" * 5000, "grumpf " * 400, "\n"]
    whole, _ = T.score_texts(model, pa.array(texts, pa.string()))
    monkeypatch.setattr(T, "CHUNK", 50)
    assert np.allclose(T.score_texts(model, pa.array(texts, pa.string()))[0], whole, atol=1e-5)
    alone = [T.score_texts(model, pa.array([t], pa.string()))[0][0] for t in texts]
    assert np.allclose(alone, whole, atol=1e-5)


def test_votes_do_not_depend_on_the_block():
    """Bit for bit, whatever texts share a block."""
    texts, labels = corpus(220, seed=6)
    texts += ["", "x", "dup dup", "dup dup", "long " * 3000] + texts[:20]
    df = np.zeros(Q.BINS)
    for _, c in Q.text_blocks(pa.array(texts)):
        df += (c > 0).sum(0)
    m = Q.fit(texts[:150], labels[:150], df, len(texts))
    c = np.concatenate([c for _, c in Q.text_blocks(pa.array(texts))])
    whole = Q.vote(m, c)
    assert (whole[:20] == whole[-20:]).all() and whole[222] == whole[223]
    for size in (1, 2, 3, 17, 64, 100):
        parts = [Q.vote(m, c[i:i + size]) for i in range(0, len(c), size)]
        assert (np.concatenate(parts) == whole).all()
    order = np.random.default_rng(1).permutation(len(c))
    assert (Q.vote(m, c[order]) == whole[order]).all()


def test_constant_without_both_labels():
    assert T.score_texts(T.fit([], []), pa.array(["a", ""]))[0].max() < 0.5
    assert T.score_texts(T.fit(["a"], [1]), pa.array(["a", None], pa.string()))[0].min() > 0.5


def frame(spark, texts):
    return spark.createDataFrame([(i, t, "mine", 2) for i, t in enumerate(texts)],
                                 "doc_id long, text string, windows string, n int")


@pytest.mark.parametrize("op,label", [(T, "toxic"), (Q, "quality")])
def test_spark_scores_equal_local_ones(spark, op, label):
    texts, labels = corpus(150, seed=9)
    texts += [None, "", "dup dup", "dup dup"]
    docs = frame(spark, texts)
    lab = spark.createDataFrame([(i, y) for i, y in enumerate(labels)] + [(3, None), (9999, 1)],
                                f"doc_id long, {label} int")
    m = op.train(docs, lab)
    out = op.score(docs, m)
    assert out.columns[:4] == docs.columns
    got = {r.doc_id: r.score for r in out.collect()}
    assert len(got) == len(texts) and all(0 <= s <= 1 for s in got.values())
    assert got[152] == got[153]
    column = pa.array(texts, pa.string())
    if op is T:
        want = T.score_texts(m, column)[0]
    else:
        want = np.concatenate([Q.vote(m, c) for _, c in Q.text_blocks(column)])
    assert np.allclose([got[i] for i in range(len(texts))], want, atol=1e-5)
    assert op.score(docs.where("false"), m).collect() == []
    empty = op.train(docs.where("false"), lab.where("false"))
    assert len(op.score(docs, empty).collect()) == len(texts)


def test_training_leaves_held_out_rows_alone(spark):
    """Labels of the held-out fold change nothing."""
    texts, labels = corpus(120, seed=4)
    docs = frame(spark, texts)
    lab = spark.createDataFrame(list(enumerate(labels)), "doc_id long, quality int")
    held = lab.withColumn("quality", lab.quality * 0 + 1).where(fold(lab.doc_id, 5) == 0)
    other = lab.where(fold(lab.doc_id, 5) != 0).unionAll(held)
    a, b = Q.train(docs, lab), Q.train(docs, other)
    assert (a["points"] == b["points"]).all() and (a["y"] == b["y"]).all()


def test_votes_against_brute_force():
    texts, labels = corpus(200, seed=12)
    df = np.zeros(Q.BINS)
    for _, c in Q.text_blocks(pa.array(texts)):
        df += (c > 0).sum(0)
    m = Q.fit(texts[:120], labels[:120], df, len(texts))
    idf = m["idf"]
    vec = []
    for t in texts[120:] + [""]:
        c = Q.counts(np.frombuffer(t.encode(), np.uint8), np.array([0, len(t.encode())]))
        x = Q.weighted(c, idf)[0] @ m["v"]
        vec.append(x / max(np.linalg.norm(x), 1e-9) if np.linalg.norm(x) > 1e-6 else x * 0)
    got = np.concatenate([Q.vote(m, c) for _, c in Q.text_blocks(pa.array(texts[120:] + [""]))])
    for v, g in zip(vec, got):
        sims = m["points"] @ v
        near = np.argsort(-sims)[:Q.NEIGHBOURS]
        w = np.maximum(sims[near], 0).astype(float) ** Q.SHARPNESS
        want = ((w * m["y"][near]).sum() + 0.1 * m["mean"]) / (w.sum() + 0.1)
        assert g == pytest.approx(want, abs=1e-4)
    assert got[-1] == pytest.approx(m["mean"])
