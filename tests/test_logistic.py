"""Logistic regression with table weights against pyspark.ml and its own optimum."""

import math
import random

import numpy as np
import pytest
from conftest import SF01
from pyspark.sql import functions as F

from polarity.operators import logistic as L
from polarity.operators import model as T
from polarity.plans import inputs as I


def corpus(n=120, seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        y = i % 3 == 0
        ws = [f"w{rng.randrange(12)}" for _ in range(rng.randrange(0, 25))]
        ws += rng.choices(["good", "the", "bad"], [3, 2, 1] if y else [1, 2, 3], k=3)
        rows.append((i, ws, int(y)))
    return rows


def table(spark, rows):
    return T.term_table(spark.createDataFrame(rows, "id long, tokens array<string>, label int"),
                        "id", "tokens", ("label",))


def optimum(rows, lam, reg):
    """Newton's method on dense matrices."""
    words = sorted({w for _, ws, _ in rows for w in ws})
    x = np.array([[ws.count(w) for w in words] for _, ws, _ in rows], float)
    y, lam = np.array([r[2] for r in rows], float), np.asarray(lam, float)
    total = lam.sum()
    mean = lam @ x / total
    sd = np.sqrt((lam @ (x - mean) ** 2) / (total - (lam ** 2).sum() / total))
    keep = sd > 1e-12
    a = np.hstack([x[:, keep] / sd[keep], np.ones((len(x), 1))])
    w, pen = np.zeros(a.shape[1]), np.append(np.full(keep.sum(), reg), 0)
    for _ in range(60):
        p = 1 / (1 + np.exp(-(a @ w)))
        g = a.T @ (lam * (p - y)) / total + pen * w
        h = (a.T * (lam * p * (1 - p))) @ a / total + np.diag(pen)
        w -= np.linalg.solve(h, g)
    return dict(zip(np.array(words)[keep], w[:-1] / sd[keep])), w[-1]


def test_weights_equal_newton(spark):
    rows = corpus() + [(900, [], 1), (901, ["only"] * 4, 0)]
    m = L.fit_lr_terms(table(spark, rows), reg=0.1, tol=1e-5)
    want, b = optimum(rows, np.ones(len(rows)), 0.1)
    got = {r.word: r.weight for r in m.weights.collect()}
    assert got.keys() == want.keys() and m.gradient <= 1e-5 and m.iterations < 60
    assert m.intercept == pytest.approx(b, abs=1e-4)
    assert max(abs(got[w] - want[w]) for w in want) < 1e-4


def test_dealt_margins_give_the_same_steps(spark, monkeypatch):
    monkeypatch.setattr(L, "ROWS_PER_TASK", 20)  # many warm words
    terms = table(spark, corpus())
    plain, dealt = (L.fit_lr_terms(terms, reg=0.1, max_iter=2, max_broadcast_rows=n)
                    for n in (10 ** 6, 0))
    a, b = ({r.word: r.weight for r in m.weights.collect()} for m in (plain, dealt))
    assert a.keys() == b.keys() and all(a[w] == pytest.approx(b[w], abs=1e-9) for w in a)
    assert plain.intercept == pytest.approx(dealt.intercept, abs=1e-9)


def test_same_optimum_as_pyspark_ml(spark):
    docs = I.with_tokens(I.labeled_docs(spark, SF01)).select("doc_id", "tokens", "label")
    terms = T.term_table(docs, "doc_id", "tokens", ("label",))
    m = L.fit_lr_terms(terms, "doc_id", reg=0.2, tol=1e-5)
    ml = T.fit_lr(docs, "tokens", "label", max_iter=200, reg=0.2)
    lr = ml.stages[1]
    want = dict(zip(ml.stages[0].vocabulary, lr.coefficients.toArray()))
    got = {r.word: r.weight for r in m.weights.collect()}
    assert all(abs(got.get(w, 0.0) - v) < 1e-4 for w, v in want.items())
    assert m.intercept == pytest.approx(lr.intercept, abs=1e-4)
    a = {r.doc_id: r.score for r in L.score_lr_terms(terms, m, "doc_id").collect()}
    b = {r.doc_id: r.score for r in T.score_lr(docs, ml, "doc_id").collect()}
    assert a.keys() == b.keys() and all(abs(a[k] - b[k]) < 1e-3 for k in a)


def test_semi_supervised_refit(spark):
    rows = [(i, ws, y if i % 2 else None) for i, ws, y in corpus(120, 4)]
    terms = table(spark, rows)
    first = L.fit_lr_terms(terms, reg=0.2, tol=1e-5)
    m = L.fit_semi_lr_terms(terms, unlabel_weight=0.3, rounds=1, reg=0.2, tol=1e-4)
    w = {r.word: r.weight for r in first.weights.collect()}
    soft = [1 / (1 + math.exp(-(first.intercept + sum(w.get(t, 0) for t in ws)))) for _, ws, _ in rows]
    full = [(i, ws, y if y is not None else round(p, T.SOFT_DECIMALS))
            for (i, ws, y), p in zip(rows, soft)]
    want, b = optimum(full, [1.0 if y is not None else 0.3 for _, _, y in rows], 0.2)
    got = {r.word: r.weight for r in m.weights.collect()}
    assert max(abs(got[k] - want[k]) for k in want) < 1e-3 and m.intercept == pytest.approx(b, abs=1e-3)


def test_one_class_and_scores(spark):
    with pytest.raises(ValueError, match="both classes"):
        L.fit_lr_terms(table(spark, [(1, ["a"], 1), (2, ["b"], 1)]))
    rows = corpus(60, 2)
    terms = table(spark, rows)
    out = L.score_lr_terms(terms, L.fit_lr_terms(terms, reg=0.1, max_iter=3))
    assert out.count() == len(rows)
    assert out.where((F.col("score") > 0.5) != (F.col("pred") == 1)).isEmpty()


def test_many_words_are_fitted_as_a_table(spark, monkeypatch, tmp_out):
    """Beyond LR_WORDS nothing per word is on the driver; a row for every row of
    repeated and null keys."""
    from polarity.sources import models
    rows = corpus(40, 7) + [(3, ["good"], 1), (None, [], 0), (None, ["bad", "w1"], 0)]
    df = spark.createDataFrame(rows, "id long, tokens array<string>, label int")
    monkeypatch.setattr(T, "LR_WORDS", 3)
    monkeypatch.setattr(T, "CountVectorizer", None)
    m = T.fit_lr(df, max_iter=1, reg=0.2)
    assert isinstance(m, L.TermLR)
    models.save_model(m, tmp_out, "lr", 1)
    w = {r.word: r.weight for r in m.weights.collect()}
    want = [(i is None, i or 0, y, 1 / (1 + math.exp(-m.intercept - sum(w.get(t, 0) for t in ws))))
            for i, ws, y in rows]
    scored = T.score_lr(df, models.load_model(spark, tmp_out, "lr", 1, kind="lr"), "id", ("label",))
    got = [(r.id is None, r.id or 0, r.label, r.score) for r in scored.collect()]
    for a, b in zip(sorted(got), sorted(want)):
        assert a[:3] == b[:3] and a[3] == pytest.approx(b[3], abs=1e-9)
    assert len(got) == len(rows)


def test_many_words_self_training(spark, monkeypatch):
    rows = corpus(40, 8)
    df = spark.createDataFrame(rows, "id long, tokens array<string>, label int")
    lab, unl = df.where("id % 4 > 0"), df.where("id % 4 = 0").drop("label")
    monkeypatch.setattr(T, "LR_WORDS", 3)
    got = T.fit_semi_lr(lab, unl, "id", unlabel_weight=0.3, max_iter=1, reg=0.2)
    terms = table(spark, [(i, ws, y if i % 4 else None) for i, ws, y in rows])
    want = L.fit_semi_lr_terms(terms, unlabel_weight=0.3, max_iter=1, reg=0.2)
    a, b = ({r.word: r.weight for r in m.weights.collect()} for m in (got, want))
    assert a.keys() == b.keys() and all(a[w] == pytest.approx(b[w], abs=1e-9) for w in a)


def test_fit_joins_no_term_rows_by_word(spark, monkeypatch):
    """Iterations are products in blocks of documents."""
    monkeypatch.setattr(L, "_margins", None)
    assert L.fit_lr_terms(table(spark, corpus()), reg=0.1, max_iter=3, tol=0.0).iterations == 3


def test_sums_by_word_equal_dense_ones(spark, monkeypatch):
    """Weighted, soft labels; words of one block, of several, and one that does not vary."""
    from polarity.operators import term_blocks
    from polarity.operators.term_blocks import Blocks, array_of
    monkeypatch.setattr(term_blocks, "TERMS", 90)
    rows = [(i, ws + ["all"] * 300 * (i < 2) + ["same"], y) for i, ws, y in corpus(90, 3)] + [(99, ["same"], 0)]
    lam = {r[0]: 0.5 + r[0] % 3 for r in rows}
    terms = table(spark, rows)
    docs = spark.createDataFrame([(k, 0.25, w) for k, w in lam.items()], "id long, y double, lam double")
    total, w2 = sum(lam.values()), sum(w * w for w in lam.values())
    blocks = Blocks(terms, docs, "id", total, total - w2 / total)
    assert blocks.blocks.count() > 8
    got = {r.word: (r.value, r.n) for r in blocks.by_word(
        blocks.blocks.select("part", "lam"), lambda b, r: array_of(b.column("lam"), r, np.float64)).collect()}
    words = {w for _, ws, _ in rows for w in ws} - {"same"}
    assert got.keys() == words and blocks.n_words == len(words)
    for w in words:
        x, v = np.array([r[1].count(w) for r in rows], float), np.array([lam[r[0]] for r in rows])
        var = (v @ (x - v @ x / total) ** 2) / (total - w2 / total)
        assert got[w] == (pytest.approx(v @ x / var, rel=1e-9), (x > 0).sum())
