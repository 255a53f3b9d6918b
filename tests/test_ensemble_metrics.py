"""Weighted vote, step windows, losses, latest prediction."""

import math

import pytest
from pyspark.sql import functions as F

from polarity.operators import ensemble as E
from polarity.operators import metrics as M


def test_vote_no_votes_and_exact_tie(spark):
    ids = spark.createDataFrame([(1,), (2,), (3,)], "id long")
    w = E.member_weights(spark, [("a", "1.10"), ("b", "2.20"), ("c", "3.30")])
    votes = spark.createDataFrame(
        [(2, "a", "positive"), (2, "b", "positive"), (2, "c", "negative"),
         (3, "c", "negative"), (99, "a", "negative")],
        "id long, member string, sentiment string")
    out = {r["id"]: r["sentiment"] for r in E.ensemble(ids, votes, w).collect()}
    assert out == {1: "positive", 2: "positive", 3: "negative"}
    with pytest.raises(KeyError):
        E.ensemble(ids, votes, w, strict=True)


def test_vote_unknown_class_strict(spark):
    ids = spark.createDataFrame([(1,)], "id long")
    w = E.member_weights(spark, [("a", "1.00")])
    votes = spark.createDataFrame([(1, "a", "neutral")], "id long, member string, sentiment string")
    with pytest.raises(KeyError):
        E.weighted_vote(ids, votes, w, strict=True)


def test_step_windows_50_50_20(spark):
    steps = spark.range(120, numPartitions=4).select(
        F.lit(1).alias("epoch"), F.col("id").alias("step"), F.lit(1.0).alias("loss"),
        F.lit(2).alias("batch_size"))
    two = steps.unionByName(steps.withColumn("epoch", F.lit(2)))
    out = M.step_window_metrics(two, 50).orderBy("epoch", "window").collect()
    assert [r["steps"] for r in out] == [50, 50, 20, 50, 50, 20]
    assert [r["global_step"] for r in out] == [1, 2, 3, 4, 5, 6]


def test_latest_per_id(spark):
    df = spark.createDataFrame([(7, 0, 1), (7, 1, 2), (8, 1, 1)], "id long, pred int, step int")
    out = {r["id"]: r["pred"] for r in M.latest_per_id(df, "id", "pred", ["step"]).collect()}
    assert out == {7: 1, 8: 1}


def test_gan_losses(spark):
    df = spark.createDataFrame([("labeled", [0.0, 0.0], 1), ("real", [0.0, 0.0], 0),
                                ("fake", [0.0, 0.0], 0)], "role string, logits array<double>, label int")
    r = M.gan_losses(df).collect()[0]
    lse = math.log(2)
    sp = max(lse, 0) + math.log1p(math.exp(-abs(lse)))
    assert math.isclose(r["sup_loss"], lse)
    assert math.isclose(r["unsup_loss"], 0.5 * (-lse + sp + sp))
    assert math.isclose(r["total_loss"], r["sup_loss"] + r["unsup_loss"])


def test_feature_gap_and_histogram(spark):
    df = spark.createDataFrame([(True, [0.0, 1.0]), (False, [1.0, 1.0]), (False, [-2.0, 0.25])],
                               "a boolean, vector array<double>")
    gap = M.feature_gap(df, F.col("a")).collect()[0][0]
    assert math.isclose(gap, ((0.0 - (-0.5)) ** 2 + (1.0 - 0.625) ** 2) / 2)
    h = {r["bucket"]: r["n"] for r in M.feature_histogram(df, -1.0, 1.0, 4).collect()}
    assert h == {0: 1, 3: 2, 5: 3}  # 0.0 and 0.25 share [0, 0.5)


def test_accuracy(spark):
    df = spark.createDataFrame([(1, 1), (0, 1), (0, 0), (1, 0)], "pred int, label int")
    r = M.accuracy(df).collect()[0]
    assert (r["n"], r["correct"], r["tp"], r["fp"], r["tn"], r["fn"]) == (4, 2, 1, 1, 1, 1)


def test_fit_semi_lr(spark):
    from polarity.operators import model as T
    lab = spark.createDataFrame(
        [(1, ["good", "fun"], 1), (2, ["bad", "dull"], 0), (3, ["good"], 1), (4, ["bad"], 0)],
        "id long, tokens array<string>, label int")
    unl = spark.createDataFrame([(5, ["good", "dull"]), (6, ["fun"])], "id long, tokens array<string>")
    args = dict(max_iter=30)
    base = {r["id"]: r["score"] for r in T.score_lr(lab.unionByName(unl, allowMissingColumns=True),
                                                      T.fit_lr(lab, **args), "id").collect()}
    # weight 0: every unlabelled row drops out, the fit is the supervised one
    same = T.fit_semi_lr(lab, unl, "id", unlabel_weight=0.0, **args)
    got = {r["id"]: r["score"] for r in T.score_lr(lab.unionByName(unl, allowMissingColumns=True),
                                                     same, "id").collect()}
    assert all(abs(got[k] - base[k]) < 1e-9 for k in base)
    semi = T.fit_semi_lr(lab, unl, "id", unlabel_weight=1.0, **args)
    assert T.score_lr(unl, semi, "id").count() == 2


def test_lr_fit_is_optimal(spark):
    """First-order optimality: with the fitted weights the gradient of the
    regularised log loss is near zero."""
    import numpy as np

    from polarity.operators import model as T
    rng = np.random.default_rng(3)
    words = [f"w{i}" for i in range(12)]
    rows = []
    for i in range(120):
        y = int(rng.random() < 0.5)
        toks = [w for k, w in enumerate(words) if rng.random() < (0.6 if k % 2 == y else 0.3)]
        rows.append((i, toks or ["w0"], y))
    df = spark.createDataFrame(rows, "id long, tokens array<string>, label int")
    reg = 0.05
    m = T.fit_lr(df, max_iter=300, reg=reg)
    vocab, lr = m.stages[0].vocabulary, m.stages[1]
    assert sorted(vocab) == sorted(words)  # a feature per word, none shared
    x = np.array([[t.count(w) for w in vocab] for _, t, _ in rows], float)
    y = np.array([r[2] for r in rows], float)
    beta, b = lr.coefficients.toArray(), lr.intercept
    p = 1 / (1 + np.exp(-(x @ beta + b)))
    sd = x.std(axis=0, ddof=1)  # the penalty is on standardised features
    grad = x.T @ (p - y) / len(y) + reg * beta * sd * sd
    assert np.abs(grad).max() < 1e-3 and abs((p - y).mean()) < 1e-3
