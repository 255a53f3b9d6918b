"""End-to-end plans (T4 and the semi-supervised path).

Supervised (the reference's main run): read -> strip tags -> encode labels
-> train/valid split (or use all) -> fit -> validation metrics -> score the
test set -> strict submission -> CSV.

Semi-supervised: three-way split -> fit with labelled + unlabelled rows ->
accuracy on the test part, plus the epoch batch plan (tiled labelled rows
zipped with two unlabelled passes).
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from polarity.config import DEFAULTS, Defaults
from polarity.functions.arrays import softplus
from polarity.functions.text import encode_label, strip_tags, tokenize
from polarity.operators.metrics import accuracy
from polarity.operators.model import (fit_lr, fit_nb, fit_semi_nb, make_submission,
                                      score_lr, score_nb)
from polarity.operators.sampling import (split_three, split_train_valid, tile, zip_batches)


@dataclass
class SupervisedResult:
    submission: DataFrame       # (key, sentiment)
    valid_metrics: DataFrame | None  # one row: n, correct, accuracy, ..., loss
    model: object


def _prepare(df: DataFrame, key: str, text: str, strip: bool) -> DataFrame:
    t = strip_tags(text) if strip else F.col(text)
    return df.withColumn("tokens", tokenize(t))


def run_supervised(train_df: DataFrame, test_df: DataFrame, key: str = "id",
                   text: str = "review", sentiment: str = "sentiment",
                   cfg: Defaults = DEFAULTS, use_all: bool = True, kind: str = "nb",
                   strip: bool = True, out_path: str | None = None) -> SupervisedResult:
    """T4: fit on the labelled reviews, report validation metrics when a
    validation part is held out, and build the submission for ``test_df``."""
    lab = _prepare(train_df.select(key, text, encode_label(sentiment).alias("label")),
                   key, text, strip)
    split = split_train_valid(lab, cfg.valid_frac, cfg.seed, key, use_all=use_all)
    train = split.filter(F.col("part") == "train")
    if kind == "nb":
        model = fit_nb(train.select("tokens", F.col("label").alias("p")), "tokens", "p")
        scorer = lambda d, carry=(): score_nb(d, model, key, carry=carry)
    elif kind == "lr":
        model = fit_lr(train, "tokens", "label")
        scorer = lambda d, carry=(): score_lr(d, model, key, carry)
    else:
        raise ValueError(f"unknown classifier kind {kind!r}")
    metrics = None
    if not use_all:
        valid = split.filter(F.col("part") == "valid")
        scored = scorer(valid.select(key, "tokens", "label"), ("label",))
        # log loss of the score read as a logit, softplus(s) - y*s, written
        # as softplus(-s) for y = 1 so it keeps its digits for large |s|
        loss = softplus(F.when(F.col("label") == 1, -F.col("score")).otherwise(F.col("score")))
        metrics = accuracy(scored, extra=[F.avg(loss).alias("loss")] if kind == "nb" else None)
    test = _prepare(test_df.select(key, text), key, text, strip)
    preds = scorer(test.select(key, "tokens"))
    sub = make_submission(test.select(key), preds, key)
    if out_path:
        from polarity.sources.reviews import write_submission
        write_submission(sub, out_path, key)
    return SupervisedResult(sub, metrics, model)


def run_semi(corpus: DataFrame, key: str = "id", text: str = "review",
             sentiment: str = "sentiment", cfg: Defaults = DEFAULTS, epoch: int = 0,
             rounds: int = 1, strip: bool = False):
    """Semi-supervised path: split three ways, fit with labelled and
    unlabelled parts, evaluate on the test part; also return the batch plan
    of one epoch. Returns (test_metrics, batch_plan, model)."""
    base = _prepare(corpus.select(key, text, encode_label(sentiment).alias("label")),
                    key, text, strip)
    parts = split_three(base, cfg.test_frac, cfg.label_frac, cfg.split_seed, key)
    lab = parts.filter(F.col("part") == "labeled")
    unl = parts.filter(F.col("part") == "unlabeled")
    test = parts.filter(F.col("part") == "test")
    model = fit_semi_nb(lab, unl, key, "tokens", "label", cfg.unlabel_weight, rounds)
    scored = score_nb(test.select(key, "tokens", "label"), model, key, carry=("label",))
    n_l, n_u = lab.count(), unl.count()
    if not n_u > n_l:
        raise ValueError("the unlabelled part must be larger than the labelled part")
    tiled = tile(lab.select(key, "label"), int(math.ceil(n_u / n_l)))
    plan = zip_batches(tiled, unl.select(key), cfg.batch_size, epoch,
                       seeds=(cfg.split_seed, cfg.split_seed + 1, cfg.split_seed + 2),
                       id_col=key)
    return accuracy(scored), plan, model
