"""Scores, losses, step windows, drift and histograms.

All are DataFrame aggregations with partial (map-side) combine: one-row
results are single global aggregates, grouped results group on keys whose
hot values are combined before the shuffle. Nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from polarity.functions.arrays import log_sum_exp, softplus
from polarity.operators.joins import broadcast_if_small
from polarity.operators.ordering import ordered_rank
from polarity.session import checkpoint


def accuracy_columns(pred: str = "pred", label: str = "label") -> list:
    """Aggregate expressions of A3, to combine with others in one pass."""
    p, y = F.col(pred), F.col(label)
    return [F.count(F.lit(1)).alias("n"),
            F.count_if(p == y).alias("correct"),
            F.avg((p == y).cast("double")).alias("accuracy"),
            F.count_if((p == 1) & (y == 1)).alias("tp"),
            F.count_if((p == 1) & (y != 1)).alias("fp"),
            F.count_if((p != 1) & (y != 1)).alias("tn"),
            F.count_if((p != 1) & (y == 1)).alias("fn")]


def accuracy(scored: DataFrame, pred: str = "pred", label: str = "label",
             by: list | None = None, extra: list | None = None) -> DataFrame:
    """A3: n, correct, accuracy and the confusion counts (per group if
    ``by``); ``extra`` adds aggregate columns to the same pass."""
    aggs = accuracy_columns(pred, label) + list(extra or [])
    g = scored.groupBy(*by) if by else scored
    return g.agg(*aggs)


def weighted_mean(df: DataFrame, value: str, weight: str, by: list | None = None,
                  out: str = "loss") -> DataFrame:
    """A4: sum(value * weight) / sum(weight) - the sample-weighted mean."""
    e = (F.sum(F.col(value).cast("double") * F.col(weight))
         / F.sum(F.col(weight).cast("double"))).alias(out)
    return df.groupBy(*by).agg(e) if by else df.agg(e)


def step_window_metrics(steps: DataFrame, every: int = 50, epoch: str = "epoch",
                        order: list | None = None, loss: str = "loss",
                        size: str = "batch_size", correct: str | None = None) -> DataFrame:
    """A5: tumbling windows of ``every`` steps inside each epoch (the last one
    may be short), with a running window number over all epochs.

    Output: epoch, window (0-based inside the epoch), global_step (1-based,
    counting windows of earlier epochs), steps, samples, loss (sample
    weighted) and, with ``correct``, acc = correct / samples.

    The step order inside an epoch comes from ``ordered_rank`` (range
    partitioned), so one huge epoch is never numbered in a single task.
    """
    order = order or ["step"]
    needed = list(dict.fromkeys([epoch, *order, loss, size, *([correct] if correct else [])]))
    ranked = ordered_rank(steps.select(*needed), order, [epoch], rank_col="_rank")
    win = ranked.withColumn("window", (F.col("_rank") / every).cast("long"))
    aggs = [F.count(F.lit(1)).alias("steps"),
            F.sum(F.col(size)).cast("long").alias("samples"),
            (F.sum(F.col(loss).cast("double") * F.col(size))
             / F.sum(F.col(size).cast("double"))).alias("loss")]
    if correct:
        aggs.append((F.sum(F.col(correct).cast("double"))
                     / F.sum(F.col(size).cast("double"))).alias("acc"))
    per_win = checkpoint(win.groupBy(epoch, "window").agg(*aggs), "windows")
    # windows per epoch -> offsets; one row per epoch
    per_epoch = per_win.groupBy(epoch).agg(F.count(F.lit(1)).alias("_nw"))
    running = Window.orderBy(epoch).rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_epoch.select(epoch, F.coalesce(F.sum("_nw").over(running), F.lit(0))
                               .alias("_woff"))
    return (per_win.join(broadcast_if_small(offsets), epoch)
            .withColumn("global_step", (F.col("_woff") + F.col("window") + 1).cast("long"))
            .drop("_woff"))


def epoch_summary(steps: DataFrame, metrics: list, epoch: str = "epoch") -> DataFrame:
    """Plain (unweighted) mean over steps of each metric, per epoch."""
    return steps.groupBy(epoch).agg(
        F.count(F.lit(1)).alias("steps"),
        *[F.avg(F.col(m).cast("double")).alias(f"{m}_mean") for m in metrics])


def gan_losses(df: DataFrame, logits: str = "logits", label: str = "label",
               role: str = "role", unlabel_weight: float = 1.0) -> DataFrame:
    """A7 + A8 in one pass over a table whose ``role`` is 'labeled', 'real'
    (unlabelled) or 'fake' (generated):

    sup   = mean over labeled of LSE - logit[label]
    unsup = 0.5 * (-mean_real LSE + mean_real softplus(LSE) + mean_fake softplus(LSE))
    total = sup + unlabel_weight * unsup
    """
    lse = log_sum_exp(logits)
    r = F.col(role)
    picked = F.element_at(F.col(logits).cast("array<double>"), F.col(label) + 1)
    sup = F.avg(F.when(r == "labeled", lse - picked))
    real_lse = F.avg(F.when(r == "real", lse))
    real_sp = F.avg(F.when(r == "real", softplus(lse)))
    fake_sp = F.avg(F.when(r == "fake", softplus(lse)))
    unsup = F.lit(0.5) * (-real_lse + real_sp + fake_sp)
    return df.agg(sup.alias("sup_loss"), unsup.alias("unsup_loss"),
                  (sup + F.lit(float(unlabel_weight)) * unsup).alias("total_loss"))


def mean_vector(df: DataFrame, vec: str = "vector", by: list | None = None) -> DataFrame:
    """Per-dimension mean, long form (by..., pos, mean). The array is
    exploded and averaged with a partial aggregate; it is never gathered."""
    by = list(by or [])
    ex = df.select(*by, F.posexplode(F.col(vec).cast("array<double>")).alias("pos", "x"))
    return ex.groupBy(*by, "pos").agg(F.avg("x").alias("mean"))


def feature_gap(df: DataFrame, is_a, vec: str = "vector") -> DataFrame:
    """A10: mean over dimensions of (mean_a - mean_b)^2, where ``is_a`` picks
    the first set and the rest is the second; one pass."""
    ex = df.select(is_a.alias("_a"),
                   F.posexplode(F.col(vec).cast("array<double>")).alias("pos", "x"))
    per_dim = ex.groupBy("pos").agg(
        F.avg(F.when(F.col("_a"), F.col("x"))).alias("ma"),
        F.avg(F.when(~F.col("_a"), F.col("x"))).alias("mb"))
    return per_dim.agg(F.avg(F.pow(F.col("ma") - F.col("mb"), 2)).alias("feature_gap"))


def feature_histogram(df: DataFrame, lo: float, hi: float, bins: int, vec: str = "vector",
                      by: list | None = None) -> DataFrame:
    """Counts of all vector elements in ``bins`` equal buckets on
    [lo, hi); bucket 0 below, bins + 1 at or above hi."""
    by = list(by or [])
    x = F.col("x")
    raw = F.floor((x - F.lit(lo)) * F.lit(float(bins)) / F.lit(hi - lo)) + 1
    bucket = (F.when(x < F.lit(lo), F.lit(0)).when(x >= F.lit(hi), F.lit(bins + 1))
              .otherwise(F.least(raw, F.lit(bins)))).cast("int")
    ex = df.select(*by, F.explode(F.col(vec).cast("array<double>")).alias("x"))
    return ex.groupBy(*by, bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


def exponential_histogram(df: DataFrame, vec: str = "vector", by: list | None = None,
                          sub: int = 8) -> DataFrame:
    """A11 without bounds: counts of all vector elements in signed exponential
    buckets, (by..., sign, exponent, sub_bucket, lo, hi, n). The values 2^e <=
    |x| < 2^(e+1) of a sign are parted into ``sub`` equal buckets (a power of
    two, so that bucket edges are exact); 0 has sign 0; values that are not
    finite have sign 2 (NaN), 3 (infinity) and -3 and no edges. Nulls are not
    counted. One pass; counts of two tables with the same ``sub`` may be added."""
    if sub < 1 or sub & (sub - 1):
        raise ValueError("sub must be a power of two")
    by = list(by or [])
    x, size = F.col("x"), F.abs("x")
    finite = ~F.isnan(x) & (size != float("inf"))
    sign = (F.when(F.isnan(x), 2).when(size == float("inf"), 3 * F.signum(x))
            .otherwise(F.signum(x))).cast("int")
    power = lambda e: F.pow(F.lit(2.0), e)  # noqa: E731 - exact for whole numbers
    real = finite & (size > 0)
    guess = F.when(real, F.floor(F.log2(size))).cast("int")  # may be off by one at an edge
    ex = df.select(*by, F.explode(F.col(vec).cast("array<double>")).alias("x")).where("x is not null")
    ex = ex.select(*by, "x", sign.alias("sign"), guess.alias("_e"))
    exponent = (F.when(size < power(F.col("_e")), F.col("_e") - 1)
                .when(size >= power(F.col("_e") + 1), F.col("_e") + 1).otherwise(F.col("_e")))
    ex = ex.withColumn("exponent", exponent.cast("int"))
    part = F.floor((size / power(F.col("exponent")) - 1) * sub).cast("int")
    ex = ex.withColumn("sub_bucket", part)
    out = ex.groupBy(*by, "sign", "exponent", "sub_bucket").agg(F.count(F.lit(1)).alias("n"))
    edge = lambda k: (1 + (F.col("sub_bucket") + k) / F.lit(float(sub))) * power(
        F.col("exponent")) * F.col("sign")
    low, high = F.least(edge(0), edge(1)), F.greatest(edge(0), edge(1))
    zero = F.when(F.col("sign") == 0, F.lit(0.0))
    return out.select(*by, "sign", "exponent", "sub_bucket", F.coalesce(zero, low).alias("lo"),
                      F.coalesce(zero, high).alias("hi"), "n")


def latest_per_id(df: DataFrame, key: str, value: str, order: list) -> DataFrame:
    """One row per key holding the value of its last row (last write
    wins) by ``order``."""
    ordkey = F.struct(*[F.col(c) for c in order])
    return df.groupBy(key).agg(F.max_by(F.col(value), ordkey).alias(value))
