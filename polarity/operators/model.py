"""Fit and score two-class text classifiers (T1-T3), strict submission
lookup (J4), latest prediction per id (A12 lives in metrics).

``nb``: multinomial naive Bayes in closed form, all DataFrame aggregates.
With p the (soft) label and lam the row weight of a document:

    a(w) = sum lam*p over occurrences of w,  b(w) = sum lam*(1-p)
    A, B = totals, V = distinct words
    weight(w) = ln((a+1)/(A+V)) - ln((b+1)/(B+V))
    prior = ln(sum lam*p / sum lam*(1-p)) over documents
    score(d) = prior + sum of weight over d's tokens (unknown word: 0)
    pred = score > 0

``lr``: logistic regression on the same tokens: ``pyspark.ml`` CountVectorizer +
LogisticRegression up to LR_WORDS words, beyond them the same objective with
weights as a table (``logistic``), so that no word list is on the driver.
"""

from __future__ import annotations

import math
import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from polarity.functions.text import decode_label
from polarity.operators.joins import (DEFAULT_BROADCAST_ROWS, dealt_lookup, frequent_keys,
                                      one_row_each, one_row_per_key, repeated_key, task_share)
from polarity.session import checkpoint, drop_scratch, scratch_mark, scratch_path

CLIP = 30.0
SOFT_DECIMALS = 6
# Term rows that one task of a dealt lookup may hold, at least.
ROWS_PER_TASK = 100_000
# Of a model beyond the broadcast bound, about as many of the most frequent
# words are broadcast all the same.
HOT_WORDS = 200_000
# Words up to which ``pyspark.ml`` fits a logistic regression: its driver holds
# every word and some twenty vectors of a number per word.
LR_WORDS = 1_500_000
# Tokens whose words a task counts at a time (about 50 bytes for each).
TOKENS = 1_000_000


@dataclass
class NBModel:
    weights: DataFrame  # (word, weight)
    prior: float
    n_words: int


def fit_nb(docs: DataFrame, tokens: str = "tokens", p: str = "p", lam: str | None = None) -> NBModel:
    """T1 (nb): fit from (tokens, p[, lam]) rows; p may be soft."""
    lam_c = F.col(lam).cast("double") if lam else F.lit(1.0)
    d = docs.select(F.col(tokens).alias("_t"), F.col(p).cast("double").alias("_p"),
                    lam_c.alias("_l"))
    # one pass: every document also emits a null "word" carrying its own
    # (lam*p, lam*(1-p)), whose group gives the prior's numerator and
    # denominator alongside the word counts
    # (explode_outer: no inferred size filter re-running the tokenizer)
    return _fit_counts(d.select(F.explode_outer(F.concat("_t", F.array(
        F.lit(None).cast("string")))).alias("word"), F.lit(1).alias("tf"), "_p", "_l"))


def _fit_counts(occ: DataFrame) -> NBModel:
    """Fit from (word, tf, _p, _l) rows; the null word stands for documents."""
    mass = F.col("_l") * F.col("tf")
    grouped = occ.groupBy("word").agg(F.sum(mass * F.col("_p")).alias("a"),
                                      F.sum(mass * (1 - F.col("_p"))).alias("b"))
    grouped = checkpoint(grouped)
    per_word = grouped.filter(F.col("word").isNotNull())
    row = grouped.agg(
        F.sum(F.when(F.col("word").isNotNull(), F.col("a"))).alias("A"),
        F.sum(F.when(F.col("word").isNotNull(), F.col("b"))).alias("B"),
        F.count("word").alias("V"),
        F.max(F.when(F.col("word").isNull(), F.col("a"))).alias("pos"),
        F.max(F.when(F.col("word").isNull(), F.col("b"))).alias("neg")).first()
    big_a, big_b, v = row["A"] or 0.0, row["B"] or 0.0, row["V"]
    weight = (F.log((F.col("a") + 1) / F.lit(big_a + v))
              - F.log((F.col("b") + 1) / F.lit(big_b + v)))
    # mass = the word's weighted occurrences: tells the scorer its hot words
    weights = per_word.select("word", weight.alias("weight"),
                              (F.col("a") + F.col("b")).alias("mass"))
    if not row["pos"] or not row["neg"]:
        raise ValueError("naive Bayes needs rows of both classes")
    prior = math.log(row["pos"] / row["neg"])
    return NBModel(weights=weights, prior=prior, n_words=v)


def score_nb(df: DataFrame, model: NBModel, key: str = "id", tokens: str = "tokens",
             max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS, carry: tuple = ()) -> DataFrame:
    """T2 (nb): (key, *carry, score, pred) for every input row; ``carry``
    names columns that go along. ``key`` must be unique: two rows with one key
    fail the job, they are never merged.

    Vocabulary within the broadcast bound: tokens stream through a broadcast
    hash join and are summed per row map-side (one shuffle of one row per
    document). Beyond it the frequent words are broadcast, and what they leave
    is counted per (row, word), meets its weight by a shuffle join in which
    words are copied by their counts, and is added to the row's sum.
    """
    ex = df.select(key, *carry, F.posexplode_outer(tokens).alias("_pos", "word"))
    rows = one_row_per_key(F.col("_pos"))
    along = [F.first(c).alias(c) for c in carry]
    w = model.weights.select("word", "weight")
    if model.n_words <= max_broadcast_rows:
        j = ex.join(F.broadcast(w), "word", "left")
        sums = j.groupBy(key).agg(F.sum(F.coalesce(F.col("weight"), F.lit(0.0))).alias("_s"),
                                  rows.alias("_rows"), *along)
    else:
        head, tail = _by_frequency(w, _word_mass(model, ex))
        # a row per document, and one per document and word that head lacks
        left = F.when(F.col("weight").isNull(), F.col("word")).alias("word")
        tf = checkpoint(ex.join(F.broadcast(head), "word", "left").groupBy(key, left).agg(
            F.sum(F.coalesce(F.col("weight"), F.lit(0.0))).alias("_s"),
            F.count(F.lit(1)).alias("_tf"), rows.alias("_r"), *along), "terms")
        rest = tf.where("word is not null")
        j = _weighted(rest.select(key, "word", "_tf"), tail, key, checkpoint(
            rest.groupBy("word").agg(F.count(F.lit(1)).alias("n")), "word-counts"))
        zero = F.lit(0).cast("long")
        contrib = F.coalesce(F.col("weight"), F.lit(0.0)) * F.col("_tf")
        none = [F.lit(None).cast(tf.schema[c].dataType).alias(c) for c in carry]
        parts = tf.select(key, *carry, "_s", "_r").unionByName(
            j.select(key, *none, contrib.alias("_s"), zero.alias("_r")))
        along = [F.first(c, ignorenulls=True).alias(c) for c in carry]
        sums = parts.groupBy(key).agg(F.sum("_s").alias("_s"), F.sum("_r").alias("_rows"), *along)
    score = F.when(F.col("_rows") > 1, repeated_key(key)).otherwise(F.lit(model.prior)
                                                                    + F.col("_s"))
    return (sums.select(key, *carry, score.alias("score"))
            .select(key, *carry, "score", (F.col("score") > 0).cast("int").alias("pred")))


def _word_mass(model: NBModel, rows: DataFrame) -> DataFrame:
    """(word, n): how often words occur, by the mass the model gave them (by a
    count of the rows where it kept none)."""
    if "mass" in model.weights.columns:
        return model.weights.select("word", F.ceil("mass").alias("n"))
    return checkpoint(rows.where("word is not null").groupBy("word")
                      .agg(F.count(F.lit(1)).alias("n")), "word-counts")


def _by_frequency(weights: DataFrame, counts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows of ``weights`` with a frequent word, HOT_WORDS at most, and the others."""
    frequent = F.broadcast(frequent_keys(counts, "word", HOT_WORDS))
    return (weights.join(frequent, "word", "left_semi"), weights.join(frequent, "word", "left_anti"))


def _weighted(tf: DataFrame, weights: DataFrame, key: str, counts: DataFrame) -> DataFrame:
    """Term rows with their weight, by a shuffle join in which a word of more
    rows than a task's share is copied by its count."""
    total = counts.agg(F.sum("n")).first()[0] or 0
    return dealt_lookup(tf, "word", weights, counts, F.xxhash64(F.col(key), F.col("word")),
                        task_share(tf.sparkSession, total, ROWS_PER_TASK))


def soft_label(score) -> F.Column:
    """Probability of the positive class from a score, clipped and rounded so
    the refit does not hinge on the last bits of a float sum."""
    s = F.greatest(F.least(score, F.lit(CLIP)), F.lit(-CLIP))
    return F.round(F.lit(1.0) / (F.lit(1.0) + F.exp(-s)), SOFT_DECIMALS)


def _counted(carry: int):
    """mapInArrow: (key, *carry, tokens) to (key, *carry, terms), terms being the (word, tf)
    of a row's distinct words, and a null word with tf 1."""
    def run(batches):
        for b in batches:
            lists = b.column(carry + 1)
            sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy().astype(np.int64)
            cuts = np.searchsorted(np.cumsum(sizes), np.arange(TOKENS, int(sizes.sum()), TOKENS)) + 1
            for lo, hi in zip([0, *cuts], [*cuts, len(sizes)]):
                if hi <= lo:
                    continue
                tokens = lists.slice(lo, hi - lo).flatten()
                if tokens.null_count:
                    raise ValueError("a row has a null token")
                coded = tokens.dictionary_encode()
                none = len(coded.dictionary)  # the null word's number
                rows = np.arange(hi - lo, dtype=np.int64)
                at = np.repeat(rows, sizes[lo:hi]) * (none + 1) + coded.indices.to_numpy()
                at = np.sort(np.concatenate([at, rows * (none + 1) + none]))
                first = np.flatnonzero(np.diff(at, prepend=-1))
                row, word = np.divmod(at[first], none + 1)
                tf = np.diff(first, append=len(at))
                word = coded.dictionary.take(pa.array(word, mask=word == none))
                ends = np.searchsorted(row, np.arange(hi - lo + 1)).astype(np.int32)
                terms = pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays(
                    [word, pa.array(tf.astype(np.int64))], ["word", "tf"]))
                yield pa.RecordBatch.from_arrays(
                    [*(b.column(k).slice(lo, hi - lo) for k in range(carry + 1)), terms],
                    [*b.schema.names[:carry + 1], "_terms"])
    return run


def term_table(docs: DataFrame, key: str = "id", tokens: str = "tokens",
               carry: tuple = ()) -> DataFrame:
    """(key, *carry, word, tf) of every document, and one row per document
    with a null word and tf 1, written once as Parquet bucketed by ``key``
    under the shared checkpoint folder. Words are counted where a document lies.
    Sums per document and joins on the key then need no exchange, so fitting,
    scoring and refitting move per-word and per-document numbers only, never
    tokens. ``key`` must be unique."""
    spark = docs.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    one_row_each(docs, key)
    rows = docs.select(key, *carry, tokens)
    counted = rows.mapInArrow(_counted(len(carry)), StructType([*rows.schema.fields[:-1], StructField(
        "_terms", ArrayType(StructType([StructField("word", StringType()), StructField("tf", LongType())])))]))
    name = f"polarity_terms_{uuid.uuid4().hex}"
    (counted.repartition(n, key).select(key, *carry, F.inline("_terms")).write.bucketBy(n, key).sortBy(key)
     .option("path", scratch_path(spark, "terms")).saveAsTable(name))
    return spark.table(name)


def score_terms(terms: DataFrame, model: NBModel, key: str = "id",
                max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """(key, score, pred) from a term table."""
    w = model.weights.select("word", "weight")
    tf = terms.select(key, "word", "tf")
    score = F.sum(F.coalesce(F.col("weight"), F.lit(0.0)) * F.col("tf")).alias("_s")
    if model.n_words <= max_broadcast_rows:
        sums = tf.join(F.broadcast(w), "word", "left").groupBy(key).agg(score)
    else:
        # frequent words where the rows lie; only the rows of others are moved
        counts = _word_mass(model, tf)
        head, tail = _by_frequency(w, counts)
        head = F.broadcast(head)
        rest = tf.where("word is not null").join(head.select("word"), "word", "left_anti")
        others = _weighted(rest, tail, key, counts.join(head.select("word"), "word", "left_anti"))
        sums = (tf.join(head, "word", "left").groupBy(key).agg(score)
                .unionByName(others.groupBy(key).agg(score)).groupBy(key).agg(F.sum("_s").alias("_s")))
    return (sums.select(key, (F.lit(model.prior) + F.col("_s")).alias("score"))
            .select(key, "score", (F.col("score") > 0).cast("int").alias("pred")))


def fit_semi_terms(terms: DataFrame, key: str = "id", label: str = "label",
                   unlabel_weight: float = 1.0, rounds: int = 1) -> NBModel:
    """T3 over a term table whose ``label`` is null on unlabelled documents:
    fit on labelled ones, give the others soft labels from the model, refit on
    all with the unlabelled weighted by ``unlabel_weight``; ``rounds`` times."""
    known = terms.where(F.col(label).isNotNull()).select(
        "word", "tf", F.col(label).cast("double").alias("_p"), F.lit(1.0).alias("_l"))
    model = _fit_counts(known)
    unknown = terms.where(F.col(label).isNull()).select(key, "word", "tf")
    for _ in range(rounds):
        soft = score_terms(unknown, model, key).select(
            key, soft_label(F.col("score")).alias("_p"))
        both = unknown.join(soft, key).select("word", "tf", "_p",
                                              F.lit(float(unlabel_weight)).alias("_l"))
        model = _fit_counts(known.unionByName(both))
    return model


def fit_semi_nb(labeled: DataFrame, unlabeled: DataFrame, key: str = "id",
                tokens: str = "tokens", label: str = "label",
                unlabel_weight: float = 1.0, rounds: int = 1) -> NBModel:
    """Weighted self-training from two parts, through one term table."""
    both = labeled.select(key, tokens, F.col(label).cast("double").alias("_y")).unionByName(
        unlabeled.select(key, tokens, F.lit(None).cast("double").alias("_y")))
    return fit_semi_terms(term_table(both, key, tokens, ("_y",)), key, "_y", unlabel_weight, rounds)


def _lr_terms(df: DataFrame, tokens: str, carry: tuple) -> DataFrame:
    """A term table with a row id of its own (``_row``): keys may repeat."""
    return term_table(df.select(*carry, tokens, F.monotonically_increasing_id().alias("_row")),
                      "_row", tokens, carry)


def _word_count(terms: DataFrame) -> int:
    return terms.where("word is not null").select("word").distinct().count()


def _known(label: str) -> F.Column:
    return F.coalesce(F.col(label).cast("double"), F.raise_error(F.lit(f"null {label}")).cast("double"))


def fit_lr(df: DataFrame, tokens: str = "tokens", label: str = "label",
           weight: str | None = None, max_iter: int = 50, reg: float = 0.0):
    """T1 (lr): word counts + logistic regression (optionally row weighted).
    Every distinct word is a feature of its own. Up to LR_WORDS of them a
    ``PipelineModel``; beyond, a ``logistic.TermLR`` of the same objective."""
    data = df.withColumn("_label", F.col(label).cast("double"))
    lam = F.col(weight).cast("double") if weight else F.lit(1.0)
    mark = scratch_mark()
    terms = _lr_terms(data.select(tokens, F.col("_label").alias("_y"), lam.alias("_lam")),
                      tokens, ("_y", "_lam"))
    n = _word_count(terms)
    if n > LR_WORDS:
        from polarity.operators.logistic import fit_weighted_terms
        model = fit_weighted_terms(terms.withColumn("_y", _known("_y")), "_row", "_y", "_lam", reg, max_iter)
    drop_scratch(df.sparkSession, mark, mark + 1)
    if n > LR_WORDS:
        return model
    tf = CountVectorizer(inputCol=tokens, outputCol="_features", vocabSize=max(1, n), minDF=1.0)
    lr = LogisticRegression(featuresCol="_features", labelCol="_label", maxIter=max_iter,
                            regParam=reg, predictionCol="_pred",
                            probabilityCol="_prob", rawPredictionCol="_raw")
    if weight:
        lr.setWeightCol(weight)
    return Pipeline(stages=[tf, lr]).fit(data)


def fit_semi_lr(labeled: DataFrame, unlabeled: DataFrame, key: str = "id",
                tokens: str = "tokens", label: str = "label", unlabel_weight: float = 1.0,
                rounds: int = 1, **lr_args):
    """T3 (lr): weighted self-training with logistic regression.

    Binomial logistic regression takes 0/1 labels only, so an unlabelled row
    with soft label p enters as two weighted rows, (1, lam*p) and
    (0, lam*(1-p)); their log-loss is exactly the soft-label log-loss.
    Labelled rows keep weight 1. Soft labels are a lineage cut per round.
    With weights as a table (more than LR_WORDS words) labels may be soft, so
    all rounds work on one term table.
    """
    lab = labeled.select(key, tokens, F.col(label).cast("double").alias("_y"),
                         F.lit(1.0).alias("_w"))
    unl = unlabeled.select(key, tokens)
    both = lab.select(tokens, "_y", F.lit(True).alias("_lab")).unionByName(
        unl.select(tokens, F.lit(None).cast("double").alias("_y"), F.lit(False).alias("_lab")))
    mark = scratch_mark()
    terms = _lr_terms(both, tokens, ("_y", "_lab"))
    many = _word_count(terms) > LR_WORDS
    if many:
        from polarity.operators.logistic import fit_semi_lr_terms
        model = fit_semi_lr_terms(terms.withColumn("_y", F.when(F.col("_lab"), _known("_y"))), "_row", "_y",
                                  unlabel_weight, rounds, **{"reg": 0.0, "max_iter": 50, **lr_args})
    drop_scratch(unl.sparkSession, mark, mark + 1)
    if many:
        return model
    model = fit_lr(lab, tokens, "_y", weight="_w", **lr_args)
    for _ in range(rounds):
        soft = checkpoint(score_lr(unl, model, key)
                          .select(key, F.round("score", SOFT_DECIMALS).alias("_p")))
        both = F.explode(F.array(
            F.struct(F.lit(1.0).alias("_y"), (F.lit(float(unlabel_weight)) * F.col("_p")).alias("_w")),
            F.struct(F.lit(0.0).alias("_y"),
                     (F.lit(float(unlabel_weight)) * (1 - F.col("_p"))).alias("_w"))))
        u = (unl.join(soft, key).select(key, tokens, both.alias("_s"))
             .select(key, tokens, "_s._y", "_s._w").filter(F.col("_w") > 0))
        model = fit_lr(lab.unionByName(u), tokens, "_y", weight="_w", **lr_args)
    return model


def score_lr(df: DataFrame, model, key: str = "id", carry: tuple = ()) -> DataFrame:
    """T2 (lr): (key, *carry, score = P(positive), pred) for every input row."""
    if not isinstance(model, PipelineModel):
        from polarity.operators.logistic import score_lr_terms
        terms = _lr_terms(df, "tokens", (key, *carry))
        scored = score_lr_terms(terms, model, "_row")
        return (terms.where("word is null").select("_row", key, *carry).join(scored, "_row")
                .select(key, *carry, "score", "pred"))
    out = model.transform(df)
    return out.select(key, *carry, vector_to_array("_prob")[1].alias("score"),
                      F.col("_pred").cast("int").alias("pred"))


def make_submission(ids: DataFrame, preds: DataFrame, key: str = "id",
                    pred: str = "pred") -> DataFrame:
    """(key, sentiment) for every test row; a test id without a
    prediction fails the job, as the reference's dictionary lookup does."""
    j = ids.select(key).join(preds.select(key, pred), key, "left")
    missing = F.raise_error(F.concat(F.lit("no prediction for test id "),
                                     F.col(key).cast("string")))
    return j.select(key, F.when(F.col(pred).isNull(), missing)
                    .otherwise(decode_label(F.col(pred))).alias("sentiment"))
