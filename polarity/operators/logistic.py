"""Logistic regression whose weights are a table (T1-T3, lr).

The optimiser's vectors - weights, gradient, the last steps and gradient changes
of L-BFGS - are all D^-1 X' a for some number per document (X the counts, D the
words' deviations), so they are kept as that number and as their margins, in
Parquet rows by block of documents (``term_blocks``); the driver holds the
intercept's parts and about a hundred dot products, never a word or a document.
One iteration:

1. dot products of the columns, from the numbers and the margins; from them the
   two-loop recursion gives the search direction as a combination of the columns,
   and so its margins;
2. the step along it, from derivatives at a grid of steps, one pass over the
   documents' numbers alone (margins are linear in the step);
3. the residuals there, their sums by word and these sums' margins: one product
   with X X', which moves a number for every word that a block shares with others.

Objective, as in ``pyspark.ml`` with standardisation: the weighted mean log-loss
plus reg / 2 * sum((sd(word) * weight)^2); the intercept is free. Labels may be
soft. Words that do not vary have weight 0.
"""

from __future__ import annotations

import gc
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from polarity.operators import term_blocks as T
from polarity.operators.joins import (DEFAULT_BROADCAST_ROWS, dealt_lookup, frequent_keys,
                                      task_share)
from polarity.operators.model import HOT_WORDS, SOFT_DECIMALS
from polarity.session import checkpoint, drop_scratch, scratch_mark

#: steps tried along a direction, in one pass
STEPS = [2.0 ** k for k in range(-8, 0)] + [0.7, 0.85, 1.0, 1.2, 1.4, 2.0, 4.0, 8.0, 16.0]
#: term rows a lookup task may hold, at least
ROWS_PER_TASK = 1_000_000
#: iterations after which shuffle files of earlier ones are let go
FREED = 1


@dataclass
class TermLR:
    weights: DataFrame   # (word, weight)
    counts: DataFrame    # (word, n): rows of the term table with the word
    intercept: float
    n_words: int
    iterations: int
    gradient: float      # norm at the end, in standardised weights


def _margins(rows: DataFrame, key: str, table: DataFrame, counts: DataFrame, n_words: int,
             max_broadcast_rows: int, out: str) -> DataFrame:
    """(key, out): sum of tf * v over the words of each document; ``table`` is
    (word, v). Documents without known words give 0."""
    rows = rows.select(key, "word", "tf")
    total = F.sum(F.coalesce("v", F.lit(0.0)) * F.col("tf")).alias(out)
    if n_words <= min(max_broadcast_rows, HOT_WORDS):
        return rows.join(F.broadcast(table), "word", "left").groupBy(key).agg(total)
    # frequent words where the rows lie; only the rows of others are moved
    frequent = F.broadcast(frequent_keys(counts, "word", HOT_WORDS))
    head = F.broadcast(table.join(frequent, "word", "left_semi"))
    rest = rows.where("word is not null").join(frequent, "word", "left_anti")
    few = counts.join(frequent, "word", "left_anti")
    n = few.agg(F.sum("n")).first()[0] or 0
    others = dealt_lookup(rest, "word", table.join(frequent, "word", "left_anti"), few,
                          F.xxhash64(key, "word"), task_share(rows.sparkSession, n, ROWS_PER_TASK))
    return (rows.join(head, "word", "left").groupBy(key).agg(total)
            .unionByName(others.groupBy(key).agg(total)).groupBy(key).agg(F.sum(out).alias(out)))


def _direction(names: list[str], dot, pairs: list[int]) -> dict[str, float]:
    """Two-loop recursion on dot products: the direction's coefficients of the
    columns; ``pairs`` are the slots of the history, oldest first."""
    c = dict.fromkeys(names, 0.0)
    c["g"] = -1.0
    along = lambda b: sum(c[a] * dot(a, b) for a in names if c[a])
    alpha = {}
    for i in reversed(pairs):
        alpha[i] = along(f"s{i}") / dot(f"s{i}", f"y{i}")
        c[f"y{i}"] -= alpha[i]
    if pairs:
        i = pairs[-1]
        scale = dot(f"s{i}", f"y{i}") / dot(f"y{i}", f"y{i}")
        c = {a: v * scale for a, v in c.items()}
    for i in pairs:
        beta = along(f"y{i}") / dot(f"s{i}", f"y{i}")
        c[f"s{i}"] += alpha[i] - beta
    return c


def _columns(b, r: int) -> tuple:
    """The state of a block: labels, weights, margins z, and of every column a number per
    document (``a``: the column is D^-1 X' a) and its margins (``m``)."""
    y, lam, z, a, m = (T.array_of(b.column(c), r, np.float64) for c in ("y", "lam", "z", "a", "m"))
    return y, lam, z, a.reshape(-1, len(y)), m.reshape(-1, len(y))


def _slopes(b, r: int, c: list[float], free: float) -> list[float]:
    """Of a block, the loss's derivatives along the direction at each of STEPS."""
    y, lam, z, _, m = _columns(b, r)
    zd = np.asarray(c) @ m + free
    with np.errstate(over="ignore"):
        return [float((lam * zd * (1 / (1 + np.exp(-(z + t * zd))) - y)).sum()) for t in STEPS]


def _step(slopes: list[float], total: float, slope0: float, penalty) -> float:
    """The step where the derivative along the direction is about 0, from the loss's at
    each of STEPS; ``penalty`` is the regulariser's derivative at a step."""
    low, low_slope = 0.0, slope0
    for t, s in zip(STEPS, slopes):
        slope = s / total + penalty(t)
        if slope >= 0:
            gap = slope - low_slope
            return low + (t - low) * (-low_slope / gap if gap > 0 else 0.5)
        low, low_slope = t, slope
    return low


def free_shuffles(spark) -> None:
    """Have files of shuffles that nothing refers to any more deleted; else they stay until
    the driver's JVM happens to collect its garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


STATE = ("part long, y binary, lam binary, z binary, a binary, m binary, dots array<double>, "
         "free double")


def _started(columns: int, intercept: float):
    def run(batches):
        for b in batches:
            for r in range(b.num_rows):
                y, lam = (T.array_of(b.column(c), r, np.float64) for c in ("y", "lam"))
                none = np.zeros(columns * len(y)).tobytes()
                z = np.full(len(y), intercept).tobytes()
                yield pa.RecordBatch.from_pylist(
                    [dict(part=b.column("part")[r].as_py(), y=y.tobytes(), lam=lam.tobytes(), z=z, a=none,
                          m=none, dots=[], free=0.0)], schema=T.arrow_schema(STATE))
    return run


def _moved(names: list[str], c: dict[str, float], step: float, free: float, total: float, reg: float,
           slot: int | None):
    """The two halves of a step along the direction ``c`` for a block: its residuals, and,
    from their margins, its state with the step and the gradient's change in history
    slot ``slot`` and the dot products of all columns. Column 0 is u, column 1 is g."""
    along = np.array([c.get(k, 0.0) for k in names])

    def there(b, r):
        y, lam, z, a, m = _columns(b, r)
        da, dm = step * (along @ a), step * (along @ m)
        z = z + dm + step * free
        with np.errstate(over="ignore"):
            return y, lam, z, a, m, da, dm, lam * (1 / (1 + np.exp(-z)) - y) / total

    def residuals(b, r):
        return there(b, r)[-1]

    def moved(b, r, residual, margins):
        y, lam, z, a, m, da, dm, _ = there(b, r)
        a, m = a.copy(), m.copy()
        for x, d, g in ((a, da, residual), (m, dm, margins)):
            x[0] += d
            g = g + reg * x[0]
            if slot is not None:
                x[2 + 2 * slot], x[3 + 2 * slot] = d, g - x[1]
            x[1] = g
        return (y.tobytes(), lam.tobytes(), z.tobytes(), a.tobytes(), m.tobytes(),
                (a @ m.T).ravel().tolist(), float(residual.sum()))
    return residuals, moved


def _fit(rows: DataFrame, docs: DataFrame, key: str, reg: float, max_iter: int, tol: float,
         history: int) -> TermLR:
    """Fit from term rows (key, word, tf; a null word per document) and (key,
    y, lam) of the documents."""
    spark = rows.sparkSession
    free_shuffles(spark)  # of the term table
    begun = scratch_mark()
    docs = checkpoint(docs.where("lam > 0").select(key, F.col("y").cast("double").alias("y"),
                                                   F.col("lam").cast("double").alias("lam")), "lr-docs")
    lam = F.col("lam")
    whole = docs.agg(F.sum(lam).alias("w"), F.sum(lam * lam).alias("w2"),
                     F.sum(lam * F.col("y")).alias("pos")).first()
    total = whole["w"] or 0.0
    share = (whole["pos"] or 0.0) / total if total else 0.0
    if not 0 < share < 1:
        raise ValueError("logistic regression needs rows of both classes")
    spread = total - whole["w2"] / total
    matrix = T.Blocks(rows, docs, key, total, spread if spread > 0 else 1.0)
    columns = ["u", "g"] + [f"{c}{i}" for i in range(history) for c in "sy"]
    intercept = math.log(share / (1 - share))
    free_of = dict.fromkeys(columns, 0.0)  # the intercept's part of each column
    mark = scratch_mark()

    def sums(rows, size):  # in the order of the blocks
        return np.sum([r[1] for r in sorted(rows, key=lambda r: r[0])] or [np.zeros(size)], axis=0)

    def moved(state, c, step, free, slot):
        new = matrix.product(state, *_moved(columns, c, step, free, total, reg, slot), STATE, "lr-state")
        got = new.select("part", F.concat("dots", F.array("free"))).collect()
        T.forget(state)
        *dots, free = sums(got, len(columns) ** 2 + 1).tolist()
        return new, np.reshape(dots, (len(columns), -1)), free

    start = matrix.blocks.select("part", "y", "lam").mapInArrow(_started(len(columns), intercept), STATE)
    state = T.kept(start, matrix.n, "lr-state")
    state, inside, free_of["g"] = moved(state, {}, 0.0, 0.0, None)
    place = {a: k for k, a in enumerate(columns)}
    pairs: list[int] = []
    done, norm = 0, float("inf")
    while True:
        until = scratch_mark()
        names = ["g"] + [f"{c}{i}" for i in pairs for c in "sy"]
        word = lambda a, b: float(inside[place[a], place[b]] + inside[place[b], place[a]]) / 2  # noqa: E731,B023
        dot = lambda a, b: word(a, b) + free_of[a] * free_of[b]
        norm = math.sqrt(max(dot("g", "g"), 0.0))
        if norm <= tol or done == max_iter:
            break
        c = _direction(names, dot, pairs)
        slope = sum(c[a] * dot(a, "g") for a in names)
        if slope >= 0:  # rounding has spoiled the history: start again downhill
            pairs, names, c = [], ["g"], {"g": -1.0}
            slope = -dot("g", "g")
        free = sum(c[a] * free_of[a] for a in names)
        ud = sum(c[a] * word("u", a) for a in names)
        dd = sum(c[a] * c[b] * word(a, b) for a in names for b in names)
        along = [c.get(a, 0.0) for a in columns]
        got = state.mapInArrow(_each(_slopes, along, free), "part long, slopes array<double>").collect()
        step = _step(sums(got, len(STEPS)).tolist(), total, slope, lambda t: reg * (ud + t * dd))  # noqa: B023
        slot = pairs.pop(0) if len(pairs) == history else len(pairs)
        state, inside, g0 = moved(state, c, step, free, slot)
        intercept += step * free
        free_of[f"s{slot}"], free_of[f"y{slot}"], free_of["g"] = step * free, g0 - free_of["g"], g0
        pairs.append(slot)
        drop_scratch(spark, mark, until)
        done += 1
        if done % FREED == 0:
            free_shuffles(spark)
    until = scratch_mark()
    words = checkpoint(matrix.by_word(state, lambda b, r: _columns(b, r)[3][0]), "lr-weights")
    T.forget(state)
    matrix.forget()
    drop_scratch(spark, begun, until)
    return TermLR(words.select("word", F.col("value").alias("weight")), words.select("word", "n"),
                  intercept, matrix.n_words, done, norm)


def _each(of, *args):
    """mapInArrow: (part, list of numbers) of every row of a state."""
    def run(batches):
        for b in batches:
            for r in range(b.num_rows):
                yield pa.RecordBatch.from_arrays(
                    [b.column("part").slice(r, 1), pa.array([of(b, r, *args)])], ["part", "slopes"])
    return run


def fit_lr_terms(terms: DataFrame, key: str = "id", label: str = "label", reg: float = 0.01,
                 max_iter: int = 100, tol: float = 1e-6, history: int = 5,
                 max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> TermLR:
    """T1 (lr): fit from a term table (``model.term_table``) that carries
    ``label``, null on documents to leave out."""
    known = terms.where(F.col(label).isNotNull())
    docs = known.where("word is null").select(key, F.col(label).alias("y"), F.lit(1.0).alias("lam"))
    return _fit(known, docs, key, reg, max_iter, tol, history)


def fit_weighted_terms(terms: DataFrame, key: str, label: str, weight: str, reg: float,
                       max_iter: int, tol: float = 1e-6, history: int = 5,
                       max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> TermLR:
    """T1 (lr): the same with a weight on every document."""
    docs = terms.where("word is null").select(key, F.col(label).alias("y"), F.col(weight).alias("lam"))
    return _fit(terms, docs, key, reg, max_iter, tol, history)


def score_lr_terms(terms: DataFrame, model: TermLR, key: str = "id",
                   max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """T2 (lr): (key, score = P(positive), pred) of every document."""
    z = _margins(terms, key, model.weights.withColumnRenamed("weight", "v"), model.counts,
                 model.n_words, max_broadcast_rows, "z")
    p = 1 / (1 + F.exp(-(F.col("z") + model.intercept)))
    return z.select(key, p.alias("score")).select(key, "score",
                                                  (F.col("score") > 0.5).cast("int").alias("pred"))


def fit_semi_lr_terms(terms: DataFrame, key: str = "id", label: str = "label",
                      unlabel_weight: float = 1.0, rounds: int = 1, reg: float = 0.01,
                      max_iter: int = 100, tol: float = 1e-6,
                      max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> TermLR:
    """T3 (lr): fit on labelled documents, label the others softly, refit on
    all with the others weighted by ``unlabel_weight``; ``rounds`` times."""
    model = fit_lr_terms(terms, key, label, reg, max_iter, tol,
                         max_broadcast_rows=max_broadcast_rows)
    heads = terms.where("word is null").select(key, F.col(label).cast("double").alias("_y"))
    for _ in range(rounds):
        soft = score_lr_terms(terms, model, key, max_broadcast_rows).select(
            key, F.round("score", SOFT_DECIMALS).alias("_p"))
        docs = heads.join(soft, key).select(
            key, F.coalesce("_y", "_p").alias("y"),
            F.when(F.col("_y").isNotNull(), 1.0).otherwise(float(unlabel_weight)).alias("lam"))
        model = _fit(terms, docs, key, reg, max_iter, tol, 5)
    return model
