"""Sampling, splitting, shuffling and batching.

Contract (the reference's generators cannot be replayed row for row): exact
sizes, disjoint and covering parts, deterministic per seed, independent of
partitioning. A row's random order is ``order_key(seed, *keys)`` (md5 hex),
ties broken by the keys themselves, so the key columns should be unique.

Samples and splits never sort the data: the k-th smallest order key is found
from bounded hash-prefix counts (at most 4096 rows per round, a few rounds
even at 10^11 rows), after which membership is a plain filter ``key < T``
that runs inside the scan stage.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from polarity.functions.hashing import order_key
from polarity.operators.ordering import hash_rank, ordered_rank

_H = "_smp_h"
PREFIX_STEP = 3          # hex digits per refinement round: <= 4096 groups
EXACT_ROWS = 200_000     # a bucket this small is ranked directly


def _keys(id_cols) -> list[str]:
    return [id_cols] if isinstance(id_cols, str) else list(id_cols)


def exact_count(frac: float, n: int, how: str = "round") -> int:
    """Sample size: round half to even (pandas ``sample``) or ceil (the
    train/valid split's validation part)."""
    x = frac * n
    return int(math.ceil(x)) if how == "ceil" else int(round(x))


def _key_less(hcol: str, id_cols: list[str], t) -> Column:
    """(h, id1, id2, ...) < t, lexicographically."""
    vals = [t[hcol]] + [t[c] for c in id_cols]
    cols = [F.col(hcol)] + [F.col(c) for c in id_cols]
    cond = None
    for i in range(len(cols) - 1, -1, -1):
        here = cols[i] < F.lit(vals[i])
        cond = here if cond is None else (here | ((cols[i] == F.lit(vals[i])) & cond))
    return cond


def kth_key(keyed: DataFrame, hcol: str, id_cols: list[str], n: int, k: int):
    """The row key at 0-based position ``k`` in (hcol, *id_cols) order, or
    None when k >= n. Only bounded aggregates reach the driver."""
    if k >= n:
        return None
    prefix, before, size = "", 0, n
    narrow = keyed.select(hcol, *id_cols)
    while size > EXACT_ROWS:
        if len(prefix) >= 32:
            # one key repeated on more than EXACT_ROWS rows: no threshold can
            # split it; the caller ranks instead
            raise RepeatedKey(prefix)
        plen = len(prefix) + PREFIX_STEP
        sub = narrow.filter(F.col(hcol).startswith(prefix)) if prefix else narrow
        buckets = (sub.groupBy(F.substring(hcol, 1, plen).alias("b"))
                   .agg(F.count(F.lit(1)).alias("c")).collect())
        for row in sorted(buckets, key=lambda r: r["b"]):
            if before + row["c"] > k:
                prefix, size = row["b"], row["c"]
                break
            before += row["c"]
    sub = narrow.filter(F.col(hcol).startswith(prefix)) if prefix else narrow
    rows = (sub.orderBy(F.col(hcol), *[F.col(c) for c in id_cols])
            .offset(k - before).limit(1).collect())
    return rows[0].asDict()


class RepeatedKey(Exception):
    """Raised when one sort key covers too many rows for a threshold."""


def _threshold(df: DataFrame, seed, id_cols: list[str], k: int, n: int):
    """Threshold for "first k rows in seeded order": False (none), True (all)
    or the k-th key as a dict with the hash under ``_smp_h``."""
    if k <= 0:
        return False
    keyed = df.withColumn(_H, order_key(seed, *id_cols))
    t = kth_key(keyed, _H, id_cols, n, k)
    return True if t is None else t


def _below(hcol: str, id_cols: list[str], t) -> Column:
    if t is True or t is False:
        return F.lit(t)
    t = dict(t)
    t[hcol] = t.pop(_H)
    return _key_less(hcol, id_cols, t)


def global_rank(df: DataFrame, id_cols="id", seed=7, pos_col: str = "pos") -> DataFrame:
    """0-based exact position of every row in seeded random order."""
    ids = _keys(id_cols)
    keyed = df.withColumn(_H, order_key(seed, *ids))
    return hash_rank(keyed, _H, ids, pos_col).drop(_H)


def sample_exact(df: DataFrame, frac: float, seed=7, id_cols="id") -> DataFrame:
    """A seeded sample of exactly round_half_even(frac * n) rows."""
    ids = _keys(id_cols)
    n = df.count()
    k = exact_count(frac, n)
    try:
        t = _threshold(df, seed, ids, k, n)
    except RepeatedKey:
        return _first_k_by_rank(df, seed, ids, k, n)
    return df.withColumn(_H, order_key(seed, *ids)).filter(_below(_H, ids, t)).drop(_H)


def _first_k_by_rank(df: DataFrame, seed, ids: list[str], k: int, n: int) -> DataFrame:
    """Exact first-k when keys repeat: rank (skew-safe) and filter."""
    keyed = df.withColumn(_H, order_key(seed, *ids))
    return (hash_rank(keyed, _H, ids, "_smp_pos", n=n)
            .filter(F.col("_smp_pos") < k).drop(_H, "_smp_pos"))


def sample_approx(df: DataFrame, frac: float, seed=7, id_cols="id") -> DataFrame:
    """D1, approximate form: keep rows whose hash falls below frac; no count,
    no shuffle, expected size frac * n."""
    ids = _keys(id_cols)
    h = F.conv(F.substring(order_key(seed, *ids), 1, 8), 16, 10).cast("long")
    return df.filter(h < F.lit(int(frac * 16 ** 8)))


def split_three(df: DataFrame, test_frac: float = 0.3, label_frac: float = 0.2,
                seed=7, id_cols="id", part_col: str = "part") -> DataFrame:
    """train = round((1-test_frac) n) rows, the rest test; inside train,
    round(label_frac * train) rows labeled, the rest unlabeled.

    The second draw uses its own order key ("<seed>/labeled") so the two
    draws are independent.
    """
    ids = _keys(id_cols)
    n = df.count()
    n_train = exact_count(1 - test_frac, n)
    t_train = _threshold(df, seed, ids, n_train, n)
    h2 = "_smp_h2"
    keyed = (df.withColumn(_H, order_key(seed, *ids))
             .withColumn(h2, order_key(f"{seed}/labeled", *ids)))
    in_train = _below(_H, ids, t_train)
    train = keyed.filter(in_train).drop(_H, h2)
    t_lab = _threshold(train, f"{seed}/labeled", ids, exact_count(label_frac, n_train), n_train)
    return (keyed.withColumn(part_col,
                             F.when(in_train & _below(h2, ids, t_lab), F.lit("labeled"))
                             .when(in_train, F.lit("unlabeled"))
                             .otherwise(F.lit("test")))
            .drop(_H, h2))


def split_train_valid(df: DataFrame, frac: float = 0.1, seed=230, id_cols="id",
                      use_all: bool = False, part_col: str = "part") -> DataFrame:
    """ceil(frac * n) rows 'valid', the rest 'train'; ``use_all``
    keeps every row in 'train'."""
    if use_all:
        return df.withColumn(part_col, F.lit("train"))
    ids = _keys(id_cols)
    n = df.count()
    t = _threshold(df, seed, ids, exact_count(frac, n, "ceil"), n)
    return (df.withColumn(_H, order_key(seed, *ids))
            .withColumn(part_col, F.when(_below(_H, ids, t), F.lit("valid")).otherwise(F.lit("train")))
            .drop(_H))


def assign_batches(df: DataFrame, size: int, epoch: int = 0, seed=7, id_cols="id",
                   shuffle: bool = True, drop_last: bool = False) -> DataFrame:
    """Epoch, batch number and slot per row.

    With ``shuffle`` the order is seeded by (seed, epoch); without it rows keep
    key order. ``drop_last`` removes the short final batch.
    """
    ids = _keys(id_cols)
    n = df.count()
    if shuffle:
        keyed = df.withColumn(_H, order_key(f"{seed}:{epoch}", *ids))
        ranked = hash_rank(keyed, _H, ids, "_smp_pos", n=n).drop(_H)
    else:
        ranked = ordered_rank(df, ids, rank_col="_smp_pos")
    out = (ranked.withColumn("epoch", F.lit(epoch).cast("int"))
           .withColumn("batch_id", (F.col("_smp_pos") / size).cast("long"))
           .withColumn("slot", (F.col("_smp_pos") % size).cast("int"))
           .drop("_smp_pos"))
    if drop_last:
        out = out.filter(F.col("batch_id") < F.lit(n // size))
    return out


def tile(df: DataFrame, times: int, copy_col: str = "copy") -> DataFrame:
    """Repeat every row ``times`` times, numbering the copies."""
    if times < 1:
        raise ValueError("times must be >= 1")
    return df.withColumn(copy_col, F.explode(F.sequence(F.lit(0), F.lit(times - 1))))


def tile_to_cover(labeled: DataFrame, unlabeled: DataFrame, copy_col: str = "copy"):
    """D6 as used: tile the labelled rows ceil(U / L) times; needs U > L."""
    n_l, n_u = labeled.count(), unlabeled.count()
    if not n_u > n_l:
        raise ValueError(f"need more unlabelled than labelled rows ({n_u} <= {n_l})")
    return tile(labeled, int(math.ceil(n_u / n_l)), copy_col)


def zip_batches(labeled_tiled: DataFrame, unlabeled: DataFrame, size: int,
                epoch: int = 0, seeds=(1, 2, 3), id_col: str = "id",
                copy_col: str = "copy", label_col: str = "label") -> DataFrame:
    """Zip three shuffled, drop-last batch streams by (batch, slot):
    labelled (tiled), unlabelled pass 1, unlabelled pass 2. Stops at the
    shortest stream, as a zip does."""
    lab = assign_batches(labeled_tiled.select(id_col, copy_col, label_col), size, epoch,
                         seeds[0], [id_col, copy_col], drop_last=True)
    u1 = assign_batches(unlabeled.select(id_col), size, epoch, seeds[1], [id_col],
                        drop_last=True)
    u2 = assign_batches(unlabeled.select(id_col), size, epoch, seeds[2], [id_col],
                        drop_last=True)
    k = ["epoch", "batch_id", "slot"]
    return (lab.select(*k, F.col(id_col).alias("label_id"), F.col(copy_col).alias("label_copy"),
                       F.col(label_col).alias("label"))
            .join(u1.select(*k, F.col(id_col).alias("unlabel1_id")), k)
            .join(u2.select(*k, F.col(id_col).alias("unlabel2_id")), k))
