"""Many shuffled epochs from one rank.

Every row gets its exact seeded position once (one exchange). The order of an
epoch is a keyed permutation of positions, computed per row: a Feistel network
on a grid of about sqrt(n) x sqrt(n) cells, walked along its cycles until it
lands below n. So ten epochs are ten times the rows, and still one exchange.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from polarity.operators.sampling import global_rank

#: modulus of the round functions (2^31 - 1; a fixed value)
PRIME = 2147483647
ROUNDS = 4


def round_keys(seed, epoch: int) -> list[tuple[int, int]]:
    """Multiplier and addend of each round."""
    out = []
    for k in range(ROUNDS):
        h = hashlib.md5(f"{seed}:{epoch}:{k}".encode()).hexdigest()
        out.append((int(h[:8], 16) % (PRIME - 1) + 1, int(h[8:16], 16) % PRIME))
    return out


def grid(n: int) -> tuple[int, int]:
    """Rows and columns of the smallest near-square grid of n cells or more."""
    a = max(1, math.isqrt(n - 1) + 1) if n > 0 else 1
    return a, max(1, -(-n // a))


def _pass(x, keys, a: int, b: int):
    """One pass of the network over cell numbers (Spark columns or numpy
    arrays): the halves take turns in moving each other."""
    left, right = (x - x % b) / b if isinstance(x, Column) else x // b, x % b
    if isinstance(x, Column):
        left = left.cast("long")
    for k, (m, c) in enumerate(keys):
        t = ((right if k % 2 == 0 else left) * m + c) % PRIME
        moved = t * t % PRIME
        if k % 2 == 0:
            left = (left + moved) % a
        else:
            right = (right + moved) % b
    return left * b + right


def walks(n: int, keys) -> int:
    """Passes that some position below n needs: one, and one for each cell of
    the longest chain of cells from n on (fewer than the grid has rows). Cells
    that only lead to each other are never entered and left out."""
    a, b = grid(n)
    x, passes = np.arange(n, a * b, dtype=np.int64), 1
    while len(x):
        after = _pass(x, keys, a, b)
        after = after[after >= n]
        if len(after) == len(x):  # closed cycles; every chain has ended
            break
        x, passes = after, passes + 1
    return passes


def permuted(pos: Column, n: int, keys, passes: int) -> Column:
    """Position ``pos`` (0 to n - 1) in the order that ``keys`` name."""
    a, b = grid(n)
    first = _pass(pos, keys, a, b)
    if passes == 1:
        return first
    return F.aggregate(F.sequence(F.lit(2), F.lit(passes)), first,
                       lambda x, _: F.when(x < n, x).otherwise(_pass(x, keys, a, b)))


def epoch_batches(df: DataFrame, size: int, epochs: int, seed=7, id_cols="id",
                  drop_last: bool = False) -> DataFrame:
    """Every row once per epoch, with epoch, batch_id and slot: a different
    order in each epoch, fixed by (seed, epoch) whatever the partitioning.
    ``drop_last`` removes each epoch's short final batch."""
    if epochs < 1:
        raise ValueError("epochs must be >= 1")
    n = df.count()
    if n > PRIME * PRIME:
        raise ValueError("too many rows for the round functions")
    ranked = global_rank(df, id_cols, seed, "_ep_pos")
    keys = [round_keys(seed, e) for e in range(epochs)]
    passes = max(walks(n, k) for k in keys)
    out = ranked.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))))

    def pick(k, i):
        return F.element_at(F.array(*[F.lit(e[k][i]).cast("long") for e in keys]), F.col("epoch") + 1)
    mine = [(pick(k, 0), pick(k, 1)) for k in range(ROUNDS)]
    out = out.withColumn("_ep_at", permuted(F.col("_ep_pos"), n, mine, passes))
    out = (out.withColumn("batch_id", F.floor(F.col("_ep_at") / size).cast("long"))
           .withColumn("slot", (F.col("_ep_at") % size).cast("int")).drop("_ep_pos", "_ep_at"))
    return out.filter(F.col("batch_id") < n // size) if drop_last else out
