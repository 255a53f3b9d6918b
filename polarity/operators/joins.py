"""Join helpers: size-checked broadcast, anti-join complement."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from polarity.session import checkpoint

# Broadcast only tables whose row count is checked below this bound (the
# hash relation of a few million short rows stays well under 1 GB).
DEFAULT_BROADCAST_ROWS = 2_000_000


def broadcast_if_small(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS,
                       known_rows: int | None = None) -> DataFrame:
    """Hint a broadcast only when the table is proven small.

    ``known_rows`` is an upper bound the caller already has (e.g. a ``limit``);
    otherwise the table is counted. Beyond the bound the plain DataFrame is
    returned and the planner picks a shuffle join (AQE splits skewed keys).
    """
    n = known_rows if known_rows is not None else df.count()
    return F.broadcast(df) if n <= max_rows else df


def complement(df: DataFrame, part: DataFrame, on="id") -> DataFrame:
    """Rows of ``df`` whose key is not in ``part`` (keeps duplicates).

    Written as a left anti join, not ``NOT IN``, so no null-aware plan.
    """
    keys = [on] if isinstance(on, str) else list(on)
    return df.join(part.select(*keys), keys, "left_anti")


# Values over which rows with a null key are dealt (they match nothing).
DEALT_NULLS = 1 << 20

# Copies of warm keys that a partition of a dealt lookup gets, about.
PIECES = 16


def dealt_lookup(left: DataFrame, on: str | list, table: DataFrame, counts: DataFrame, spread,
                 rows_per_task: int, count_col: str = "n", how: str = "left") -> DataFrame:
    """Join ``left`` to ``table`` (unique key ``on``) by a shuffle in which no
    key of ``left`` puts more than about ``rows_per_task`` rows into a task.

    ``counts`` is (on..., ``count_col``): how often keys occur in ``left``;
    keys below the bound may be missing. A key of more rows is warm: it is
    copied ceil(count / rows_per_task) times in ``table``, and its rows in
    ``left`` are dealt over the copies by ``spread`` (a 64-bit hash, one value
    per row). There are at most (rows of ``left``) / ``rows_per_task`` warm
    keys, so their copy numbers are broadcast behind a count; how warm a key is
    decides everything, its place in a ranking nothing. Keys that ``table``
    lacks are dealt as well, and rows with a null key over DEALT_NULLS values.
    Output = left columns + the table's other columns.
    """
    keys = [on] if isinstance(on, str) else list(on)
    values = [c for c in table.columns if c not in keys]
    warm = checkpoint(counts.where(F.col(count_col) > rows_per_task).select(
        *keys, F.ceil(F.col(count_col) / rows_per_task).cast("int").alias("_copies")), "warm")
    copies = broadcast_if_small(warm.select(*[F.col(k).alias(f"_w_{k}") for k in keys], "_copies"))

    def with_copies(df):
        same = _every([F.col(k) == F.col(f"_w_{k}") for k in keys])
        return df.join(copies, same, "left").drop(*[f"_w_{k}" for k in keys])
    null = F.lit(False)
    for k in keys:
        null = null | F.col(k).isNull()
    number = F.when(null, F.lit(DEALT_NULLS)).otherwise(F.coalesce("_copies", F.lit(1)))
    dealt = with_copies(left).withColumn("_copy", F.pmod(spread, number).cast("int"))
    each = F.sequence(F.lit(0), F.coalesce("_copies", F.lit(1)) - 1)
    copied = with_copies(table).select(*[F.col(k).alias(f"_t_{k}") for k in keys],
                                       *[F.col(c).alias(f"_t_{c}") for c in values],
                                       F.explode(each).alias("_t_copy"))
    same = _every([F.col(k) == F.col(f"_t_{k}") for k in keys]
                  + [F.col("_copy") == F.col("_t_copy")])
    return dealt.join(copied, same, how).select(
        *left.columns, *[F.col(f"_t_{c}").alias(c) for c in values])


def task_share(spark, total: int, least: int = 100_000) -> int:
    """Rows of one copy of a key in a dealt lookup: a PIECES-th of an even
    share of ``total`` over the shuffle partitions (so that chance, which puts
    several copies into one partition, evens out), at least ``least``."""
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(least, -(-int(total) // (PIECES * parts)))


# Classes of counts that ``frequent_keys`` tells apart in each doubling.
CLASSES = 8


def frequent_keys(counts: DataFrame, on: str, most: int, count_col: str = "n") -> DataFrame:
    """(on): the most frequent keys, ``most`` at most: those whose count is in the
    upper classes (a few hundred, by the count's logarithm) that fit together."""
    at = F.floor(F.log2(F.col(count_col).cast("double")) * CLASSES)
    some = counts.where(F.col(count_col) > 0)
    least, total = None, 0
    for r in sorted(some.groupBy(at.alias("at")).agg(F.count(F.lit(1)).alias("k")).collect(),
                    key=lambda r: -r["at"]):
        total += r["k"]
        if total > most:
            break
        least = r["at"]
    return some.where(F.lit(False) if least is None else at >= least).select(on)


def _every(conditions: list):
    out = conditions[0]
    for c in conditions[1:]:
        out = out & c
    return out


def one_row_per_key(pos):
    """Aggregate over exploded rows (``posexplode_outer`` places): how many
    rows were exploded into the group."""
    return F.sum(F.when(F.coalesce(pos, F.lit(0)) == 0, 1).otherwise(0))


def one_row_each(df: DataFrame, key: str) -> None:
    """Fail for a key that two rows share; only the key is read."""
    twice = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").first()
    if twice:
        raise ValueError(f"more than one row with {key} {twice[0]}")


def repeated_key(key: str):
    """An expression that fails the job for a key that two rows share."""
    return F.raise_error(F.concat(F.lit(f"more than one row with {key} "),
                                  F.coalesce(F.col(key).cast("string"), F.lit("null"))))
