"""Exact ranks and running totals without a single-partition window.

Three shapes:

- ``hash_rank``: rank by a uniform hash key (seeded shuffles). Rows fall into
  hash-prefix buckets of even size; a bounded table of bucket counts gives
  offsets; ``row_number`` runs inside each bucket only.
- ``ordered_rank``: rank by arbitrary sort columns, optionally inside groups
  (e.g. steps of an epoch). Data is range-partitioned on the full key (unique
  keys split evenly even when one group holds a third of all rows), sorted
  inside each partition, numbered, and pinned by a reliable checkpoint; a
  per-partition count table (one row per partition) gives the offsets.
- ``running_total``: cumulative sums of values in a sort order, in two passes:
  sums inside each range partition, then the totals of earlier partitions of
  the same group carried on.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from polarity.operators.joins import broadcast_if_small
from polarity.session import checkpoint

# Rows per hash bucket aimed at; bucket tables up to 16**5 rows are broadcast.
TARGET_BUCKET_ROWS = 200_000
MAX_BROADCAST_BUCKETS = 16 ** 5
# a bucket this many times over its expected size holds a repeated key
HOT_BUCKET_FACTOR = 4
_LOCAL_BITS = 33


def prefix_len(n: int, target: int = TARGET_BUCKET_ROWS) -> int:
    """Hex digits of the hash prefix so that buckets hold about ``target`` rows."""
    if n <= target:
        return 1
    return min(8, max(1, math.ceil(math.log(n / target, 16))))


def hash_rank(df: DataFrame, hash_col: str, tie_cols: list[str], pos_col: str = "pos",
              n: int | None = None) -> DataFrame:
    """0-based exact rank of each row ordered by (hash_col, *tie_cols).

    Buckets are even when keys are distinct. A key repeated on a large share
    of rows hashes into one bucket; that shows in the (bounded) bucket-count
    table, and the rank then switches to ``ordered_rank`` with a row
    tie-breaker, which splits even identical keys across tasks. Rows with
    identical keys are interchangeable, so their relative order is arbitrary.
    """
    if n is None:
        n = df.count()
    plen = prefix_len(n)
    keyed = df.withColumn("_hr_b", F.substring(F.col(hash_col), 1, plen))
    counts = checkpoint(keyed.groupBy("_hr_b").agg(F.count(F.lit(1)).alias("_hr_n")),
                        "buckets")
    largest = counts.agg(F.max("_hr_n")).first()[0] or 0
    if largest > HOT_BUCKET_FACTOR * max(TARGET_BUCKET_ROWS, n / 16 ** plen):
        tied = df.withColumn("_hr_t", F.monotonically_increasing_id())
        return ordered_rank(tied, [hash_col, *tie_cols, "_hr_t"], rank_col=pos_col).drop("_hr_t")
    # bounded by 16**plen rows: one small sort, not a data-size one
    running = Window.orderBy("_hr_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_hr_b", F.coalesce(F.sum("_hr_n").over(running),
                                                F.lit(0)).alias("_hr_off"))
    if 16 ** plen <= MAX_BROADCAST_BUCKETS:
        offsets = F.broadcast(offsets)
    inner = Window.partitionBy("_hr_b").orderBy(F.col(hash_col), *[F.col(c) for c in tie_cols])
    return (keyed.join(offsets, "_hr_b")
            .withColumn(pos_col, (F.col("_hr_off") + F.row_number().over(inner) - 1)
                        .cast("long"))
            .drop("_hr_b", "_hr_off"))


def ordered_rank(df: DataFrame, order_cols: list, group_cols: list | None = None,
                 rank_col: str = "rank", num_partitions: int | None = None) -> DataFrame:
    """0-based rank by ``order_cols`` inside each group of ``group_cols``.

    The sort key (group_cols + order_cols) should be unique; ties get an
    arbitrary but fixed order.
    """
    group_cols = list(group_cols or [])
    keys = group_cols + list(order_cols)
    spark = df.sparkSession
    p = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    staged = (df.repartitionByRange(p, *keys).sortWithinPartitions(*keys)
              .withColumn("_or_mid", F.monotonically_increasing_id()))
    staged = checkpoint(staged)  # pins partition membership and numbering
    part = F.shiftright(F.col("_or_mid"), _LOCAL_BITS)
    local = F.col("_or_mid").bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1))
    counts = staged.groupBy(part.alias("_or_p")).agg(F.count(F.lit(1)).alias("_or_n"))
    running = Window.orderBy("_or_p").rowsBetween(Window.unboundedPreceding, -1)
    offsets = F.broadcast(counts.select(
        "_or_p", F.coalesce(F.sum("_or_n").over(running), F.lit(0)).alias("_or_off")))
    ranked = (staged.withColumn("_or_p", part).join(offsets, "_or_p")
              .withColumn("_or_g", F.col("_or_off") + local))
    if group_cols:
        first = ranked.groupBy(*group_cols).agg(F.min("_or_g").alias("_or_first"))
        ranked = (ranked.join(broadcast_if_small(first), group_cols)
                  .withColumn(rank_col, (F.col("_or_g") - F.col("_or_first")).cast("long"))
                  .drop("_or_first"))
    else:
        ranked = ranked.withColumn(rank_col, F.col("_or_g").cast("long"))
    return ranked.drop("_or_mid", "_or_p", "_or_off", "_or_g")


def running_total(df: DataFrame, order_cols: list, totals: dict, group_cols: list | None = None,
                  num_partitions: int | None = None) -> DataFrame:
    """``df`` with, for each ``totals`` item (new column -> value column), the
    sum of the values up to and with the row, in the order of ``order_cols``
    inside each group of ``group_cols`` (null is a group of its own; a null
    value counts as 0).

    Rows are range-partitioned on the full key, so a group that holds a third
    of all rows is spread over many tasks; sums inside (partition, group) are
    one window, and only groups at a partition's edges - two a partition -
    can have rows before it: their totals per partition are added up in
    partition order and broadcast. Rows with equal keys get an arbitrary but
    fixed order. Whole numbers and decimals give exact totals.
    """
    groups = list(group_cols or [])
    keys = groups + list(order_cols)
    spark = df.sparkSession
    p = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    staged = checkpoint(df.repartitionByRange(p, *keys).sortWithinPartitions(*keys)
                        .withColumn("_rt_mid", F.monotonically_increasing_id()), "running")
    staged = staged.withColumn("_rt_p", F.shiftright("_rt_mid", _LOCAL_BITS))
    value = {c: F.coalesce(F.col(v), F.lit(0)) for c, v in totals.items()}
    # the first and last group of every partition: all that may span several
    edge = F.struct(*[F.col(g).alias(f"_rt_{i}") for i, g in enumerate(groups)],
                    F.lit(0).alias("_rt_one"))
    ends = staged.groupBy("_rt_p").agg(F.min_by(edge, F.col("_rt_mid")).alias("a"),
                                       F.max_by(edge, F.col("_rt_mid")).alias("b"))
    ends = ends.select(F.explode(F.array("a", "b")).alias("e")).select("e.*").distinct()
    same = [F.col(g).eqNullSafe(F.col(f"_rt_{i}")) for i, g in enumerate(groups)]
    at_edge = staged.join(F.broadcast(ends), _all(same), "left_semi") if groups else staged
    sums = at_edge.groupBy("_rt_p", *groups).agg(*[F.sum(v).alias(f"_rt_t_{c}")
                                                   for c, v in value.items()])
    before = (Window.partitionBy(*groups) if groups else Window.partitionBy()).orderBy(
        "_rt_p").rowsBetween(Window.unboundedPreceding, -1)  # a row per partition at most
    carry = checkpoint(sums.select(
        F.col("_rt_p").alias("_rt_q"), *[F.col(g).alias(f"_rt_{i}") for i, g in enumerate(groups)],
        *[F.sum(f"_rt_t_{c}").over(before).alias(f"_rt_c_{c}") for c in totals]), "carry")
    here = Window.partitionBy("_rt_p", *groups).orderBy("_rt_mid").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    local = staged.select(*df.columns, "_rt_p", *[F.sum(v).over(here).alias(f"_rt_l_{c}")
                                                  for c, v in value.items()])
    # two rows per partition at most
    out = local.join(F.broadcast(carry), _all([F.col("_rt_p") == F.col("_rt_q"), *same]), "left")
    return out.select(*df.columns, *[
        (F.coalesce(F.col(f"_rt_c_{c}"), F.lit(0)) + F.col(f"_rt_l_{c}")).alias(c) for c in totals])


def _all(conditions: list):
    out = conditions[0]
    for c in conditions[1:]:
        out = out & c
    return out
