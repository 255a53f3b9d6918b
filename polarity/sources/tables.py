"""Table scans with an input-parallelism guard.

A large table arrives in thousands of splits and is used as is. A small
file (one row group, say) arrives as one split, and everything fused into
the scan stage - tokenizing, exploding, partial aggregation - would run in
one task. Such a scan is hash-partitioned on its key to the cluster's
parallelism; the key partitioning then also serves later per-key
aggregations without another shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def balance(df: DataFrame, key: str | None = None, min_partitions: int | None = None) -> DataFrame:
    spark = df.sparkSession
    target = min_partitions or spark.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= target:
        return df
    return df.repartition(target, key) if key else df.repartition(target)


def spread_partitions(spark: SparkSession) -> int:
    """Partitions for rows that expand a lot after the shuffle (a document
    into its n-grams): an explicit count, so AQE does not coalesce them by
    their small shuffle size into a few heavy tasks. The configured shuffle
    partitions (sized for the cluster's data) or several tasks per core,
    whichever is larger, so uneven documents even out."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")),
               4 * spark.sparkContext.defaultParallelism)
