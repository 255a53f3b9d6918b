"""Connected components of a link table by alternating large-star and
small-star rounds: each round is two aggregations and joins on the link table,
written to the checkpoint folder, and the number of rounds grows with the
logarithm of the longest path. No task holds a component: minima are partial
aggregates and the joins on a hot centre are ones that AQE may split."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from polarity.llm.common import checkpoint

MAX_ROUNDS = 60


def _large_star(e: DataFrame) -> DataFrame:
    both = e.unionAll(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    return (both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .where("u != v"))


def _small_star(e: DataFrame) -> DataFrame:
    down = e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionAll(least.select("u", F.col("m").alias("v")))


def _unsettled(e: DataFrame) -> bool:
    """Whether a node has two links down, or is linked both down and up; if
    none is, every link ends in a component's smallest node."""
    ends = e.select(F.col("u").alias("x"), F.lit(1).alias("down"), F.lit(0).alias("up")).unionAll(
        e.select(F.col("v").alias("x"), F.lit(0).alias("down"), F.lit(1).alias("up")))
    bad = ends.groupBy("x").agg(F.sum("down").alias("d"), F.max("up").alias("a")).where(
        "d > 1 or (d = 1 and a = 1)")
    return not bad.isEmpty()


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (u, v): the component is
    its smallest node. Loops and repeats are harmless; no links, no rows."""
    e = checkpoint(links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                   .where("u != v").distinct(), "links")
    for _ in range(MAX_ROUNDS):
        if not _unsettled(e):
            break
        e = checkpoint(_small_star(checkpoint(_large_star(e), "star")).distinct(), "star")
    else:
        raise RuntimeError("components did not settle")
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(
        e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
