"""Metric log as a long table (S6): (run, tag, step, value), a Parquet folder
partitioned by run and range of steps.

A call commits its points: a point (run, tag, step) that the log has already is
replaced, the others stay, so a rerun or a retried call leaves the log as one
run would. Only the ranges of steps that a call touches are read and written
(dynamic partition overwrite); a call that was interrupted while its ranges
were put in place is finished by running it again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from polarity.session import checkpoint
from polarity.sources.files import exists

#: steps of one run that share a folder
PART_STEPS = 1_000_000
POINT = ["run", "tag", "step"]


def to_long(wide: DataFrame, run: str, step: str, tags: list[str],
            group: str | None = None) -> DataFrame:
    """Unpivot metric columns into (run, tag, step, value); with ``group``
    the tag becomes "<group>/<name>" (grouped scalars)."""
    long = wide.unpivot([step], tags, "tag", "value")
    tag = F.concat(F.lit(f"{group}/"), F.col("tag")) if group else F.col("tag")
    return long.select(F.lit(run).alias("run"), tag.alias("tag"),
                       F.col(step).cast("long").alias("step"),
                       F.col("value").cast("double").alias("value"))


def _stored(spark: SparkSession, path: str) -> DataFrame:
    # types are stated: a run called 007 is not a number
    return spark.read.schema("tag string, step long, value double, run string, part long") \
        .parquet(path)


def log_metrics(wide: DataFrame, run: str, step: str, tags: list[str], path: str,
                group: str | None = None, part_steps: int = PART_STEPS) -> DataFrame:
    """Commit the long form under ``path`` (``run=<run>/part=<range>``) and
    return it. Two values for one (tag, step) in a call fail it. ``part_steps``
    is a property of the log: every call under ``path`` must give the same.
    Calls for one run may not overlap in time."""
    spark = wide.sparkSession
    value = F.when(F.count(F.lit(1)) > 1, F.raise_error(F.concat(
        F.lit("two values of one point: "), F.coalesce("tag", F.lit("null")), F.lit(" "),
        F.coalesce(F.col("step").cast("string"), F.lit("null"))))).otherwise(F.first("value"))
    new = to_long(wide, run, step, tags, group).groupBy(*POINT).agg(value.alias("value"))
    new = checkpoint(new.withColumn("part", F.floor(F.col("step") / part_steps)), "points")
    rows = new
    if exists(spark, path):
        touched = new.select("run", "part").distinct()
        old = _stored(spark, path)
        old = old.join(touched, (old["run"] == touched["run"])
                       & old["part"].eqNullSafe(touched["part"]), "left_semi")
        old = old.join(new, (old["run"] == new["run"]) & old["tag"].eqNullSafe(new["tag"])
                       & old["step"].eqNullSafe(new["step"]), "left_anti")
        # a copy first: its folders are replaced
        rows = checkpoint(new.unionByName(old), "merged")
    (rows.repartitionByRange("part", "tag", "step").write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("run", "part").parquet(path))
    return new.select(*POINT, "value")


def read_metrics(spark: SparkSession, path: str, run: str | None = None) -> DataFrame:
    """(run, tag, step, value) of the log, or of one run (its folders only)."""
    log = _stored(spark, path)
    if run is not None:
        log = log.where(F.col("run") == run)
    return log.select(*POINT, "value")
