"""Vocabulary with vectors (S2) and encoded-id matrices (S3)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_vocabulary(spark: SparkSession, path: str, fmt: str = "text") -> DataFrame:
    """(id, word, vector ARRAY<FLOAT>).

    ``text``: one "word v1 v2 ... vd" line per word (the common word-vector
    file form); ids follow file order (0-based). The id is taken from the
    line's position within its file plus the sizes of earlier files, so it
    does not depend on how the read is split. Every line keeps its number: a
    line without a word or a vector fails the job. ``parquet``: (id, word,
    vector).
    """
    if fmt == "parquet":
        return spark.read.parquet(path).select(F.col("id").cast("int"), "word",
                                               F.col("vector").cast("array<float>"))
    lines = (spark.read.option("wholetext", "false").text(path)
             .select(F.col("_metadata.file_path").alias("_f"),
                     F.col("_metadata.file_block_start").alias("_b"), "value"))
    parts = lines.select("_f", "_b", F.split(F.trim("value"), " +").alias("p"))
    from polarity.operators.ordering import ordered_rank
    # line order = (file, byte offset of the line); monotonic per split
    indexed = parts.withColumn("_o", F.monotonically_increasing_id())
    ranked = ordered_rank(indexed, ["_f", "_b", "_o"], rank_col="_rank")
    bad = F.raise_error(F.concat(F.lit("no word with a vector in line "),
                                 F.col("_rank").cast("string")))
    return ranked.select(F.col("_rank").cast("int").alias("id"),
                         F.element_at("p", 1).alias("word"),
                         F.when(F.size("p") < 2, bad).otherwise(
                             F.slice(F.col("p"), F.lit(2), F.size("p") - 1))
                         .cast("array<float>").alias("vector"))


def write_vocabulary_text(vocab: DataFrame, path: str) -> None:
    """Write (id, word, vector) in the text form, in id order.

    The sort is range partitioned and every task writes its own part file;
    part files are numbered in range order, so reading the folder in file
    name order gives id order (no single-task funnel).
    """
    line = F.concat_ws(" ", F.col("word"),
                       F.array_join(F.col("vector").cast("array<string>"), " "))
    vocab.orderBy("id").select(line.alias("value")).write.text(path)


def read_encoded(spark: SparkSession, path: str) -> DataFrame:
    """S3: a matrix written one row per line as comma-separated numbers
    (floats such as 1.000000000000000000e+00 are cast back to ints):
    (row, ids ARRAY<INT>), ``row`` = line number within the file set."""
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("_f"),
        F.col("_metadata.file_block_start").alias("_b"), "value")
    ids = F.split(F.trim("value"), ",").cast("array<double>").cast("array<int>")
    from polarity.operators.ordering import ordered_rank
    # line order = (file, split start, position inside the split); a large
    # file is read in several splits whose tasks need not run in file order
    indexed = lines.withColumn("_o", F.monotonically_increasing_id())
    ranked = ordered_rank(indexed, ["_f", "_b", "_o"], rank_col="row")
    return ranked.select("row", ids.alias("ids"))


def write_encoded(df: DataFrame, path: str, ids: str = "ids", order="row") -> None:
    """Write an id matrix one row per line, comma separated, in ``order``.

    Range-partitioned sort, one part file per task, numbered in range order:
    ``read_encoded`` gives the rows back numbered in the same order.
    """
    order = [order] if isinstance(order, str) else list(order)
    (df.orderBy(*order).select(F.array_join(F.col(ids).cast("array<string>"), ",")
                               .alias("value")).write.text(path))


def write_encoded_part(df: DataFrame, path: str, ids: str = "ids", label: str = "label",
                       order="row") -> None:
    """A labelled part as two matrices, ``path/ids`` and ``path/labels`` (one
    label per line), both in ``order``: row i of one belongs to row i of the
    other."""
    write_encoded(df, f"{path}/ids", ids, order)
    write_encoded(df.withColumn("_l", F.array(F.col(label))), f"{path}/labels", "_l", order)


def read_encoded_part(spark: SparkSession, path: str) -> DataFrame:
    """(row, ids, label): the two matrices of ``write_encoded_part``, paired by
    line number; parts of different length fail the job."""
    ids = read_encoded(spark, f"{path}/ids")
    labels = read_encoded(spark, f"{path}/labels").withColumnRenamed("ids", "_l")
    bad = F.raise_error(F.concat(F.lit("ids and labels differ at row "),
                                 F.col("row").cast("string")))
    both = ids.join(labels, "row", "full")
    return both.select("row", F.when(F.col("ids").isNull() | F.col("_l").isNull(), bad)
                       .otherwise(F.col("ids")).alias("ids"), F.element_at("_l", 1).alias("label"))
