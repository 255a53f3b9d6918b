"""Shared pieces of the training-data operators: word rules, held-out folds,
partition counts and size-checked broadcasts."""

from __future__ import annotations

import ctypes
import gc

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from polarity.session import checkpoint, ensure_checkpoint_dir, scratch_path

__all__ = ["WS", "SPLIT", "checkpoint", "ensure_checkpoint_dir", "scratch_path", "fold",
           "words", "n_words", "let", "small_or_plain", "arrow_batches", "table",
           "labelled_sample", "trim_memory", "tidy"]

#: the bytes that part words, and the same as a pattern (fixed values)
WS = " \t\n\x0b\x0c\r"
SPLIT = r"[\x20\x09-\x0D]+"

#: rows of a table that may be broadcast: with rows under 100 bytes, 100 MB at most
BROADCAST_ROWS = 1_000_000
#: bytes of a table with arrays that may be broadcast
BROADCAST_BYTES = 64 << 20


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def let(value: Column, body) -> Column:
    """body(value) with ``value`` evaluated once per row, however often the
    body uses it (Catalyst would otherwise copy the expression)."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words(text: Column) -> Column:
    """Array of the words of a text; null and blank texts give an empty one."""
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(WS))
    return F.when(F.length(bare) == 0, F.array().cast("array<string>")).otherwise(
        F.split(bare, SPLIT))


def n_words(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def fold(id_col: Column, n: int) -> Column:
    """crc32 of the id as text, modulo n; a null id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")), F.lit(n))


def small_or_plain(df: DataFrame, rows: int = BROADCAST_ROWS,
                   size: Column | None = None) -> DataFrame:
    """``df`` marked for broadcast if it has at most ``rows`` rows and, where
    rows vary, a sum of ``size`` (bytes a row) of at most BROADCAST_BYTES, both
    measured; otherwise as it is, so that the join shuffles and AQE splits hot
    keys."""
    if df.limit(rows + 1).count() > rows:
        return df
    if size is not None and (df.agg(F.sum(size)).first()[0] or 0) > BROADCAST_BYTES:
        return df
    return F.broadcast(df)


def arrow_batches(spark, rows: int = 1000) -> None:
    """Rows per Arrow batch: bounds a worker's memory with long texts."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def labelled_sample(docs: DataFrame, labels: DataFrame, label_col: str, folds: int, n: int,
                    max_bytes: int, seed: str) -> tuple[list[str], list[int]]:
    """Texts and labels of at most ``n`` labelled documents, first by a hash of
    their id, without those of more than ``max_bytes`` bytes; documents whose
    crc32 of the id modulo ``folds`` is 0 are held out. The ids are drawn from
    the labels alone, so texts are only filtered and at most ``n`` travel."""
    drawn = (labels.where(F.col(label_col).isNotNull() & (fold(F.col("doc_id"), folds) != 0))
             .groupBy("doc_id").agg(F.max(F.col(label_col).cast("int")).alias("_y"))
             .orderBy(F.xxhash64(F.lit(seed), "doc_id"), "doc_id").limit(n))
    text = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("_text")).where(
        F.octet_length("_text") <= max_bytes)
    rows = (text.join(F.broadcast(drawn), "doc_id").orderBy("doc_id", "_text").limit(n)
            .select("_text", "_y").collect())
    return [r[0] for r in rows], [r[1] for r in rows]


def trim_memory() -> None:
    """Give what training has freed back to the system (glibc keeps it): the
    driver's Python lives on beside its JVM."""
    gc.collect()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def tidy(run):
    """``run`` for mapInArrow, after which the worker gives its memory back
    (workers live on beside the executor's JVM, stage after stage)."""
    def both(batches):
        yield from run(batches)
        trim_memory()
    return both
