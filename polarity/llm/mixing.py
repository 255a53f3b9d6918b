"""Mixing sources to target weights (DataFrame functions only).

Every document gets a hash-random key (md5 of a seed and its id). Within a
source documents are ranged by that key; bucket totals give distributed
prefix sums of word counts, and the source is cut at its exact budget. A
budget above the source's own words takes whole epochs first and cuts the
remainder. Texts never move: the cut is one small row per source, and whether
a document is taken follows from its key alone.

Contract: null text has size 0; null sources are one source, last in order;
documents whose keys tie (repeated ids) at the cut share what is left of the
budget in proportion to their sizes, rounded down; empty tables give no rows.
Sources are assumed to fit one sort (one row each); documents are not.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from polarity.llm.common import WS, checkpoint, n_words, small_or_plain, words
from polarity.operators.ordering import prefix_len

WEIGHTS = (1, 2, 3)
MAX_EPOCHS = 3
SEED = "mix-1"
#: documents per key bucket of a source, aimed at
BUCKET_ROWS = 100_000


def source_key(source: Column) -> Column:
    """A join key in which null is a value of its own."""
    return F.coalesce(F.concat(F.lit("s"), source), F.lit("n"))


def mix_key(doc_id: Column, seed: str = SEED) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce(doc_id.cast("string"), F.lit(""))))


def sized(docs: DataFrame, id_col="doc_id", text_col="text", source_col="source",
          seed: str = SEED) -> DataFrame:
    """(doc_id, source, _mx_s, size, _mx_key): all the mix needs of a document."""
    return docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
                       source_key(F.col(source_col)).alias("_mx_s"),
                       n_words(F.col(text_col)).alias("size"),
                       mix_key(F.col(id_col), seed).alias("_mx_key"))


def targets(rows: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """One row per source: words, weight and target.

    Targets share the words of all sources by weight, each at most
    ``max_epochs`` times its own words. With sources in order of cap / weight
    the level at which capped sources stop is the largest of
    (total - caps before) / (weights from here on).
    """
    per = rows.groupBy("_mx_s", "source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.get(F.array(*[F.lit(float(w)) for w in weights]),
                   F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))))
    per = (per.withColumn("weight", weight)
           .withColumn("_cap", (F.col("source_size") * max_epochs).cast("double")))
    by = Window.orderBy(F.col("_cap") / F.col("weight"), "_mx_s")
    every = Window.partitionBy(F.lit(0))
    before = F.coalesce(F.sum("_cap").over(by.rowsBetween(Window.unboundedPreceding, -1)),
                        F.lit(0.0))
    after = F.sum("weight").over(by.rowsBetween(0, Window.unboundedFollowing))
    total = F.sum("source_size").over(every)
    per = per.withColumn("_level", (total - before) / after)
    return (per.withColumn("target", F.least(F.col("_cap"), F.col("weight")
                                             * F.max("_level").over(every)))
            .drop("_level", "_cap"))


def cuts(rows: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """One row per source: how many whole epochs are taken, and the key at
    which the remainder ends, with the words before and at that key."""
    per = checkpoint(targets(rows, weights, max_epochs), "mix-targets")
    per = (per.withColumn("_budget", F.least(F.round("target").cast("long"),
                                             F.col("source_size") * max_epochs))
           .withColumn("_epochs", F.when(F.col("source_size") > 0,
                                         F.floor(F.col("_budget") / F.col("source_size")))
                       .otherwise(0).cast("long"))
           .withColumn("_rest", F.col("_budget") - F.col("_epochs") * F.col("source_size")))
    plen = prefix_len(rows.count(), BUCKET_ROWS)
    bucket = F.substring("_mx_key", 1, plen)
    sums = rows.groupBy("_mx_s", bucket.alias("_b")).agg(F.sum("size").alias("_w"))
    run = Window.partitionBy("_mx_s").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("_before", F.coalesce(F.sum("_w").over(run), F.lit(0)))
    hit = (sums.join(per.select("_mx_s", "_rest"), "_mx_s")
           .where("_rest > _before and _rest <= _before + _w")
           .select("_mx_s", "_b", "_before", "_rest"))
    inside = (rows.withColumn("_b", bucket).join(small_or_plain(hit), ["_mx_s", "_b"])
              .groupBy("_mx_s", "_before", "_rest", "_mx_key").agg(F.sum("size").alias("_at")))
    run = Window.partitionBy("_mx_s").orderBy("_mx_key").rowsBetween(Window.unboundedPreceding, -1)
    cut = (inside.withColumn("_cut_before", F.col("_before")
                             + F.coalesce(F.sum("_at").over(run), F.lit(0)))
           .where("_rest > _cut_before and _rest <= _cut_before + _at")
           .select("_mx_s", F.col("_mx_key").alias("_cut_key"), "_cut_before",
                   F.col("_at").alias("_cut_at")))
    return checkpoint(per.join(cut, "_mx_s", "left")
                      .select("_mx_s", "source_size", "target", "_epochs", "_rest",
                              F.coalesce("_cut_key", F.lit("")).alias("_cut_key"),
                              F.coalesce("_cut_before", F.lit(0)).alias("_cut_before"),
                              F.coalesce("_cut_at", F.lit(1)).alias("_cut_at")), "mix-cuts")


def taken(size: Column) -> Column:
    """Words taken of a row of that size that carries its source's cut."""
    part = F.floor(size * (F.col("_rest") - F.col("_cut_before")) / F.col("_cut_at"))
    return (F.col("_epochs") * size
            + F.when(F.col("_mx_key") < F.col("_cut_key"), size)
            .when(F.col("_mx_key") == F.col("_cut_key"), part).otherwise(0)).cast("long")


def mix(docs: DataFrame, id_col="doc_id", text_col="text", source_col="source",
        weights=WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: str = SEED) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken), one row per document."""
    rows = checkpoint(sized(docs, id_col, text_col, source_col, seed), "mix-sizes")
    at = small_or_plain(cuts(rows, weights, max_epochs))
    return rows.join(at, "_mx_s").select("doc_id", "source", "size", "source_size", "target",
                                         taken(F.col("size")).alias("taken"))


def mixed_documents(docs: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS,
                    seed: str = SEED) -> DataFrame:
    """The mix as documents, in the columns of ``docs`` (doc_id, text, source
    and any others): a row per whole epoch, and the leading words taken of the
    document at the cut (``n_chars``, where there is one, follows the text).
    Documents of which nothing is taken go; documents without words are kept
    in sources of which anything is taken (they cost no budget)."""
    rows = checkpoint(sized(docs, seed=seed), "mix-sizes")
    at = small_or_plain(cuts(rows, weights, max_epochs).drop("source_size", "target"))
    names = docs.columns
    d = docs.select(*names, source_key(F.col("source")).alias("_mx_s"),
                    mix_key(F.col("doc_id"), seed).alias("_mx_key"))
    d = d.join(at, "_mx_s")
    # within the cut only rows at the cut key need their word count
    size = F.col("_mx_size")
    d = d.withColumn("_mx_size", n_words(F.col("text"))).withColumn("_taken", taken(size))
    whole = F.when(size > 0, F.floor(F.col("_taken") / size)).otherwise(
        F.when(F.col("_epochs") > 0, F.col("_epochs"))
        .when((F.col("_rest") > 0) & (F.col("_mx_key") < F.col("_cut_key")), 1).otherwise(0))
    part = F.when(size > 0, F.col("_taken") % size).otherwise(0)
    copies = F.concat(F.array_repeat(F.lit(-1).cast("long"), whole.cast("int")),
                      F.when(part > 0, F.array(part)).otherwise(F.array().cast("array<bigint>")))
    d = d.withColumn("_part", F.explode(copies))
    text = F.when(F.col("_part") < 0, F.col("text")).otherwise(
        F.array_join(F.slice(words(F.col("text")), F.lit(1), F.greatest(F.col("_part"), F.lit(1))
                             .cast("int")), " "))
    out = d.withColumn("text", text)
    if "n_chars" in names:
        out = out.withColumn("n_chars", F.when(F.col("_part") < 0, F.col("n_chars")).otherwise(
            F.length("text").cast(docs.schema["n_chars"].dataType)))
    return out.select(*names)
