"""How the generated test tables stand in for the reference's inputs.

| reference input         | test table                                              |
| labelled reviews        | documents join labels; quality 1 -> 'positive'          |
| unlabelled / test set   | documents anti labels                                   |
| reviews with markup     | pages.html                                              |
| word vectors            | embeddings, vec_id = word id                            |
| features / logits       | embeddings: logits = first two values, target label%2;  |
|                         | role by label: 0-3 labeled, 4-7 real, 8-9 fake          |
| training step log       | events: epoch user_id%3, order (ts, event_id),          |
|                         | loss value, batch size event_id%2+1,                    |
|                         | correct answers event_id%(batch size+1)                 |
| member submissions      | one vote per (member, document) from md5(member:doc_id) |
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from polarity.config import MEMBER_WEIGHTS, NEGATIVE, POSITIVE
from polarity.functions.text import tokenize
from polarity.sources.tables import balance


def table(spark: SparkSession, sf_dir: str, name: str, key: str | None = None) -> DataFrame:
    """Scan a test table; with ``key``, rows that carry heavy per-row work
    (text, vectors) are spread over the cluster when the scan is too narrow."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return balance(df, key) if key else df


def documents(spark, sf_dir) -> DataFrame:
    """(doc_id, text)."""
    return table(spark, sf_dir, "documents", "doc_id").select("doc_id", "text")


def doc_ids(spark, sf_dir) -> DataFrame:
    """(doc_id) - no text, so no rebalancing."""
    return table(spark, sf_dir, "documents").select("doc_id")


def labeled_docs(spark, sf_dir) -> DataFrame:
    """(doc_id, text, sentiment, label)."""
    lab = table(spark, sf_dir, "labels").select("doc_id", "quality")
    return (documents(spark, sf_dir).join(lab, "doc_id")
            .select("doc_id", "text",
                    F.when(F.col("quality") == 1, F.lit(POSITIVE)).otherwise(F.lit(NEGATIVE))
                    .alias("sentiment"),
                    F.col("quality").cast("int").alias("label")))


def unlabeled_docs(spark, sf_dir) -> DataFrame:
    """(doc_id, text) of documents without a label."""
    lab = table(spark, sf_dir, "labels").select("doc_id")
    return documents(spark, sf_dir).join(lab, "doc_id", "left_anti")


def unlabeled_ids(spark, sf_dir) -> DataFrame:
    lab = table(spark, sf_dir, "labels").select("doc_id")
    return doc_ids(spark, sf_dir).join(lab, "doc_id", "left_anti")


def labeled_ids(spark, sf_dir) -> DataFrame:
    """(doc_id, label) of labelled documents, without text."""
    lab = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").cast("int")
                                                .alias("label"))
    return doc_ids(spark, sf_dir).join(lab, "doc_id")


def with_tokens(df: DataFrame, text: str = "text") -> DataFrame:
    return df.withColumn("tokens", tokenize(text)).drop(text)


def embeddings(spark, sf_dir) -> DataFrame:
    """(vec_id, embedding, label, role, logits, target)."""
    e = table(spark, sf_dir, "embeddings", "vec_id")
    role = (F.when(F.col("label") <= 3, F.lit("labeled"))
            .when(F.col("label") <= 7, F.lit("real")).otherwise(F.lit("fake")))
    return e.select("vec_id", "embedding", "label", role.alias("role"),
                    F.slice(F.col("embedding").cast("array<double>"), 1, 2).alias("logits"),
                    (F.col("label") % 2).cast("int").alias("target"))


def steps(spark, sf_dir) -> DataFrame:
    """Training step log: (event_id, ts, epoch, loss, batch_size, event_type, user_id)."""
    ev = table(spark, sf_dir, "events")
    return ev.select("event_id", "ts", "user_id", "event_type",
                     (F.col("user_id") % 3).cast("int").alias("epoch"),
                     F.col("value").cast("double").alias("loss"),
                     (F.col("event_id") % 2 + 1).cast("long").alias("batch_size"),
                     (F.col("event_id") % (F.col("event_id") % 2 + 2)).cast("long")
                     .alias("correct"))


def member_votes(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, member, sentiment): member m votes positive on document d when
    the first hex digit of md5('m:d') is below 8, and casts no vote when the
    second digit is 0 (so ties and missing votes occur)."""
    members = F.array(*[F.lit(m) for m, _ in MEMBER_WEIGHTS])
    ex = docs.select(key, F.explode(members).alias("member"))
    h = F.md5(F.concat_ws(":", F.col("member"), F.col(key).cast("string")))
    return (ex.filter(F.substring(h, 2, 1) != F.lit("0"))
            .select(key, "member",
                    F.when(F.substring(h, 1, 1) < F.lit("8"), F.lit(POSITIVE))
                    .otherwise(F.lit(NEGATIVE)).alias("sentiment")))
