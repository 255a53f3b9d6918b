"""Nearest words through a random-projection index (K2 at a large vocabulary).

``build_index`` gives each distinct vector of the vocabulary one bucket in each
of several tables: the signs of its products with random planes, as many as
leave about ``BUCKET_ROWS`` vectors a bucket. ``nearest_indexed`` looks into a
query's own bucket of each table and those across its nearest planes, takes the
exact cosine with every vector found there, and keeps the best k.

Every vector is in the index and no bucket is capped: a bucket of many vectors
is dealt over several groups, a bucket of many queries likewise, so a task
holds one group of bounded size whatever the data's skew (all vectors in one
bucket is an exact search in pieces). What is approximate is which words are
compared; the cosines and their order are exact, and a query that finds fewer
than k words is searched over the whole vocabulary (``neighbors.nearest``).
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from polarity.operators.joins import broadcast_if_small
from polarity.operators.neighbors import _best_per_vector, _keys, _top, nearest
from polarity.session import checkpoint

#: vectors per bucket, aimed at
BUCKET_ROWS = 256
TABLES = 6
#: planes across which a query's neighbouring buckets are tried, per table
PROBES = 2
#: vectors, and queries, of one group
GROUP_ROWS = 4096
WORDS = "array<struct<id:int,word:string>>"


@dataclass(frozen=True)
class VectorIndex:
    """Where an index lies and how its buckets are named."""
    path: str
    tables: int
    bits: int
    dim: int
    k: int
    seed: int

    def planes(self) -> np.ndarray:
        return np.random.default_rng(self.seed).standard_normal(
            (self.dim, self.tables * self.bits))


def _buckets(index: VectorIndex, col: str, probes: int):
    """mapInPandas: rows with ``_b``, the buckets of ``col``."""
    def run(batches):
        planes = index.planes()
        power = 1 << np.arange(index.bits, dtype=np.int64)
        base = (np.arange(index.tables, dtype=np.int64) << index.bits)[None, :, None]
        for b in batches:
            if not len(b):
                continue
            side = np.vstack(b[col].to_numpy()).astype(np.float64) @ planes
            side = side.reshape(len(b), index.tables, index.bits)
            code = ((side > 0) * power).sum(axis=2, dtype=np.int64)[:, :, None]
            near = np.argsort(np.abs(side), axis=2, kind="stable")[:, :, :probes]
            found = np.concatenate([code, code ^ power[near]], axis=2) + base
            yield b.assign(_b=list(found.reshape(len(b), -1)))
    return run


def build_index(vocab: DataFrame, path: str, k: int = 10, tables: int = TABLES,
                bucket_rows: int = BUCKET_ROWS, seed: int = 7) -> VectorIndex:
    """Index of ``vocab`` (id, word, vector) under ``path`` (overwritten), for
    searches of up to ``k`` words. Null vectors are left out; vectors of
    another length fail the job; an empty vocabulary is an error."""
    v = _best_per_vector(vocab.select(
        F.col("id").cast("int").alias("id"), F.col("word").cast("string"),
        F.col("vector").cast("array<double>").alias("vec")).where("vec is not null"), k)
    v = checkpoint(v, "vectors")
    size = v.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("vec")).alias("d")).first()
    if not size["n"]:
        raise ValueError("the vocabulary has no vectors to index")
    bits = min(40, max(1, math.ceil(math.log2(max(2, size["n"] / bucket_rows)))))
    index = VectorIndex(path.rstrip("/"), tables, bits, size["d"], k, seed)
    rows = v.mapInPandas(_buckets(index, "vec", 0), f"vec array<double>, words {WORDS}, _b array<long>")
    rows = rows.withColumn("bucket", F.explode("_b")).drop("_b")
    rows.write.mode("overwrite").parquet(f"{index.path}/entries")
    spark = vocab.sparkSession
    (spark.read.parquet(f"{index.path}/entries").groupBy("bucket").count()
     .write.mode("overwrite").parquet(f"{index.path}/sizes"))
    return index


def _group_best(k: int):
    """applyInPandas of a group's queries and vectors: each query's best k."""
    def run(q: pd.DataFrame, v: pd.DataFrame) -> pd.DataFrame:
        out: dict = {"_row": [], "sim": [], "word_id": [], "word": []}
        if len(q) and len(v):
            words = [[(w["id"], w["word"]) for w in ws] for ws in v["words"]]
            order = np.argsort([w[0][0] for w in words], kind="stable")
            words = [words[i] for i in order]
            mat = np.vstack(v["vec"].to_numpy())[order]
            idx, sim = _top(np.vstack(q["_qv"].to_numpy()), mat, np.linalg.norm(mat, axis=1),
                            np.array([w[0][0] for w in words]), k)
            for row, at, values in zip(q["_row"], idx, sim):
                best = sorted(((-s, *w) for i, s in zip(at, values) for w in words[i]))[:k]
                for s, w_id, w in best:
                    out["_row"].append(row)
                    out["sim"].append(-s)
                    out["word_id"].append(w_id)
                    out["word"].append(w)
        return pd.DataFrame(out)
    return run


def _dealt(n, rows: int):
    return F.greatest(F.lit(1), F.ceil(n / F.lit(rows))).cast("int")


def candidates(queries: DataFrame, index: VectorIndex, probes: int = PROBES,
               group_rows: int = GROUP_ROWS) -> tuple[DataFrame, DataFrame]:
    """Queries (bucket, part, turn, _row, _qv) and vectors (bucket, part, turn,
    words, vec) dealt into groups: each query meets each vector of its buckets
    in one group."""
    spark = queries.sparkSession
    asked = queries.mapInPandas(_buckets(index, "_qv", min(probes, index.bits)),
                                "_row long, _qv array<double>, _b array<long>")
    asked = checkpoint(asked.withColumn("bucket", F.explode("_b")).drop("_b"), "asked")
    sizes = (spark.read.parquet(f"{index.path}/sizes")
             .join(asked.groupBy("bucket").agg(F.count(F.lit(1)).alias("_n")), "bucket")
             .select("bucket", _dealt(F.col("count"), group_rows).alias("_parts"),
                     _dealt(F.col("_n"), group_rows).alias("_turns")))
    sizes = broadcast_if_small(checkpoint(sizes, "sizes"))
    copies = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    q = asked.join(sizes, "bucket").select(
        "bucket", copies("_parts").alias("part"),
        F.pmod(F.xxhash64("_row"), "_turns").cast("int").alias("turn"), "_row", "_qv")
    v = spark.read.parquet(f"{index.path}/entries").join(sizes, "bucket").select(
        "bucket", F.pmod(F.xxhash64("vec"), "_parts").cast("int").alias("part"),
        copies("_turns").alias("turn"), "words", "vec")
    return q, v


def nearest_indexed(queries: DataFrame, index: VectorIndex, vocab: DataFrame, qid="qid",
                    qvec: str = "vector", k: int = 1, probes: int = PROBES,
                    group_rows: int = GROUP_ROWS) -> DataFrame:
    """(qid..., rank, word_id, word, sim): for each row of ``queries`` the k
    most similar words among those of its buckets, by descending cosine, then
    ascending id; rank from 0. ``vocab`` is the table that was indexed, for
    queries that find fewer than k words. Equal vectors are searched once and
    every input row gets its own rows; a null vector gets none."""
    if k > index.k:
        raise ValueError(f"the index keeps {index.k} words a vector, asked for {k}")
    keys = _keys(qid)
    every = queries.select(*keys, F.col(qvec).cast("array<double>").alias("_qv")).where(
        "_qv is not null")
    distinct = checkpoint(every.select("_qv").distinct().withColumn(
        "_row", F.monotonically_increasing_id()).select("_row", "_qv"), "queries")
    q, v = candidates(distinct, index, probes, group_rows)
    at = ["bucket", "part", "turn"]
    found = q.groupBy(*at).cogroup(v.groupBy(*at)).applyInPandas(
        _group_best(k), "_row long, sim double, word_id int, word string")
    # several tables find the same word
    found = found.groupBy("_row", "word_id", "word").agg(F.max("sim").alias("sim"))
    order = Window.partitionBy("_row").orderBy(F.desc("sim"), "word_id", "word")
    found = checkpoint(found.withColumn("rank", F.row_number().over(order) - 1)
                       .where(F.col("rank") < k), "found")
    full = found.where(F.col("rank") == k - 1).select("_row")
    rest = checkpoint(distinct.join(full, "_row", "left_anti"), "rest")
    if not rest.isEmpty():
        exact = nearest(rest, vocab, "_row", "_qv", k)
        if k == 1:
            exact = exact.withColumn("rank", F.lit(0))
        found = found.join(full, "_row", "left_semi").unionByName(exact.select(*found.columns))
    answers = found.join(distinct, "_row").drop("_row")
    return every.join(answers, "_qv").select(*keys, "rank", "word_id", "word", "sim")
