"""Nearest words by cosine (K2, J7), sentence decoding (K3), and the
weight-normalised linear score (M4).

Nearest-word search is exact, with no pair table, and nothing of the vocabulary
passes through the driver: its distinct vectors are written once as Parquet
blocks of bounded size in the checkpoint folder, and tasks read them there. A
task takes its query rows in Arrow batches past one block after the other (one
matrix product per batch and block, numpy) with the best words so far. Where
queries are few and blocks many, the blocks are dealt over several tasks per
query part, and the best words of a row's tasks are merged by one aggregate.

Words that share a vector are scored once and come in order of id, so exact
ties go to the lowest id whatever the rounding of a matrix product.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, DoubleType, IntegerType, StringType, StructField,
                               StructType)

from polarity.functions.arrays import COSINE_EPS
from polarity.functions.text import detokenize
from polarity.session import checkpoint, scratch_path
from polarity.sources.files import read_folder

# Similarity values held at once per task (16 MB of doubles, four times over):
# query rows are scored in slices so a 10k-row Arrow batch against a large
# vocabulary block never materializes a multi-GB matrix.
SIM_VALUES_PER_SLICE = 2_000_000
# Numbers of the vocabulary's vectors in a block at most (32 MB, three times over
# while it is read), as every Python worker of an executor holds one.
BLOCK_VALUES = 4_000_000

FOUND = ArrayType(StructType([StructField("sim", DoubleType()), StructField("id", IntegerType()),
                              StructField("word", StringType())]))


def _top(q: np.ndarray, vmat: np.ndarray, vnorm: np.ndarray, first_id: np.ndarray, k: int):
    """The k best vocabulary rows and their cosines, per query row, by
    descending cosine, then ascending first id.

    Repeated query vectors (pads, common words) are scored once per batch:
    rows are de-duplicated and the answers spread back by the inverse index.
    """
    uq, inverse = np.unique(q, axis=0, return_inverse=True)
    inverse = inverse.reshape(-1)
    k = min(k, len(vmat))
    step = max(1, SIM_VALUES_PER_SLICE // max(1, len(vmat)))
    idx_u = np.empty((len(uq), k), dtype=np.int64)
    sim_u = np.empty((len(uq), k), dtype=np.float64)
    for lo in range(0, len(uq), step):
        qs = uq[lo:lo + step]
        qn = np.linalg.norm(qs, axis=1)
        sims = (qs @ vmat.T) / np.maximum(np.outer(qn, vnorm), COSINE_EPS)
        if k == 1:
            idx = sims.argmax(axis=1)[:, None]  # rows come by first id
        else:
            # every row at or above the k-th value, so a tie at the edge is
            # settled by id and not by the partition
            edge = np.partition(sims, len(vmat) - k, axis=1)[:, len(vmat) - k]
            idx = np.empty((len(qs), k), dtype=np.int64)
            for i, (row, e) in enumerate(zip(sims, edge)):
                at = np.flatnonzero(row >= e)
                idx[i] = at[np.lexsort((first_id[at], -row[at]))][:k]
        idx_u[lo:lo + step] = idx
        sim_u[lo:lo + step] = np.take_along_axis(sims, idx, axis=1)
    return idx_u[inverse], sim_u[inverse]


def _keys(qid) -> list[str]:
    return [qid] if isinstance(qid, str) else list(qid)


_blocks: dict[str, tuple] = {}


def _block(path: str):
    """(words, first ids, vectors, norms) of a block, by first id; None if it
    is empty. A worker keeps the last one it read."""
    if path not in _blocks:
        t = read_folder(path, ["vec", "words"])
        _blocks.clear()
        _blocks[path] = None
        if t is not None and t.num_rows:
            words = [[(w["id"], w["word"]) for w in ws] for ws in t.column("words").to_pylist()]
            order = np.argsort([w[0][0] for w in words], kind="stable")
            vec = t.column("vec").combine_chunks()
            flat = vec.flatten() if isinstance(vec, pa.ListArray) else pa.concat_arrays(
                [c.flatten() for c in vec.chunks])
            mat = flat.to_numpy(zero_copy_only=False).reshape(len(words), -1)[order]
            words = [words[i] for i in order]
            _blocks[path] = (words, np.array([w[0][0] for w in words]), mat,
                             np.linalg.norm(mat, axis=1))
    return _blocks[path]


def _search(root: str, blocks: int, groups: int, k: int):
    """mapInPandas: rows (..., _qv, _best[, _group]) with _best improved by all
    blocks, or by those of the row's group."""
    def improve(b, block):
        words, first, mat, norm = block
        idx, sim = _top(np.vstack(b["_qv"].to_numpy()).astype(np.float64), mat, norm, first, k)
        best = []
        for rows, values, old in zip(idx, sim, b["_best"]):
            found = [(v, w_id, w) for r, v in zip(rows, values) for w_id, w in words[r][:k]]
            found += [(f["sim"], f["id"], f["word"]) for f in old]
            found.sort(key=lambda f: (-f[0], f[1]))
            best.append([{"sim": float(v), "id": w_id, "word": w} for v, w_id, w in found[:k]])
        return b.assign(_best=pd.Series(best, index=b.index, dtype=object))

    def run(batches):
        for b in batches:
            for g, part in b.groupby("_group", sort=False) if groups > 1 else [(0, b)]:
                if not len(part):
                    continue
                for i in range(int(g), blocks, groups):
                    block = _block(f"{root}/block={i}")
                    if block is not None:
                        part = improve(part, block)
                yield part
    return run


def _best_per_vector(vocab: DataFrame, k: int) -> DataFrame:
    """(vec, words): the k lowest ids of each distinct vector. A rank limit is
    applied before the shuffle, so words that share a vector are never
    gathered."""
    w = Window.partitionBy("vec").orderBy("id", "word")
    return (vocab.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") <= k)
            .groupBy("vec").agg(F.sort_array(F.collect_list(F.struct("id", "word")))
                                .alias("words")))


def nearest(queries: DataFrame, vocab: DataFrame, qid="qid", qvec: str = "vector", k: int = 1,
            max_broadcast_values: int = 16_000_000) -> DataFrame:
    """K2: (qid..., word_id, word, sim), and ``rank`` from 0 if ``k`` > 1 -
    the k vocabulary words most similar to each query vector, by descending
    cosine, then ascending id. ``vocab`` is (id, word, vector); ``qid`` is one
    key column or several, carried through; every input row gives its own
    rows, also where keys repeat. An empty vocabulary is an error. The word
    travels with its vector, so no lookup join follows the search. A task
    holds one block of ``max_broadcast_values`` numbers, BLOCK_VALUES at most, at
    a time."""
    spark = queries.sparkSession
    keys = _keys(qid)
    q = queries.select(*keys, F.col(qvec).cast("array<double>").alias("_qv"),
                       F.array().cast(FOUND).alias("_best"))
    v = _best_per_vector(vocab.select(
        F.col("id").cast("int").alias("id"), F.col("word").cast("string"),
        F.col("vector").cast("array<double>").alias("vec")).where("vec is not null"), k)
    v = checkpoint(v, "vectors")
    stats = v.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("vec")).alias("d")).first()
    if not stats["n"]:
        raise ValueError("the vocabulary has no vectors to search")
    blocks = max(1, math.ceil(stats["n"] * (stats["d"] or 1)
                              / min(max_broadcast_values, BLOCK_VALUES)))
    root = scratch_path(spark, "vector-blocks")
    at = F.pmod(F.xxhash64(F.col("words")[0]["id"]), F.lit(blocks))
    v.withColumn("block", at).repartition(blocks, "block").write.partitionBy("block").parquet(root)
    cores = spark.sparkContext.defaultParallelism
    groups = min(blocks, max(1, cores // max(1, q.rdd.getNumPartitions())))
    if groups > 1:
        # few queries: pinned with a number a row, then once per group of blocks
        q = checkpoint(q.withColumn("_row", F.monotonically_increasing_id()), "queries")
        q = (q.withColumn("_group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
             .repartition(cores, "_group", "_row"))
        q = q.mapInPandas(_search(root, blocks, groups, k), q.schema)
        order = F.array_sort(F.flatten(F.collect_list("_best")), lambda a, b: F.when(
            a["sim"] > b["sim"], -1).when(a["sim"] < b["sim"], 1).otherwise(
            F.when(a["id"] < b["id"], -1).when(a["id"] > b["id"], 1).otherwise(0)))
        q = q.groupBy("_row").agg(*[F.first(c).alias(c) for c in keys],  # groups x k words
                                  F.slice(order, 1, k).alias("_best"))
    else:
        q = q.mapInPandas(_search(root, blocks, 1, k), q.schema)
    if k == 1:
        best = F.col("_best")[0]
        return q.select(*keys, best["id"].alias("word_id"), best["word"].alias("word"),
                        best["sim"].alias("sim"))
    return q.select(*keys, F.posexplode("_best").alias("rank", "_f")).select(
        *keys, "rank", F.col("_f.id").alias("word_id"), F.col("_f.word").alias("word"),
        F.col("_f.sim").alias("sim"))


def decode_sentence(long_df: DataFrame, vocab: DataFrame, key: str = "id",
                    pos: str = "pos", vec: str = "vector") -> DataFrame:
    """K3: (key, sentence) - nearest word for every position, joined by
    blanks in position order.

    Every (key, pos) row is searched where it lies (repeated vectors are
    scored once per Arrow batch), so the only shuffle is the per-sentence
    regroup, which carries one short word per row.
    """
    found = nearest(long_df.select(key, pos, vec), vocab, qid=[key, pos], qvec=vec)
    items = F.sort_array(F.collect_list(F.struct(F.col(pos), F.col("word"))))
    return (found.groupBy(key).agg(items.alias("_w"))
            .select(key, detokenize(F.col("_w")["word"]).alias("sentence")))


_units_read: dict[str, tuple] = {}


def _units(path: str):
    """(outs, scaled weights, biases) of a block of units; None if it is empty.
    A worker keeps the last one it read."""
    if path not in _units_read:
        t = read_folder(path, ["out", "w", "g", "b"])
        _units_read.clear()
        _units_read[path] = None
        if t is not None and t.num_rows:
            mat = np.array(t.column("w").to_pylist(), dtype=np.float64)
            g = t.column("g").to_numpy()[:, None]
            norm = np.linalg.norm(mat, axis=1, keepdims=True)
            scaled = np.where(norm > 0, mat * g / np.where(norm > 0, norm, 1), 0.0)
            _units_read[path] = (np.array(t.column("out").to_pylist()), scaled,
                                 t.column("b").to_numpy())
    return _units_read[path]


def linear_score(vec_df: DataFrame, weights: DataFrame, key: str = "id", vec: str = "vector",
                 max_values: int = 4_000_000) -> DataFrame:
    """M4: (key, out, score) with score = x . (g * w / |w|) + b per output
    unit; a unit of norm 0 scores b (the reference gives NaN there).

    ``weights`` is (out, w ARRAY, g, b). Units are written once as Parquet
    blocks of about ``max_values`` weights in the checkpoint folder, and tasks
    read them there: rows are scored where they lie, one product per Arrow
    batch and block. No weight passes through the driver, the input is read
    once, and any number of units is scored.
    """
    spark = vec_df.sparkSession
    x = vec_df.select(key, F.col(vec).cast("array<double>").alias("_x"))
    w = checkpoint(weights.select("out", F.col("w").cast("array<double>").alias("w"),
                                  F.col("g").cast("double").alias("g"),
                                  F.col("b").cast("double").alias("b")), "weights")
    size = w.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("w")).alias("d")).first()
    blocks = max(1, math.ceil(size["n"] * (size["d"] or 1) / max_values))
    root = scratch_path(spark, "weight-blocks")
    (w.withColumn("block", F.pmod(F.xxhash64("out"), F.lit(blocks))).repartition(blocks, "block")
     .write.partitionBy("block").parquet(root))
    schema = StructType([vec_df.schema[key], StructField("out", w.schema["out"].dataType),
                         StructField("score", DoubleType())])

    def score(batches):
        for batch in batches:
            for i in range(blocks if len(batch) else 0):
                units = _units(f"{root}/block={i}")
                if units is None:
                    continue
                outs, m, b = units
                step = max(1, SIM_VALUES_PER_SLICE // len(outs))
                for lo in range(0, len(batch), step):
                    part = batch.iloc[lo:lo + step]
                    s = np.vstack(part["_x"].to_numpy()) @ m.T + b
                    yield pd.DataFrame({key: np.repeat(part[key].to_numpy(), len(outs)),
                                        "out": np.tile(outs, len(part)), "score": s.ravel()})
    return x.mapInPandas(score, schema)
