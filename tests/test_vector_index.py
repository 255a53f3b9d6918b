"""The random-projection index against the exact search."""

import os

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from polarity.operators.neighbors import nearest
from polarity.operators.vector_index import build_index, candidates, nearest_indexed

VOCAB = "id int, word string, vector array<double>"
ASKED = "qid long, vector array<double>"


def words(spark, vectors, first=0):
    return spark.createDataFrame([(i + first, f"w{i + first}", list(map(float, x)))
                                  for i, x in enumerate(vectors)], VOCAB)


def asked(spark, vectors):
    return spark.createDataFrame([(i, None if x is None else list(map(float, x)))
                                  for i, x in enumerate(vectors)], ASKED)


def rows(df):
    return sorted((r["qid"], r["rank"], r["word_id"], r["word"], round(r["sim"], 9))
                  for r in df.collect())


def test_recall_on_grouped_vectors(spark, tmp_out):
    rng = np.random.default_rng(3)
    x = np.repeat(rng.standard_normal((200, 32)), 40, 0)
    x = x + .35 * rng.standard_normal(x.shape)
    vocab = words(spark, x)
    q = asked(spark, x[rng.integers(0, len(x), 300)] + .35 * rng.standard_normal((300, 32)))
    index = build_index(vocab, os.path.join(tmp_out, "ix"), bucket_rows=64)
    got, exact = rows(nearest_indexed(q, index, vocab, k=10)), rows(nearest(q, vocab, k=10))
    assert len(got) == len(exact) == 3000
    found = {(r[0], r[2]): r[4] for r in got}
    best = {(r[0], r[2]): r[4] for r in exact}
    assert len(found.keys() & best.keys()) / len(best) >= 0.9
    assert all(found[p] == best[p] for p in found.keys() & best.keys())  # exact cosines
    # far fewer comparisons than all pairs
    sizes = spark.read.parquet(f"{index.path}/sizes")
    met, _ = candidates(q.select(F.col("qid").alias("_row"), F.col("vector").alias("_qv")), index)
    compared = met.join(sizes, "bucket").agg(F.sum("count")).first()[0]
    assert compared < 0.35 * 300 * len(x)
    # every vector is in every table
    assert sizes.agg(F.sum("count")).first()[0] == index.tables * len(x)


def test_one_bucket_is_dealt_and_exact(spark, tmp_out):
    rng = np.random.default_rng(4)
    x = 5 + .01 * rng.standard_normal((300, 8))  # all in one cone
    x[10:110] = x[10]  # a vector on a third of the words
    vocab = words(spark, x)
    q = asked(spark, 5 + .01 * rng.standard_normal((120, 8)))
    index = build_index(vocab, os.path.join(tmp_out, "ix"), k=5, bucket_rows=64)
    got = rows(nearest_indexed(q, index, vocab, k=5, group_rows=20))
    assert got == rows(nearest(q, vocab, k=5))
    asks, meets = candidates(q.select(F.col("qid").alias("_row"), F.col("vector").alias("_qv")),
                             index, group_rows=20)
    at = ["bucket", "part", "turn"]
    for side in (asks, meets):  # dealt by hash: about 20 rows a group
        assert side.groupBy(*at).count().agg(F.max("count")).first()[0] <= 60
    # each query meets each vector of a bucket in one group
    pairs = asks.join(meets, at).groupBy("bucket", "_row", F.col("words")[0]["id"]).count()
    assert pairs.where("count > 1").isEmpty()


def test_ties_repeats_nulls_and_few_words(spark, tmp_out):
    vocab = words(spark, [[1, 0], [1, 0], [0, 1], [0, 0]]).unionAll(
        spark.createDataFrame([(9, "null", None)], VOCAB))
    q = asked(spark, [[2, 0], [2, 0], None, [0, 0]]).unionAll(asked(spark, [[2, 0]]))
    index = build_index(vocab, os.path.join(tmp_out, "ix"))
    got = rows(nearest_indexed(q, index, vocab, k=2))
    assert got == sorted([(i, r, r, f"w{r}", 1.0) for i in (0, 0, 1) for r in (0, 1)]
                         + [(3, r, r, f"w{r}", 0.0) for r in (0, 1)])
    # more than the vocabulary holds: all of it, by the exact search
    all_words = rows(nearest_indexed(q.where("qid = 1"), index, vocab, k=9))
    assert [r[2] for r in all_words] == [0, 1, 2, 3]
    assert nearest_indexed(q.limit(0), index, vocab).count() == 0
    with pytest.raises(ValueError):
        nearest_indexed(q, index, vocab, k=11)
    with pytest.raises(ValueError):
        build_index(vocab.limit(0), os.path.join(tmp_out, "none"))
