"""Quality by nearest-neighbour voting in a latent-semantic space.

A text is its hashed byte-trigram counts, logarithmic, weighted by inverse
document frequency over the whole corpus, and projected on the leading
singular vectors of a bounded labelled sample. The sample's vectors are
broadcast (LABELLED x DIM floats: 1 MB); every document's exact cosines with
all of them are blocked matrix products in tasks, and the nearest NEIGHBOURS
vote with their similarity as weight.

Scores are made of whole numbers as far as sums go (weights, directions and
vectors are rounded to steps of 2^-12, 2^-20 and 2^-24, and their products add
up below 2^53), so that no order of summation rounds and a score depends on the
text alone, not on the rows or the shape of its block.

Contract: null and empty texts have no direction and score the sample's mean
label; so does everything where nothing is labelled (0.5 without labels);
equal texts score alike; columns of the input are kept as they are.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from polarity.llm import words as W
from polarity.llm.common import arrow_batches, labelled_sample, trim_memory

BINS = 4096
DIM = 64
NEIGHBOURS = 25
SHARPNESS = 4
#: bounds of the labelled sample: documents, and bytes of each of them
LABELLED = 4000
LABELLED_BYTES = 16_384
CHUNK = 1 << 20
#: steps of weights, directions and unit vectors
WEIGHT, DIRECTION, UNIT = 2.0 ** 12, 2.0 ** 20, 2.0 ** 24
#: labelled vectors a key can tell apart
PLACES = 1 << 13

_rng = np.random.Generator(np.random.PCG64(11))
_MIX = _rng.integers(0, BINS, (3, 256)).astype(np.int32)


def counts(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """(texts, BINS) counts of hashed byte trigrams; the two bytes around a
    text count as blanks."""
    n = len(offsets) - 1
    if not len(raw):
        return np.zeros((n, BINS), np.float32)
    before = np.concatenate([[np.uint8(32)], raw[:-1]])
    after = np.concatenate([raw[1:], [np.uint8(32)]])
    inner = offsets[(offsets > 0) & (offsets < len(raw))]
    before[inner] = 32
    after[inner - 1] = 32
    code = _MIX[0][before] ^ _MIX[1][raw] ^ _MIX[2][after]
    row = np.repeat(np.arange(n, dtype=np.int64) * BINS, np.diff(offsets))
    return np.bincount(row + code, minlength=n * BINS).reshape(n, BINS).astype(np.float32)


def text_blocks(column: pa.Array):
    """(first row, counts) of blocks of texts, by bytes and at most 256 rows."""
    raw, offsets = W.utf8(column)
    for a, b in W.chunks(offsets, CHUNK):
        for i in range(a, b, 256):
            j = min(b, i + 256)
            o = offsets[i:j + 1]
            yield i, counts(raw[o[0]:o[-1]], o - o[0])


def weighted(c: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = np.log1p(c) * idf
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)


def document_frequencies(docs: DataFrame, text_col: str = "text") -> tuple[np.ndarray, int]:
    """Texts that hold each bin, over all documents, and their number. Each
    task sends one row per bin at most; BINS sums reach the driver."""
    def run(batches):
        df, n = np.zeros(BINS, np.int64), 0
        for batch in batches:
            for _, c in text_blocks(batch.column(0)):
                df += (c > 0).sum(0)
                n += len(c)
        bins = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(bins, -1)), pa.array(np.append(df[bins], n))], names=["bin", "n"])
    got = (docs.select(text_col).mapInArrow(run, "bin long, n long")
           .groupBy("bin").agg(F.sum("n").alias("n")).collect())
    df, n = np.zeros(BINS), 0
    for r in got:
        if r["bin"] < 0:
            n = r["n"]
        else:
            df[r["bin"]] = r["n"]
    return df, n


def leading(x: np.ndarray, dim: int, seed: int = 3) -> np.ndarray:
    """Leading right singular vectors (columns) by subspace iteration."""
    dim = min(dim, *x.shape)
    rng = np.random.Generator(np.random.PCG64(seed))
    q = rng.standard_normal((x.shape[1], min(x.shape[1], dim + 10))).astype(np.float32)
    for _ in range(4):
        q, _ = np.linalg.qr(x.T @ (x @ q))
    _, _, vt = np.linalg.svd(x @ q, full_matrices=False)
    return np.ascontiguousarray((q @ vt.T)[:, :dim], np.float32)


def fit(texts: list[str], labels: list[int], df: np.ndarray, n: int) -> dict:
    """Vectors of the labelled sample and the projection that made them."""
    idf = np.log((n + 1) / (df + 1)).astype(np.float32) + np.float32(0.1)
    y = np.asarray(labels, np.float32)
    mean = float(y.mean()) if len(y) else 0.5
    if not len(y):
        return {"idf": idf, "v": np.zeros((BINS, 1), np.float32), "y": y, "mean": mean,
                "points": np.zeros((0, 1), np.float32)}
    x = np.concatenate([weighted(c, idf) for _, c in text_blocks(pa.array(texts,
                                                                          pa.large_string()))])
    v = leading(x, DIM)
    points = unit(x @ v)
    return {"idf": idf, "v": v, "points": points, "y": y, "mean": mean,
            "whole_v": np.rint(v * DIRECTION).astype(np.float64),
            "whole_points": np.rint(points * UNIT).astype(np.float64)}


def unit(x: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(x, axis=1, keepdims=True)
    return np.where(norm > 1e-6, x / np.maximum(norm, 1e-6), 0).astype(np.float32)


def directions(model: dict, c: np.ndarray) -> np.ndarray:
    """Unit vectors of the texts in steps of 1 / UNIT; 0 where a text has no
    direction but rounding."""
    x = np.rint(np.log1p(c) * model["idf"] * np.float32(WEIGHT)).astype(np.float64)
    p = x @ model["whole_v"]
    square = np.zeros(len(c))
    for j in range(p.shape[1]):  # one order, whatever the block
        square += p[:, j] * p[:, j]
    norm = np.sqrt(square)
    real = norm > 64 * x.max(axis=1, initial=0)
    return np.where(real[:, None], np.rint(p / np.where(real, norm, 1)[:, None] * UNIT), 0)


def vote(model: dict, c: np.ndarray, k: int = NEIGHBOURS) -> np.ndarray:
    """Similarity-weighted mean label of the k nearest (the first of equally
    near ones), drawn slightly to the sample's mean."""
    y = model["y"].astype(np.float64)
    if not len(y):
        return np.full(len(c), model["mean"])
    sims = (directions(model, c) @ model["whole_points"].T).astype(np.int64)
    k = min(k, len(y))
    key = sims * PLACES
    key -= np.arange(len(y))
    near = np.sort(np.argpartition(-key, k - 1, axis=1)[:, :k], axis=1)
    total, voted = np.zeros(len(c)), np.zeros(len(c))
    for j in range(k):
        s = np.maximum(sims[np.arange(len(c)), near[:, j]], 0) / (UNIT * UNIT)
        w = (s * s) ** (SHARPNESS // 2)
        total += w
        voted += w * y[near[:, j]]
    return (voted + model["mean"] * 0.1) / (total + 0.1)


def train(docs: DataFrame, labels: DataFrame, label_col: str = "quality", folds: int = 5) -> dict:
    """A model from at most LABELLED labelled documents of at most
    LABELLED_BYTES bytes, in order of a hash of their id; documents whose
    crc32 of the id modulo ``folds`` is 0 are held out."""
    arrow_batches(docs.sparkSession)
    texts, y = labelled_sample(docs, labels, label_col, folds, LABELLED, LABELLED_BYTES, "knn")
    df, n = document_frequencies(docs)
    model = fit(texts, y, df, n)
    trim_memory()
    return model


def score(docs: DataFrame, model: dict, text_col: str = "text",
          score_col: str = "score") -> DataFrame:
    """``docs`` with a score column more (its name must be new)."""
    arrow_batches(docs.sparkSession)
    names = docs.columns
    at = names.index(text_col)
    schema = StructType(docs.schema.fields + [StructField(score_col, DoubleType())])
    shipped = docs.sparkSession.sparkContext.broadcast(model)  # 8 MB, by LABELLED and DIM

    def run(batches):
        for batch in batches:
            out = np.zeros(batch.num_rows)
            for a, c in text_blocks(batch.column(at)):
                out[a:a + len(c)] = vote(shipped.value, c)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.clip(out, 0, 1))], names=[*names, score_col])
    return docs.mapInArrow(run, schema)
