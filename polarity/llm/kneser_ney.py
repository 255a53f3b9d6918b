"""Interpolated modified Kneser-Ney language model (bigrams).

Counting is one exchange: tasks send their distinct bigrams with counts,
packed and bucketed by context (the contexts of a hot word are spread over all
buckets by the second word), and a bucket's task merges them into a sorted
array of bigram hashes with their counts, written as a file to the shared
checkpoint folder. What a bucket knows of words (how often each is a context,
how many of its bigrams occur once, twice, more often, and in how many
contexts it follows) is summed per word in a second, smaller exchange and
written as sorted arrays too. Discounts come from sums of counts.

Scoring is one pass over the texts: workers map the files into memory, look up
the distinct words and bigrams of a block of texts by binary search and add
logarithms. A lost executor repeats its buckets; files of attempts that failed
are never listed. Files on stores that cannot be mapped are copied to a
temporary file by the worker first.

Contract: A-Z count as lower case; null text is empty, and every text ends in
one end token; repeated rows count as often as they occur; unknown words share
one reserved probability; with nothing to learn from, every text scores 0.
"""

from __future__ import annotations

import tempfile
import uuid

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from polarity.llm import words as W
from polarity.llm.common import arrow_batches, checkpoint, scratch_path

#: hashes of the marks before and after a text (no word hashes are reserved;
#: a clash has the odds of any other 64-bit one)
START, END = np.uint64(0x243F6A8885A308D3), np.uint64(0x13198A2E03707344)
#: tokens per bucket, aimed at; tokens a task gathers before it sends them
BUCKET_TOKENS = 2_500_000
FLUSH = 3_000_000
#: words per word file, aimed at
SHARD_WORDS = 1_000_000
#: part of a task's tokens from which a word is reported as frequent
FREQUENT = 0.001
CHUNK = 1 << 20


# ---------------------------------------------------------------- tokens

def sequences(raw: np.ndarray, offsets: np.ndarray):
    """(hashes, first): START, words and END of every text in one array, and
    where each text begins."""
    h, row = W.word_hashes(raw, offsets, lower=True)
    n = len(offsets) - 1
    bounds = W.row_starts(row, n)
    out = np.empty(len(h) + 2 * n, np.uint64)
    i = np.arange(n)
    out[np.arange(len(h)) + 2 * row + 1] = h
    out[bounds[:-1] + 2 * i] = START
    out[bounds[1:] + 2 * i + 1] = END
    return out, np.append(bounds[:-1] + 2 * i, len(out))


def text_blocks(column: pa.Array):
    raw, offsets = W.utf8(column)
    for a, b in W.chunks(offsets, CHUNK):
        o = offsets[a:b + 1]
        yield a, b, *sequences(raw[o[0]:o[-1]], o - o[0])


def bucket_of(v: np.ndarray, w: np.ndarray, hot: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket of a bigram: by its context, or by both words under a hot one."""
    spread = np.isin(v, hot)
    return (W.mix(np.where(spread, W.combine([v, w]), v)) % np.uint64(buckets)).astype(np.int32)


# ---------------------------------------------------------------- packing

def _small(c: np.ndarray) -> list[np.ndarray]:
    """Counts as bytes; those of 255 and more in two arrays beside them."""
    big = np.flatnonzero(c >= 255)
    return [np.minimum(c, 255).astype(np.uint8), big.astype(np.uint32), c[big].astype(np.uint64)]


def _large(parts) -> np.ndarray:
    c = parts[0].astype(np.int64)
    c[parts[1]] = parts[2].astype(np.int64)
    return c


def pack(arrays: list[np.ndarray]) -> bytes:
    """Arrays of any types in one value."""
    head = np.array([len(arrays)] + [x for a in arrays for x in (a.itemsize, len(a))], np.uint32)
    return head.tobytes() + b"".join(a.tobytes() for a in arrays)


_TYPES = {1: np.uint8, 4: np.uint32, 8: np.uint64}


def unpack(blob: bytes) -> list[np.ndarray]:
    n = int(np.frombuffer(blob, np.uint32, 1)[0])
    head = np.frombuffer(blob, np.uint32, 1 + 2 * n)[1:].reshape(n, 2)
    out, at = [], 4 + 8 * n
    for size, length in head.tolist():
        out.append(np.frombuffer(blob, _TYPES[size], length, at))
        at += size * length
    return out


def _blob_rows(buckets, blobs, names=("bucket", "blob")):
    return pa.RecordBatch.from_arrays([pa.array(buckets, pa.int32()), pa.array(blobs, pa.binary())],
                                      names=list(names))


def _send(s: np.ndarray, hot: np.ndarray, buckets: int):
    """Distinct bigrams of sequences with counts, one packed value per bucket."""
    both, code = np.unique(s, return_inverse=True)
    code = code.ravel()
    inside = np.flatnonzero(s[1:] != START)
    pair, c = np.unique(code[inside] * len(both) + code[inside + 1], return_counts=True)
    del code, inside
    v, w = both[pair // len(both)], both[pair % len(both)]
    bucket = bucket_of(v, w, hot, buckets)
    order = np.argsort(bucket, kind="stable")
    v, w, c = v[order], w[order], c[order]
    edges = np.searchsorted(bucket[order], np.arange(buckets + 1))
    ids, blobs = [], []
    for b in np.flatnonzero(np.diff(edges)):
        s = slice(edges[b], edges[b + 1])
        first = np.flatnonzero(np.concatenate([[True], v[s][1:] != v[s][:-1]]))
        runs = np.diff(np.append(first, edges[b + 1] - edges[b])).astype(np.uint32)
        ids.append(int(b))
        blobs.append(pack([v[s][first], runs, w[s], *_small(c[s])]))
    return _blob_rows(ids, blobs)


def _pairs(hot: np.ndarray, buckets: int):
    """mapInArrow: texts -> packed bigram counts by bucket."""
    def run(batches):
        held: list[np.ndarray] = []
        for batch in batches:
            for _, _, s, _ in text_blocks(batch.column(0)):
                held.append(s)
                if sum(map(len, held)) >= FLUSH:
                    yield _send(np.concatenate(held), hot, buckets)
                    held = []
        if held:
            yield _send(np.concatenate(held), hot, buckets)
    return run


# ---------------------------------------------------------------- files

def _filesystem(uri: str):
    """(file system, path) of a Hadoop-style path or URI."""
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    if "://" not in uri:
        return pafs.LocalFileSystem(), uri
    return pafs.FileSystem.from_uri(uri)


def write_array(root: str, name: str, a: np.ndarray) -> str:
    """Write under a name that no other attempt uses; returns its place."""
    f, path = _filesystem(root)
    f.create_dir(path, recursive=True)
    name = f"{name}-{uuid.uuid4().hex}"
    with f.open_output_stream(f"{path}/{name}") as out:
        out.write(a.tobytes())
    return f"{root}/{name}"


_maps: dict[str, np.ndarray] = {}


def mapped(uri: str, dtype, n: int) -> np.ndarray:
    """The array as a read-only memory map, opened once per worker."""
    if uri not in _maps:
        f, path = _filesystem(uri)
        if not n:
            _maps[uri] = np.zeros(0, dtype)
        elif isinstance(f, pafs.LocalFileSystem):
            _maps[uri] = np.memmap(path, dtype, "r", shape=(n,))
        else:
            copy = tempfile.TemporaryFile()
            with f.open_input_stream(path) as src:
                while part := src.read(8 << 20):
                    copy.write(part)
            copy.flush()
            _maps[uri] = np.memmap(copy, dtype, "r", shape=(n,))
    return _maps[uri]


# ---------------------------------------------------------------- reducing

def _merge_bucket(root: str, shards: int):
    """applyInArrow: a bucket's packed counts -> its files, its sums of counts
    and packed word statistics by word shard."""
    def run(key, table):
        bucket = key[0].as_py()
        vs, ws, cs = [], [], []
        for blob in table.column("blob").to_pylist():
            v, runs, w, *c = unpack(blob)
            vs.append(np.repeat(v, runs))
            ws.append(w)
            cs.append(_large(c))
        v, w, c = np.concatenate(vs), np.concatenate(ws), np.concatenate(cs)
        del vs, ws, cs
        v_all, v = np.unique(v, return_inverse=True)
        w_all, w = np.unique(w, return_inverse=True)
        code = v.ravel() * len(w_all) + w.ravel()
        order = np.argsort(code)
        code, c = code[order], c[order]
        first = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]]))
        c, code = np.add.reduceat(c, first), code[first]
        v, w = code // len(w_all), code % len(w_all)
        keys = W.combine([v_all[v], w_all[w]])
        order = np.argsort(keys)
        small, at, big = _small(c[order])
        files = [write_array(root, f"bigrams-{bucket}", keys[order]),
                 write_array(root, f"counts-{bucket}", small),
                 write_array(root, f"large-{bucket}", np.concatenate([at.astype(np.uint64), big]))]
        total = np.bincount(v, c, len(v_all)).astype(np.int64)
        kinds = [np.bincount(v[k], minlength=len(v_all)) for k in (c == 1, c == 2, c >= 3)]
        after = np.bincount(w, minlength=len(w_all))
        words = np.concatenate([v_all, w_all])
        zero = np.zeros(len(w_all), np.int64)
        stats = [np.concatenate([s, zero]) for s in (total, *kinds)]
        stats.append(np.concatenate([np.zeros(len(v_all), np.int64), after]))
        rows = list(_word_blobs(words, stats, shards))
        meta = pack([np.array([len(keys), len(big)] + [int((c == k).sum()) for k in (1, 2, 3, 4)],
                              np.uint64)])
        kind = ["file"] + ["words"] * len(rows)
        return pa.table({
            "kind": pa.array(kind), "shard": pa.array([bucket] + [s for s, _ in rows], pa.int32()),
            "blob": pa.array([meta] + [b for _, b in rows], pa.binary()),
            "files": pa.array([files] + [None] * len(rows), pa.list_(pa.string()))})
    return run


def shard_of(words: np.ndarray, shards: int) -> np.ndarray:
    return (words % np.uint64(shards)).astype(np.int64)


def _word_blobs(words: np.ndarray, stats: list[np.ndarray], shards: int):
    shard = shard_of(words, shards)
    for s in range(shards):
        at = np.flatnonzero(shard == s)
        if len(at):
            yield s, pack([words[at]] + [p for x in stats for p in _small(x[at])])


_WORD_COLUMNS = ("context", "once", "twice", "more", "after")


def _merge_words(root: str):
    """applyInArrow: a word shard's packed statistics -> its files and sums."""
    def run(key, table):
        shard = key[0].as_py()
        words, stats = [], []
        for blob in table.column("blob").to_pylist():
            w, *parts = unpack(blob)
            words.append(w)
            stats.append([_large(parts[3 * i:3 * i + 3]) for i in range(len(_WORD_COLUMNS))])
        words, inverse = np.unique(np.concatenate(words), return_inverse=True)
        inverse = inverse.ravel()
        sums = [np.bincount(inverse, np.concatenate([s[i] for s in stats]), len(words))
                .astype(np.uint64) for i in range(len(_WORD_COLUMNS))]
        files = [write_array(root, f"words-{shard}", words)]
        files += [write_array(root, f"{name}-{shard}", x) for name, x in zip(_WORD_COLUMNS, sums)]
        real = (words != START)
        after = sums[4]
        meta = [len(words), int(sums[0][real].sum()), int((real & (words != END)).sum()),
                int(after.sum())] + [int((after == k).sum()) for k in (1, 2, 3, 4)] + [
                int((after >= 3).sum())]
        return pa.table({"shard": pa.array([shard], pa.int32()),
                         "blob": pa.array([pack([np.array(meta, np.uint64)])], pa.binary()),
                         "files": pa.array([files], pa.list_(pa.string()))})
    return run


def discounts(n1: int, n2: int, n3: int, n4: int) -> np.ndarray:
    """Discounts of counts 0, 1, 2 and 3 or more; 0.75 where the counts of
    counts do not determine one, and never more than the count."""
    y = n1 / (n1 + 2 * n2) if n1 + 2 * n2 else 0.0
    out = [0.0]
    for k, a, b in ((1, n1, n2), (2, n2, n3), (3, n3, n4)):
        d = k - (k + 1) * y * b / a if a and y else 0.75
        out.append(min(max(d, 0.05), float(k)))
    return np.array(out)


def frequent_words(texts: DataFrame) -> tuple[list[tuple[int, int]], int, int]:
    """((word, count) of words that are a part FREQUENT or more of a task's
    tokens, by their counts in such tasks, at most 1 / FREQUENT a task; all
    tokens; texts."""
    def run(batches):
        n, docs, seen, counts = 0, 0, np.zeros(0, np.uint64), np.zeros(0, np.int64)
        for batch in batches:
            docs += len(batch)
            for _, _, s, _ in text_blocks(batch.column(0)):
                n += int((s != START).sum())
                u, c = np.unique(s, return_counts=True)
                use = c >= FREQUENT * len(s)
                seen, inverse = np.unique(np.concatenate([seen, u[use]]), return_inverse=True)
                counts = np.bincount(inverse.ravel(), np.concatenate([counts, c[use]]),
                                     len(seen)).astype(np.int64)
        use = counts >= FREQUENT * n
        yield pa.RecordBatch.from_arrays(
            [pa.array(["word"] * int(use.sum()) + ["all", "texts"]),
             pa.array(np.append(W.signed(seen[use]), [0, 0])),
             pa.array(np.append(counts[use], [n, docs]))], names=["kind", "w", "c"])
    got = (texts.mapInArrow(run, "kind string, w long, c long").groupBy("kind", "w")
           .agg(F.sum("c").alias("c")))
    got = checkpoint(got, "frequent")
    total = {r["kind"]: r["c"] for r in got.where("kind != 'word'").collect()}
    n = total.get("all", 0)
    hot = [(r["w"], r["c"]) for r in got.where("kind = 'word'")
           .where(F.col("c") * 2 * buckets_for(n) > n).collect()]  # under 2 * buckets rows
    return hot, n, total.get("texts", 0)


def buckets_for(tokens: int) -> int:
    return max(1, -(-tokens // BUCKET_TOKENS))


def train(texts: DataFrame) -> dict:
    """Count the texts (one string column) and write the model; returns where
    its files are and its few scalars."""
    spark = texts.sparkSession
    arrow_batches(spark)
    hot, tokens, n_texts = frequent_words(texts)
    buckets = buckets_for(tokens)
    shards = max(1, -(-buckets * BUCKET_TOKENS // 20 // SHARD_WORDS))
    root = scratch_path(spark, "kneser-ney")
    hot = np.sort(np.array([w for w, _ in hot], np.int64).view(np.uint64))
    sent = texts.mapInArrow(_pairs(hot, buckets), "bucket int, blob binary")
    merged = checkpoint(sent.repartition(buckets, "bucket").groupBy("bucket").applyInArrow(
        _merge_bucket(root, shards), "kind string, shard int, blob binary, files array<string>"),
        "kn-bigrams")
    words = checkpoint(merged.where("kind = 'words'").select("shard", "blob")
                       .repartition(shards, "shard").groupBy("shard").applyInArrow(
        _merge_words(root), "shard int, blob binary, files array<string>"), "kn-words")
    # a row per file; their number is that of buckets and shards
    bi = {r["shard"]: (r["files"], unpack(bytes(r["blob"]))[0].tolist())
          for r in merged.where("kind = 'file'").select("shard", "blob", "files").collect()}
    wo = {r["shard"]: (r["files"], unpack(bytes(r["blob"]))[0].tolist()) for r in words.collect()}
    sums = np.array([m[2:6] for _, m in bi.values()] or [[0] * 4]).sum(0).tolist()
    w_sums = np.array([m[1:] for _, m in wo.values()] or [[0] * 8]).sum(0).tolist()
    n_tokens, vocabulary = w_sums[0] + n_texts, w_sums[1] + (n_texts > 0)
    d_low = discounts(*w_sums[3:7])
    pairs = w_sums[2]
    spare = (d_low[1] * w_sums[3] + d_low[2] * w_sums[4] + d_low[3] * w_sums[7]) / pairs \
        if pairs else 1.0
    return {"buckets": buckets, "shards": shards, "hot": hot,
            "bigrams": {b: (f, m[0], m[1]) for b, (f, m) in bi.items()},
            "words": {s: (f, m[0]) for s, (f, m) in wo.items()},
            "tokens": n_tokens, "vocabulary": vocabulary, "texts": n_texts, "pairs": pairs,
            "d_low": d_low, "d_high": discounts(*sums), "spare": spare}


# ---------------------------------------------------------------- scoring

def _find(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Place of each (sorted) wanted key, -1 where there is none."""
    if not len(keys):
        return np.full(len(wanted), -1)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, at, -1)


def word_stats(model: dict, words: np.ndarray) -> np.ndarray:
    """A row per (sorted, distinct) word: the columns of _WORD_COLUMNS."""
    out = np.zeros((len(words), len(_WORD_COLUMNS)), np.int64)
    shard = shard_of(words, model["shards"])
    for s, (files, n) in model["words"].items():
        at = np.flatnonzero(shard == s)
        place = _find(mapped(files[0], np.uint64, n), words[at])
        hit = place >= 0
        for i, f in enumerate(files[1:]):
            out[at[hit], i] = mapped(f, np.uint64, n)[place[hit]]
    return out


def bigram_counts(model: dict, v: np.ndarray, w: np.ndarray) -> np.ndarray:
    keys = W.combine([v, w])
    bucket = bucket_of(v, w, model["hot"], model["buckets"])
    order = np.argsort(keys)
    order = order[np.argsort(bucket[order], kind="stable")]
    there, edges = np.unique(bucket[order], return_index=True)
    out = np.zeros(len(keys), np.int64)
    for b, at in zip(there.tolist(), np.split(order, edges[1:])):
        if b not in model["bigrams"]:
            continue
        files, n, big = model["bigrams"][b]
        place = _find(mapped(files[0], np.uint64, n), keys[at])
        hit = np.flatnonzero(place >= 0)
        c = mapped(files[1], np.uint8, n)[place[hit]].astype(np.int64)
        many = np.flatnonzero(c == 255)
        if len(many):
            large = mapped(files[2], np.uint64, 2 * big)
            c[many] = large[big + _find(large[:big], place[hit][many].astype(np.uint64))]
        out[at[hit]] = c
    return out


def score_block(model: dict, s: np.ndarray, first: np.ndarray):
    """(tokens, known, base, score) of each text of a block of sequences."""
    both, code = np.unique(s, return_inverse=True)
    code = code.ravel()
    stats = word_stats(model, both)
    n, vocab = model["tokens"], model["vocabulary"]
    token = np.where(both == START, 0, np.where(both == END, model["texts"], stats[:, 0]))
    base = np.log10((token + 1) / (n + vocab + 1))
    d, pairs = model["d_low"], max(model["pairs"], 1)
    after = stats[:, 4]
    low = np.maximum(after - d[np.minimum(after, 3)], 0) / pairs + model["spare"] / (vocab + 1)
    d = model["d_high"]
    context = np.maximum(stats[:, 0], 1)
    back = np.where(stats[:, 0] > 0, stats[:, 1:4] @ d[1:] / context, 1.0)
    inside = np.flatnonzero(s[1:] != START)
    v, w = code[:-1][inside], code[1:][inside]
    pair, of = np.unique(v * len(both) + w, return_inverse=True)
    pv, pw = pair // len(both), pair % len(both)
    c = bigram_counts(model, both[pv], both[pw])
    high = np.maximum(c - d[np.minimum(c, 3)], 0) / context[pv] + back[pv] * low[pw]
    logs = np.log10(high)[of.ravel()]
    # token i of text t is number first[t] - t + i
    starts = first[:-1] - np.arange(len(first) - 1)
    count = np.diff(first) - 1
    add = lambda x: np.add.reduceat(x, starts)  # noqa: E731  every text has a token
    return count, add((token[w] > 0).astype(np.int64)), add(base[w]), add(logs)


def score(docs: DataFrame, model: dict, text_col: str = "text") -> DataFrame:
    """``docs`` with n_tokens, n_known, base_score and score (new names)."""
    arrow_batches(docs.sparkSession)
    names = docs.columns
    at = names.index(text_col)
    more = ["n_tokens", "n_known", "base_score", "score"]
    schema = StructType(docs.schema.fields + [
        StructField(n, LongType() if n[0] == "n" else DoubleType()) for n in more])
    # a name per file and a few numbers: 30 kB a GB of text
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            parts = [score_block(shipped.value, s, first)
                     for _, _, s, first in text_blocks(batch.column(at))]
            cols = [np.concatenate([p[i] for p in parts]) if parts else np.zeros(0)
                    for i in range(4)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *(pa.array(c, pa.int64() if i < 2 else pa.float64())
                                   for i, c in enumerate(cols))], names=[*names, *more])
    return docs.mapInArrow(run, schema)
