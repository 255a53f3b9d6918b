"""Anchors against an independent version, spans that two texts share, and
buckets of neighbouring ids."""

import random
import struct

import pytest
import xxhash
from pyspark.sql import functions as F

from polarity.llm import syncmers as S


def brute_anchors(words, k=S.K):
    """Closed syncmers by their definition: a least inner word at an edge."""
    h = [xxhash.xxh64_intdigest(w.encode(), 42) for w in words]
    signed = [x - (1 << 64) if x >> 63 else x for x in h]

    def of(part):
        seed = 42
        for x in part:
            seed = xxhash.xxh64_intdigest(struct.pack("<Q", x), seed)
        return seed & 0xFFFFFFFF
    if len(h) < k:
        return [(of(h), 0)] if h else []
    return [(of(h[i:i + k]), i) for i in range(len(h) - k + 1)
            if min(signed[i:i + k]) in (signed[i], signed[i + k - 1])]


@pytest.mark.parametrize("k", [3, 5])
def test_anchors_are_the_closed_syncmers(spark, k):
    rng = random.Random(3)
    texts = [[], ["a"], ["a", "b"], ["a"] * 9, ["a", "b"] * 6] + [
        [rng.choice(["x", "y", "é", "zz", f"n{rng.random()}"]) for _ in range(rng.randrange(60))]
        for _ in range(40)]
    df = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "i int, t string")
    got = {r.i: [tuple(x) for x in r.a] for r in df.select("i", S.placed_anchors(df.t, k).alias("a")).collect()}
    assert got == {i: brute_anchors(t, k) for i, t in enumerate(texts)}


def brute_matched(a, b, k=S.K):
    both = set(brute_anchors(a)) & set(brute_anchors(b))
    return len({p + j for _, p in both for j in range(k)})


def test_words_matched_at_one_place(spark):
    rng = random.Random(5)
    pairs = []
    for _ in range(30):
        a = [rng.choice("abcdefgh") for _ in range(rng.randrange(80))]
        b = [w if rng.random() < 0.9 else "new" for w in a] + ["end"] * rng.randrange(3)
        pairs.append((a, b))
    pairs += [(["a"] * 20, ["a"] * 30), ([], []), (list("abcdef"), list("uvwxyz"))]
    df = spark.createDataFrame([(i, " ".join(a), " ".join(b)) for i, (a, b) in enumerate(pairs)],
                               "i int, a string, b string")
    got = {r.i: r.n for r in df.select("i", S.matched_words(
        S._packed(df.a, S.K), S._packed(df.b, S.K)).alias("n")).collect()}
    assert got == {i: brute_matched(a, b) for i, (a, b) in enumerate(pairs)}


def brute_spans(a, b, k=S.K):
    places = {}
    for side, words in enumerate((a, b)):
        for h, p in brute_anchors(words):
            places.setdefault(h, ([], []))[side].append(p)
    met = {}
    for left, right in places.values():
        for x, y in zip(left, right):
            met.setdefault(x - y, []).append(x)
    out = set()
    for d, at in met.items():
        at.sort()
        start = 0
        for i in range(1, len(at) + 1):
            if i == len(at) or at[i] - at[i - 1] > k:
                out.add((at[start], at[start] - d, at[i - 1] - at[start] + k, i - start))
                start = i
    return out


def test_shared_passages_are_found_where_they_lie(spark):
    rng = random.Random(7)
    word = lambda: f"w{rng.randrange(10 ** 6)}"
    made = []
    for n in (12, 51, 300):
        passage = [word() for _ in range(n)]
        made.append(([word() for _ in range(40)] + passage + [word() for _ in range(9)],
                     [word() for _ in range(700)] + passage, 40, 700, n))
    pairs = [m[:2] for m in made] + [(["a"] * 40, ["a"] * 25), (list("abcab") * 8, list("abxab") * 8),
                                     ([], ["a"]), (["p"], ["q"])]
    df = spark.createDataFrame([(i, " ".join(a), " ".join(b)) for i, (a, b) in enumerate(pairs)],
                               "pair int, a string, b string")
    df = df.select("pair", S.placed_anchors(df.a).alias("x"), S.placed_anchors(df.b).alias("y"))
    got = {}
    for r in S.aligned_spans(df, "pair", "x", "y").collect():
        got.setdefault(r.pair, set()).add((r.left_start, r.right_start, r.n_words, r.n_anchors))
    assert got == {i: s for i, (a, b) in enumerate(pairs) if (s := brute_spans(a, b))}
    for i, (a, b, x, y, n) in enumerate(made):
        (left, right, words, _), = got[i]
        assert x <= left <= x + S.K - 2 and left - right == x - y
        assert n - 2 * (S.K - 2) <= words <= n
    assert all(a[x:x + n] == b[y:y + n] for i, (a, b) in enumerate(pairs)
               for x, y, n, _ in got.get(i, ()))
    nothing = df.select("pair", F.lit(None).cast(df.schema["x"].dataType).alias("x"), "y")
    assert S.aligned_spans(nothing, "pair", "x", "y").collect() == []
    assert S.aligned_spans(df.where("false"), "pair", "x", "y").collect() == []


@pytest.mark.parametrize("coarse", [1024, 4])
def test_buckets_rise_and_split_an_id_of_many_rows(spark, monkeypatch, coarse):
    """A third of the rows share an id; every bucket stays small."""
    monkeypatch.setattr(S, "BUCKET_ROWS", 100)
    monkeypatch.setattr(S, "COARSE", coarse)
    monkeypatch.setattr(S, "_FAN", 8)
    rows = spark.range(6000).select(
        F.when(F.col("id") % 3 == 0, 777).otherwise(F.col("id") * 5 - 9000).alias("_k"),
        F.xxhash64("id").alias("_t"))
    got = sorted((r._k, r._t, r._b) for r in S.with_buckets(rows).collect())
    assert len(got) == 6000
    at = [b for _, _, b in got]
    assert at == sorted(at)
    sizes = [at.count(b) for b in set(at)]
    assert max(sizes) <= 300 and len(sizes) >= 40


@pytest.mark.parametrize("coarse", [1024, 3])
def test_next_document_across_buckets(spark, monkeypatch, coarse):
    monkeypatch.setattr(S, "BUCKET_ROWS", 5)
    monkeypatch.setattr(S, "COARSE", coarse)
    rows = [(i * 7 - 300, f"text {i}") for i in range(100)] + [(5, f"many {i}") for i in range(60)]
    rows += [(None, "no id"), (8, "same"), (8, "same"), (2 ** 62, "last")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    got = S.with_next(df, {}, ["doc_id", "text"]).collect()
    assert len(got) == len(rows)
    assert sorted(r._next.text for r in got) == sorted(t for _, t in rows)
    by_key = df.select("doc_id", "text", F.xxhash64("text").alias("t")).collect()
    order = sorted(by_key, key=lambda r: (-2 ** 63 if r.doc_id is None else r.doc_id, r.t), reverse=True)
    want = sorted((r.text, order[(i + 1) % len(order)].text) for i, r in enumerate(order))
    assert sorted((r.text, r._next.text) for r in got) == want
