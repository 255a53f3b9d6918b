"""Closed-syncmer document fingerprints (DataFrame functions only).

Units are words. A k-mer of words is an anchor if the smallest hash among its
inner s-mers lies at its first or last place; that depends on the k-mer alone,
so an edit moves no anchor outside the words it touches. Every anchor is kept
with its place (the number of its first word, from 0), so what two texts share
can be found and aligned: ``matched_words`` measures what lies at the same
place of both, ``aligned_spans`` finds every passage that lies anywhere in both.
The fingerprint is the whole set of distinct anchors, sorted, in hex, and
likeness is the Jaccard similarity of these sets. The bottom sketch, the SKETCH
smallest of them, is a column of its own.

Contract: null text is empty; texts with fewer than k words have one anchor,
the hash of all their words, at 0; texts without words have an empty
fingerprint, and two empty ones have likeness 1. Rows with one id are ordered
by text hash; an id of many rows is dealt over buckets by that hash, so only
rows equal in id and text always share one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from polarity.llm.common import checkpoint, let, small_or_plain, words

K = 3
SKETCH = 256
#: documents per bucket of neighbouring ids, aimed at; beyond MAX_BUCKETS of
#: them buckets grow instead (the first row of each is broadcast by its key)
BUCKET_ROWS = 2000
MAX_BUCKETS = 1 << 20
#: quantiles of all ids, kept as literals; each range is cut again by its own
COARSE = 1024
_FAN = 64


_MASK = 0xFFFFFFFF


def _packed(text: Column, k: int) -> Column:
    """All anchors of a text in order of place, repeated ones too: a long each,
    the place above the 32 bits of the hash (inner s-mers are single words)."""
    def of(h: Column) -> Column:
        def inner_least(i: Column) -> Column:
            edge = F.least(F.get(h, i), F.get(h, i + (k - 1)))
            return edge <= F.least(*[F.get(h, i + j) for j in range(1, k - 1)]) if k > 3 \
                else edge <= F.get(h, i + 1)
        at = F.filter(F.sequence(F.lit(0), F.size(h) - k), inner_least)
        some = F.transform(at, lambda i: F.shiftleft(i.cast("long"), 32).bitwiseOR(
            F.xxhash64(*[F.get(h, i + j) for j in range(k)]).bitwiseAND(F.lit(_MASK))))
        return F.when(F.size(h) >= k, some).when(
            F.size(h) > 0, F.array(F.xxhash64(h).bitwiseAND(F.lit(_MASK)))).otherwise(
                F.array().cast("array<bigint>"))
    return let(F.transform(words(text), lambda w: F.xxhash64(w)), of)


def _hashes(packed: Column) -> Column:
    return F.array_distinct(F.transform(packed, lambda x: x.bitwiseAND(F.lit(_MASK))))


def _places(packed: Column) -> Column:
    return F.transform(packed, lambda x: F.struct(
        x.bitwiseAND(F.lit(_MASK)).alias("hash"), F.shiftright(x, 32).cast("int").alias("position")))


def anchors(text: Column, k: int = K) -> Column:
    """Distinct 32-bit anchors of a text."""
    return _hashes(_packed(text, k))


def placed_anchors(text: Column, k: int = K) -> Column:
    """(hash, position) of every anchor of a text in order of position, the
    number of its first word."""
    return _places(_packed(text, k))


def sketch(hashes: Column, size: int = SKETCH) -> Column:
    """The smallest of a sorted set of anchors."""
    return F.slice(hashes, 1, size)


def as_text(hashes: Column) -> Column:
    return F.lower(F.array_join(F.transform(hashes, lambda x: F.lpad(F.hex(x), 8, "0")), ""))


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity of two sets; 1 if both are empty."""
    return F.when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0)).otherwise(
        let(F.size(F.array_intersect(a, b)), lambda n: n / (F.size(a) + F.size(b) - n)))


def _below(pivots: list, key: Column, equal: bool = False) -> Column:
    """How many of the sorted pivots are below the key (or not above it, if
    ``equal``), through a two-level tree of literals."""
    def under(p):
        return p <= key if equal else p < key
    groups = [pivots[i:i + _FAN] for i in range(0, len(pivots), _FAN)]
    tops = F.lit([g[-1] for g in groups])
    fine = F.array(*[F.lit(g) for g in groups], F.array().cast("array<bigint>"))
    return let(F.size(F.filter(tops, under)), lambda top: top * _FAN + let(
        F.get(fine, top), lambda g: F.size(F.filter(g, under))))


def _dealt(below: Column, upto: Column, share: Column) -> Column:
    """(number, share): the place of a key between pivots. A key that fills
    several pivots has many rows: they are dealt over the ranges it fills by
    ``share`` (0 to 1), of which the part inside the range is left."""
    n = upto - below
    off = F.when(n > 0, F.least(F.floor(share * n).cast("int"), n - 1)).otherwise(0)
    return F.struct((below + off).cast("long").alias("at"),
                    F.when(n > 0, share * n - off).otherwise(share).alias("share"))


def with_buckets(d: DataFrame) -> DataFrame:
    """``d`` (_k, _t: a long key and a hash that orders its rows) with the
    bucket ``_b`` of each row, which never falls as (_k, _t) rises: counts of
    quantile pivots below the key, first of all rows, then of each range."""
    n = min(MAX_BUCKETS, max(1, -(-d.count() // BUCKET_ROWS)))
    if n == 1:
        return d.withColumn("_b", F.lit(0).cast("long"))

    def quantiles(parts):
        return F.percentile_approx("_k", [i / parts for i in range(1, parts)], 20 * parts)

    first = min(n, COARSE)
    pivots = sorted(d.agg(quantiles(first)).first()[0])  # COARSE numbers at most
    even = F.col("_t") / F.lit(float(2 ** 64)) + 0.5
    d = d.withColumn("_o", let(_below(pivots, F.col("_k")), lambda lo: let(
        _below(pivots, F.col("_k"), True), lambda hi: _dealt(lo, hi, even))))
    if n == first:
        return d.withColumn("_b", F.col("_o.at")).drop("_o")
    parts = -(-n // first)
    d = d.withColumn("_c", F.col("_o.at"))
    # COARSE rows at most, of MAX_BUCKETS / COARSE numbers
    cuts = checkpoint(d.groupBy("_c").agg(F.sort_array(quantiles(parts)).alias("_p")), "cuts")
    d = d.join(F.broadcast(cuts), "_c")
    at = _dealt(F.size(F.filter("_p", lambda p: p < F.col("_k"))),
                F.size(F.filter("_p", lambda p: p <= F.col("_k"))), F.col("_o.share"))
    return d.withColumn("_b", F.col("_c") * parts + at["at"]).drop("_o", "_c", "_p")


def with_next(docs: DataFrame, made: dict[str, Column], keep: list[str]) -> DataFrame:
    """``docs`` (doc_id, text) with the columns ``made`` of each row, and the
    columns ``keep`` of the next one in descending doc_id as struct ``_next``
    (after the last: the first).

    One exchange of rows by id bucket; only the first row of a bucket is
    copied to the bucket before it, so no window crosses tasks.
    """
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(-2 ** 63))
    d = with_buckets(docs.select("doc_id", "text", key.alias("_k"),
                                 F.xxhash64("text").alias("_t")))
    # a row per bucket, MAX_BUCKETS at most: its first row's key
    heads = checkpoint(d.groupBy("_b").agg(F.max(F.struct("_k", "_t")).alias("_h")), "heads")
    n, least = heads.agg(F.count(F.lit(1)), F.min("_b")).first()
    before = F.lag("_b").over(Window.orderBy(F.desc("_b")))
    g = checkpoint(heads.select("_b", "_h._k", "_h._t", F.coalesce(
        before, F.lit(least).cast("long")).alias("_to")), "ghosts")
    copies = (d.join(small_or_plain(g, MAX_BUCKETS), ["_b", "_k", "_t"])
              .select("doc_id", "text", "_k", "_t", F.col("_to").alias("_b"),
                      F.lit(1).alias("_ghost"))
              .dropDuplicates(["_b", "_k", "_t"]))
    rows = d.select("doc_id", "text", "_k", "_t", "_b", F.lit(0).alias("_ghost")).unionByName(copies)
    rows = rows.repartition(max(1, n), "_b").withColumns(made)
    w = Window.partitionBy("_b").orderBy("_ghost", F.desc("_k"), F.desc("_t"))
    return (rows.withColumn("_next", F.lead(F.struct(*keep)).over(w))
            .where("_ghost = 0").drop("_k", "_t", "_b", "_ghost"))


def matched_words(packed: Column, other: Column, k: int = K) -> Column:
    """Words of a text that anchors prove to stand at the same place of another:
    the words under the anchors that both hold at one place. The texts are
    given by their packed anchors; a text under k words has k or none."""
    def covered(at: Column) -> Column:
        return F.aggregate(
            at, F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
            lambda s, p: F.struct((s["n"] + p + k - F.greatest(s["end"], p)).alias("n"),
                                  (p + k).alias("end")),
            lambda s: s["n"])
    return covered(F.transform(F.array_intersect(packed, other),
                               lambda x: F.shiftright(x, 32).cast("int")))


def aligned_spans(pairs: DataFrame, key: str, left: str, right: str, k: int = K) -> DataFrame:
    """Passages that two texts share, by their placed anchors: rows (key,
    left_start, right_start, n_words, n_anchors) for ``pairs`` (a key of one
    row, and arrays of (hash, position) in ``left`` and ``right``).

    The i-th place of an anchor in one text is matched with its i-th place in
    the other, so repeats make no product. Matches at one distance whose words
    touch are one span; all its words are equal. As k-1 neighbouring windows
    hold an anchor, a shared passage shows but for k-2 words at either end.
    Anchors are dealt by (key, hash), then by (key, distance); null arrays,
    and texts without a common anchor, give no row; equal texts of fewer than k
    words give one span of k.
    """
    def placed(col: str, name: str) -> DataFrame:
        one = pairs.select(F.col(key), F.explode(col).alias("_x")).select(
            key, "_x.hash", F.col("_x.position").alias(name))
        nth = Window.partitionBy(key, "hash").orderBy(name)
        return one.withColumn("_i", F.row_number().over(nth))

    met = (placed(left, "_l").join(placed(right, "_r"), [key, "hash", "_i"])
           .select(key, "_l", (F.col("_l") - F.col("_r")).alias("_d")))
    order = Window.partitionBy(key, "_d").orderBy("_l")
    fresh = F.coalesce(F.col("_l") - F.lag("_l").over(order) > k, F.lit(True))
    runs = met.withColumn("_new", fresh.cast("int")).withColumn("_run", F.sum("_new").over(order))
    return (runs.groupBy(key, "_d", "_run")
            .agg(F.min("_l").alias("left_start"), F.max("_l").alias("_last"),
                 F.count(F.lit(1)).alias("n_anchors"))
            .select(key, "left_start", (F.col("left_start") - F.col("_d")).alias("right_start"),
                    (F.col("_last") - F.col("left_start") + k).alias("n_words"), "n_anchors"))


def _made(text: Column, k: int) -> Column:
    """A text's anchors (packed) and its sorted set of hashes."""
    return let(_packed(text, k), lambda p: F.struct(
        p.alias("packed"), F.sort_array(_hashes(p)).alias("set")))


def fingerprints(docs: DataFrame, k: int = K, size: int = SKETCH) -> DataFrame:
    """(doc_id, fingerprint, sketch, anchors) of every document."""
    out = let(_made(F.coalesce("text", F.lit("")), k), lambda m: F.struct(
        as_text(m["set"]).alias("fingerprint"), as_text(sketch(m["set"], size)).alias("sketch"),
        _places(m["packed"]).alias("anchors")))
    return docs.select("doc_id", out.alias("_o")).select("doc_id", "_o.*")


def compare_with_edits(docs: DataFrame, k: int = K, size: int = SKETCH) -> DataFrame:
    """Each document's fingerprint, that of its edited text (the last third
    replaced by the start of the next document), both likenesses, the words
    matched at the same place of both texts, and the document's bottom sketch
    and placed anchors."""
    d = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = with_next(d, {"_m": _made(F.col("text"), k)}, ["text", "_m.set"])
    n = F.length("text")
    third = F.floor(n / 3).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - third),
                      F.substring(F.col("_next.text"), F.lit(1), third))
    rows = rows.select("doc_id", n.cast("long").alias("n_chars"), F.col("_m.set").alias("_set"),
                       F.col("_m.packed").alias("_packed"), F.col("_next.set").alias("_nset"),
                       edited.alias("_e"))
    out = let(_made(F.col("_e"), k), lambda e: F.struct(
        as_text(e["set"]).alias("fp"), likeness(F.col("_set"), e["set"]).alias("near"),
        matched_words(F.col("_packed"), e["packed"], k).alias("matched")))
    return (rows.withColumn("_o", out)
            .select("doc_id", "n_chars", F.sha2("_e", 256).alias("edited_sha256"),
                    as_text(F.col("_set")).alias("fingerprint"),
                    F.col("_o.fp").alias("edited_fingerprint"),
                    F.col("_o.near").alias("near_edited"),
                    likeness(F.col("_set"), F.col("_nset")).alias("near_next"),
                    as_text(sketch(F.col("_set"), size)).alias("sketch"),
                    _places(F.col("_packed")).alias("anchors"),
                    F.col("_o.matched").cast("long").alias("matched_edited")))
