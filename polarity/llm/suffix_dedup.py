"""Removal of repeated byte strings by suffix sorting.

Every byte covered by a DEPTH-byte string that also starts anywhere else, in
this text or another, goes. Texts meet without being compared in pairs:

1. A window of DEPTH bytes picks the least hash among its K-byte substrings
   (the last, if it repeats) as its anchor. Equal windows pick equal anchors,
   so windows whose anchor occurs once in the corpus cannot repeat. Equal
   texts are one class; all of a repeated class of DEPTH bytes goes.
2. For each repeated anchor, the segment of the windows that picked it is
   sent to the anchor's shard; equal segments are counted and sent once. An
   anchor of many different segments is split: equal windows hold the anchor
   at the same place, so windows are parted by that place, PART places a part,
   and a part goes to the shard named by the bytes that all its windows share.
   Bytes that many parts share (a passage in many texts) are no shard: there
   each window is named by its place and bytes, and names are counted.
3. A shard sorts the suffixes of its segments by external induced sorting
   (``induced``) and reads off which windows share DEPTH bytes with another.
4. Repeated windows go back to their texts as byte ranges, neighbours as one;
   ranges are merged into a text's runs before they meet it, and the runs are
   cut out.

Contract: null text is empty; texts under DEPTH bytes stay whole; repeated
rows are texts that occur elsewhere; runs are judged on the input, not on what
is left. Columns of the input are kept as they are.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

from polarity.llm import induced
from polarity.llm import words as W
from polarity.llm.common import arrow_batches, checkpoint, small_or_plain, tidy
from polarity.session import drop_scratch, scratch_mark

DEPTH = 400
K = 32
#: bytes of segments per shard, aimed at
SHARD_BYTES = 2 << 20
#: distinct segments of one anchor from which it is split over shards (also
#: parts of one key from which their windows are counted), and the windows of
#: a part
HOT_SEGMENTS = 1000
PART = 64
#: bytes of a text handled at once (windows of neighbouring pieces overlap)
PIECE = 1 << 18
#: segments that a worker holds before it passes them on
HELD = 5000
_LOW = np.uint64((1 << 24) - 1)


# ---------------------------------------------------------------- anchors

def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Least of every w neighbours, from block-wise running minima."""
    n = len(x)
    pad = np.full(-n % w, np.iinfo(np.uint64).max, np.uint64)
    blocks = np.concatenate([x, pad]).reshape(-1, w)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n - w + 1], ahead[w - 1:n])


def window_runs(raw: np.ndarray, offsets: np.ndarray, depth: int, k: int):
    """(row, first window's start, windows, anchor's start, anchor's hash) of
    each run of windows with one anchor; starts are places in ``raw``."""
    if len(raw) < depth:
        return tuple(np.zeros(0, np.int64) for _ in range(4)) + (np.zeros(0, np.uint64),)
    at = np.arange(len(raw) - k + 1)
    h = W.span_hash(raw, at, at + k)
    # the place in the low bits: equal hashes give the last one
    key = (h & ~_LOW) | (_LOW - at.astype(np.uint64))
    low = sliding_min(key, depth - k + 1)
    anchor = (_LOW - (low & _LOW)).astype(np.int64)
    starts = np.arange(len(anchor))
    row = np.searchsorted(offsets, starts, "right") - 1
    inside = starts + depth <= offsets[row + 1]
    starts, anchor, row = starts[inside], anchor[inside], row[inside]
    if not len(starts):
        return starts, starts, starts, starts, np.zeros(0, np.uint64)
    new = np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (starts[1:] != starts[:-1] + 1)
                          | (row[1:] != row[:-1])])
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(starts)))
    return row[first], starts[first], count, anchor[first], h[anchor[first]]


def text_runs(column: pa.Array, depth: int, k: int):
    """(rows a..b, what to add to a place in ``raw`` for one in the text, by
    row, raw, runs) by chunks; a text beyond PIECE comes in pieces that overlap
    by depth - 1 bytes."""
    raw, offsets = W.utf8(column)
    for a, b in W.chunks(offsets, PIECE):
        o = offsets[a:b + 1]
        if b - a > 1 or o[1] - o[0] <= PIECE:
            part, po = raw[o[0]:o[-1]], o - o[0]
            yield a, b, -po, part, window_runs(part, po, depth, k)
        else:
            for s in range(int(o[0]), int(o[1]) - depth + 1, PIECE):
                part = raw[s:min(int(o[1]), s + PIECE + depth - 1)]
                yield a, b, np.array([s - o[0]]), part, window_runs(
                    part, np.array([0, len(part)]), depth, k)


def _anchors(depth: int, k: int):
    """mapInArrow: (id, tk, text) -> id, tk, n_bytes, hashes of all anchors."""
    def run(batches):
        for batch in batches:
            n = len(batch)
            found: list = [[] for _ in range(n)]
            raw, offsets = W.utf8(batch.column(2))
            for a, b, _, _, (row, _, _, _, h) in text_runs(batch.column(2), depth, k):
                bounds = W.row_starts(row, b - a)
                for i in np.flatnonzero(np.diff(bounds)):
                    found[a + i].append(h[bounds[i]:bounds[i + 1]])
            ends = np.concatenate([[0], np.cumsum([sum(map(len, f)) for f in found])])
            flat = [h for f in found for h in f]
            flat = np.concatenate(flat) if flat else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(np.diff(offsets)),
                 pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(W.signed(flat)))],
                names=["id", "tk", "n_bytes", "h"])
    return run


def _segments(depth: int, k: int):
    """mapInArrow: (tk, text, repeated anchors) -> a row per run of windows of
    such an anchor: tk, start, windows, place of the anchor, h, sk (names that
    place and the bytes), and the bytes where sk is new to the batch."""
    def run(batches):
        for batch in batches:
            tks = batch.column(0).to_pylist()
            wanted = batch.column(2)
            out: list = []
            seen: set = set()
            for a, b, shift, raw, (row, start, count, anchor, h) in text_runs(batch.column(1),
                                                                              depth, k):
                bounds = W.row_starts(row, b - a)
                h = W.signed(h)
                for i in np.flatnonzero(np.diff(bounds)):
                    r = slice(bounds[i], bounds[i + 1])
                    known = np.asarray(wanted[a + int(i)].values)
                    for j in np.flatnonzero(np.isin(h[r], known)) + bounds[i]:
                        s, c = int(start[j]), int(count[j])
                        seg = raw[s:s + c + depth - 1].tobytes()
                        sk = hashlib.md5(b"%d|" % (int(anchor[j]) - s) + seg).digest()
                        out.append((tks[a + i], int(shift[i]) + s, c, int(anchor[j]) - s, int(h[j]),
                                    sk, None if sk in seen else seg))
                        seen.add(sk)
                if len(out) > HELD:
                    yield _rows(out)
                    out = []
            yield _rows(out)
    return run


_SEG = [("tk", pa.binary()), ("start", pa.int64()), ("windows", pa.int64()), ("place", pa.int64()),
        ("h", pa.int64()), ("sk", pa.binary()), ("seg", pa.binary())]


def _rows(out):
    cols = list(zip(*out)) if out else [()] * len(_SEG)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(cols, _SEG)],
                                      names=[n for n, _ in _SEG])


# ---------------------------------------------------------------- shards

def _parts(depth: int, bytes_too: bool = True):
    """mapInArrow over segments of hot anchors (sk, windows, c, place, seg):
    (sk, at, windows, c, key, seg) of their parts; seg is null without
    ``bytes_too``."""
    part = min(PART, depth)  # the windows of a part share a byte at least

    def run(batches):
        for batch in batches:
            out = []
            for sk, windows, c, place, seg in zip(*(batch.column(i).to_pylist() for i in range(5))):
                # window i holds the anchor at place - i
                for q in range((place - windows + 1) // part, place // part + 1):
                    shared = place - part * q
                    a, b = max(0, shared - part + 1), min(windows, shared + 1)
                    core = seg[shared:shared - part + 1 + depth]
                    key = hashlib.md5(b"%d|" % q + core).digest()[:8]
                    out.append((sk, a, b - a, c, int.from_bytes(key, "little", signed=True),
                                seg[a:b + depth - 1] if bytes_too else None))
            cols = list(zip(*out)) if out else [()] * 6
            types = (pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(cols, types)],
                                             names=["sk", "at", "windows", "c", "key", "seg"])
    return run


def _windows(depth: int):
    """mapInArrow over parts of hot keys (sk, at, windows, c, key, seg): (sk,
    at, c, wk), a row per window. wk names the key and the window's bytes:
    equal windows have their anchor at one place, so lie in parts of one key."""
    def run(batches):
        for batch in batches:
            for i in range(0, len(batch), 256):
                out = []
                for sk, at, windows, c, key, seg in zip(*(
                        batch.column(j).slice(i, 256).to_pylist() for j in range(6))):
                    head = b"%d|" % key
                    for w in range(windows):
                        out.append((sk, at + w, c,
                                    hashlib.md5(head + seg[w:w + depth]).digest()))
                cols = list(zip(*out)) if out else [()] * 4
                types = (pa.binary(), pa.int64(), pa.int64(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(cols, types)],
                                                 names=["sk", "at", "c", "wk"])
    return run


def _counted(parts: DataFrame, depth: int) -> DataFrame:
    """(sk, ranges) of the windows in ``parts`` that occur elsewhere. Nothing
    is gathered by key: equal windows meet as partial counts."""
    once = parts.dropDuplicates(["sk", "at"])  # other read tasks may have sent it too
    w = checkpoint(once.mapInArrow(tidy(_windows(depth)), "sk binary, at long, c long, wk binary"),
                   "windows")
    twice = checkpoint(w.groupBy("wk").agg(F.sum("c").alias("n")).where("n > 1").select("wk"),
                       "twice")
    found = w.join(small_or_plain(twice), "wk", "left_semi").groupBy("sk").agg(
        F.sort_array(F.collect_set("at")).alias("at"))
    # neighbouring windows are one range
    found = found.withColumn("next", F.transform("at", lambda x: x + 1))
    return found.select("sk", F.zip_with(
        F.array_except("at", "next"), F.array_except("next", "at"),
        lambda a, b: F.struct(a.alias("a"), b.alias("b"))).alias("ranges"))


def _shard(depth: int):
    """mapInArrow over a shard's distinct segments or parts (sk, at, windows,
    c, seg): the ranges of windows that occur elsewhere. All of a segment that
    occurs twice do; the others are sorted with the shard."""
    def run(batches):
        meta: dict[tuple, tuple] = {}

        def segments():
            for batch in batches:
                for sk, at, windows, c, seg in zip(*(batch.column(i).to_pylist()
                                                     for i in range(5))):
                    if (sk, at) not in meta:  # other read tasks may have sent it too
                        meta[sk, at] = (windows, c)
                        yield seg
        text, starts = induced.join_segments(segments())
        if not meta:
            return
        twice = induced.repeated(text, len(text) - induced.MARGIN, depth)
        out = []
        for ((sk, at), (windows, c)), s in zip(meta.items(), starts):
            if c > 1:
                out.append((sk, [{"a": at, "b": at + windows}]))
                continue
            hit = np.flatnonzero(np.diff(np.concatenate([[0], twice[s:s + windows], [0]])))
            if len(hit):
                out.append((sk, [{"a": at + int(x), "b": at + int(y)} for x, y in
                                 hit.reshape(-1, 2)]))
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in out], pa.binary()),
             pa.array([r[1] for r in out], pa.list_(pa.struct([("a", pa.int64()),
                                                               ("b", pa.int64())])))],
            names=["sk", "ranges"])
    return run


def _runs(batches):
    """mapInArrow: (tk, whole, spans) with the spans of each text as disjoint
    runs in order, joined where they overlap or touch."""
    for batch in batches:
        spans = batch.column(2)
        row = np.repeat(np.arange(len(batch)), spans.value_lengths().fill_null(0).to_numpy())
        flat = spans.flatten()
        a, b = (flat.field(i).to_numpy() for i in range(2))
        order = np.lexsort((a, row))
        row, a, b = row[order], a[order], b[order]
        # ends so far within the row: rows are kept apart by more than any end
        apart = row * (int(b.max()) + 2 if len(b) else 0)
        reach = np.maximum.accumulate(b + apart)
        first = np.flatnonzero(np.concatenate([[True], (a + apart)[1:] > reach[:-1]])[:len(a)])
        ends = np.append(first[1:], len(a))[:len(first)] - 1
        runs = pa.StructArray.from_arrays([pa.array(a[first]), pa.array((reach - apart)[ends])],
                                          names=["a", "b"])
        offsets = pa.array(W.row_starts(row[first], len(batch)), pa.int32(),
                           mask=np.append(spans.is_null().to_numpy(False), False))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.ListArray.from_arrays(offsets, runs)],
            names=["tk", "whole", "spans"])


def repeated_runs(docs: DataFrame, depth: int = DEPTH, k: int = K) -> DataFrame:
    """(tk, whole, spans): for each text (by its md5) of which anything goes,
    whether all does, and else the disjoint byte ranges covered by repeated
    windows, in order."""
    spark = docs.sparkSession
    arrow_batches(spark)
    mark = scratch_mark()
    text = F.coalesce("text", F.lit(""))
    d = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(-2 ** 63)).alias("id"),
                    F.unhex(F.md5(text.cast("binary"))).alias("tk"), text.alias("text"))
    t = checkpoint(d.mapInArrow(tidy(_anchors(depth, k)), "id long, tk binary, n_bytes long, "
                                                    "h array<long>"), "anchors")
    classes = checkpoint(t.where(F.col("n_bytes") >= depth).groupBy("tk").agg(
        F.count(F.lit(1)).alias("c"), F.min("id").alias("id"), F.first("h").alias("h")), "texts")
    marks = classes.select("tk", "id", F.explode("h").alias("h"))
    counts = checkpoint(marks.groupBy("h").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
                        .select("h"), "repeated")
    wanted = checkpoint(marks.join(small_or_plain(counts), "h").groupBy("tk", "id").agg(
        F.collect_set("h").alias("h")), "wanted")
    some = d.join(small_or_plain(wanted.select("tk", "id")), ["tk", "id"], "left_semi")
    some = some.join(wanted, ["tk", "id"]).select("tk", "text", "h")
    schema = ("tk binary, start long, windows long, place long, h long, sk binary, "
              "seg binary")
    segs = checkpoint(some.mapInArrow(tidy(_segments(depth, k)), schema), "segments")
    places = segs.select("tk", "start", "windows", "place", "h", "sk")
    # a text's row may repeat under one id; its runs count once
    if not t.where(F.col("n_bytes") >= depth).groupBy("tk", "id").count().where("count > 1").isEmpty():
        places = places.distinct()
    per = places.groupBy("h", "sk").agg(F.count(F.lit(1)).alias("c"),
                                        F.first("windows").alias("windows"),
                                        F.first("place").alias("place"))
    per = checkpoint(per, "distinct")
    # an anchor of very many segments is one row here, and broadcast where few are
    several = small_or_plain(checkpoint(
        per.groupBy("h").agg(F.count(F.lit(1)).alias("s")).where("s > 1"), "several"))
    todo = checkpoint(per.join(several, "h").select("sk", "h", "c", "windows", "place", "s"),
                      "to-sort")
    alike = per.where("c > 1").join(several, "h", "left_anti").select(
        "sk", F.array(F.struct(F.lit(0).cast("long").alias("a"), F.col("windows").alias("b")))
        .alias("ranges"))
    size = todo.agg(F.sum(F.col("windows") + depth)).first()[0] or 0
    sent = segs.where("seg is not null").select("sk", "seg").join(small_or_plain(todo), "sk")
    hot = sent.where(F.col("s") > HOT_SEGMENTS).select("sk", "windows", "c", "place", "seg")
    schema = "sk binary, at long, windows long, c long, key long, seg binary"
    parts = hot.mapInArrow(_parts(depth), schema)
    # a passage of more bytes than parts share gives one key in every text
    crowded = checkpoint(hot.mapInArrow(_parts(depth, bytes_too=False), schema).groupBy("key").agg(
        F.count(F.lit(1)).alias("n")).where(F.col("n") > HOT_SEGMENTS).select("key"), "crowded")
    done = alike
    if not crowded.isEmpty():
        crowded = small_or_plain(crowded)
        done = alike.unionAll(_counted(parts.join(crowded, "key", "left_semi").select(
            *parts.columns), depth))
        parts = parts.join(crowded, "key", "left_anti").select(*parts.columns)
    whole = sent.where(F.col("s") <= HOT_SEGMENTS).select(
        "sk", F.lit(0).cast("long").alias("at"), "windows", "c", F.col("h").alias("key"), "seg")
    shards = (whole.unionAll(parts).repartition(max(1, -(-size // SHARD_BYTES)), "key")
              .select("sk", "at", "windows", "c", "seg")
              .mapInArrow(tidy(_shard(depth)), "sk binary, ranges array<struct<a:long,b:long>>"))
    ranges = checkpoint(shards.unionAll(done), "ranges")
    spans = places.join(small_or_plain(ranges, size=F.size("ranges") * 16 + 40), "sk").select(
        "tk", F.explode(F.transform("ranges", lambda r: F.struct(
            (F.col("start") + r["a"]).alias("a"),
            (F.col("start") + r["b"] + (depth - 1)).alias("b")))).alias("span"))
    spans = spans.groupBy("tk").agg(F.collect_list("span").alias("spans"))
    whole = classes.where("c > 1").select("tk", F.lit(True).alias("whole"))
    until = scratch_mark()
    found = whole.join(spans, "tk", "full").select(
        "tk", F.coalesce("whole", F.lit(False)).alias("whole"),
        F.when(F.col("whole"), None).otherwise(F.col("spans")).alias("spans"))
    out = checkpoint(found.mapInArrow(tidy(_runs), "tk binary, whole boolean, "
                                                   "spans array<struct<a:long,b:long>>"), "spans")
    drop_scratch(spark, mark, until)  # the result reads ``out`` alone
    return out


# ---------------------------------------------------------------- removal

def remove_repeats(docs: DataFrame, depth: int = DEPTH, k: int = K, readable: bool = False,
                   kept_col: str = "_kept", removed_col: str = "_n_removed",
                   spans_col: str = "_n_spans") -> DataFrame:
    """``docs`` (doc_id, text and any others) with the remaining bytes, the
    number removed and the number of removed runs (names must be new).
    ``readable`` gives what remains as text, without the characters of which
    a cut has left only part."""
    names = docs.columns
    found = repeated_runs(docs, depth, k)
    rows = docs.withColumn("_sd_tk", F.unhex(F.md5(F.coalesce("text", F.lit("")).cast("binary"))))
    found = found.select(F.col("tk").alias("_sd_tk"), F.col("whole").alias("_sd_whole"),
                         F.col("spans").alias("_sd_spans"))
    size = F.greatest(F.size("_sd_spans"), F.lit(0)) * 24 + 60
    rows = rows.join(small_or_plain(found, size=size), "_sd_tk", "left").select(
        *names, "_sd_whole", "_sd_spans")
    at = names.index("text")
    schema = StructType(docs.schema.fields + [
        StructField(kept_col, StringType() if readable else BinaryType()), StructField(removed_col, LongType()),
        StructField(spans_col, LongType())])

    def run(batches):
        for whole_batch in batches:
            _, offsets = W.utf8(whole_batch.column(at))
            for first, last in W.chunks(offsets, PIECE):
                batch = whole_batch.slice(first, last - first)
                texts = batch.column(at).cast(pa.large_binary())
                kept, removed, runs = [], [], []
                for t, w, s in zip(texts, batch.column(len(names)), batch.column(len(names) + 1)):
                    t = t.as_py() or b""
                    cut = [(0, len(t))] if w.as_py() else []
                    if s.is_valid and not cut:
                        cut = zip(*(s.values.field(i).to_pylist() for i in range(2)))
                    parts, end, n = [], 0, 0
                    for a, b in cut:
                        parts.append(t[end:a])
                        end, n = b, n + 1
                    parts.append(t[end:])
                    kept.append(b"".join(parts))
                    removed.append(len(t) - len(kept[-1]))
                    runs.append(n)
                rest = (pa.array([x.decode("utf-8", "ignore") for x in kept], pa.string())
                        if readable else pa.array(kept, pa.binary()))
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:len(names)], rest,
                     pa.array(removed, pa.int64()), pa.array(runs, pa.int64())],
                    names=[*names, kept_col, removed_col, spans_col])
    return rows.mapInArrow(tidy(run), schema)


def digests(docs: DataFrame, depth: int = DEPTH, k: int = K) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    out = remove_repeats(docs.select("doc_id", "text"), depth, k)
    return out.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
                      .alias("n_bytes"), F.col("_n_removed").alias("n_removed"),
                      F.col("_n_spans").alias("n_spans"),
                      F.sha2("_kept", 256).alias("kept_sha256"))


def without_repeats(docs: DataFrame, depth: int = DEPTH, k: int = K) -> DataFrame:
    """``docs`` with the repeated bytes of each text removed, in its own
    columns; ``n_chars``, where there is one, follows the text; null texts
    stay null."""
    out = remove_repeats(docs, depth, k, readable=True)
    cut = F.col("_n_removed") > 0
    out = out.withColumn("text", F.when(cut, F.col("_kept")).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(cut, F.length("text").cast(kind))
                             .otherwise(F.col("n_chars")))
    return out.select(*docs.columns)
