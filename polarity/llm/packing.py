"""Hierarchical residual packing of tokenized documents into sequences.

Round 0 runs where the texts are read: a task tokenizes its documents, cuts
those longer than a sequence, packs the pieces best-fit (longest first, each
into the fullest bin it fits) and writes its bins. Bins within SLACK tokens of
full are done. The others are items of the next round: they move to a smaller
number of tasks, are packed best-fit as whole items, and so on up the tree
until one task holds what is left or a round merges next to nothing. Only bins
that are not full ever move, as small rows; every round is written, so a lost
executor repeats one round at most.

Contract: null text is empty and packs as the end token alone; strings of
special tokens in a text are those tokens; repeated rows are packed as often as
they occur; no rows give no rows.
"""

from __future__ import annotations

import os
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, BinaryType, BooleanType, IntegerType, LongType,
                               StructField, StructType)

from polarity.llm.common import arrow_batches, checkpoint

TOKENIZER = "word_bpe_49k.json"
CAPACITY = 2048
END_ID = 0
#: a bin this close to full is done
SLACK = 8
#: items a merge task holds at most, and least shrinking that pays for a round
ITEMS_PER_TASK = 50_000
MERGE_GAIN = 0.02
#: word encodings a task remembers (about 200 bytes each)
CACHE_WORDS = 1_000_000
#: words encoded as one string: words of letters parted by blanks (each ends in
#: one token that ends a word), others by PART, a special token
TOGETHER = 64
PART = "<|startoftext|>"
WORD_END = "</w>"
#: marks that make a token run of their own after letters (no apostrophe)
MARKS = b".,;:!?#*$%&|\"()"

_encoders: dict[tuple[str, int], "WordEncoder"] = {}


class WordEncoder:
    """Token ids of whole texts, word by word.

    The tokenizer drops white space and never joins across it, so a text's ids
    are its words' ids in order; a worker encodes each frequent word once.
    """

    def __init__(self, path: str, cache_words: int = CACHE_WORDS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.cache_words = cache_words
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.part = self.tokenizer.token_to_id(PART)
        self.known: dict[bytes, bytes] = {}
        vocab = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        self.ends[[i for t, i in vocab.items() if t.endswith(WORD_END)]] = True

    def learn(self, words) -> None:
        """Remember the ids of each word. A word of letters and then marks has
        the ids of both parts, so only parts that are new are encoded."""
        known = self.known
        letters, others, joined = set(), set(), []
        for w in words:
            core = w.rstrip(MARKS)
            text = core.decode("utf-8")
            if text.isalpha() and text.lower().isalpha():
                if core not in known:
                    letters.add(core)
                if len(core) < len(w):
                    tail = w[len(core):]
                    joined.append((w, core, tail))
                    if tail not in known:
                        others.add(tail)
            else:
                others.add(w)
        others |= self._learn_letters(list(letters))
        # a special token's string in a text is that token, as the plain call has it
        special = [w for w in others if b"<|" in w]
        for w in special:
            ids = self.tokenizer.encode(w.decode("utf-8"), add_special_tokens=False).ids
            known[w] = np.asarray(ids, "<u4").tobytes()
        self._learn_parted([w for w in others if b"<|" not in w])
        for w, core, tail in joined:
            known[w] = known[core] + known[tail]

    def _encoded(self, words: list[bytes], between: bytes):
        groups = [words[i:i + TOGETHER] for i in range(0, len(words), TOGETHER)]
        texts = [between.join(g).decode("utf-8") for g in groups]
        for group, e in zip(groups, self.tokenizer.encode_batch_fast(texts,
                                                                     add_special_tokens=False)):
            yield group, np.asarray(e.ids, "<u4")

    def _learn_letters(self, words: list[bytes]) -> set[bytes]:
        """Learn words of letters; those of a group whose words do not end
        where word-ending tokens say (letters to Python, but not to the
        tokenizer) are returned."""
        left: set[bytes] = set()
        for group, ids in self._encoded(words, b" "):
            cuts = (np.flatnonzero(self.ends[ids]) + 1).tolist()
            if len(cuts) != len(group) or (cuts and cuts[-1] != len(ids)):
                left.update(group)
                continue
            raw, at = ids.tobytes(), 0
            for w, cut in zip(group, cuts):
                self.known[w] = raw[4 * at:4 * cut]
                at = cut
        return left

    def _learn_parted(self, words: list[bytes]) -> None:
        for group, ids in self._encoded(words, PART.encode()):
            raw, at = ids.tobytes(), 0
            for w, cut in zip(group, [*np.flatnonzero(ids == self.part).tolist(), len(ids)]):
                self.known[w] = raw[4 * at:4 * cut]
                at = cut + 1

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Little-endian 32-bit ids of each text."""
        parts = [t.split() for t in texts]
        new = set().union(*parts).difference(self.known)
        if len(self.known) + len(new) > self.cache_words:
            self.known.clear()
            new = set().union(*parts)
        self.learn(new)
        get = self.known.__getitem__
        return [b"".join(map(get, p)) for p in parts]


def encoder(path: str, cache_words: int = CACHE_WORDS) -> WordEncoder:
    key = (path, cache_words)
    if key not in _encoders:
        _encoders[key] = WordEncoder(path, cache_words)
    return _encoders[key]


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of every item, longest first, each into the fullest bin
    with room. Bins are kept in lists by free space, the free spaces in use as
    bits of one integer, so that finding the tightest is one bit scan."""
    n = len(lengths)
    at, offset = np.zeros(n, np.int64), np.zeros(n, np.int64)
    by_free: list[list[int]] = [[] for _ in range(capacity + 1)]
    bits, bins = 0, 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[i])
        above = bits >> size
        if above:
            free = size + (above & -above).bit_length() - 1
            b = by_free[free].pop()
            if not by_free[free]:
                bits &= ~(1 << free)
        else:
            free, b = capacity, bins
            bins += 1
        at[i], offset[i] = b, capacity - free
        free -= size
        by_free[free].append(b)
        bits |= 1 << free
    return at, offset


MEMBER = [("doc_id", LongType()), ("piece", IntegerType()), ("start", LongType()),
          ("length", LongType()), ("ids_crc32", LongType()), ("offset", LongType())]


def bin_schema(with_ids: bool) -> StructType:
    member = StructType([StructField(n, t) for n, t in MEMBER]
                        + ([StructField("ids", BinaryType())] if with_ids else []))
    return StructType([StructField("bin", LongType()), StructField("total", LongType()),
                       StructField("full", BooleanType()),
                       StructField("members", ArrayType(member))])


def _arrow_schema(with_ids: bool) -> pa.Schema:
    member = pa.struct([("doc_id", pa.int64()), ("piece", pa.int32())]
                       + [(n, pa.int64()) for n in ("start", "length", "ids_crc32", "offset")]
                       + ([("ids", pa.binary())] if with_ids else []))
    return pa.schema([("bin", pa.int64()), ("total", pa.int64()), ("full", pa.bool_()),
                      ("members", pa.list_(member))])


def _merge(columns: dict, totals: np.ndarray, ends: np.ndarray, level: int, capacity: int,
           slack: int, schema: pa.Schema):
    """Bins of items; item i holds members ends[i]..ends[i+1]."""
    if not len(totals):
        return
    at, offset = best_fit(totals, capacity)
    order = np.lexsort((offset, at))
    counts = np.diff(ends)[order]
    shift = np.repeat(offset[order], counts)
    first = np.repeat(ends[:-1][order] - (np.cumsum(counts) - counts), counts)
    take = first + np.arange(counts.sum())
    bins = int(at.max()) + 1
    total = np.bincount(at, totals, bins).astype(np.int64)
    sizes = np.bincount(np.repeat(at[order], counts), minlength=bins)
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    base = (level << 56) | (TaskContext.get().partitionId() << 28)
    kind = schema.field("members").type.value_type
    step = 2000
    for a in range(0, bins, step):
        b = min(bins, a + step)
        idx = take[bounds[a]:bounds[b]]
        fields = []
        for f in kind:
            if f.name == "offset":
                v = pa.array(columns["offset"][idx] + shift[bounds[a]:bounds[b]])
            else:
                v = columns[f.name].take(pa.array(idx))
            fields.append(v.cast(f.type))
        members = pa.ListArray.from_arrays(pa.array(bounds[a:b + 1] - bounds[a], pa.int32()),
                                           pa.StructArray.from_arrays(fields, fields=list(kind)))
        yield pa.RecordBatch.from_arrays(
            [pa.array(base + np.arange(a, b)), pa.array(total[a:b]),
             pa.array(total[a:b] >= capacity - slack), members.cast(schema.field(3).type)],
            schema=schema)


def _first_round(path: str, capacity: int, slack: int, with_ids: bool):
    schema = _arrow_schema(with_ids)

    def run(batches):
        enc, end = encoder(path), np.asarray([END_ID], "<u4").tobytes()
        ids, pieces, starts, lengths, crcs, kept = [], [], [], [], [], []
        for batch in batches:
            doc_id = batch.column(0).to_pylist()
            text = batch.column(1).cast(pa.large_binary()).fill_null(b"")
            for a in range(0, len(text), 200):
                for d, e in zip(doc_id[a:a + 200], enc.encode(text.slice(a, 200).to_pylist())):
                    e += end
                    for p, s in enumerate(range(0, len(e), 4 * capacity)):
                        cut = e[s:s + 4 * capacity]
                        ids.append(d)
                        pieces.append(p)
                        starts.append(s // 4)
                        lengths.append(len(cut) // 4)
                        crcs.append(zlib.crc32(cut))
                        if with_ids:
                            kept.append(cut)
        enc.known.clear()  # workers live on: their memory is for the next stage
        total = np.asarray(lengths, np.int64)
        columns = {"doc_id": pa.array(ids, pa.int64()), "piece": pa.array(pieces, pa.int32()),
                   "start": pa.array(starts, pa.int64()), "length": pa.array(total),
                   "ids_crc32": pa.array(crcs, pa.int64()), "offset": np.zeros(len(ids), np.int64)}
        if with_ids:
            columns["ids"] = pa.array(kept, pa.binary())
        yield from _merge(columns, total, np.arange(len(ids) + 1), 0, capacity, slack, schema)
    return run


def _next_round(level: int, capacity: int, slack: int, with_ids: bool):
    schema = _arrow_schema(with_ids)

    def run(batches):
        batches = [b for b in batches if b.num_rows]
        if not batches:
            return
        t = pa.Table.from_batches(batches).combine_chunks()
        members = t.column("members").combine_chunks()
        members = members.chunk(0) if isinstance(members, pa.ChunkedArray) else members
        flat = members.flatten()
        columns = {f.name: flat.field(f.name) for f in flat.type}
        columns["offset"] = columns["offset"].to_numpy()
        ends = np.concatenate([[0], np.cumsum(members.value_lengths().to_numpy())])
        yield from _merge(columns, t.column("total").to_numpy(), ends, level, capacity, slack,
                          schema)
    return run


def pack(docs: DataFrame, id_col="doc_id", text_col="text", path: str | None = None,
         capacity: int = CAPACITY, slack: int = SLACK, with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id,
    offset; ``with_ids`` adds the piece's ids (little-endian 32-bit, binary)."""
    spark = docs.sparkSession
    arrow_batches(spark)
    schema = bin_schema(with_ids)
    path = path or tokenizer_path()
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    bins = checkpoint(d.mapInArrow(_first_round(path, capacity, slack, with_ids), schema), "bins")
    done, level = [bins.where("full")], 0
    loose = bins.where("not full")
    left = loose.count()
    while left > 1:
        level += 1
        parts = -(-left // ITEMS_PER_TASK)
        bins = checkpoint(loose.repartition(parts).mapInArrow(
            _next_round(level, capacity, slack, with_ids), schema), "bins")
        done.append(bins.where("full"))
        loose = bins.where("not full")
        before, left = left, loose.count()
        if parts == 1 or left > (1 - MERGE_GAIN) * before:
            break
    done.append(loose)
    out = done[0]
    for more in done[1:]:
        out = out.unionAll(more)
    out = out.select(F.col("bin").alias("sequence_id"), F.explode("members").alias("m"))
    return out.select("m.doc_id", "m.piece", "m.start", "m.length", "m.ids_crc32", "sequence_id",
                      "m.offset", *(["m.ids"] if with_ids else []))
