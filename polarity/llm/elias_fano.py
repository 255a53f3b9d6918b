"""Token ids in binary shards whose document boundaries are Elias-Fano coded.

A shard file holds the ids of consecutive documents, one after the other (two
bytes an id where the vocabulary allows it, else four), then the documents'
boundaries and ids, both as Elias-Fano sequences, and a footer of fixed size. Of
n ascending numbers up to u a sequence keeps the low log2(u / n) bits in a
packed array and the rest in unary, about two bits a number; a select structure,
the place of every SAMPLE-th one, finds any number by scanning the few bytes
between two samples. So a boundary costs 2 + log2(mean length) bits and half a
bit of select instead of the 64 of an offset table.

Documents are range-partitioned by id, so that each task writes one shard and
shards follow each other; the index table has one row per shard. A shard is
written under a name that no other attempt uses, and only the rows of the
attempt that Spark accepts name files: a lost executor leaves no half-read
shard behind.

Contract: null text is empty, so its document is the end id alone; documents
come by ascending id, nulls first, rows that repeat an id by a hash of their
text; strings of special tokens are those tokens; no rows give no files and no
rows; other columns are not read.
"""

from __future__ import annotations

import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from polarity.llm.common import arrow_batches, checkpoint, scratch_path, trim_memory
from polarity.llm.kneser_ney import _filesystem
from polarity.llm.packing import encoder, tokenizer_path

END_ID = 2
#: bytes of text a shard holds, about, and at least where there are few
SHARD_BYTES = 64 << 20
MIN_SHARD_BYTES = 1 << 20
#: numbers between two places that the select structure keeps
SAMPLE = 64
#: bytes of ids and documents read at once
READ_BYTES = 8 << 20
READ_DOCS = 4096

MAGIC = b"EFIDS\x00\x00\x01"
#: magic, bytes an id, documents, ids, documents without an id, least id
FOOTER = struct.Struct("<8sIQQQq")


# ---------------------------------------------------------------- sequences

class EliasFano:
    """An ascending sequence of whole numbers, read without unpacking it all."""

    HEAD = struct.Struct("<QIQQQ")  # numbers, low bits, bytes of low, high, samples

    def __init__(self, data: bytes):
        self.n, self.low_bits, a, b, c = self.HEAD.unpack_from(data)
        at = self.HEAD.size
        self.low = np.frombuffer(data, np.uint8, a, at)
        self.high = np.frombuffer(data, np.uint8, b, at + a)
        self.samples = np.frombuffer(data, "<u4", c // 4, at + a + b)
        self.size = at + a + b + c

    @classmethod
    def encode(cls, values: np.ndarray) -> bytes:
        v = np.asarray(values, np.uint64)
        n = len(v)
        if not n:
            return cls.HEAD.pack(0, 0, 0, 0, 0)
        if (v[1:] < v[:-1]).any():
            raise ValueError("numbers must ascend")
        bits = max(0, (int(v[-1]) // n).bit_length() - 1)
        low = _pack_low(v, bits)
        ones = (v >> np.uint64(bits)) + np.arange(n, dtype=np.uint64)
        if int(ones[-1]) >= 1 << 32:
            raise ValueError("too many numbers for one sequence")
        ones = ones.astype(np.int64)
        unary = np.zeros(int(ones[-1]) + 1, np.uint8)
        unary[ones] = 1
        high = np.packbits(unary, bitorder="little").tobytes()
        samples = ones[::SAMPLE].astype("<u4").tobytes()
        return cls.HEAD.pack(n, bits, len(low), len(high), len(samples)) + low + high + samples

    def _ones(self, a: int, b: int) -> np.ndarray:
        """Places of ones a to b - 1 in the unary part."""
        k = a // SAMPLE
        begin = int(self.samples[k])
        last = -(-b // SAMPLE)
        end = int(self.samples[last]) if last < len(self.samples) else 8 * len(self.high)
        first = begin // 8
        bits = np.unpackbits(self.high[first:end // 8 + 1], bitorder="little")
        found = np.flatnonzero(bits) + 8 * first
        skip = int(np.searchsorted(found, begin)) + a - k * SAMPLE
        return found[skip:skip + b - a]

    def slice(self, a: int, b: int) -> np.ndarray:
        """Numbers a to b - 1."""
        if b <= a:
            return np.zeros(0, np.uint64)
        high = (self._ones(a, b) - np.arange(a, b)).astype(np.uint64)
        return (high << np.uint64(self.low_bits)) | _unpack_low(self.low, self.low_bits, a, b)

    def select(self, i: int) -> int:
        """Number i."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        return int(self.slice(i, i + 1)[0])


def _pack_low(v: np.ndarray, bits: int) -> bytes:
    if not bits:
        return b""
    shifts = np.arange(bits, dtype=np.uint64)
    parts = []
    for a in range(0, len(v), 1 << 16):  # a multiple of eight: parts end on bytes
        each = (v[a:a + (1 << 16), None] >> shifts) & np.uint64(1)
        parts.append(np.packbits(each.astype(np.uint8).ravel(), bitorder="little"))
    return np.concatenate(parts).tobytes()


def _unpack_low(low: np.ndarray, bits: int, a: int, b: int) -> np.ndarray:
    if not bits:
        return np.zeros(b - a, np.uint64)
    first = a * bits // 8
    got = np.unpackbits(low[first:-(-b * bits // 8)], bitorder="little")
    skip = a * bits - 8 * first
    each = got[skip:skip + (b - a) * bits].reshape(b - a, bits).astype(np.uint64)
    return (each << np.arange(bits, dtype=np.uint64)).sum(1, dtype=np.uint64)


# ---------------------------------------------------------------- shards

class ShardWriter:
    """Writes the documents of one shard; the file appears with the first."""

    def __init__(self, folder: str, width: int):
        self.folder, self.kind = folder, "<u2" if width == 2 else "<u4"
        self.out, self.uri = None, None
        self.doc_ids: list = []
        self.lengths: list[int] = []

    def add(self, doc_id, ids: bytes) -> None:
        """``ids``: little-endian unsigned 32-bit."""
        if self.out is None:
            f, path = _filesystem(self.folder)
            f.create_dir(path, recursive=True)
            name = f"ids-{uuid.uuid4().hex}"
            self.out, self.uri = f.open_output_stream(f"{path}/{name}"), f"{self.folder}/{name}"
        self.out.write(np.frombuffer(ids, "<u4").astype(self.kind).tobytes())
        self.doc_ids.append(doc_id)
        self.lengths.append(len(ids) // 4)

    def close(self) -> tuple[str, int, int] | None:
        """(uri, documents, ids), or None if nothing was added."""
        if self.out is None:
            return None
        ends = np.cumsum(np.asarray(self.lengths, np.uint64))
        known = [d for d in self.doc_ids if d is not None]
        least = known[0] if known else 0
        gaps = (np.asarray(known, np.int64) - np.int64(least)).view(np.uint64) \
            if known else np.zeros(0, np.uint64)
        self.out.write(EliasFano.encode(np.concatenate([np.zeros(1, np.uint64), ends])))
        self.out.write(EliasFano.encode(gaps))
        self.out.write(FOOTER.pack(MAGIC, int(self.kind[-1]), len(self.lengths), int(ends[-1]),
                                   len(self.doc_ids) - len(known), least))
        self.out.close()
        return self.uri, len(self.lengths), int(ends[-1])


class Shard:
    """A shard file: documents by their number in it."""

    def __init__(self, uri: str):
        f, path = _filesystem(uri)
        self.file = f.open_input_file(path)
        size = self.file.size()
        magic, width, self.n_docs, self.n_ids, self.n_null, self.least = FOOTER.unpack(
            self._read(size - FOOTER.size, FOOTER.size))
        if magic != MAGIC:
            raise ValueError(f"{uri} is no shard of ids")
        self.kind = np.dtype(f"<u{width}")
        at = self.n_ids * width
        tail = self._read(at, size - FOOTER.size - at)
        self.bounds = EliasFano(tail)
        self.ids_of = EliasFano(tail[self.bounds.size:])

    def _read(self, at: int, n: int) -> bytes:
        self.file.seek(at)
        data = self.file.read(n)
        if len(data) != n:
            raise ValueError("the shard is cut short")
        return data

    def doc_ids(self, a: int, b: int) -> list:
        nulls = max(0, min(b, self.n_null) - a)
        rest = self.ids_of.slice(max(a, self.n_null) - self.n_null, max(b, self.n_null) - self.n_null)
        return [None] * nulls + (rest.view(np.int64) + np.int64(self.least)).tolist()

    def ids(self, start: int, end: int) -> np.ndarray:
        w = self.kind.itemsize
        return np.frombuffer(self._read(start * w, (end - start) * w), self.kind).astype("<u4")

    def document(self, i: int) -> tuple:
        """(doc_id, start, ids) of document i."""
        start, end = self.bounds.select(i), self.bounds.select(i + 1)
        return self.doc_ids(i, i + 1)[0], start, self.ids(start, end)

    def blocks(self):
        """(doc_ids, starts and the end, ids) of consecutive documents, of
        READ_BYTES of ids (one document at least)."""
        room = READ_BYTES // self.kind.itemsize
        a = 0
        while a < self.n_docs:
            b = min(self.n_docs, a + READ_DOCS)
            starts = self.bounds.slice(a, b + 1).astype(np.int64)
            b = a + max(1, int(np.searchsorted(starts, starts[0] + room, "right")) - 1)
            b = min(b, a + len(starts) - 1)
            starts = starts[:b - a + 1]
            yield self.doc_ids(a, b), starts, self.ids(int(starts[0]), int(starts[-1]))
            a = b

    def close(self) -> None:
        self.file.close()


# ---------------------------------------------------------------- Spark

INDEX = "part int, file string, n_docs long, n_ids long"


def _write(path: str, folder: str, end_id: int):
    def run(batches):
        enc, end = encoder(path), np.asarray([end_id], "<u4").tobytes()
        shard = ShardWriter(folder, 2 if max(len(enc.ends) - 1, end_id) < 1 << 16 else 4)
        for batch in batches:
            doc_id = batch.column(0).to_pylist()
            text = batch.column(1).cast(pa.large_binary()).fill_null(b"")
            for a in range(0, len(text), 200):
                for d, ids in zip(doc_id[a:a + 200], enc.encode(text.slice(a, 200).to_pylist())):
                    shard.add(d, ids + end)
        enc.known.clear()  # workers live on: their memory is for the next stage
        trim_memory()
        done = shard.close()
        if done:
            yield pa.RecordBatch.from_arrays(
                [pa.array([TaskContext.get().partitionId()], pa.int32()),
                 *(pa.array([v]) for v in done)], names=["part", "file", "n_docs", "n_ids"])
    return run


def shard_count(docs: DataFrame, text_col: str = "text") -> int:
    """Shards of SHARD_BYTES of text each; smaller ones where the cores would
    otherwise wait."""
    size = docs.agg(F.sum(F.octet_length(text_col).cast("long"))).first()[0] or 0
    cores = docs.sparkSession.sparkContext.defaultParallelism
    return max(1, -(-size // SHARD_BYTES), min(4 * cores, -(-size // MIN_SHARD_BYTES)))


def write(docs: DataFrame, folder: str | None = None, path: str | None = None,
          end_id: int = END_ID, shards: int | None = None, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """Write all documents under ``folder`` (default: a fresh one in the shared
    checkpoint folder); returns the index: part, file, n_docs, n_ids, first_id
    (ids in the shards before), one row per shard."""
    spark = docs.sparkSession
    arrow_batches(spark)
    folder = folder or scratch_path(spark, "ids")
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                    F.xxhash64(F.col(text_col)).alias("_h"),
                    F.monotonically_increasing_id().alias("_m"))
    order = ["doc_id", "_h", "_m"]  # rows that repeat an id part at any place
    d = (d.repartitionByRange(shards or shard_count(docs, text_col), *order)
         .sortWithinPartitions(*order).select("doc_id", "text"))
    index = checkpoint(d.mapInArrow(_write(path or tokenizer_path(), folder, end_id), INDEX),
                       "ids-index")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # one row per shard: 10^6 at 64 TB of text
    return index.withColumn("first_id", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def read(index: DataFrame, with_ids: bool = False) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids_crc32 of
    every document, from the files; ``with_ids`` adds its ids (little-endian
    unsigned 32-bit, binary)."""
    names = ["doc_id", "start", "n_tokens", "ids_crc32"] + (["ids"] if with_ids else [])

    def run(batches):
        for batch in batches:
            for uri, first in zip(*(batch.column(i).to_pylist() for i in range(2))):
                shard = Shard(uri)
                for doc_ids, bounds, ids in shard.blocks():
                    raw, cut = memoryview(ids.tobytes()), (4 * (bounds - bounds[0])).tolist()
                    parts = [raw[a:b] for a, b in zip(cut, cut[1:])]
                    columns = [pa.array(doc_ids, pa.int64()), pa.array(bounds[:-1] + first),
                               pa.array(np.diff(bounds)),
                               pa.array([zlib.crc32(p) for p in parts], pa.int64())]
                    if with_ids:
                        columns.append(pa.array([bytes(p) for p in parts], pa.binary()))
                    yield pa.RecordBatch.from_arrays(columns, names=names)
                shard.close()
    shards = max(1, index.count())
    return index.select("file", "first_id").repartition(shards).mapInArrow(
        run, "doc_id long, start long, n_tokens long, ids_crc32 long"
             + (", ids binary" if with_ids else ""))
