"""Prefix trie of rebuilt conversations from composable fingerprints.

A sequence of turns has the fingerprint H = sum of t_i * B^i (mod p), in four
lanes of 31 bits, where t_i is a turn's digest and i its place. (length, H) is a
monoid: H(a + b) = H(a) + B^len(a) * H(b). So

- running fingerprints of a conversation are scanned inside range partitions,
  and what came before a partition is composed in front of it;
- a rebuilt conversation, the head of a base conversation and the suffix of its
  own, gets the fingerprint of every prefix from those of the two originals:
  H(base, k) + B^(k - h) * (H(own, i) - H(own, h)). No rebuilt text exists.

Prefixes of one depth and fingerprint are one node. That equal fingerprints mean
equal turns is verified, not assumed: a row keeps its turn's digest and its
parent's fingerprint, which must agree within a node (by induction, so do all
turns above), and among the stored turns one digest must mean one role and text.
If either fails, everything is done again with other bases and digests.

Sums over a subtree need no walk: a node's smallest member is also the smallest
of a run of prefixes down to its end, so each node's own value lies at one place
of one conversation, and a subtree's sum is the sum, over the members, of the
values from that depth on - a running total along conversations and one
aggregate by node.

Contract: null role or text is empty; turns come by turn (null first), role and
text; rows without a conversation id belong to none and are left out; repeated
turns are turns; a base that does not exist gives no head; a conversation whose
turns all go to a head it lacks is turnless and a member of the root alone; no
rows give no nodes, not even a root; other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from polarity.llm.common import arrow_batches, checkpoint, n_words, small_or_plain
from polarity.operators.joins import dealt_lookup
from polarity.operators.ordering import running_total

#: primes below 2^31 (fixed values), one a lane
PRIMES = (2147483647, 2147483629, 2147483587, 2147483579)
LANES = range(len(PRIMES))
#: a conversation's base is that of the next lower multiple, and its head has
#: fewer than HEADS turns
BASES = 20
HEADS = 4
#: characters of a text that decide its range partition, where turns tie
TIE_CHARS = 32
#: conversation ids that one piece of a node's list of ends may hold
PIECE = 4096
#: children of one node that a lookup task may hold, at least
CHILDREN = 10_000
TRIES = 3


def bases(salt: int) -> list[int]:
    """A base of each lane."""
    return [int.from_bytes(hashlib.sha256(f"trie {salt} {k}".encode()).digest(), "little")
            % (p - 1000) + 500 for k, p in enumerate(PRIMES)]


def digests(h1: np.ndarray, h2: np.ndarray) -> list[np.ndarray]:
    """A turn's number in each lane, from its 128 bits."""
    a, b = h1.view(np.uint64), h2.view(np.uint64)
    low, high = np.uint64((1 << 31) - 1), np.uint64(33)
    return [((x & low) if k % 2 == 0 else (x >> high)).astype(np.int64) % p
            for k, (x, p) in enumerate(zip((a, a, b, b), PRIMES))]


# ---------------------------------------------------------------- scan

class Powers:
    """Powers of the bases, computed as far as they are asked for."""

    def __init__(self, base: list[int]):
        self.base = base
        self.table = [np.ones(1, np.int64) for _ in base]

    def upto(self, n: int) -> list[np.ndarray]:
        while len(self.table[0]) <= n:
            k = len(self.table[0])
            self.table = [np.concatenate([t, t * pow(b, k, p) % p])
                          for t, b, p in zip(self.table, self.base, PRIMES)]
        return self.table


class Scan:
    """Running places and fingerprints of conversations, batch after batch."""

    def __init__(self, base: list[int]):
        self.powers = Powers(base)
        self.conv, self.n, self.h = None, 0, [0] * len(PRIMES)
        self.edges: list[tuple] = []  # the first conversation, once it has ended

    def add(self, conv: np.ndarray, h1: np.ndarray, h2: np.ndarray):
        """(places, terms, fingerprints) of the rows, per lane; places from 1."""
        count = len(conv)
        at = np.arange(count)
        new = np.concatenate([[conv[0] != self.conv], conv[1:] != conv[:-1]])
        start = np.maximum.accumulate(np.where(new, at, 0))
        carried = ~np.maximum.accumulate(new)
        place = at - start + 1 + np.where(carried, self.n, 0)
        powers = self.powers.upto(int(place.max()))
        terms, prints = [], []
        for k, (t, p) in enumerate(zip(digests(h1, h2), PRIMES)):
            term = t * powers[k][place] % p
            run = np.cumsum(term)
            run -= (run - term)[start]
            terms.append(term)
            prints.append((run + np.where(carried, self.h[k], 0)) % p)
        if new.any() and not self.edges and (self.conv is not None or new[1:].any()):
            first_end = int(np.flatnonzero(new)[0 if self.conv is not None else 1]) - 1
            if first_end < 0:
                self.edges.append(self.state())
            else:
                self.edges.append((int(conv[first_end]), int(place[first_end]),
                                   *(int(x[first_end]) for x in prints)))
        self.conv, self.n = int(conv[-1]), int(place[-1])
        self.h = [int(x[-1]) for x in prints]
        return place, terms, prints

    def state(self) -> tuple:
        return (self.conv, self.n, *self.h)

    def ends(self) -> list[tuple]:
        """(conversation, turns, fingerprint) of the first and the last
        conversation of the rows."""
        return self.edges + ([self.state()] if self.conv is not None else [])


_TURN = ["conv_id", "h1", "h2", "words", "role", "text"]
_LONGS = ["place", *(f"t{k}" for k in LANES), *(f"p{k}" for k in LANES)]


def _scanned(base: list[int]):
    names = ["edge", "part", *_TURN, *_LONGS]

    def run(batches):
        part, scan = TaskContext.get().partitionId(), Scan(base)
        for b in batches:
            n = b.num_rows
            if not n:
                continue
            conv, h1, h2 = (b.column(i).to_numpy() for i in range(3))
            place, terms, prints = scan.add(conv, h1, h2)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.zeros(n, bool)), pa.array(np.full(n, part, np.int32)), *b.columns,
                 *(pa.array(x) for x in (place, *terms, *prints))], names=names)
        ends = scan.ends()
        if ends:
            n = len(ends)
            ids, place, *prints = (np.array(c, np.int64) for c in zip(*ends))
            none = [pa.nulls(n, pa.int64())] * 3 + [pa.nulls(n, pa.string())] * 2
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.ones(n, bool)), pa.array(np.full(n, part, np.int32)), pa.array(ids),
                 *none, pa.array(place), *[pa.nulls(n, pa.int64())] * len(PRIMES),
                 *(pa.array(x) for x in prints)], names=names)
    return run


def _before(base: list[int]):
    """The edge rows of one conversation, at most one a partition -> what
    precedes it in each partition: turns, fingerprint, and the power that moves
    a fingerprint behind them."""
    def run(key, table):
        rows = sorted(zip(*(table.column(c).to_pylist() for c in
                            ("part", "place", *(f"p{k}" for k in LANES)))))
        n, h, out = 0, [0] * len(PRIMES), []
        for part, place, *prints in rows:
            shift = [pow(b, n, p) for b, p in zip(base, PRIMES)]
            if n:
                out.append((key[0].as_py(), part, n, *h, *shift))
            h = [(a + s * x) % p for a, s, x, p in zip(h, shift, prints, PRIMES)]
            n += place
        names = ["conv_id", "part", "n", *(f"h{k}" for k in LANES), *(f"s{k}" for k in LANES)]
        columns = list(zip(*out)) or [()] * len(names)
        return pa.table({c: pa.array(v, pa.int32() if c == "part" else pa.int64())
                         for c, v in zip(names, columns)})
    return run


def _longs(names) -> str:
    return ", ".join(f"{n} long" for n in names)


def stored_turns(rows: DataFrame, salt: int) -> DataFrame:
    """(conv_id, place, words, h1, h2, role, text, fp0.., term0..) of every turn:
    its place in its conversation, the fingerprint up to it and its own term."""
    spark = rows.sparkSession
    arrow_batches(spark)
    base = bases(salt)
    text = F.coalesce("text", F.lit(""))
    d = rows.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn",
        F.coalesce("role", F.lit("")).alias("role"), text.alias("text"))
    d = d.select("*", *[F.xxhash64(F.lit(f"{salt} {k}"), "role", "text").alias(f"h{k}")
                        for k in (1, 2)], n_words(F.col("text")).alias("words"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    d = (d.repartitionByRange(parts, "conv_id", "turn", "role", F.substring("text", 1, TIE_CHARS))
         .sortWithinPartitions("conv_id", "turn", "role", "text").select(*_TURN))
    scanned = checkpoint(d.mapInArrow(
        _scanned(base), "edge boolean, part int, conv_id long, h1 long, h2 long, words long, "
                        f"role string, text string, {_longs(_LONGS)}"), "turns")
    edges = scanned.where("edge").select("conv_id", "part", "place", *(f"p{k}" for k in LANES))
    before = checkpoint(edges.groupBy("conv_id").applyInArrow(
        _before(base), f"conv_id long, part int, n long, {_longs(f'h{k}' for k in LANES)}, "
                       f"{_longs(f's{k}' for k in LANES)}"), "before")
    b = before.select(F.col("conv_id").alias("_c"), F.col("part").alias("_p"), F.col("n").alias("_n"),
                      *[F.col(f"{x}{k}").alias(f"_{x}{k}") for x in "hs" for k in LANES])
    turns = scanned.where("not edge").join(  # a row per partition at most
        small_or_plain(b), (F.col("conv_id") == F.col("_c")) & (F.col("part") == F.col("_p")), "left")
    moved = [(F.coalesce(f"_s{k}", F.lit(1)) * F.col(f"{x}{k}") + (
        F.coalesce(f"_h{k}", F.lit(0)) if x == "p" else F.lit(0))) % PRIMES[k]
        for x in "pt" for k in LANES]
    return turns.select("conv_id", (F.col("place") + F.coalesce("_n", F.lit(0))).alias("place"),
                        "words", "h1", "h2", "role", "text",
                        *[m.alias(f"{x}{k}") for m, (x, k) in zip(
                            moved, [(x, k) for x in ("fp", "term") for k in LANES])])


# ---------------------------------------------------------------- rebuilding

def _pack(lanes: list[Column]) -> list[Column]:
    """Two lanes a number."""
    return [F.shiftleft(lanes[k], 31).bitwiseOR(lanes[k + 1]) for k in range(0, len(lanes), 2)]


def heads(turns: DataFrame) -> DataFrame:
    """One row per conversation: its turns, and of each of the first HEADS - 1
    the fingerprint, digest and words."""
    what = ["words", "h1", "h2", *(f"fp{k}" for k in LANES)]
    first = [F.max(F.when(F.col("place") == j, F.struct(*what))).alias(f"at{j}")
             for j in range(1, HEADS)]
    return turns.groupBy("conv_id").agg(F.max("place").alias("n"), *first)


def rebuilt(turns: DataFrame, salt: int) -> DataFrame:
    """(conv_id, depth, k1, k2, q1, q2, h1, h2, words, ends): every prefix of
    every rebuilt conversation - its fingerprint, its parent's, the digest and
    words of its last turn, and whether the conversation ends there."""
    base = bases(salt)
    convs = checkpoint(heads(turns), "heads")
    own = convs.withColumn("h", F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")),
                                       F.lit(HEADS)).cast("int"))
    own = own.withColumn("base", F.col("conv_id") - F.col("conv_id") % BASES)
    of_base = convs.select(F.col("conv_id").alias("base"), F.col("n").alias("nb"),
                           *[F.col(f"at{j}").alias(f"b{j}") for j in range(1, HEADS)])
    c = own.join(of_base, "base", "left")
    c = c.withColumn("hb", F.least("h", F.coalesce("nb", F.lit(0))).cast("long"))

    def at(column: Column, prefix: str, k: int) -> Column:
        """Lane k of the fingerprint of the first ``column`` turns."""
        out = F.lit(0).cast("long")
        for j in range(1, HEADS):
            out = F.when(column == j, F.col(f"{prefix}{j}")[f"fp{k}"]).otherwise(out)
        return out
    back = [F.element_at(F.array(*[F.lit(pow(b, -j, p)) for j in range(HEADS)]),
                         (F.col("h") - F.col("hb") + 1).cast("int"))
            for b, p in zip(base, PRIMES)]
    c = c.select(
        "conv_id", "h", "hb", *[f"b{j}" for j in range(1, HEADS)],
        (F.col("hb") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("depths"),
        *[at(F.col("hb"), "b", k).alias(f"head{k}") for k in LANES],
        *[F.when(F.col("n") >= F.col("h"), at(F.col("h"), "at", k)).otherwise(F.lit(0))
          .alias(f"gone{k}") for k in LANES], *[x.alias(f"back{k}") for k, x in zip(LANES, back)])
    c = checkpoint(c, "rebuilt")
    zero = F.lit(0).cast("long")

    def row(depth, lanes, parent, h1, h2, words):
        return [F.col("conv_id"), depth.cast("long").alias("depth"),
                *[x.alias(n) for x, n in zip(_pack(lanes) + _pack(parent), ("k1", "k2", "q1", "q2"))],
                h1.alias("h1"), h2.alias("h2"), words.cast("long").alias("words"),
                (depth == F.col("depths")).alias("ends")]
    nothing = [zero] * len(PRIMES)
    parts = [c.select(*row(zero, nothing, nothing, zero, zero, zero))]
    for j in range(1, HEADS):
        b = F.col(f"b{j}")
        above = [F.col(f"b{j - 1}")[f"fp{k}"] for k in LANES] if j > 1 else nothing
        parts.append(c.where(F.col("hb") >= j).select(*row(
            F.lit(j).cast("long"), [b[f"fp{k}"] for k in LANES], above, b["h1"], b["h2"], b["words"])))
    keep = c.select("conv_id", "h", "hb", "depths", *[f"{x}{k}" for x in ("head", "gone", "back")
                                                    for k in LANES])
    t = turns.select("conv_id", "place", "words", "h1", "h2",
                     *[f"{x}{k}" for x in ("fp", "term") for k in LANES])
    t = t.join(small_or_plain(keep), "conv_id").where("place > h")
    lanes, parent = [], []
    for k, p in zip(LANES, PRIMES):
        own_part = F.pmod(F.col(f"fp{k}") - F.col(f"gone{k}"), F.lit(p)) * F.col(f"back{k}") % p
        here = (F.col(f"head{k}") + own_part) % p
        lanes.append(here)
        parent.append(F.pmod(here - F.col(f"term{k}") * F.col(f"back{k}") % p, F.lit(p)))
    parts.append(t.select(*row(F.col("hb") + F.col("place") - F.col("h"), lanes, parent,
                               F.col("h1"), F.col("h2"), F.col("words"))))
    out = parts[0]
    for more in parts[1:]:
        out = out.unionAll(more)
    return out


# ---------------------------------------------------------------- nodes

KEY = ["depth", "k1", "k2"]


def grouped(prefixes: DataFrame) -> DataFrame:
    """One row per node: smallest member, members, words of the last turn, the
    parent's fingerprint, and whether all members agree on both."""
    same = F.lit(True)
    for c in ("q1", "q2", "h1", "h2"):
        same = same & (F.min(c) == F.max(c))
    return prefixes.groupBy(*KEY).agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"),
        F.max("words").alias("words"), F.max("q1").alias("q1"), F.max("q2").alias("q2"),
        same.alias("same"))


def mistaken(turns: DataFrame, nodes: DataFrame) -> bool:
    """Whether a fingerprint or a digest stands for two different things."""
    if not nodes.where("not same").isEmpty():
        return True
    said = F.struct("role", "text")
    two = turns.groupBy("h1", "h2").agg((F.min(said) != F.max(said)).alias("two")).where("two")
    return not two.isEmpty()


def ends_digests(prefixes: DataFrame) -> DataFrame:
    """(node, ends_sha256): the ids that end there, ascending, joined by commas.
    Pieces of at most PIECE ids are joined first; a task streams the pieces of
    its nodes through the digest and holds one at a time."""
    piece = F.floor(F.col("conv_id") / PIECE)
    ids = F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string"))
    pieces = (prefixes.where("ends").groupBy(*KEY, piece.alias("piece"))
              .agg(F.array_join(ids, ",").alias("ids")))
    pieces = pieces.repartition(*KEY).sortWithinPartitions(*KEY, "piece").select(*KEY, "ids")

    def run(batches):
        names = [*KEY, "ends_sha256"]

        def batch(done):
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*done), [pa.int64()] * 3 + [pa.string()])],
                names=names)
        node, state, done = None, None, []
        for b in batches:
            for *key, ids in zip(*(b.column(i).to_pylist() for i in range(4))):
                if key != node:
                    if node is not None:
                        done.append((*node, state.hexdigest()))
                    node, state = key, hashlib.sha256(ids.encode())
                else:
                    state.update(f",{ids}".encode())
            if len(done) >= 10_000:
                yield batch(done)
                done = []
        if node is not None:
            yield batch(done + [(*node, state.hexdigest())])
    return pieces.mapInArrow(run, "depth long, k1 long, k2 long, ends_sha256 string")


def trie(rows: DataFrame) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256."""
    spark = rows.sparkSession
    for salt in range(TRIES):
        turns = stored_turns(rows, salt)
        prefixes = checkpoint(rebuilt(turns, salt), "prefixes")
        found = checkpoint(grouped(prefixes), "nodes")
        if not mistaken(turns, found):
            break
    else:
        raise RuntimeError("fingerprints stay ambiguous")
    children = found.where("depth > 0").groupBy(
        (F.col("depth") - 1).alias("depth"), F.col("q1").alias("k1"), F.col("q2").alias("k2")).agg(
        F.count(F.lit(1)).alias("n_children"))
    nodes = checkpoint(found.join(children, KEY, "left").select(
        *KEY, "conv_id", "n_convs", "q1", "q2",
        F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"),
        ((F.col("n_convs") - 1) * F.col("words")).alias("saved")), "nodes")
    leaf = (F.col("n_children") == 0).cast("long")
    zero = F.lit(0).cast("long")
    # a node's value lies at its smallest member, before that conversation's own row
    along = nodes.select("conv_id", *KEY, F.lit(True).alias("value"), leaf.alias("leaf"),
                         "saved").unionAll(
        prefixes.select("conv_id", *KEY, F.lit(False), zero, zero))
    along = along.withColumn("up", -F.col("depth")).withColumn("last", (~F.col("value")).cast("int"))
    below = running_total(along, ["up", "last"], {"n_leaves": "leaf", "saved_tokens": "saved"},
                          ["conv_id"]).where("not value")
    none = F.lit(None)
    facts = below.select(*KEY, "n_leaves", "saved_tokens", none.cast("string").alias("ends_sha256"))
    facts = facts.unionAll(ends_digests(prefixes).select(
        *KEY, none.cast("long"), none.cast("long"), "ends_sha256"))
    facts = facts.groupBy(*KEY).agg(F.sum("n_leaves").alias("n_leaves"),
                                    F.sum("saved_tokens").alias("saved_tokens"),
                                    F.max("ends_sha256").alias("ends_sha256"))
    up = nodes.select(*KEY, "conv_id", "n_convs", "n_children",
                      F.when(F.col("depth") > 0, F.col("depth") - 1).alias("d"),
                      "q1", "q2")
    parents = nodes.select(F.col("depth").alias("d"), F.col("k1").alias("q1"),
                           F.col("k2").alias("q2"), F.col("conv_id").alias("parent_conv_id"))
    counts = nodes.select(F.col("depth").alias("d"), F.col("k1").alias("q1"),
                          F.col("k2").alias("q2"), F.col("n_children").alias("n"))
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    share = max(CHILDREN, -(-nodes.count() // tasks))
    up = dealt_lookup(up, ["d", "q1", "q2"], parents, counts, F.xxhash64("depth", "k1", "k2"), share)
    empty = hashlib.sha256(b"").hexdigest()
    return up.join(facts, KEY).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(empty)).alias("ends_sha256"))
