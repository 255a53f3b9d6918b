"""Product codes of vectors, trained by Lloyd rounds over cover trees.

A vector's whole-number parts are coded apart, each part position with its own
codebook. Every block of vectors (one Arrow batch of a partition) gets a cover
tree for each part position, built once and written: a node stands for a point
and everything within its radius of it, its children lie at least half that
radius apart, and it keeps the number and the sum of the vectors below it. In
a round a node whose point is nearer to one codebook entry than to any other by
more than twice its radius gives its whole subtree to that entry (triangle
inequality), adding the stored sum; other nodes descend, and only the points of
ambiguous leaves are compared one by one. Squared distances are whole numbers
computed exactly, so ties are ties. A task sends one row per entry, the driver
holds the codebooks (ENTRIES x vector length numbers).

Contract: rows whose vector is null or holds a null or non-finite component are
left out; a vector shorter than the longest, or of a length that PARTS does not
divide, is filled up with zeros; with fewer than ENTRIES vectors the codebooks
have as many entries as there are vectors; null ids come last and rows that
repeat an id are vectors of their own (the lesser vector first); null labels
are one label; components of LARGEST / 1024 and more, whose distances would not fit a long,
fail the job; no rows give no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from polarity.llm.common import arrow_batches, checkpoint, small_or_plain

SCALE = 1024
PARTS = 4
ENTRIES = 256
ROUNDS = 4
#: vectors under one set of trees
BLOCK = 4096
#: points of a leaf, and candidates for children that are thinned at once
LEAF = 16
CANDIDATES = 64
#: components after scaling stay below: distances of 1,024 components fit a long
LARGEST = 1 << 25
#: values of a distance matrix held at once
MATRIX = 4 << 20


# ---------------------------------------------------------------- exact distances

def squared(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances as whole numbers: in floats where all sums stay below
    2^53 (so that no order of summation rounds), else in 64-bit numbers."""
    most = max(int(np.abs(points).max(initial=0)), int(np.abs(centres).max(initial=0)))
    if 4 * most * most * max(1, points.shape[1]) < 1 << 53:
        p, c = points.astype(np.float64), centres.astype(np.float64)
        out = p @ c.T
        out *= -2
        out += (p * p).sum(1)[:, None]
        out += (c * c).sum(1)
        return out
    out = np.zeros((len(points), len(centres)), np.int64)
    for j in range(points.shape[1]):
        gap = points[:, j, None] - centres[None, :, j]
        out += gap * gap
    return out


def nearest(points: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index, squared distance) of every point's nearest centre; the lower
    index of equal ones."""
    at, dist = np.zeros(len(points), np.int64), np.zeros(len(points), np.int64)
    step = max(1, MATRIX // max(1, len(centres)))
    for a in range(0, len(points), step):
        d = squared(points[a:a + step], centres)
        best = d.argmin(1)
        at[a:a + step] = best
        dist[a:a + step] = d[np.arange(len(d)), best].astype(np.int64)
    return at, dist


# ---------------------------------------------------------------- cover trees

def _net(points: np.ndarray, rows: np.ndarray, apart: float):
    """Split ``rows`` into groups around centres that are more than ``apart``
    from each other, every point within ``apart`` of its centre: (rows of a
    group, centre first) one by one."""
    rest = rows
    while len(rest):
        some = rest[:CANDIDATES]
        among = squared(points[some], points[some]) <= apart * apart
        chosen, taken = [], np.zeros(len(some), bool)
        for i in range(len(some)):
            if not taken[i]:
                chosen.append(i)
                taken |= among[i]
        centres = some[chosen]
        at, dist = nearest(points[rest], points[centres])
        near = dist <= apart * apart
        at, inside = at[near], rest[near]
        order = np.argsort(at, kind="stable")
        inside, bounds = inside[order], np.searchsorted(at[order], np.arange(len(centres) + 1))
        for k, c in enumerate(centres):
            group = inside[bounds[k]:bounds[k + 1]]
            yield np.concatenate([[c], group[group != c]])
        rest = rest[~near]


def cover_tree(points: np.ndarray) -> dict:
    """A tree over ``points``: ``order`` lists them so that every node is a
    run; a node has its run (start, end), its point (the first of the run), its
    radius and its children (first, last + 1; none for a leaf). Nodes come level
    by level, children of a node side by side."""
    n = len(points)
    order = np.zeros(n, np.int32)
    start, end, radius, first, last = [], [], [], [], []
    level = [(0, np.arange(n))] if n else []
    while level:
        below, base = [], len(start) + len(level)
        for at, rows in level:
            _, dist = nearest(points[rows], points[rows[:1]])
            r = float(np.sqrt(float(dist.max())))
            start.append(at)
            end.append(at + len(rows))
            radius.append(r)
            order[at:at + len(rows)] = rows
            first.append(base + len(below))
            if r > 0 and len(rows) > LEAF:
                for group in _net(points, rows, r / 2):
                    below.append((at, group))
                    at += len(group)
            last.append(base + len(below))
        level = below
    kinds = (np.int32, np.int32, np.float64, np.int32, np.int32)
    return {"order": order, **{k: np.asarray(v, t) for k, v, t in zip(
        ("start", "end", "radius", "first", "last"), (start, end, radius, first, last), kinds)}}


def node_sums(points: np.ndarray, tree: dict) -> np.ndarray:
    """Sum of the vectors below every node."""
    run = np.concatenate([np.zeros((1, points.shape[1]), np.int64),
                          np.cumsum(points[tree["order"]], axis=0, dtype=np.int64)])
    return run[tree["end"]] - run[tree["start"]]


def assign(points: np.ndarray, tree: dict, centres: np.ndarray):
    """(nodes, their entries, points, their entries): a partition of all points
    into whole subtrees and single points, each with its nearest entry."""
    nodes, node_at, singles = [], [], []
    level = np.zeros(min(1, len(tree["start"])), np.int64)
    while len(level):
        own = points[tree["order"][tree["start"][level]]]
        whole, at = _whole_subtrees(own, tree["radius"][level], centres)
        nodes.append(level[whole])
        node_at.append(at[whole])
        rest = level[~whole]
        size = (tree["last"] - tree["first"])[rest]
        for leaf in rest[size == 0]:
            singles.append(tree["order"][tree["start"][leaf]:tree["end"][leaf]])
        inner, size = rest[size > 0], size[size > 0]
        skip = np.repeat(tree["first"][inner] - (np.cumsum(size) - size), size)
        level = skip + np.arange(len(skip))
    rows = np.concatenate(singles) if singles else np.zeros(0, np.int64)
    at, _ = nearest(points[rows], centres)
    join = lambda x: np.concatenate(x) if x else np.zeros(0, np.int64)
    return join(nodes), join(node_at), rows, at


def _whole_subtrees(points: np.ndarray, radius: np.ndarray, centres: np.ndarray):
    """Whether all within ``radius`` of each point have one nearest centre, and
    that centre. Equal points are one point; else the second centre must be
    farther by more than twice the radius (and the roots' rounding)."""
    whole, at = np.zeros(len(points), bool), np.zeros(len(points), np.int64)
    step = max(1, MATRIX // max(1, len(centres)))
    for a in range(0, len(points), step):
        d = squared(points[a:a + step], centres)
        best = d.argmin(1)
        every = np.arange(len(d))
        near = np.sqrt(d[every, best].astype(np.float64))
        if len(centres) > 1:
            d = d.astype(np.float64)
            d[every, best] = np.inf
            other = np.sqrt(d.min(1))
        else:
            other = np.full(len(d), np.inf)
        r = radius[a:a + step]
        whole[a:a + step] = (r == 0) | (other - near > (2 * r) * (1 + 1e-9) + other * 1e-9)
        at[a:a + step] = best
    return whole, at


# ---------------------------------------------------------------- blocks

_TREE = [("order", pa.int32()), ("start", pa.int32()), ("end", pa.int32()),
         ("radius", pa.float64()), ("first", pa.int32()), ("last", pa.int32()),
         ("points", pa.int32()), ("sums", pa.int64())]
_SQL = {pa.int32(): "int", pa.int64(): "long", pa.float64(): "double"}
TREES = "trees array<struct<" + ", ".join(f"`{n}`: array<{_SQL[t]}>" for n, t in _TREE) + ">>"


def _build(parts: int, width: int):
    """Batches of (vec_id, label, vector) -> one row per batch: its ids, labels
    and the trees of its parts, ``width`` components each."""
    kind = pa.list_(pa.struct([(n, pa.list_(t)) for n, t in _TREE]))

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = batch.column(2)
            flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            all_parts = flat.reshape(batch.num_rows, parts, width)
            trees = []
            for p in range(parts):
                points = np.ascontiguousarray(all_parts[:, p])
                tree = cover_tree(points)
                tree["points"] = points.ravel()
                tree["sums"] = node_sums(points, tree).ravel()
                trees.append({n: tree[n] for n, _ in _TREE})
            yield pa.RecordBatch.from_arrays(
                [pa.array([batch.column(0)], pa.list_(pa.int64())),
                 pa.array([batch.column(1)], pa.list_(batch.column(1).type)),
                 pa.array([trees], kind)], names=["ids", "labels", "trees"])
    return run


def _tree(row: pa.StructScalar, width: int) -> tuple[np.ndarray, dict]:
    t = {n: row[n].values.to_numpy(zero_copy_only=False) for n, _ in _TREE}
    t["points"] = t["points"].reshape(-1, width).astype(np.int64)
    t["sums"] = t["sums"].reshape(-1, width)
    return t["points"], t


def _sums(books: list[np.ndarray], width: int):
    """Blocks -> one row per (part, entry) of a task: how many vectors, and
    their sum."""
    def run(batches):
        count = [np.zeros(len(b), np.int64) for b in books]
        total = [np.zeros(b.shape, np.int64) for b in books]
        for batch in batches:
            for row in batch.column(0):
                for p, centres in enumerate(books):
                    points, tree = _tree(row[p], width)
                    nodes, node_at, singles, at = assign(points, tree, centres)
                    np.add.at(count[p], node_at, (tree["end"] - tree["start"])[nodes])
                    np.add.at(total[p], node_at, tree["sums"][nodes])
                    np.add.at(count[p], at, 1)
                    np.add.at(total[p], at, points[singles])
        for p in range(len(books)):
            used = np.flatnonzero(count[p])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(used), p, np.int32)), pa.array(used.astype(np.int32)),
                 pa.array(count[p][used]), pa.array(list(total[p][used]), pa.list_(pa.int64()))],
                names=["part", "entry", "n", "total"])
    return run


def _codes(books: list[np.ndarray], width: int):
    """Blocks -> (vec_id, label, code, error) of every vector."""
    def run(batches):
        for batch in batches:
            for ids, labels, trees in zip(*(batch.column(i) for i in range(3))):
                codes = np.zeros((len(ids), len(books)), np.int64)
                error = np.zeros(len(ids), np.int64)
                for p, centres in enumerate(books):
                    points, tree = _tree(trees[p], width)
                    nodes, node_at, singles, at = assign(points, tree, centres)
                    for node, entry in zip(nodes, node_at):
                        rows = tree["order"][tree["start"][node]:tree["end"][node]]
                        codes[rows, p] = entry
                    codes[singles, p] = at
                    gap = points - centres[codes[:, p]]
                    error += (gap * gap).sum(1)
                yield pa.RecordBatch.from_arrays(
                    [ids.values, labels.values,
                     pa.array(["".join(f"{c:02x}" for c in r) for r in codes.tolist()], pa.string()),
                     pa.array(error)], names=["vec_id", "label", "code", "error"])
    return run


# ---------------------------------------------------------------- Spark

def whole_numbers(rows: DataFrame, id_col: str, vec_col: str, label_col: str) -> DataFrame:
    """(vec_id, label, v): the kept rows with their scaled components."""
    x = F.col(vec_col).cast("array<double>")
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    big = F.raise_error(F.concat(F.lit("a component is too large for whole-number distances: "),
                                 F.col(id_col).cast("string")))
    v = F.transform("_x", lambda c: F.floor(c * SCALE))
    kept = rows.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).alias("label"),
                       F.when(~bad, x).alias("_x")).where(F.col("_x").isNotNull())
    large = F.exists("_x", lambda c: F.abs(c) * SCALE >= LARGEST)
    return kept.select("vec_id", "label", F.when(large, big.cast("array<long>")).otherwise(v)
                       .alias("v"))


def train(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
          id_col: str = "vec_id", vec_col: str = "embedding",
          label_col: str = "label") -> tuple[DataFrame, list[np.ndarray]]:
    """(blocks with their trees, codebooks after ``rounds`` rounds)."""
    if not 1 <= entries <= 256:
        raise ValueError("a code has two hexadecimal digits: 1 to 256 entries")
    spark = rows.sparkSession
    arrow_batches(spark, BLOCK)
    v = whole_numbers(rows, id_col, vec_col, label_col)
    longest = v.agg(F.max(F.size("v"))).first()[0] or 0
    width = -(-longest // parts)
    fill = F.array_repeat(F.lit(0).cast("long"), F.lit(parts * width) - F.size("v"))
    v = v.withColumn("v", F.concat("v", fill))
    label = v.schema["label"].dataType.simpleString()
    blocks = checkpoint(v.mapInArrow(_build(parts, width),
                                     f"ids array<long>, labels array<{label}>, {TREES}"), "trees")
    first = v.orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(entries).select("v").collect()
    start = np.array([r["v"] for r in first], np.int64).reshape(len(first), parts, width)
    books = [np.ascontiguousarray(start[:, p]) for p in range(parts)]
    spec = "part int, entry int, n long, total array<long>"
    for _ in range(rounds if len(first) else 0):
        sums = blocks.select("trees").mapInArrow(_sums(books, width), spec)
        # a task's sums fit longs; those of all tasks are decimals
        each = [F.sum(F.col("total")[j].cast("decimal(38,0)")).alias(f"s{j}") for j in range(width)]
        for r in sums.groupBy("part", "entry").agg(F.sum("n").alias("n"), *each).collect():
            books[r["part"]][r["entry"]] = [int(r[f"s{j}"]) // r["n"] for j in range(width)]
    return blocks, books


def books_sha256(books: list[np.ndarray]) -> str:
    """Digest of all entries' components by part, entry and place."""
    text = ",".join(str(c) for b in books for c in b.ravel().tolist())
    return hashlib.sha256(text.encode()).hexdigest()


def encode(blocks: DataFrame, books: list[np.ndarray]) -> DataFrame:
    """(vec_id, label, code, error) of every vector of the blocks."""
    width = books[0].shape[1] if books else 0
    label = blocks.schema["labels"].dataType.elementType
    return blocks.mapInArrow(_codes(books, width), f"vec_id long, label {label.simpleString()}, "
                                                   "code string, error long")


def codes(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
          id_col: str = "vec_id", vec_col: str = "embedding",
          label_col: str = "label") -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256 of every kept row."""
    blocks, books = train(rows, parts, entries, rounds, id_col, vec_col, label_col)
    coded = checkpoint(encode(blocks, books), "codes")
    per = checkpoint(coded.groupBy(F.col("label").alias("_l")).agg(
        F.sum("error").alias("label_error")), "labels")
    out = coded.join(small_or_plain(per), F.col("label").eqNullSafe(F.col("_l")))
    return out.select("vec_id", "code", "error", "label_error",
                      F.lit(books_sha256(books)).alias("codebooks_sha256"))
