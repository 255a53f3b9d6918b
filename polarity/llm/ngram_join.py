"""N-gram Jaccard self-join with grouped prefixes.

1. Every text becomes its set of word shingles (64-bit hashes); equal sets are
   one class.
2. Shingles are ordered globally: those whose hash is in the lowest part
   (COUNTED_MORE percent more than the longest prefix) by the number of
   classes that hold them (counted over all classes, in one exchange of that
   part), then the others by hash. Any order is correct; this one puts rare
   shingles into prefixes and keeps shared passages out.
3. Two sets can reach the threshold only if their prefixes share a shingle.
   Classes with one prefix and one size form a group; groups are posted under
   those shingles of their prefix that others have too, and lists with the
   same groups are kept once (under their first shingle).
4. Group pairs are filtered by size and by the place of the shared shingle,
   made distinct, and only then expanded to members and verified on whole sets.
   First each group meets one of its list, drawn by hash: all its members
   against that group's first one, and against their own group's; these links
   already join most of a dense group. Then, in lists that still hold several
   components, members outside the largest meet all members of other
   components: in short lists as pairs of groups' parts (the members in one
   component), expanded once each and only where not tried before, in long ones
   in blocks of bounded size. Components of the verified links are the result;
   every pair that may link different components has been compared, so no link
   between different texts is lost.

Contract: A-Z count as lower case; fewer than ``width`` words make one shingle
of them all; texts without words (and null) have no shingles and no links;
repeated rows and ids are linked as their texts are; a component's id is its
smallest document id (null only if it has no other).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from polarity.llm import words as W
from polarity.llm.common import arrow_batches, checkpoint, small_or_plain, tidy
from polarity.llm.components import components
from polarity.session import drop_scratch, scratch_mark

#: words of a shingle and Jaccard threshold in percent of near duplicates; the
#: query op4 gives its own (4 and 85)
WIDTH = 5
PERCENT = 80
#: percent of all shingles that are counted beyond the longest prefix's
#: 100 - threshold
COUNTED_MORE = 5
#: lists of more comparisons than this are compared in blocks of BLOCK sets
PAIRS = 2_000
BLOCK = 256
#: rows by shingle up to which they are broadcast; more are joined by a shuffle
#: whose hot shingles AQE splits
SPREAD = 200_000


# ---------------------------------------------------------------- sets

def shingle_sets(raw: np.ndarray, offsets: np.ndarray, width: int = WIDTH):
    """(hashes, bounds): the sorted distinct shingle hashes of every text, and
    where each text's begin."""
    h, row = W.word_hashes(raw, offsets, lower=True)
    n = len(offsets) - 1
    first = W.row_starts(row, n)
    count = np.diff(first)
    if len(h) >= width:
        grams = W.combine([h[i:len(h) - width + 1 + i] for i in range(width)])
        inside = row[width - 1:] == row[:len(h) - width + 1]
        grams, owner = grams[inside], row[:len(h) - width + 1][inside]
    else:
        grams, owner = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    short = np.flatnonzero((count > 0) & (count < width))
    if len(short):
        whole = np.array([W.combine(list(h[first[i]:first[i + 1], None]))[0] for i in short],
                         np.uint64)
        grams, owner = np.concatenate([grams, whole]), np.concatenate([owner, short])
        order = np.argsort(owner, kind="stable")
        grams, owner = grams[order], owner[order]
    bounds = W.row_starts(owner, n)
    for i in range(n):
        grams[bounds[i]:bounds[i + 1]].sort()
    if len(grams):
        new = np.ones(len(grams), bool)
        new[1:] = (grams[1:] != grams[:-1]) | (owner[1:] != owner[:-1])
        grams, owner = grams[new], owner[new]
    return grams, W.row_starts(owner, n)


def _sum_by(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)])
    return total[bounds[1:]] - total[bounds[:-1]]


def set_ids(grams: np.ndarray, bounds: np.ndarray) -> list[bytes]:
    """16 bytes that name a set: two sums of differently mixed hashes."""
    a = _sum_by(W.mix(grams), bounds)
    b = _sum_by(W.mix(grams ^ np.uint64(0x5851F42D4C957F2D)), bounds)
    both = np.stack([W.mix(a + np.diff(bounds).astype(np.uint64)), b], 1)
    return [r.tobytes() for r in both]


def _blocks(batch: pa.RecordBatch, column: int, width: int):
    raw, offsets = W.utf8(batch.column(column))
    for a, b in W.chunks(offsets, 1 << 19):
        o = offsets[a:b + 1]
        yield a, b, *shingle_sets(raw[o[0]:o[-1]], o - o[0], width)


def prefix_length(n, percent: int = PERCENT):
    return n - (percent * n + 99) // 100 + 1


def _tokens(width: int, percent: int):
    """mapInArrow: (doc_id, text, said) -> doc_id, said, cls, n, the number of
    shingles that are counted, and these in order of hash (more if a prefix
    needs them)."""
    limit = np.uint64(min((100 - percent + COUNTED_MORE) * 2 ** 64 // 100, 2 ** 64 - 1))

    def run(batches):
        for batch in batches:
            for a, b, grams, bounds in _blocks(batch, 1, width):
                n = np.diff(bounds)
                low = np.concatenate([[0], np.cumsum(grams < limit)])
                counted = low[bounds[1:]] - low[bounds[:-1]]
                size = np.where(n > 0, np.maximum(counted, prefix_length(n, percent)), 0)
                ends = np.concatenate([[0], np.cumsum(size)])
                take = np.repeat(bounds[:-1] - ends[:-1], size) + np.arange(ends[-1])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), batch.column(2).slice(a, b - a),
                     pa.array(set_ids(grams, bounds), pa.binary()),
                     pa.array(n.astype(np.int64)), pa.array(counted.astype(np.int64)),
                     pa.ListArray.from_arrays(pa.array(ends, pa.int32()),
                                              pa.array(W.signed(grams[take])))],
                    names=["doc_id", "said", "cls", "n", "counted", "tokens"])
    return run


def _sets(width: int):
    def run(batches):
        for batch in batches:
            for _, _, grams, bounds in _blocks(batch, 0, width):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(set_ids(grams, bounds), pa.binary()),
                     pa.ListArray.from_arrays(pa.array(bounds, pa.int32()),
                                              pa.array(W.signed(grams)))], names=["cls", "hashes"])
    return run


# ---------------------------------------------------------------- filters

def _need(n1: Column, n2: Column, percent: int) -> Column:
    """Least intersection of sets of these sizes at the threshold."""
    return F.ceil((n1 + n2) * F.lit(percent) / F.lit(100 + percent))


def _may_link(n1, p1, n2, p2, percent: int) -> Column:
    """Size filter, and the bound from the first shared shingle's places."""
    near = (F.least(n1, n2) * 100 >= F.greatest(n1, n2) * percent)
    return near & (F.least(n1 - p1, n2 - p2) >= _need(n1, n2, percent))


def _compare(block: dict, percent: int):
    """Verified links of one block: each left member against all right ones of
    other components, by marking its shingles among theirs."""
    hashes = np.concatenate(block["sets"])
    sizes = np.array([len(s) for s in block["sets"]])
    _, code = np.unique(hashes, return_inverse=True)
    starts = np.concatenate([[0], np.cumsum(sizes)])
    right = np.flatnonzero(~block["left"])
    r_codes = np.concatenate([code[starts[i]:starts[i + 1]] for i in right])
    r_starts = np.concatenate([[0], np.cumsum(sizes[right])[:-1]])
    flag = np.zeros(int(code.max()) + 1, np.int32)
    out = {}
    comp = block["comp"]
    for i in np.flatnonzero(block["left"]):
        mine = code[starts[i]:starts[i + 1]]
        flag[mine] = 1
        common = np.add.reduceat(flag[r_codes], r_starts)
        flag[mine] = 0
        ok = 100 * common >= percent * (sizes[right] + sizes[i] - common)
        for j in right[ok]:
            if comp[j] != comp[i]:
                out[(comp[i], comp[j])] = True
    return list(out)


def _block_links(percent: int):
    """mapInArrow over rows sorted by (g, i, j): links of every block."""
    def run(batches):
        key, held = None, None

        def done():
            if held and any(held["left"]) and not all(held["left"]):
                block = {"sets": held["sets"], "left": np.array(held["left"]), "comp": held["comp"]}
                return _compare(block, percent)
            return []
        found: list = []
        for batch in batches:
            cols = {n: batch.column(n) for n in batch.schema.names}
            keys = list(zip(*(cols[c].to_pylist() for c in ("g", "i", "j"))))
            left, comp = cols["side"].to_pylist(), cols["comp"].to_pylist()
            flat = cols["hashes"].flatten().to_numpy()
            ends = np.concatenate([[0], np.cumsum(cols["hashes"].value_lengths().to_numpy())])
            for r, k in enumerate(keys):
                if k != key:
                    found += done()
                    key, held = k, {"sets": [], "left": [], "comp": []}
                held["sets"].append(flat[ends[r]:ends[r + 1]].copy())
                held["left"].append(left[r])
                held["comp"].append(comp[r])
            if len(found) > 10_000:
                yield _pairs(found)
                found = []
        found += done()
        yield _pairs(found)
    return run


def _pairs(found):
    return pa.RecordBatch.from_arrays([pa.array([a for a, _ in found], pa.int64()),
                                       pa.array([b for _, b in found], pa.int64())],
                                      names=["u", "v"])


# ---------------------------------------------------------------- join

def _posted(t: DataFrame, percent: int) -> DataFrame:
    """(token, ref, n, p, common, late): the prefix shingles of every class
    that other classes have too. p: place in the prefix, from 0; shingles that
    are counted come in order of count (1 first, which are not posted), then
    the late ones in order of hash."""
    rows = t.select("ref", F.posexplode("tokens").alias("pos", "token"))
    # counted by partial sums and joined back: a shingle of all texts is no task
    counts = checkpoint(rows.groupBy("token").agg(F.count(F.lit(1)).alias("common"))
                        .where("common > 1"), "counts")
    rows = checkpoint(rows.join(small_or_plain(counts, SPREAD), "token"), "shared")
    rows = rows.join(t.select("ref", "n", "counted"), "ref")
    rows = rows.withColumn("late", F.col("pos") >= F.col("counted"))
    rows = rows.withColumn("common", F.when(F.col("late"), 0).otherwise(F.col("common")))
    own = Window.partitionBy("ref")
    alone = F.col("counted") - F.count(F.when(~F.col("late"), 1)).over(own)
    number = F.row_number().over(own.orderBy("late", "common", "pos")) - 1
    rows = rows.withColumn("p", F.when(F.col("late"), F.col("pos")).otherwise(alone + number))
    return rows.where(F.col("p") < prefix_length_of(F.col("n"), percent)).drop("pos", "counted")


def prefix_length_of(n: Column, percent: int) -> Column:
    return n - F.floor((n * percent + 99) / 100) + 1


def _lists(t: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """((token, gid, n, p): groups of every list that can hold a pair;
    (ref, n, gid): members of all groups)."""
    posts = checkpoint(_posted(t, percent), "posts")
    whole = posts.groupBy("ref", "n").agg(
        F.count(F.lit(1)).alias("c"), F.sum(F.xxhash64("token", "p").cast("decimal(38,0)")).alias("h"))
    # one group: all of the prefix is shared, and alike
    gid = F.when(F.col("c") == prefix_length_of(F.col("n"), percent), F.xxhash64("n", "h")).otherwise(
        F.xxhash64("ref"))
    members = checkpoint(whole.select("ref", "n", gid.alias("gid")), "members")
    groups = members.groupBy("gid").agg(F.min("ref").alias("ref"), F.count(F.lit(1)).alias("k"))
    at = posts.join(checkpoint(groups, "groups"), "ref").select("token", "gid", "k", "n", "p",
                                                                "common", "late")
    at = checkpoint(at, "group-posts")
    rank = F.struct("late", "common", F.col("token").bitwiseXOR(F.lit(-2 ** 63)).alias("h"))
    lists = at.groupBy("token").agg(
        F.count(F.lit(1)).alias("m"), F.sum("k").alias("k"), F.min(rank).alias("rank"),
        F.sum(F.xxhash64("gid").cast("decimal(38,0)")).alias("h")).where("k > 1")
    kept = checkpoint(lists.groupBy("m", "h").agg(F.min(F.struct("rank", "token")).alias("f"))
                      .select(F.col("f.token").alias("token")), "kept")
    lists = at.join(small_or_plain(kept, SPREAD), "token").select("token", "gid", "n", "p")
    return checkpoint(lists, "lists"), members


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    a = sets.select(F.col("ref").alias("u"), F.col("hashes").alias("hu"))
    b = sets.select(F.col("ref").alias("v"), F.col("hashes").alias("hv"))
    both = F.size(F.array_intersect("hu", "hv")).cast("long")
    rows = pairs.join(a, "u").join(b, "v").select(
        "u", "v", both.alias("c"), (F.size("hu") + F.size("hv")).cast("long").alias("s"))
    return rows.where(F.col("c") * 100 >= (F.col("s") - F.col("c")) * percent).select("u", "v")


def _once(pairs: DataFrame) -> DataFrame:
    """(u, v) of rows (ref, other): each pair of different ones once."""
    return pairs.where("ref != other").select(
        F.greatest("ref", "other").alias("u"), F.least("ref", "other").alias("v")).distinct()


def _drawn_pairs(lists: DataFrame, members: DataFrame, percent: int) -> DataFrame:
    """Each member with the first one of the group drawn for its list, as far
    as the groups may link, and with the first one of its own group."""
    draw = F.xxhash64("token", "gid").alias("h")
    centre = checkpoint(lists.groupBy("token").agg(F.min(F.struct(draw, "gid", "n", "p")).alias("c")),
                        "centres")
    ok = _may_link(F.col("n"), F.col("p"), F.col("c.n"), F.col("c.p"), percent)
    met = lists.join(small_or_plain(centre, SPREAD), "token").where(
        (F.col("gid") != F.col("c.gid")) & ok).select("gid", F.col("c.gid").alias("to")).distinct()
    own = members.select("gid", F.col("gid").alias("to"), "ref")
    rows = met.join(members.select("gid", "ref"), "gid").unionAll(own)
    first = members.groupBy(F.col("gid").alias("to")).agg(F.min("ref").alias("other"))
    return _once(rows.join(first, "to"))


def _open_lists(lists: DataFrame, members: DataFrame, comps: DataFrame,
                percent: int) -> DataFrame:
    """(token, gid, ref, n, p, comp, top, m, out) of lists with several components:
    the largest one, the members, and those outside it. Members that no size
    and place in the list would let link are left out."""
    members = members.join(comps.select(F.col("node").alias("ref"), "component"), "ref", "left")
    m = checkpoint(lists.join(members.select("gid", "ref", F.coalesce("component", "ref")
                                             .alias("comp")), "gid")
                   .select("token", "gid", "ref", "n", "p", "comp"), "members")
    room = m.groupBy("token").agg(F.max(F.col("n") - F.col("p")).alias("room"),
                                  F.min("n").alias("least"), F.min("comp").alias("c0"),
                                  F.max("comp").alias("c1")).where("c0 != c1").drop("c0", "c1")
    partner = F.greatest("least", F.ceil(F.col("n") * percent / 100))
    m = m.join(room, "token").where(
        F.least(F.col("n") - F.col("p"), "room") >= _need(F.col("n"), partner, percent))
    m = checkpoint(m.select("token", "gid", "ref", "n", "p", "comp"), "members")
    parts = m.groupBy("token", "comp").agg(F.count(F.lit(1)).alias("c"))
    at = parts.groupBy("token").agg(F.max(F.struct("c", "comp")).alias("t"), F.sum("c").alias("m"),
                                    F.count(F.lit(1)).alias("parts")).where("parts > 1")
    at = at.select("token", F.col("t.comp").alias("top"), "m", (F.col("m") - F.col("t.c"))
                   .alias("out"))
    return checkpoint(m.join(at, "token"), "open")


def _short_pairs(lists: DataFrame, percent: int) -> DataFrame:
    """All pairs that may link, of members outside the largest component with
    members of others, in lists of at most PAIRS comparisons: pairs of groups'
    parts (gid, comp), then their members."""
    short = lists.where(F.col("m") * F.col("out") <= PAIRS)
    units = short.select("token", "gid", "n", "p", "comp", "top").distinct()
    other = units.select("token", F.struct("gid", "n", "p", "comp").alias("c"))
    ok = _may_link(F.col("n"), F.col("p"), F.col("c.n"), F.col("c.p"), percent)
    met = units.where("comp != top").join(other, "token").where(
        (F.col("comp") != F.col("c.comp")) & ok).select(
        "gid", "comp", F.col("c.gid").alias("gid2"), F.col("c.comp").alias("comp2")).distinct()
    parts = checkpoint(short.select("gid", "comp", "ref").distinct(), "parts")
    second = parts.select(F.col("gid").alias("gid2"), F.col("comp").alias("comp2"),
                          F.col("ref").alias("other"))
    return _once(met.join(parts, ["gid", "comp"]).join(second, ["gid2", "comp2"]))


def _long_blocks(lists: DataFrame) -> DataFrame:
    """(g, ref, comp, i, j, side): members of the other lists dealt into
    blocks: those outside the largest component on the left, all on the right.
    Lists of one largest component are mostly the same documents under other
    shingles; where taking them as one list sends fewer sets, they are."""
    m = lists.where(F.col("m") * F.col("out") > PAIRS)
    blocks = lambda n: F.ceil(F.col(n) / BLOCK)
    sent = (F.col("out") * blocks("m") + F.col("m") * blocks("out")).alias("sent")
    apart = (m.groupBy("top", "token").agg(F.first("m").alias("m"), F.first("out").alias("out"))
             .select("top", sent).groupBy("top").agg(F.sum("sent").alias("apart")))
    once = m.select("top", "ref", "comp").distinct()
    whole = once.groupBy("top").agg(F.count(F.lit(1)).alias("m"),
                                    F.count(F.when(F.col("comp") != F.col("top"), 1)).alias("out"))
    one = checkpoint(whole.join(apart, "top").where(sent <= F.col("apart"))
                     .select("top", "m", "out"), "one")
    joint = once.join(one, "top").select(F.concat(F.lit("c"), "top").alias("g"), "ref", "comp", "top",
                                         "m", "out")
    single = m.join(one.select("top"), "top", "left_anti").select(
        F.concat(F.lit("l"), "token").alias("g"), "ref", "comp", "top", "m", "out")
    m = joint.unionAll(single).withColumn("nr", blocks("m").cast("int")).withColumn(
        "nl", blocks("out").cast("int"))
    h = F.xxhash64("ref")
    left = m.where("comp != top").select(
        "g", "ref", "comp", F.pmod(h, "nl").cast("int").alias("i"),
        F.explode(F.sequence(F.lit(0), F.col("nr") - 1)).alias("j"), F.lit(True).alias("side"))
    right = m.select(
        "g", "ref", "comp", F.explode(F.sequence(F.lit(0), F.col("nl") - 1)).alias("i"),
        F.pmod(h, "nr").cast("int").alias("j"), F.lit(False).alias("side"))
    return left.unionAll(right)


def classes(docs: DataFrame, width: int = WIDTH,
            percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """((doc_id, said, cls, n) of every document, with a hash of its text;
    (cls, component) of linked classes)."""
    arrow_batches(docs.sparkSession)
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    t = d.withColumn("said", said()).mapInArrow(
        tidy(_tokens(width, percent)), "doc_id long, said long, cls binary, n long, counted long, "
                                 "tokens array<long>")
    t = checkpoint(t.withColumn("ref", F.monotonically_increasing_id()), "sets")
    thin = t.select("doc_id", "said", "cls", "n")
    first = t.where("n > 0").groupBy("cls").agg(F.min("ref").alias("ref"))
    first = checkpoint(first.select("ref"), "classes")
    t = t.join(small_or_plain(first), "ref", "left_semi")
    lists, members = _lists(t, percent)
    members = checkpoint(members.join(lists.select("gid").distinct(), "gid", "left_semi")
                         .select("gid", "ref"), "refs")
    wanted = checkpoint(t.join(small_or_plain(members.select("ref")), "ref", "left_semi")
                        .select("ref", "cls", F.coalesce("doc_id", F.lit(-2 ** 63)).alias("_id")),
                        "wanted")
    texts = (d.withColumn("_id", F.coalesce("doc_id", F.lit(-2 ** 63)))
             .join(small_or_plain(wanted.select("_id").distinct()), "_id", "left_semi")
             .select("text"))
    sets = texts.mapInArrow(tidy(_sets(width)), "cls binary, hashes array<long>")
    sets = checkpoint(sets.join(small_or_plain(wanted.select("cls", "ref")), "cls")
                      .select("ref", "hashes").dropDuplicates(["ref"]), "hashes")
    tried = checkpoint(_drawn_pairs(lists, members, percent), "pairs")
    links = checkpoint(_verified(tried, sets, percent), "links")
    comps = checkpoint(components(links), "comps")
    left = _open_lists(lists, members, comps, percent)
    rest = checkpoint(_short_pairs(left, percent).join(tried, ["u", "v"], "left_anti"), "pairs")
    links = links.unionAll(checkpoint(_verified(rest, sets, percent), "links"))
    blocks = (_long_blocks(left).join(sets, "ref").repartition("g", "i", "j")
              .sortWithinPartitions("g", "i", "j"))
    links = links.unionAll(checkpoint(
        blocks.mapInArrow(_block_links(percent), "u long, v long").distinct(), "links"))
    comps = components(links).withColumnRenamed("node", "ref")
    return thin, wanted.select("ref", "cls").join(comps, "ref").select("cls", "component")


def said() -> Column:
    """Tells texts under one id apart."""
    return F.xxhash64(F.coalesce("text", F.lit("")))


def _decided(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """(doc_id, said, n, component_id, first) of every document: the smallest
    id of its component, and the (id, text hash) that comes first there, rows
    without an id last; both null without shingles."""
    t, comps = classes(docs, width, percent)
    comps = checkpoint(comps, "comps")
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "said")
    per = t.where("n > 0").groupBy("cls").agg(F.min("doc_id").alias("id"), F.min(place).alias("first"))
    per = per.join(comps, "cls", "left").select(
        "cls", F.coalesce(F.col("component").cast("string"), F.hex("cls")).alias("comp"), "id", "first")
    per = checkpoint(per, "classes")
    least = per.groupBy("comp").agg(F.min("id").alias("component_id"), F.min("first").alias("first"))
    ids = checkpoint(per.select("cls", "comp").join(least, "comp")
                     .select("cls", "component_id", "first"), "class-ids")
    rows = t.join(small_or_plain(ids), "cls", "left")
    some = F.col("n") > 0
    return rows.select("doc_id", "said", "n", F.when(some, F.col("component_id")).alias("component_id"),
                       F.when(some, F.col("first")).alias("first"))


def join_components(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id), one row per document."""
    return _decided(docs, width, percent).select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
        .alias("component_id"))


def one_of_each(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """``docs`` (doc_id, text and any others) with one row of each component:
    that of the smallest id (rows without an id come last), under one id that
    of the least text hash, and one of rows that agree in both. Texts without
    words are linked with nothing and all stay."""
    mark = scratch_mark()
    rows = checkpoint(_decided(docs, width, percent).where("n > 0").select(
        "doc_id", "said", F.when(F.col("doc_id").eqNullSafe(F.col("first.doc_id"))
                                 & (F.col("said") == F.col("first.said")), True)
        .otherwise(False).alias("stays")), "join")
    per = rows.groupBy("doc_id", "said").agg(F.max("stays").alias("stays"),
                                             F.count(F.lit(1)).alias("n"))
    until = scratch_mark()
    per = checkpoint(per.where("not stays or n > 1"), "dropped")
    drop_scratch(docs.sparkSession, mark, until)  # the result reads ``per`` alone

    def of(which):
        return small_or_plain(per.where(which).select(F.col("doc_id").alias("_d"),
                                                      F.col("said").alias("_s")))
    same = F.col("_id").eqNullSafe(F.col("_d")) & (F.col("_said") == F.col("_s"))
    named = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("_id"),
                        said().alias("_said"))
    kept = named.join(of("not stays"), same, "left_anti")
    if per.where("stays").isEmpty():
        return kept.select("row.*")
    twice = of("stays")
    once = kept.join(twice, same, "left_anti")
    return once.unionAll(kept.join(twice, same, "left_semi").dropDuplicates(["_id", "_said"])
                         ).select("row.*")
