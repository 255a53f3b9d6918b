"""Vocabulary and token lookups.

Token lookups keep the per-document order: a broadcast join leaves the exploded
tokens as they lie, so that Arrow batches turn them back into arrays without an
exchange or a sort. The vocabulary side is broadcast only when its size is proven
(a capped vocabulary, or a counted one); of a larger one only the frequent words
are, and the tokens these leave go through a shuffle join in which every word of
more tokens than a task's share is copied by its count and its tokens are dealt
over the copies. Arrays are cut to the encoding
length *before* they are exploded, so a 20,000-word review costs 500 rows, not 20,000.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from polarity.config import BOS_ID, EOS_ID, PAD_ID, UNK_ID
from polarity.functions.text import (attention_mask, encode_with_specials, pad_truncate,
                                     strip_tags, tokenize)
from polarity.operators.joins import (DEFAULT_BROADCAST_ROWS, dealt_lookup, frequent_keys,
                                      one_row_each, task_share)
from polarity.operators.ordering import ordered_rank
from polarity.session import checkpoint

# A capped vocabulary is taken with a take-ordered top-k only while the rows
# its single merge task receives (cap x partitions of the count table) stay
# within this bound; beyond it the distributed rank is used.
TOPK_MERGE_ROWS = 20_000_000
# Tokens that one task of a dealt lookup may hold, at least.
ROWS_PER_TASK = 100_000
# Of a table beyond the broadcast bound, about as many of the most frequent
# words, or bytes of vectors, are broadcast all the same.
HOT_WORDS = 200_000
HOT_BYTES = 16 << 20
# Positions whose rows are put in the order of their ids together, before they
# meet their vectors (a task holds about 50 bytes for each).
SORTED_POSITIONS = 2_000_000
# Tokens whose n-grams a task makes at a time (about 100 bytes for each and width).
GRAM_TOKENS = 200_000


def build_vocabulary(tokens_df: DataFrame, tokens_col: str = "tokens",
                     min_count: int = 1, max_size: int | None = None,
                     first_id: int = 0) -> DataFrame:
    """V1: (id, word, n) - every word, by descending count then word,
    numbered from ``first_id``. Only a caller that asks for it gets less:
    words seen at least ``min_count`` times, at most ``max_size`` of them.

    The word count is a partial + final hash aggregate, so a word holding a
    third of all tokens is combined map-side. With a cap the top-k is a
    bounded take-ordered; without one the numbering uses a range-partitioned
    rank instead of a single-partition window.
    """
    # explode_outer + null filter: a plain explode makes the optimizer infer
    # size(tokens) > 0 and evaluate the tokenizer a second time below it
    counts = (tokens_df.select(F.explode_outer(tokens_col).alias("word"))
              .filter(F.col("word").isNotNull())
              .groupBy("word").agg(F.count(F.lit(1)).alias("n"))
              .filter(F.col("n") >= F.lit(min_count)))
    order = [F.col("n").desc(), F.col("word").asc()]
    parts = int(tokens_df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if max_size is not None and max_size * parts <= TOPK_MERGE_ROWS:
        top = counts.orderBy(*order).limit(max_size)
        w = Window.orderBy(*order)  # at most max_size rows
        vocab = top.select((F.row_number().over(w) - 1 + first_id).cast("int").alias("id"),
                           "word", F.col("n").cast("long").alias("n"))
        # a fitted artifact: materialized once, reused by every lookup
        return checkpoint(vocab)
    # uncapped, or a cap too large for one task's take-ordered merge:
    # exact distributed rank on (count desc, word)
    ranked = ordered_rank(counts.select("word", "n", (-F.col("n")).alias("_neg_n")),
                          ["_neg_n", "word"], rank_col="_rank")
    if max_size is not None:
        ranked = ranked.filter(F.col("_rank") < max_size)
    return ranked.select((F.col("_rank") + first_id).cast("int").alias("id"), "word",
                         F.col("n").cast("long").alias("n"))


def _dealt(left: DataFrame, on: str, table: DataFrame, counts: DataFrame, spread) -> DataFrame:
    total = counts.agg(F.sum("n")).first()[0] or 0
    return dealt_lookup(left, on, table, counts, spread,
                        task_share(left.sparkSession, total, ROWS_PER_TASK))


def _token_rows(carry: int):
    """mapInArrow: rows (key, *carry, pos, id, word) of exploded documents, in the
    order of the explode (a broadcast join keeps it), back to one row a document:
    (key, *carry, ids, rest) with rest the (pos, word) of rows that have a word.
    A document begins where pos is null (it is empty) or 0."""
    def whole(tables):
        t = pa.concat_tables(tables).combine_chunks()
        pos = t.column(carry + 1).combine_chunks()
        empty = pos.is_null().to_numpy(zero_copy_only=False)
        at = pos.fill_null(0).to_numpy()
        starts = np.flatnonzero(at == 0)
        later = np.flatnonzero(at != 0)
        if len(starts) == 0 or starts[0] != 0 or (at[later] != at[later - 1] + 1).any():
            raise ValueError("rows of a document are not in order")
        heads, kept = t.take(pa.array(starts)), pa.array(np.flatnonzero(~empty))
        here = np.concatenate([[0], np.cumsum(~empty)])  # rows with a token before each row
        ends = np.append(starts, len(at))
        ids = t.column(carry + 2).combine_chunks().take(kept)
        words = t.column(carry + 3).combine_chunks()
        asked = words.is_valid().to_numpy(zero_copy_only=False)
        there = np.concatenate([[0], np.cumsum(asked)])
        some = pa.array(np.flatnonzero(asked))
        rest = pa.StructArray.from_arrays([pos.take(some), words.take(some)], ["pos", "word"])
        columns = [heads.column(i).combine_chunks() for i in range(carry + 1)]
        columns += [pa.ListArray.from_arrays(pa.array(here[ends].astype(np.int32)), ids),
                    pa.ListArray.from_arrays(pa.array(there[ends].astype(np.int32)), rest)]
        return pa.RecordBatch.from_arrays(columns, [*t.column_names[:carry + 1], "_ids", "_rest"])

    def run(batches):
        held = []  # rows of the document that is still open
        for b in batches:
            t = pa.Table.from_batches([b])
            starts = np.flatnonzero(t.column(carry + 1).combine_chunks().fill_null(0).to_numpy() == 0)
            if len(starts):
                if held or starts[-1]:
                    yield whole([*held, t.slice(0, int(starts[-1]))])
                held = []
                t = t.slice(int(starts[-1]))
            if t.num_rows:
                held.append(t)
        if held:
            yield whole(held)
    return run


def _filled(at: int):
    """mapInArrow: column ``at``, ids, with the (pos, id) of the next column put
    in their places, in the order of the rows."""
    def run(batches):
        for b in batches:
            lists, found = b.column(at), b.column(at + 1)
            sizes = lists.value_lengths().to_numpy().astype(np.int64)
            flat = lists.flatten().to_numpy(zero_copy_only=False).copy()
            put = found.flatten()
            if len(put):
                each = found.value_lengths().fill_null(0).to_numpy()
                first = np.repeat(np.cumsum(sizes) - sizes, each)
                flat[first + put.field(0).to_numpy()] = put.field(1).to_numpy()
            ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:at], pa.ListArray.from_arrays(pa.array(ends), pa.array(flat, pa.int32()))],
                b.schema.names[:at + 1])
    return run


def lookup_ids(df: DataFrame, vocab: DataFrame, key: str = "id", tokens_col: str = "tokens",
               n: int | None = 500, unk: int = -1, pad: int | None = -1,
               out_col: str = "ids", vocab_rows: int | None = None,
               max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
               carry: tuple = ()) -> DataFrame:
    """Word -> id through ``vocab`` (word, id); a miss is ``unk``; order
    kept; cut to ``n`` first and padded with ``pad`` (no padding if None).

    Tokens meet the broadcast vocabulary where they lie, and their rows become
    one array a document again without an exchange. Of a vocabulary beyond the
    bound only the frequent words are broadcast: the tokens they leave go through
    a shuffle join, and come back to their document's array by its key.

    Returns (key, *carry, out_col) for every input row, including empty ones;
    ``carry`` names columns that go along. ``key`` must be unique: two rows
    with one key fail the job (they would be mixed), they are never merged.
    """
    one_row_each(df, key)
    toks = F.col(tokens_col) if n is None else F.slice(F.col(tokens_col), 1, n)
    exploded = df.select(key, *carry, F.posexplode_outer(toks).alias("pos", "word"))
    v = vocab.select("word", F.col("id").cast("int").alias("_vid"))
    n_vocab = vocab_rows if vocab_rows is not None else vocab.count()
    head, tail = v, None
    if n_vocab > max_broadcast_rows:
        counts = (vocab.select("word", "n") if "n" in vocab.columns else
                  checkpoint(exploded.where("word is not null").groupBy("word")
                             .agg(F.count(F.lit(1)).alias("n")), "word-counts"))
        frequent = frequent_keys(counts, "word", HOT_WORDS)
        head = v.join(F.broadcast(frequent), "word", "left_semi")
        tail = checkpoint(v.join(F.broadcast(frequent), "word", "left_anti"), "rare-words")
    left = F.lit(None).cast("string") if tail is None else F.when(F.col("_vid").isNull(), F.col("word"))
    ids = F.coalesce(F.col("_vid"), F.lit(unk)).cast("int")
    rows = exploded.join(F.broadcast(head), "word", "left").select(
        key, *carry, F.col("pos").cast("int").alias("_pos"), ids.alias("_id"), left.alias("_word"))
    along = StructType([rows.schema[c] for c in (key, *carry)])
    array = ArrayType(IntegerType())
    rest = ArrayType(StructType([StructField("pos", IntegerType()), StructField("word", StringType())]))
    # written once: readers that sample or count (a sort, an embedding) do not
    # tokenize again
    docs = checkpoint(rows.mapInArrow(_token_rows(len(carry)), StructType(
        [*along.fields, StructField("_ids", array), StructField("_rest", rest)])), "ids")
    if tail is not None:
        asked = docs.select(key, F.inline("_rest"))
        counts = checkpoint(asked.groupBy("word").agg(F.count(F.lit(1)).alias("n")), "word-counts")
        found = _dealt(asked, "word", tail, counts, F.xxhash64(F.col(key), F.col("pos")))
        found = (found.where("_vid is not null").groupBy(F.col(key).alias("_key"))
                 .agg(F.collect_list(F.struct("pos", "_vid")).alias("_found")))
        docs = (docs.join(found, F.col(key).eqNullSafe(F.col("_key")), "left")
                .select(key, *carry, "_ids", "_found")
                .mapInArrow(_filled(len(carry) + 1), StructType([*along.fields, StructField("_ids", array)])))
    ids = F.col("_ids")
    if pad is not None and n is not None:
        ids = pad_truncate(ids, n, pad)
    return docs.select(key, *carry, ids.alias(out_col))


def _by_id(most: int):
    """mapInArrow: (key, ids) to rows (key, pos, id), of about ``most`` positions at
    a time in the order of their ids; null and empty arrays give no rows."""
    def run(batches):
        for b in batches:
            sizes = pc.fill_null(pc.list_value_length(b.column(1)), 0).to_numpy().astype(np.int64)
            ends = np.cumsum(sizes)
            cuts = np.searchsorted(ends, np.arange(most, int(sizes.sum()), most)) + 1
            for lo, hi in zip([0, *cuts], [*cuts, len(sizes)]):
                n = sizes[lo:hi]
                if hi <= lo or not n.sum():
                    continue
                ids = b.column(1).slice(lo, hi - lo).flatten()
                order = np.argsort(pc.fill_null(ids, -1).to_numpy(zero_copy_only=False), kind="stable")
                row = np.repeat(np.arange(lo, hi, dtype=np.int32), n)
                pos = (np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)).astype(np.int32)
                for k in range(0, len(order), ROWS_PER_TASK):
                    some = order[k:k + ROWS_PER_TASK]
                    yield pa.RecordBatch.from_arrays(
                        [b.column(0).take(pa.array(row[some])), pa.array(pos[some]),
                         ids.take(pa.array(some))], [b.schema.names[0], "pos", "_tid"])
    return run


def embed(ids_df: DataFrame, vectors: DataFrame, key: str = "id", ids_col: str = "ids",
          dim: int | None = None, vector_rows: int | None = None,
          max_broadcast_bytes: int = 128 << 20) -> DataFrame:
    """Long form (key, pos, vector); an id with no vector (-1: pad or
    unknown) gets a zero vector of ``dim`` floats.

    ``vectors`` is (id, vector). Broadcast when rows x dim x 4 bytes is
    within ``max_broadcast_bytes``; otherwise the vectors of the frequent ids
    are broadcast, ids below 0 are joined with nothing, and the positions these
    leave go through a shuffle join in which an id of many positions is copied
    by its count and its positions are dealt over the copies.

    Rows of one id come together (by SORTED_POSITIONS positions of whole
    documents), so that a written vector takes its full size once, not once a row.
    """
    if dim is None:
        dim = vectors.select(F.size("vector")).first()[0]
    v = vectors.select(F.col("id").cast("int").alias("_jid"),
                       F.col("vector").cast("array<float>").alias("_vec"))
    n_vec = vector_rows if vector_rows is not None else v.count()

    def together(df, ids):
        at = df.select(key, ids).schema
        return df.select(key, ids).mapInArrow(_by_id(SORTED_POSITIONS), StructType(
            [at[0], StructField("pos", IntegerType()), StructField("_tid", at[1].dataType.elementType)]))
    if n_vec * dim * 4 <= max_broadcast_bytes:
        joined = together(ids_df, ids_col).join(F.broadcast(v), F.col("_tid") == F.col("_jid"), "left")
    else:
        # the ids are read more than once
        kept = checkpoint(ids_df.select(key, F.col(ids_col).alias("_ids")), "embed-ids")
        exploded = kept.select(key, F.posexplode_outer("_ids").alias("pos", "_tid")).filter(
            F.col("pos").isNotNull())
        v = v.withColumnRenamed("_jid", "_tid")
        asked = F.col("_tid") >= 0
        counts = checkpoint(exploded.where(asked).groupBy("_tid")
                            .agg(F.count(F.lit(1)).alias("n")), "id-counts")
        frequent = F.broadcast(frequent_keys(counts, "_tid", HOT_BYTES // max(1, 4 * dim)))
        head = v.join(frequent, "_tid", "left_semi").withColumn("_hot", F.lit(True))
        # a vector may be null: its id is known all the same
        known = together(kept, "_ids").join(F.broadcast(head), "_tid", "left").where(
            F.col("_hot").isNotNull() | ~F.coalesce(asked, F.lit(False))).drop("_hot")
        rest = exploded.where(asked).join(F.broadcast(head.select("_tid")), "_tid", "left_anti")
        joined = known.unionByName(_dealt(
            rest, "_tid", v.join(frequent, "_tid", "left_anti"), counts.join(
                F.broadcast(head.select("_tid")), "_tid", "left_anti"),
            F.xxhash64(F.col(key), F.col("pos"))))
    zero = F.array_repeat(F.lit(0.0).cast("float"), dim)
    return joined.select(key, F.col("pos").cast("int").alias("pos"),
                         F.coalesce(F.col("_vec"), zero).alias("vector"))


def encode_reviews(df: DataFrame, vocab: DataFrame, key: str = "id", text_col: str = "review",
                   max_len: int = 512, strip: bool = True,
                   vocab_rows: int | None = None, carry: tuple = ()) -> DataFrame:
    """P8 over a corpus: (key, *carry, input_ids) with begin/end ids, unknown
    = 3, padded with 0 to ``max_len``. ``vocab`` ids must start at 4."""
    text = strip_tags(text_col) if strip else F.col(text_col)
    toks = df.select(key, *carry, tokenize(text).alias("tokens"))
    ids = lookup_ids(toks, vocab, key, n=max_len - 2, unk=UNK_ID, pad=None,
                     out_col="_ids", vocab_rows=vocab_rows, carry=carry)
    enc = encode_with_specials(F.col("_ids"), max_len, BOS_ID, EOS_ID)
    return ids.select(key, *carry, pad_truncate(enc, max_len, PAD_ID).alias("input_ids"))


def build_examples(df: DataFrame, vocab: DataFrame, key: str = "id", text_col: str = "review",
                   label_col: str | None = "label", max_len: int = 512,
                   strip: bool = True, vocab_rows: int | None = None) -> DataFrame:
    """(key, input_ids, attention_mask, label) - label null when the row
    is unlabelled (the key then identifies it, as the original id did)."""
    label = (F.col(label_col) if label_col else F.lit(None)).cast("int").alias("label")
    enc = encode_reviews(df.select(key, text_col, label), vocab, key, text_col, max_len, strip,
                         vocab_rows, carry=("label",))
    return enc.select(key, "input_ids", attention_mask("input_ids").alias("attention_mask"),
                      "label")


def ngram_features(tokens_df: DataFrame, key: str = "id", tokens_col: str = "tokens",
                   widths=(3, 4, 5, 6, 7)) -> DataFrame:
    """Long (key, width, gram, n) - count of each word n-gram per row,
    over the whole token array.

    A row's grams are counted where the row lies, in Arrow batches. Nothing is
    exchanged, so a wide scan is used as it is; rows that share a key are counted
    apart. A row's grams come by their first place, the widest first: neighbours
    share most of their words, so a written gram takes a few bytes.
    """
    rows = tokens_df.select(key, tokens_col)
    return rows.mapInArrow(_grams(sorted(set(widths))), StructType(
        [rows.schema[0], StructField("width", IntegerType()), StructField("gram", StringType()),
         StructField("n", LongType())]))


def _grams(widths: list[int]):
    """mapInArrow: (key, tokens) to (key, width, gram, n), of about GRAM_TOKENS tokens at a time."""
    def run(batches):
        for b in batches:
            sizes = pc.fill_null(pc.list_value_length(b.column(1)), 0).to_numpy().astype(np.int64)
            cuts = np.searchsorted(np.cumsum(sizes), np.arange(GRAM_TOKENS, int(sizes.sum()), GRAM_TOKENS)) + 1
            for lo, hi in zip([0, *cuts], [*cuts, len(sizes)]):
                if hi <= lo or not sizes[lo:hi].any():
                    continue
                row = np.repeat(np.arange(lo, hi), sizes[lo:hi])
                at, width, gram, n = _gram_rows(b.column(1).slice(lo, hi - lo).flatten(), row, widths)
                for k in range(0, len(at), ROWS_PER_TASK):
                    to = slice(k, k + ROWS_PER_TASK)
                    yield pa.RecordBatch.from_arrays(
                        [b.column(0).take(pa.array(row[at[to]])), pa.array(width[to]),
                         gram.take(pa.array(at[to] + len(row) * np.searchsorted(widths, width[to]))),
                         pa.array(n[to])], [b.schema.names[0], "width", "gram", "n"])
    return run


def _gram_rows(tokens: pa.Array, row: np.ndarray, widths: list[int]):
    """Of tokens and their rows: (place, width, n) of each row's distinct grams, and the
    grams of every width at every place (of no use where a row ends before)."""
    size = len(tokens)
    first = np.zeros((size, len(widths)), bool)  # the gram is there, and not earlier in its row
    n = np.ones((size, len(widths)), np.int64)
    grams, again = [], None
    # then equal grams of a width begin with equal grams of a lesser one
    plain = not tokens.null_count and not pc.any(pc.match_substring(tokens, " ")).as_py()
    for j, w in enumerate(widths):
        last = max(0, size - w + 1)
        gram = pc.binary_join_element_wise(*[tokens.slice(k, last) for k in range(w)], " ",
                                           null_handling="skip")
        grams += [gram, pa.nulls(size - last, gram.type)]
        there = np.flatnonzero(row[:last] == row[w - 1:w - 1 + last])
        first[there, j] = True
        if plain and again is not None:
            there = there[again[there]]
        code = gram.take(pa.array(there)).dictionary_encode().indices.to_numpy()
        each = row[there] * (size + 1) + code
        order = np.argsort(each, kind="stable")
        starts = np.flatnonzero(np.diff(each[order], prepend=-1))
        counts = np.diff(starts, append=len(order))
        many = np.repeat(counts > 1, counts)
        again = np.zeros(size, bool)
        again[there[order[many]]] = True
        first[again, j] = False
        heads = there[order[starts[counts > 1]]]
        first[heads, j], n[heads, j] = True, counts[counts > 1]
    at, j = np.divmod(np.flatnonzero(first[:, ::-1]), len(widths))
    j = len(widths) - 1 - j
    return at, np.asarray(widths, np.int32)[j], pa.concat_arrays(grams), n[at, j]


def vocabulary_vectors(vocab: DataFrame, vectors: DataFrame, vec_id: str = "vec_id",
                       vec_col: str = "embedding") -> DataFrame:
    """S2 in table form: (id, word, vector) for vocabulary words that have a
    vector (vector table keyed by the word id)."""
    v = vectors.select(F.col(vec_id).cast("int").alias("id"),
                       F.col(vec_col).cast("array<float>").alias("vector"))
    return vocab.select("id", "word").join(v, "id")
