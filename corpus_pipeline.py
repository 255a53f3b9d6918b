"""The corpus pipeline over ``documents``.

Stages, each working on all that the one before kept: toxicity (rejected
documents go), n-gram Jaccard join (one document of each group stays),
suffix-array dedup (repeated byte runs are cut out of the texts), mixing
sources to target weights (documents as often as the mix takes them) and
best-fit packing (pieces of sequences). Every stage's result is written as
Parquet to the shared checkpoint folder and read again; all but the last have
the columns of ``documents``. Empty input gives empty results at every stage.
"""

from __future__ import annotations

from polarity.llm import mixing, ngram_join, packing, suffix_dedup, toxicity
from polarity.session import checkpoint

REJECT = 0.5
#: bytes of a repeat that is cut: below the shortest passage of over 50 words
REPEATED_BYTES = 240
#: bytes of the strings that bring such repeats together: long enough not to
#: occur twice by chance
ANCHOR_BYTES = 64


def reject_toxic(spark, docs, sf_dir):
    """Documents that score below REJECT."""
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = toxicity.score(docs, model, score_col="_toxic", windows_col="_windows")
    return scored.where(scored["_toxic"] < REJECT).select(*docs.columns)


def drop_near_duplicates(spark, docs, sf_dir):
    """One document, that of the smallest id, of each group of near copies:
    80 % of the 5-word shingles."""
    return ngram_join.one_of_each(docs, width=5, percent=80)


def cut_repeats(spark, docs, sf_dir):
    """Texts without the bytes of REPEATED_BYTES-byte strings that repeat."""
    return suffix_dedup.without_repeats(docs, depth=REPEATED_BYTES, k=ANCHOR_BYTES)


def mix_sources(spark, docs, sf_dir):
    """Documents as often as the mix takes them."""
    return mixing.mixed_documents(docs)


def pack_sequences(spark, docs, sf_dir):
    """Pieces of packed sequences."""
    return packing.pack(docs)


STAGES = [("toxicity", reject_toxic), ("ngram_jaccard_join", drop_near_duplicates),
          ("suffix_array_dedup", cut_repeats), ("source_mix", mix_sources),
          ("best_fit_packing", pack_sequences)]

#: the first and third stage are not SQL; tests compare with brute force
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages over ``documents``; rows of the last."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = checkpoint(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
