"""The training-data queries: each applies its operator, with production
parameters, to its whole table."""

from __future__ import annotations

from pyspark.sql import functions as F

from polarity.llm import (chat, elias_fano, host_rules, kneser_ney, mixing, ngram_join, packing,
                          prefix_trie, quality_knn, suffix_dedup, syncmers, toxicity, vector_codes)
from polarity.llm.common import fold, table


def _scores(scored, limit, *more):
    return scored.select("doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), "score",
                         (F.col("score") >= limit).cast("int").alias("predicted"), *more)


def op1_toxicity(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.train(docs, labels)
    return _scores(toxicity.score(docs.select("doc_id", "text"), model).drop("text"), 0.5,
                   "n_windows")


def op2_syncmer_fingerprints(spark, sf_dir):
    return syncmers.compare_with_edits(table(spark, sf_dir, "documents"))


def op3_best_fit_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"))


def op4_ngram_jaccard(spark, sf_dir):
    return ngram_join.join_components(table(spark, sf_dir, "documents"), width=4, percent=85)


def op5_host_rules(spark, sf_dir):
    return host_rules.host_rules(table(spark, sf_dir, "documents"))


def op6_kneser_ney(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held = fold(F.col("doc_id"), 7) == 2
    model = kneser_ney.train(docs.where(~held).select("text"))
    return kneser_ney.score(docs, model).select(
        "doc_id", held.alias("held_out"), "n_tokens", "n_known",
        F.lit(model["tokens"]).cast("long").alias("train_tokens"), "base_score", "score")


def op7_source_mix(spark, sf_dir):
    return mixing.mix(table(spark, sf_dir, "documents"))


def op8_quality_neighbours(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = quality_knn.train(docs, labels)
    return _scores(quality_knn.score(docs.select("doc_id", "text"), model).drop("text"), 0.3)


def op9_suffix_dedup(spark, sf_dir):
    return suffix_dedup.digests(table(spark, sf_dir, "documents"))


def op10_chat_format(spark, sf_dir):
    return chat.digests(chat.with_probe(table(spark, sf_dir, "conversations")))


def op11_vector_codes(spark, sf_dir):
    return vector_codes.codes(table(spark, sf_dir, "embeddings"))


def op12_token_ids(spark, sf_dir):
    return elias_fano.read(elias_fano.write(table(spark, sf_dir, "documents")))


def op13_prefix_trie(spark, sf_dir):
    return prefix_trie.trie(table(spark, sf_dir, "conversations"))


QUERIES = {f.__name__: f for f in (
    op1_toxicity, op2_syncmer_fingerprints, op3_best_fit_packing, op4_ngram_jaccard, op5_host_rules,
    op6_kneser_ney, op7_source_mix, op8_quality_neighbours, op9_suffix_dedup, op10_chat_format,
    op11_vector_codes, op12_token_ids, op13_prefix_trie)}
