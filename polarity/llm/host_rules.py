"""Host-level quality rules (DataFrame functions only).

Each document is tested by the base rules and by softer rules; failures are
counted per host, host failure rates are shrunk toward the corpus by a beta
prior fitted to the hosts themselves, and the verdict of a host whose shrunken
rate passes the limit holds for its documents.

Contract: a null text has no words (and fails the base rules); null hosts are
one host; repeated rows count as often as they occur; no rows give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from polarity.llm.common import SPLIT, WS, checkpoint, let, small_or_plain, words

WINDOW = 5
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 10
MAX_REPEAT_PCT = 20
#: softer rules, counted for hosts only
MAX_SYMBOLS_PER_WORD = 0.5
MAX_DUP_LINES = 3
#: a host is rejected above this shrunken share of failing documents
MAX_HOST_RATE = 0.6
PRIOR_RANGE = (1.0, 1000.0)


def repeat_words(ws: Column, width: int = WINDOW) -> Column:
    """Words inside ``width``-word windows that occur twice or more in the
    text. Only texts with a repeated window (distinct hashes fewer than
    windows) take the sorting path; there, equal neighbours of the sorted
    (hash, place) pairs give the places, and overlaps count once."""
    def covered(h: Column) -> Column:
        pairs = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

        def places(s: Column) -> Column:
            same = lambda e, i: (
                ((i > 0) & (F.get(s, i - 1)["h"] == e["h"]))
                | F.coalesce(F.get(s, i + 1)["h"] == e["h"], F.lit(False)))
            return F.array_sort(F.transform(F.filter(s, same), lambda e: e["i"]))
        run = F.aggregate(
            let(pairs, places),
            F.struct(F.lit(0).alias("n"), F.lit(-width).alias("last")),
            lambda a, x: F.struct((a["n"] + F.least(F.lit(width), x - a["last"])).alias("n"),
                                  x.alias("last")))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(run["n"])

    hashes = F.transform(F.sequence(F.lit(0), F.size(ws) - width),
                         lambda i: F.xxhash64(*[F.get(ws, i + j) for j in range(width)]))
    return F.when(F.size(ws) < width, F.lit(0)).otherwise(let(hashes, covered)).cast("long")


def measures(text: Column) -> list[Column]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    t = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(t, "\n"), lambda x: F.length(F.btrim(x, F.lit(WS))) > 0)
    dup = let(lines, lambda ls: F.size(ls) - F.size(F.array_distinct(ls)))
    per_words = let(words(t), lambda ws: F.struct(
        F.size(ws).cast("long").alias("n"), repeat_words(ws).alias("r")))
    return [per_words.alias("_w"),
            F.length(F.regexp_replace(t, SPLIT, "")).cast("long").alias("word_chars"),
            (F.octet_length(t) - F.octet_length(F.translate(t, SYMBOLS, "")))
            .cast("long").alias("n_symbols"),
            dup.cast("long").alias("n_dup_lines")]


def host_rules(docs: DataFrame, id_col="doc_id", text_col="text", host_col="source",
               max_host_rate: float = MAX_HOST_RATE) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, kept; then rules_failed (any rule) and host_rate (shrunken)."""
    m = (docs.select(F.col(id_col).alias("doc_id"), F.col(host_col).alias("_host"),
                     *measures(F.col(text_col)))
         .select("doc_id", F.coalesce(F.concat(F.lit("h"), F.col("_host").cast("string")),
                                      F.lit("n")).alias("_host"),
                 F.col("_w.n").alias("n_words"), "word_chars", "n_symbols", "n_dup_lines",
                 F.col("_w.r").alias("n_repeat_words")))
    base = ((F.col("n_words") < MIN_WORDS)
            | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PCT))
    soft = ((F.col("n_symbols") > F.col("n_words") * MAX_SYMBOLS_PER_WORD)
            | (F.col("n_dup_lines") > MAX_DUP_LINES))
    m = m.withColumn("base_failed", base).withColumn("rules_failed", base | soft)
    m = checkpoint(m, "host-measures")  # small rows; texts are read once

    hosts = m.groupBy("_host").agg(F.count(F.lit(1)).alias("n"),
                                   F.sum(F.col("rules_failed").cast("long")).alias("f"))
    hosts = checkpoint(hosts, "hosts")
    rate = F.col("f") / F.col("n")
    prior = hosts.agg(F.sum("n").alias("tn"), F.sum("f").alias("tf"),
                      F.sum(F.col("n") * rate * rate).alias("q"))
    mean = F.col("tf") / F.col("tn")
    spread = F.greatest(F.col("q") / F.col("tn") - mean * mean, F.lit(0.0))
    strength = F.when(spread > 1e-12, F.least(F.greatest(
        mean * (1 - mean) / spread - 1, F.lit(PRIOR_RANGE[0])), F.lit(PRIOR_RANGE[1]))).otherwise(
        PRIOR_RANGE[1])
    prior = prior.select(mean.alias("_m"), strength.alias("_s"))  # one row
    shrunk = (F.col("f") + F.col("_m") * F.col("_s")) / (F.col("n") + F.col("_s"))
    verdicts = (hosts.join(F.broadcast(prior)).select(
        "_host", F.round(shrunk, 6).alias("host_rate")))
    return (m.join(small_or_plain(checkpoint(verdicts, "verdicts")), "_host")
            .select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                    "n_repeat_words", "base_failed",
                    (~F.col("base_failed") & (F.col("host_rate") <= max_host_rate)).alias("kept"),
                    "rules_failed", "host_rate"))
