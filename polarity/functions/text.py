"""Text and id-sequence column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from polarity.config import BOS_ID, EOS_ID, NEGATIVE, POSITIVE

# Markup is any "<...>" run without a ">" inside; each run
# becomes one blank.
TAG_PATTERN = "<[^>]+>"

# Tokenizer patterns. Only constructs shared by Java regex and RE2 are used
# (no lookaround, no \s, which differ), so SQL engines can run the same rule.
# Contractions split off the word ("don't" -> "do n't", "it's" -> "it 's").
CONTRACTION_PATTERN = "([^' ])('ll|'re|'ve|n't|'s|'m|'d)"
# A token is a run of letters, digits and apostrophes, or any other character
# that is not a blank.
TOKEN_PATTERN = "[\\p{L}\\p{N}']+|[^\\p{L}\\p{N} \\t\\r\\n\\f']"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def strip_tags(col) -> Column:
    """Replace each markup tag by one blank; null stays null."""
    return F.regexp_replace(_c(col), TAG_PATTERN, " ")


def encode_label(col, positive: str = POSITIVE) -> Column:
    """P2: 'positive' -> 1, anything else (other strings, case variants,
    null) -> 0."""
    return F.when(_c(col) == F.lit(positive), F.lit(1)).otherwise(F.lit(0))


def decode_label(col) -> Column:
    """1 -> 'positive', anything else -> 'negative'."""
    return F.when(_c(col) == F.lit(1), F.lit(POSITIVE)).otherwise(F.lit(NEGATIVE))


def tokenize(col) -> Column:
    """P5: lowercase, split contractions and punctuation, split on blanks.

    Null text gives an empty array; the array never holds empty strings. One
    search takes the tokens out of the text; contractions are looked for only
    where there is an apostrophe.
    """
    s = F.lower(_c(col))
    s = F.when(s.contains("'"), F.regexp_replace(s, CONTRACTION_PATTERN, "$1 $2")).otherwise(s)
    return F.coalesce(F.regexp_extract_all(s, F.lit(TOKEN_PATTERN), F.lit(0)),
                      F.array().cast("array<string>"))


def pad_truncate(arr, n: int, fill, dtype: str = "int") -> Column:
    """Keep the first ``n`` elements, pad at the end with ``fill``."""
    a = F.coalesce(_c(arr), F.array().cast(f"array<{dtype}>"))
    pad = F.array_repeat(F.lit(fill).cast(dtype),
                         F.greatest(F.lit(n) - F.size(a), F.lit(0)))
    return F.concat(F.slice(a, 1, n), pad)


def attention_mask(ids) -> Column:
    """1 where the id is > 0, else 0."""
    return F.transform(_c(ids), lambda x: (x > F.lit(0)).cast("int"))


def encode_with_specials(ids, max_len: int, bos: int = BOS_ID,
                         eos: int = EOS_ID) -> Column:
    """Begin id + ids cut to ``max_len - 2`` + end id (total <= max_len)."""
    body = F.slice(F.coalesce(_c(ids), F.array().cast("array<int>")), 1, max_len - 2)
    return F.concat(F.array(F.lit(bos).cast("int")), body,
                    F.array(F.lit(eos).cast("int")))


def detokenize(arr) -> Column:
    """P10: join words with single blanks."""
    return F.array_join(_c(arr), " ")
