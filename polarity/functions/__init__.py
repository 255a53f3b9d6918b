"""Column functions. Every function takes Columns (or column names) and
returns a Column built from Spark built-ins, so it stays inside whole-stage
codegen and works unchanged on streaming DataFrames."""

from polarity.functions.arrays import (argmax, cosine, dot, k_max, l2_norm,
                                       log_sum_exp, softplus)
from polarity.functions.hashing import order_key
from polarity.functions.text import (attention_mask, decode_label, detokenize,
                                     encode_label, encode_with_specials,
                                     pad_truncate, strip_tags, tokenize)

__all__ = [
    "argmax", "cosine", "dot", "k_max", "l2_norm", "log_sum_exp", "softplus",
    "order_key", "attention_mask", "decode_label", "detokenize", "encode_label",
    "encode_with_specials", "pad_truncate", "strip_tags", "tokenize",
]
