"""Defaults and fixed values.

The numbers below are the reference's own settings; they decide sizes of
splits, sequence lengths and batch shapes, so they are kept as they are.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Defaults:
    # supervised path
    seed: int = 230
    valid_frac: float = 0.1
    max_len: int = 512
    report_every: int = 50
    # semi-supervised path
    split_seed: int = 7
    test_frac: float = 0.3
    label_frac: float = 0.2
    sentence_len: int = 500
    batch_size: int = 64
    unlabel_weight: float = 1.0
    # feature operators
    k_max: int = 8
    ngram_widths: tuple = (3, 4, 5, 6, 7)


DEFAULTS = Defaults()

# Special ids of the length-capped encoding (pad must be 0 so
# that the attention mask "id > 0" means "not padding").
PAD_ID = 0
BOS_ID = 1
EOS_ID = 2
UNK_ID = 3
FIRST_WORD_ID = 4

# The reference's two classes, in its order (a tie or no vote
# goes to the first one).
POSITIVE = "positive"
NEGATIVE = "negative"
CLASSES = (POSITIVE, NEGATIVE)

# The eight active ensemble members (folder names) and their
# scores, in the reference's order.
MEMBER_WEIGHTS = (
    ("submission-20201226-115507-RoBERTa-large-Cumulbatch-Alldata-Warmup-Batchlarger-MoreEpoch", "96.13"),
    ("submission-20201226-182046-RoBERTa-large-Cumulbatch-Alldata-Warmup-Batchlarger-MoreEpoch", "96.08"),
    ("submission-20201227-235217-RoBERTa-large-Cumulbatch-Alldata-Warmup-Batchlarger-MoreEpoch", "96.01"),
    ("submission-20201228-134621-RoBERTa-large-Cumulbatch-Alldata-Warmup-Batchlarger-MoreEpoch", "96.15"),
    ("submission-20201228-182820-RoBERTa-large-Cumulbatch-Alldata-Warmup-Batchlarger-MoreEpoch", "96.02"),
    ("submission-20201228-200251-RoBERTa-large-Cumulbatch-Alldata-Warmup-Batchlarger-MoreEpoch", "96.20"),
    ("submission-20201228-220723-RoBERTa-large-Cumulbatch-Alldata-Warmup-Batchlarger-MoreEpoch", "96.09"),
    ("submission-20201229-020822-RoBERTa-large-Cumulbatch-Alldata-Warmup-Batchlarger-MoreEpoch", "96.09"),
)
