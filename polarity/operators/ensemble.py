"""Weighted vote over many prediction tables.

The id list and the weighted votes are unioned and grouped once: that one
shuffle on id does the semi-filter (only votes for listed ids count), the
zero-vote default and the per-class sums. Weights are DECIMAL so a tie is a
true tie, not an accident of float summation order.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from polarity.config import CLASSES
from polarity.operators.joins import broadcast_if_small

# ten digits before the point, eighteen after it: weights given with more
# decimals are refused, never rounded
WEIGHT_TYPE = "decimal(28,18)"
SUM_TYPE = "decimal(38,18)"


def member_weights(spark, pairs) -> DataFrame:
    """(member, weight DECIMAL(28,18)) from (name, score) pairs, exactly."""
    rows = [(str(m), str(w)) for m, w in pairs]
    for m, w in rows:
        if -Decimal(w).as_tuple().exponent > 18:
            raise ValueError(f"weight of {m!r} has more than 18 decimals: {w}")
    return (spark.createDataFrame(rows, "member string, weight string")
            .select("member", F.col("weight").cast(WEIGHT_TYPE).alias("weight")))


def weighted_vote(ids: DataFrame, votes: DataFrame, weights: DataFrame,
                  classes=CLASSES, key: str = "id", label: str = "sentiment",
                  strict: bool = False) -> DataFrame:
    """A1 + J6: (key, <class>... ) with the sum of member weights per class,
    one row per distinct listed id (0 where nobody voted).

    ``votes`` is (key, member, label); ``weights`` is (member, weight);
    members without a weight do not vote. ``strict`` raises, as the
    reference's dictionary lookup does, on a vote for an unlisted id or an
    unknown class.
    """
    w = broadcast_if_small(weights.select("member", F.col("weight").cast(WEIGHT_TYPE)))
    v = votes.select(key, "member", label).join(w, "member")
    if strict:
        bad = v.filter(~F.col(label).isin(*classes)).limit(1).collect()
        if bad:
            raise KeyError(f"unknown class {bad[0][label]!r}")
    zero = F.lit(0).cast(WEIGHT_TYPE)
    vote_rows = v.select(F.col(key), F.lit(False).alias("_listed"),
                         *[F.when(F.col(label) == c, F.col("weight")).otherwise(zero).alias(c)
                           for c in classes])
    id_rows = ids.select(F.col(key), F.lit(True).alias("_listed"),
                         *[zero.alias(c) for c in classes])
    grouped = (id_rows.unionByName(vote_rows).groupBy(key)
               .agg(F.max("_listed").alias("_listed"),
                    *[F.sum(c).cast(SUM_TYPE).alias(c) for c in classes]))
    if strict:
        bad = grouped.filter(~F.col("_listed")).limit(1).collect()
        if bad:
            raise KeyError(f"vote for unlisted id {bad[0][key]!r}")
    return grouped.filter(F.col("_listed")).drop("_listed")


def pick_class(sums: DataFrame, classes=CLASSES, key: str = "id",
               out: str = "sentiment") -> DataFrame:
    """A2: the class with the largest sum; ties and no votes go to the first
    listed class."""
    best = F.greatest(*[F.col(c) for c in classes])
    choice = F.coalesce(*[F.when(F.col(c) == best, F.lit(c)) for c in classes])
    return sums.select(key, choice.alias(out))


def ensemble(ids: DataFrame, votes: DataFrame, weights: DataFrame, classes=CLASSES,
             key: str = "id", label: str = "sentiment", strict: bool = False) -> DataFrame:
    """A1 + A2: (key, sentiment) for every distinct listed id."""
    return pick_class(weighted_vote(ids, votes, weights, classes, key, label, strict),
                      classes, key, label)
