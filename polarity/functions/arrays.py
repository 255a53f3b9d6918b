"""Math on array columns (M1-M5, K1), all as higher-order built-ins."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: floor of the cosine denominator.
COSINE_EPS = 1e-8


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def as_double(arr) -> Column:
    return _c(arr).cast("array<double>")


def dot(a, b) -> Column:
    """Dot product of two equal-length numeric arrays, in double."""
    prods = F.zip_with(as_double(a), as_double(b), lambda x, y: x * y)
    return F.aggregate(prods, F.lit(0.0).cast("double"), lambda s, x: s + x)


def l2_norm(a) -> Column:
    sq = F.transform(as_double(a), lambda x: x * x)
    return F.sqrt(F.aggregate(sq, F.lit(0.0).cast("double"), lambda s, x: s + x))


def cosine(a, b) -> Column:
    """M3: a.b / max(|a||b|, 1e-8); a zero vector gives 0."""
    return dot(a, b) / F.greatest(l2_norm(a) * l2_norm(b), F.lit(COSINE_EPS))


def log_sum_exp(arr) -> Column:
    """M1: m + ln(sum(exp(x - m))) with m = max(x); no overflow."""
    a = as_double(arr)
    m = F.array_max(a)
    s = F.aggregate(a, F.lit(0.0).cast("double"), lambda acc, x: acc + F.exp(x - m))
    return m + F.log(s)


def softplus(x) -> Column:
    """M2: ln(1 + e^x), stable for large |x|."""
    x = _c(x).cast("double")
    return F.greatest(x, F.lit(0.0)) + F.log1p(F.exp(-F.abs(x)))


def argmax(arr) -> Column:
    """M5: 0-based index of the largest element; first one on ties."""
    a = _c(arr)
    return (F.array_position(a, F.array_max(a)) - F.lit(1)).cast("int")


def k_max(arr, k: int) -> Column:
    """K1: the k largest values in their original order.

    Ties keep the lower index; an array shorter than k is returned whole.
    """
    a = _c(arr)
    tagged = F.transform(a, lambda x, i: F.struct(x.alias("v"), (-i).alias("ni")))
    top = F.slice(F.sort_array(tagged, asc=False), 1, k)
    by_pos = F.sort_array(F.transform(top, lambda s: F.struct((-s["ni"]).alias("i"),
                                                              s["v"].alias("v"))))
    return by_pos["v"]
