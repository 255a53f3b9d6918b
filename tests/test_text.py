"""Hand-made rows from FIXTURES.md for the column functions."""

import math

from pyspark.sql import functions as F

from polarity.functions import (argmax, attention_mask, cosine, encode_label,
                                encode_with_specials, k_max, log_sum_exp,
                                pad_truncate, softplus, strip_tags, tokenize)


def one(spark, expr, data, schema):
    return [r[0] for r in spark.createDataFrame(data, schema).select(expr.alias("o")).collect()]


def test_strip_tags(spark):
    rows = [("a<br />b",), ("x <b\nclass=1>y",), ("<> 1 < 2",), (None,)]
    assert one(spark, strip_tags("t"), rows, "t string") == ["a b", "x  y", "<> 1 < 2", None]


def test_encode_label(spark):
    rows = [("positive",), ("negative",), ("Positive",), (None,)]
    assert one(spark, encode_label("s"), rows, "s string") == [1, 0, 0, 0]


def test_tokenize(spark):
    rows = [("I don't like it!",), ("",), (None,), ("It's  A\ttest.\nOK",)]
    out = one(spark, tokenize("t"), rows, "t string")
    assert out[0] == ["i", "do", "n't", "like", "it", "!"]
    assert out[1] == [] and out[2] == []
    assert out[3] == ["it", "'s", "a", "test", ".", "ok"]


def test_pad_truncate(spark):
    rows = [([5],), ([1, 2, 3, 4],), ([],)]
    assert one(spark, pad_truncate("a", 3, -1), rows, "a array<int>") == [
        [5, -1, -1], [1, 2, 3], [-1, -1, -1]]


def test_attention_mask(spark):
    assert one(spark, attention_mask("a"), [([1, 7, 2, 0, 0],)], "a array<int>") == [
        [1, 1, 1, 0, 0]]


def test_encode_with_specials(spark):
    e = pad_truncate(encode_with_specials("a", 4, 1, 2), 4, 0)
    assert one(spark, e, [([9, 8, 7],), ([],)], "a array<int>") == [[1, 9, 8, 2], [1, 2, 0, 0]]


def test_k_max(spark):
    rows = [([3.0, 1.0, 9.0, 9.0, 2.0],), ([4.0],), ([5.0, 1.0, 7.0],)]
    assert one(spark, k_max("a", 2), rows, "a array<double>") == [[9.0, 9.0], [4.0], [5.0, 7.0]]
    # ties keep the lower index and the original order
    assert one(spark, k_max("a", 2), [([2.0, 1.0, 2.0, 2.0],)], "a array<double>") == [[2.0, 2.0]]


def test_log_sum_exp_no_overflow(spark):
    out = one(spark, log_sum_exp("a"), [([1000.0, 1000.0],)], "a array<double>")
    assert math.isclose(out[0], 1000 + math.log(2), rel_tol=1e-12)


def test_softplus(spark):
    out = one(spark, softplus("x"), [(0.0,), (800.0,), (-800.0,)], "x double")
    assert math.isclose(out[0], math.log(2)) and out[1] == 800.0 and out[2] >= 0.0


def test_cosine_zero_vector(spark):
    out = one(spark, cosine("a", "b"), [([0.0, 0.0], [1.0, 2.0])], "a array<double>, b array<double>")
    assert out == [0.0]


def test_argmax_first_on_ties(spark):
    assert one(spark, argmax("a"), [([0.5, 0.5],), ([0.1, 0.9],)], "a array<double>") == [0, 1]


def test_no_python_udf_in_text_plan(spark):
    df = spark.createDataFrame([("<b>x</b> y",)], "t string").select(
        tokenize(strip_tags("t")).alias("x"), F.lit(1))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_ngram_features_brute_force(spark):
    from collections import Counter

    from polarity.operators.vocab import ngram_features
    rows = [(1, ["a", "b", "a", "b", "a", "b", "a"]), (2, ["x", "y"]), (3, []), (4, None),
            (5, list("pqrstuvw"))]
    df = spark.createDataFrame(rows, "id long, tokens array<string>")
    want = Counter()
    for i, t in rows:
        for n in (3, 4, 5, 6, 7):
            for j in range(len(t or []) - n + 1):
                want[(i, n, " ".join(t[j:j + n]))] += 1
    got = {(r["id"], r["width"], r["gram"]): r["n"]
           for r in ngram_features(df.repartition(3), "id").collect()}
    assert got == dict(want)


def test_tokenize_equals_the_passes_it_stands_for(spark):
    """Contractions split, other characters set apart, split on blanks: as
    three passes do it."""
    texts = ["x'll's don't''re 'd a'm", "I've\tseen it 's", "😀á ǅ ²٧ \x0b\x00b",
             "''", "'", " \r\n\f", "", None, "n't can'tn't Oİ'S", "a-b_c--d...", "日本 語's"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    s = F.regexp_replace(F.lower("t"), "([^' ])('ll|'re|'ve|n't|'s|'m|'d)", "$1 $2")
    s = F.regexp_replace(s, "([^\\p{L}\\p{N} \\t\\r\\n\\f'])", " $1 ")
    old = F.coalesce(F.array_remove(F.split(s, "[ \\t\\r\\n\\f]+"), ""), F.array().cast("array<string>"))
    rows = df.select("i", old.alias("old"), tokenize("t").alias("new")).collect()
    assert all(r["old"] == r["new"] for r in rows) and rows[0]["new"]
