"""Driver contract, plan shape, streaming, and the SQL oracle on sf0.001."""

import math
import os

import duckdb
import numpy as np
import pytest

import __spark_entry__ as E
from conftest import SF001
from polarity.plans import inputs as I
from polarity.plans.catalog import QUERIES
from polarity.plans.pipeline import run_semi, run_supervised
from polarity.operators.model import fit_nb
from polarity.streaming import score_stream

TABLES = "documents labels pages embeddings events".split()
SAMPLE = ["tokenize", "lookup_ids", "build_examples", "split_three", "zip_batches",
          "ensemble_submission", "step_window", "nb_score", "semi_nb_score", "nearest_word",
          "pipeline_submission", "feature_histogram", "k_max", "review_csv", "member_files",
          "encoded_csv", "vocab_text"]


def canon(v):
    if isinstance(v, (np.ndarray, list, tuple)):
        return tuple(canon(x) for x in v)
    if isinstance(v, np.generic):
        return v.item()
    if isinstance(v, float) and math.isnan(v):
        return None
    return v


def rows(pdf):
    cols = sorted(pdf.columns)
    return cols, sorted((tuple(canon(r[c]) for c in cols) for r in pdf.to_dict("records")), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return con


def test_every_query_has_oracle_or_is_rows_only():
    assert set(E.oracle_sql()) <= set(E.queries())
    own = set(QUERIES)
    assert own - set(E.oracle_sql()) == {"lr_fit", "semi_lr_fit", "lr_table_score",
                                            "nearest_word_indexed"}


def test_entry(spark):
    df = E.entry(spark)
    assert df.columns == ["doc_id", "sentiment"] and df.count() > 0


@pytest.mark.parametrize("name", SAMPLE)
def test_oracle_sf0001(spark, duck, name):
    s = rows(E.queries()[name](spark, SF001).toPandas())
    d = rows(duck.execute(E.oracle_sql()[name]).df())
    assert s == d


def test_no_python_udf_outside_nearest(spark):
    for name in ["tokenize", "lookup_ids", "nb_score", "split_three", "ensemble_submission"]:
        plan = E.queries()[name](spark, SF001)._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan, name


def test_no_single_partition_exchange_on_data(spark):
    # the sample is a filter: no exchange at all, let alone a single partition
    plan = E.queries()["sample_exact"](spark, SF001)._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "Exchange" not in plan


def test_run_supervised_with_validation(spark, tmp_out):
    train = I.labeled_docs(spark, SF001).withColumnRenamed("doc_id", "id") \
        .withColumnRenamed("text", "review")
    test = I.unlabeled_docs(spark, SF001).withColumnRenamed("doc_id", "id") \
        .withColumnRenamed("text", "review")
    res = run_supervised(train, test, use_all=False, out_path=os.path.join(tmp_out, "sub"))
    m = res.valid_metrics.collect()[0]
    assert m["n"] == math.ceil(0.1 * train.count()) and m["loss"] >= 0
    assert spark.read.option("header", True).csv(os.path.join(tmp_out, "sub")).count() == test.count()
    lr = run_supervised(train, test, kind="lr")
    assert lr.submission.count() == test.count()


def test_run_semi(spark):
    lab = I.labeled_docs(spark, SF001).withColumnRenamed("doc_id", "id") \
        .withColumnRenamed("text", "review")
    acc, plan, _ = run_semi(lab)
    n = lab.count()
    test_n = n - round(0.7 * n)
    assert acc.collect()[0]["n"] == test_n
    assert plan.count() % 64 == 0


def test_score_stream(spark, tmp_out):
    docs = I.documents(spark, SF001).withColumnRenamed("doc_id", "id").withColumnRenamed("text", "review")
    src = os.path.join(tmp_out, "in")
    docs.limit(30).write.parquet(src)
    lab = I.with_tokens(I.labeled_docs(spark, SF001))
    model = fit_nb(lab.select("tokens", lab["label"].alias("p")))
    stream = spark.readStream.schema(docs.schema).parquet(src)
    q = score_stream(stream, model, os.path.join(tmp_out, "out"), os.path.join(tmp_out, "ck"))
    q.awaitTermination(120)
    out = spark.read.parquet(os.path.join(tmp_out, "out"))
    assert out.count() == 30 and set(out.columns) >= {"id", "score", "pred", "sentiment"}


def _plan(spark, df) -> str:
    return spark._jvm.org.apache.spark.sql.api.python.PythonSQLUtils.explainString(
        df._jdf.queryExecution(), "simple")


def test_ngram_plan_has_no_exchange(spark):
    from polarity.operators.vocab import ngram_features
    toks = spark.createDataFrame([(1, ["a", "b", "c", "d"])], "id long, tokens array<string>")
    plan = _plan(spark, ngram_features(toks, "id"))
    assert "Exchange" not in plan and "Window" not in plan


def test_term_table_needs_no_further_exchange_by_key(spark):
    from polarity.operators import model as T
    toks = I.with_tokens(I.labeled_docs(spark, SF001))
    terms = T.term_table(toks, "doc_id", "tokens", ("label",))
    m = T.fit_semi_terms(terms, "doc_id", "label", rounds=0)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = _plan(spark, T.score_terms(terms, m, "doc_id"))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "Exchange hashpartitioning" not in plan


def test_decode_plan_has_no_join(spark):
    from polarity.operators.neighbors import decode_sentence
    vocab = spark.createDataFrame([(0, "up", [0.0, 1.0])], "id int, word string, vector array<float>")
    long = spark.createDataFrame([(7, 0, [0.1, 0.8])], "sid long, pos int, vector array<float>")
    plan = _plan(spark, decode_sentence(long, vocab, "sid"))
    assert "Join" not in plan and "MapInPandas" in plan


def test_dealt_lookup_plan(spark):
    from polarity.operators import vocab as V
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        toks = spark.createDataFrame([(1, ["the", "a"])], "id long, tokens array<string>")
        vocab = spark.createDataFrame([(0, "the", 9), (1, "a", 1)], "id int, word string, n long")
        plan = _plan(spark, V.lookup_ids(toks, vocab, "id", n=4, max_broadcast_rows=0))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # the warm keys' copy numbers are broadcast to both sides, the table is not
    assert plan.count("BroadcastHashJoin") == 2 and "SortMergeJoin [word" in plan
