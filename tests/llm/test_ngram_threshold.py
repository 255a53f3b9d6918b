"""The join at the query's and at the pipeline's width and threshold."""

import corpus_pipeline as P
import pytest
import test_ngram_join as T

from polarity.llm import ngram_join as J
from polarity.llm import queries as Q


@pytest.mark.parametrize("width,percent", [(4, 85), (5, 80)])
def test_width_and_threshold(spark, monkeypatch, width, percent):
    docs = T.corpus(seed=3) + near()
    df = spark.createDataFrame(docs, "doc_id long, text string")
    out = J.join_components(df, width=width, percent=percent).collect()
    monkeypatch.setattr(J, "PERCENT", percent)
    assert sorted(map(tuple, out), key=repr) == T.brute(docs, width)


def near():
    """A text of 100 words and the same with 21 more: 96/117 on 5-word
    shingles, 97/118 on 4-word ones."""
    ws = [f"v{i}" for i in range(121)]
    return [(3000, " ".join(ws[:100])), (3001, " ".join(ws))]


def test_stage_drops_near_copies_from_80_percent(spark):
    other = [(3002, " ".join(f"u{i}" for i in range(50)))]
    df = spark.createDataFrame(near() + other, "doc_id long, text string")
    assert sorted(r.doc_id for r in P.drop_near_duplicates(spark, df, "").collect()) == [3000, 3002]


def test_query_keeps_its_width_and_threshold(spark, tmp_path):
    spark.createDataFrame(near(), "doc_id long, text string").write.parquet(
        f"{tmp_path}/documents.parquet")
    got = {tuple(r) for r in Q.op4_ngram_jaccard(spark, str(tmp_path)).collect()}
    assert got == {(3000, 97, 3000), (3001, 118, 3001)}
