"""Round trips of the readers and writers."""

import os

import pandas as pd
import pytest
from pyspark.sql import functions as F

from polarity.operators.ensemble import ensemble, member_weights
from polarity.operators.model import fit_nb, fit_lr, score_lr
from polarity.sources import cache, models, reviews, vocab_io
from polarity.sources.metrics_log import log_metrics, read_metrics

HARD = ['plain', 'quote " inside', 'line\nbreak', 'trailing backslash\\', 'comma, and "both"\n']


def test_review_csv_round_trip(spark, tmp_out):
    # a file written the way pandas writes one (blank index header)
    path = os.path.join(tmp_out, "train.csv")
    pd.DataFrame({"review": HARD, "sentiment": ["positive", "negative"] * 2 + ["positive"]}
                 ).to_csv(path)
    df = reviews.read_reviews(spark, path).orderBy("id").collect()
    assert [r["review"] for r in df] == HARD and [r["id"] for r in df] == list(range(5))
    out = os.path.join(tmp_out, "again")
    reviews.write_reviews(spark.createDataFrame(df), out)
    back = reviews.read_reviews(spark, out).orderBy("id").collect()
    assert [r["review"] for r in back] == HARD
    test = reviews.read_reviews(spark, path, labeled=False)
    assert test.columns == ["id", "review"]


def test_submission_round_trip(spark, tmp_out):
    sub = spark.createDataFrame([(3, "positive"), (1, "negative")], "id long, sentiment string")
    p = os.path.join(tmp_out, "sub")
    reviews.write_submission(sub, p)
    assert sorted(reviews.read_submission(spark, p).collect()) == [(1, "negative"), (3, "positive")]
    with pytest.raises(Exception):
        reviews.write_submission(sub, p)


def test_read_members(spark, tmp_out):
    for m, rows in {"run-a": [(1, "positive"), (2, "negative")], "run-b": [(1, "negative")],
                    "run-c": [(1, "negative")]}.items():
        reviews.write_submission(spark.createDataFrame(rows, "id long, sentiment string"),
                                 os.path.join(tmp_out, m, "submission.csv"))
    w = member_weights(spark, [("run-a", "2.00"), ("run-b", "1.50")])
    got = sorted((r["member"], r["id"], r["sentiment"], float(r["weight"]))
                 for r in reviews.read_members(spark, tmp_out, w).collect())
    assert got == [("run-a", 1, "positive", 2.0), ("run-a", 2, "negative", 2.0),
                   ("run-b", 1, "negative", 1.5)]


def test_read_members_reference_files(spark, tmp_out):
    # the reference layout: one plain file per member, root/<member>/submission.csv
    for m, sent in {"20201226-115507": "positive", "20201228-200251": "negative"}.items():
        os.makedirs(os.path.join(tmp_out, m))
        pd.DataFrame({"sentiment": [sent, sent]}, index=[7, 9]).to_csv(
            os.path.join(tmp_out, m, "submission.csv"))
    w = member_weights(spark, [("20201226-115507", "96.13"), ("20201228-200251", "96.20")])
    got = sorted((r["member"], r["id"], r["sentiment"])
                 for r in reviews.read_members(spark, tmp_out, w).collect())
    assert got == [("20201226-115507", 7, "positive"), ("20201226-115507", 9, "positive"),
                   ("20201228-200251", 7, "negative"), ("20201228-200251", 9, "negative")]


def test_members_partitioned_layout(spark, tmp_out):
    votes = spark.createDataFrame([(1, "a", "positive"), (1, "b", "negative"), (2, "c", "negative")],
                                  "id long, member string, sentiment string")
    root = os.path.join(tmp_out, "m")
    reviews.write_members(votes, root)
    w = member_weights(spark, [("a", "1.00"), ("b", "2.00")])
    df = reviews.read_members(spark, root, w, layout="partitioned")
    plan = spark._jvm.org.apache.spark.sql.api.python.PythonSQLUtils.explainString(
        df._jdf.queryExecution(), "formatted")
    assert "PartitionFilters: [member" in plan and "IN (a,b)" in plan  # pruned folders
    got = sorted((r["member"], r["id"], r["sentiment"]) for r in df.collect())
    assert got == [("a", 1, "positive"), ("b", 1, "negative")]


def test_encoded_round_trip(spark, tmp_out):
    p = os.path.join(tmp_out, "reviews.csv")
    with open(p, "w") as f:
        f.write("1.000000000000000000e+00,-1.000000000000000000e+00\n")
        f.write("2.500000000000000000e+01,3.000000000000000000e+00\n")
    rows = vocab_io.read_encoded(spark, p).orderBy("row").collect()
    assert [list(r["ids"]) for r in rows] == [[1, -1], [25, 3]]
    out = os.path.join(tmp_out, "enc")
    vocab_io.write_encoded(spark.createDataFrame(rows), out)
    assert [list(r["ids"]) for r in vocab_io.read_encoded(spark, out).orderBy("row").collect()] \
        == [[1, -1], [25, 3]]


def test_vocabulary_text(spark, tmp_out):
    p = os.path.join(tmp_out, "vec.txt")
    with open(p, "w") as f:
        f.write("the 0.5 -1.0\n, 0.25 2\nmovie 1 1\n")
    v = vocab_io.read_vocabulary(spark, p).orderBy("id").collect()
    assert [(r["id"], r["word"]) for r in v] == [(0, "the"), (1, ","), (2, "movie")]
    assert list(v[0]["vector"]) == [0.5, -1.0]


def test_materialize_once(spark, tmp_out):
    p = os.path.join(tmp_out, "cache")
    calls = []

    def build():
        calls.append(1)
        return spark.range(5)
    assert cache.materialize_once(spark, build, p).count() == 5
    assert cache.materialize_once(spark, build, p).count() == 5
    assert len(calls) == 1
    os.remove(os.path.join(p, "_SUCCESS"))  # an interrupted write is not trusted
    cache.materialize_once(spark, build, p)
    assert len(calls) == 2


def test_cache_follows_inputs_and_parameters(spark, tmp_out):
    source, p = os.path.join(tmp_out, "in"), os.path.join(tmp_out, "keyed")
    calls = []

    def build():
        calls.append(1)
        return spark.read.parquet(source)

    def get(**params):
        return cache.materialize_once(spark, build, p, inputs=[source], params=params).count()
    spark.range(3).write.parquet(source)
    assert get(n=1) == 3 and get(n=1) == 3 and len(calls) == 1
    spark.range(4).write.mode("append").parquet(source)  # one more file
    assert get(n=1) == 7 and get(n=1) == 7 and len(calls) == 2
    assert get(n=2) == 7 and len(calls) == 3  # other parameters
    name = sorted(f for f in os.listdir(source) if f.endswith(".parquet"))[0]
    at = os.path.getmtime(os.path.join(source, name))
    os.utime(os.path.join(source, name), (at + 5, at + 5))  # rewritten in place
    assert get(n=2) == 7 and len(calls) == 4
    os.remove(os.path.join(p, cache.MANIFEST))  # crash before the manifest
    assert get(n=2) == 7 and len(calls) == 5
    table = spark.read.parquet(source)
    assert cache.manifest(spark, [table]) == cache.manifest(spark, [table])
    with pytest.raises(FileNotFoundError):
        cache.manifest(spark, [os.path.join(tmp_out, "none")])


def test_metric_log_reruns_replace(spark, tmp_out):
    p = os.path.join(tmp_out, "log")

    def log(rows, run="007", tags=("a", "b")):
        wide = spark.createDataFrame(rows, "step long, a double, b double")
        return log_metrics(wide, run, "step", list(tags), p, part_steps=10)

    def points(run="007"):
        return sorted(tuple(r) for r in read_metrics(spark, p, run).collect())
    log([(1, 1.0, 2.0), (25, 3.0, None)])
    once = points()
    assert once[0] == ("007", "a", 1, 1.0) and len(once) == 4
    log([(1, 1.0, 2.0), (25, 3.0, None)])
    assert sorted(map(str, points())) == sorted(map(str, once))  # a retry doubles nothing
    log([(2, 9.0, 9.0)], tags=("a",))  # same range: other points stay
    log([(1, 5.0, 0.0)], tags=("a",))  # the point is replaced
    got = {(t, s): v for _, t, s, v in points()}
    assert got == {("a", 1): 5.0, ("b", 1): 2.0, ("a", 2): 9.0, ("a", 25): 3.0, ("b", 25): None}
    log([(1, 8.0, 8.0)], run="8")  # another run
    assert len(points()) == 5 and len(points("8")) == 2
    log([])
    assert len(points()) == 5
    with pytest.raises(Exception, match="two values of one point"):
        log([(1, 1.0, 1.0), (1, 2.0, 1.0)])
    plan = read_metrics(spark, p, "8")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(run" in plan


def test_models_save_load(spark, tmp_out):
    docs = spark.createDataFrame([(["good", "fun"], 1.0), (["bad"], 0.0)], "tokens array<string>, p double")
    m = fit_nb(docs)
    path = models.save_model(m, tmp_out, "run1", 3)
    assert path.endswith("run1--EPOCH-3")
    m2 = models.load_model(spark, tmp_out, "run1", 3)
    assert m2.prior == m.prior and m2.n_words == m.n_words == 3
    with pytest.raises(FileNotFoundError):
        models.load_model(spark, tmp_out, "run1", 4)
    lab = spark.createDataFrame([(1, ["good"], 1), (2, ["bad"], 0)], "id long, tokens array<string>, label int")
    lr = fit_lr(lab, max_iter=5)
    models.save_model(lr, tmp_out, "lr", 1)
    lr2 = models.load_model(spark, tmp_out, "lr", 1, kind="lr")
    assert score_lr(lab, lr2).count() == 2


def test_metric_log(spark, tmp_out):
    wide = spark.createDataFrame([(1, 0.5, 0.9), (2, 0.4, 0.95)], "step long, loss double, acc double")
    p = os.path.join(tmp_out, "log")
    log_metrics(wide, "r1", "step", ["loss", "acc"], p, group="batch")
    got = spark.read.parquet(p).filter(F.col("run") == "r1").orderBy("tag", "step").collect()
    assert [(r["tag"], r["step"], r["value"]) for r in got] == [
        ("batch/acc", 1, 0.9), ("batch/acc", 2, 0.95), ("batch/loss", 1, 0.5), ("batch/loss", 2, 0.4)]


def test_encoded_order_survives_many_part_files(spark, tmp_out):
    from pyspark.sql import functions as F
    df = (spark.range(300).repartition(7)
          .select(F.col("id").alias("row"), F.array(F.col("id").cast("int"), F.lit(-1)).alias("ids")))
    out = os.path.join(tmp_out, "many")
    # small data: keep AQE from merging the sorted ranges into one file
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        vocab_io.write_encoded(df, out)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    parts = [f for f in os.listdir(out) if f.startswith("part-")]
    assert len(parts) > 1  # written in parallel, not through one task
    back = vocab_io.read_encoded(spark, out).orderBy("row").collect()
    assert [(r["row"], list(r["ids"])) for r in back] == [(i, [i, -1]) for i in range(300)]


def test_reviews_by_header_name(spark, tmp_out):
    import os

    def write(name, text):
        path = os.path.join(tmp_out, name)
        with open(path, "w", newline="") as f:
            f.write(text)
        return path
    two = write("two.csv", 'sentiment,review\npositive,"a, ""b""\nc"\nnegative,""\n')
    assert [tuple(r) for r in reviews.read_reviews(spark, two).orderBy("id").collect()] == [
        (0, 'a, "b"\nc', "positive"), (1, "", "negative")]
    blank = write("blank.csv", ",review,sentiment\n5,x,positive\n")
    assert [tuple(r) for r in reviews.read_reviews(spark, blank).collect()] == [(5, "x", "positive")]
    other = write("other.csv", "review,Unnamed: 0\nx,7\n")
    assert [tuple(r) for r in reviews.read_reviews(spark, other, labeled=False).collect()] == [(7, "x")]
    with pytest.raises(ValueError, match="sentiment"):
        reviews.read_reviews(spark, other)
    with pytest.raises(Exception, match="not an id: 1_5.txt"):
        reviews.read_reviews(spark, write("bad.csv", "id,review,sentiment\n1_5.txt,x,positive\n")).collect()
    with pytest.raises(Exception):
        reviews.read_reviews(spark, write("long.csv", "id,review,sentiment\n1,x,positive,more\n")).collect()


def test_members_with_odd_names_and_lost_ones(spark, tmp_out):
    import os
    names = ["run a", "run%b", "run+c", "plain"]
    votes = spark.createDataFrame([(i, m, "positive") for i in range(3) for m in names],
                                  "id long, member string, sentiment string")
    w = member_weights(spark, [(m, "1.5") for m in names])
    root, parts = os.path.join(tmp_out, "folders"), os.path.join(tmp_out, "parts")
    for m in names:
        reviews.write_submission(votes.where(votes.member == m), f"{root}/{m}/submission.csv")
    reviews.write_members(votes, parts)
    for r, layout in ((root, "folders"), (parts, "partitioned")):
        got = reviews.read_members(spark, r, w, layout=layout).groupBy("member").count().collect()
        assert {x["member"]: x["count"] for x in got} == {m: 3 for m in names}
        lost = member_weights(spark, [("plain", "1"), ("absent", "1")])
        with pytest.raises(FileNotFoundError, match="absent"):
            reviews.read_members(spark, r, lost, layout=layout)


def test_vote_weights_are_exact(spark):
    w = member_weights(spark, [("a", "0.9613"), ("b", "0.4829"), ("c", "0.4829")])
    ids = spark.createDataFrame([(1,)], "id long")
    votes = spark.createDataFrame([(1, "a", "positive"), (1, "b", "negative"),
                                   (1, "c", "negative")],
                                  "id long, member string, sentiment string")
    assert ensemble(ids, votes, w).collect()[0]["sentiment"] == "negative"
    with pytest.raises(ValueError, match="18 decimals"):
        member_weights(spark, [("a", "0." + "1" * 19)])


def test_vocabulary_line_without_vector_fails(spark, tmp_out):
    import os
    path = os.path.join(tmp_out, "vec.txt")
    with open(path, "w") as f:
        f.write("a 1 2\nb\nc 3 4\n")
    with pytest.raises(Exception, match="no word with a vector in line 1"):
        vocab_io.read_vocabulary(spark, path).collect()


def test_encoded_part_pairs_rows(spark, tmp_out):
    import os

    from polarity.sources.vocab_io import read_encoded_part, write_encoded_part
    df = spark.createDataFrame([(i, [i, i + 1, -1], i % 2) for i in range(50)],
                               "row long, ids array<int>, label int").repartition(4)
    path = os.path.join(tmp_out, "part")
    write_encoded_part(df, path)
    got = sorted(tuple(r) for r in read_encoded_part(spark, path).collect())
    assert got == [(i, [i, i + 1, -1], i % 2) for i in range(50)]


def test_drop_scratch(spark):
    import os

    from polarity.session import checkpoint, drop_scratch, scratch_mark
    mark = scratch_mark()
    df = checkpoint(spark.range(3).toDF("id"), "gone")
    folder = df.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]
    assert df.count() == 3 and os.path.isdir(folder)
    assert drop_scratch(spark, mark) == 1 and not os.path.exists(folder)


def test_stream_nb_score_reads_a_file_or_a_folder(spark, tmp_path):
    """The documents table as one file and as a folder of part files: every
    document is scored once."""
    import glob
    import os
    from polarity.plans.catalog import q_nb_score, q_stream_nb_score
    docs = spark.createDataFrame([(i, f"good{i % 3} film") for i in range(30)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(20)], "doc_id long, quality int")
    for form, parts in (("folder", 4), ("file", 1)):
        d = str(tmp_path / form)
        labels.write.parquet(f"{d}/labels.parquet")
        docs.repartition(parts).write.parquet(f"{d}/documents.parquet")
        if form == "file":
            os.rename(glob.glob(f"{d}/documents.parquet/part-*")[0], f"{d}/part")
            os.rename(f"{d}/documents.parquet", f"{d}/_documents")
            os.rename(f"{d}/part", f"{d}/documents.parquet")
        got = sorted(q_stream_nb_score(spark, d).collect())
        assert len(got) == 30 and got == sorted(q_nb_score(spark, d).collect())
