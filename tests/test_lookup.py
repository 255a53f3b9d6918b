"""Vocabulary, lookups, nearest word, strict submission."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from polarity.operators import neighbors as N
from polarity.operators import vocab as V
from polarity.operators.model import make_submission


def test_lookup_ids_miss_and_pad(spark):
    vocab = spark.createDataFrame([(0, "a")], "id int, word string")
    docs = spark.createDataFrame([(1, ["a", "zz"]), (2, [])], "id long, tokens array<string>")
    out = {r["id"]: r["ids"] for r in V.lookup_ids(docs, vocab, "id", n=3).collect()}
    assert out == {1: [0, -1, -1], 2: [-1, -1, -1]}


def test_lookup_ids_shuffle_path_same(spark):
    vocab = spark.createDataFrame([(i, f"w{i}") for i in range(50)], "id int, word string")
    docs = spark.createDataFrame([(d, [f"w{(d * 7 + j) % 60}" for j in range(d % 9)])
                                  for d in range(40)], "id long, tokens array<string>")
    a = V.lookup_ids(docs, vocab, "id", n=5).orderBy("id").collect()
    b = V.lookup_ids(docs, vocab, "id", n=5, max_broadcast_rows=0).orderBy("id").collect()
    assert a == b


def test_build_vocabulary_order(spark):
    docs = spark.createDataFrame([(["b", "a", "b", "c", "a", "b"],), (["c", "d"],)],
                                 "tokens array<string>")
    v = V.build_vocabulary(docs, min_count=2, max_size=10, first_id=4).orderBy("id").collect()
    assert [(r["id"], r["word"], r["n"]) for r in v] == [(4, "b", 3), (5, "a", 2), (6, "c", 2)]
    u = V.build_vocabulary(docs, min_count=2, max_size=None).orderBy("id").collect()
    assert [r["word"] for r in u] == ["b", "a", "c"] and u[0]["id"] == 0
    monkey = V.TOPK_MERGE_ROWS
    V.TOPK_MERGE_ROWS = 1  # cap x partitions over the bound: distributed rank
    try:
        c = V.build_vocabulary(docs, min_count=1, max_size=3).orderBy("id").collect()
    finally:
        V.TOPK_MERGE_ROWS = monkey
    assert [r["word"] for r in c] == ["b", "a", "c"]


def test_embed_zero_vector(spark):
    vecs = spark.createDataFrame([(0, [1.0, 2.0])], "id int, vector array<float>")
    ids = spark.createDataFrame([(1, [0, -1])], "id long, ids array<int>")
    for bound in (1 << 20, 0):
        out = sorted(V.embed(ids, vecs, "id", max_broadcast_bytes=bound).collect(),
                     key=lambda r: r["pos"])
        assert [list(r["vector"]) for r in out] == [[1.0, 2.0], [0.0, 0.0]]


def test_nearest_tie_lowest_id_both_plans(spark):
    vocab = spark.createDataFrame(
        [(5, "five", [1.0, 0.0]), (2, "two", [2.0, 0.0]), (9, "nine", [0.0, 1.0])],
        "id int, word string, vector array<float>")
    q = spark.createDataFrame([(1, [3.0, 0.0]), (2, [0.0, 0.5]), (3, [0.0, 0.0])],
                              "qid long, vector array<double>")
    a = {r["qid"]: r["word_id"] for r in N.nearest(q, vocab).collect()}
    b = {r["qid"]: r["word_id"] for r in N.nearest(q, vocab, max_broadcast_values=2).collect()}
    assert a == b == {1: 2, 2: 9, 3: 2}


def test_nearest_equal_vectors_many_dimensions(spark):
    """Words that share a vector: the lowest id, on one block and on many."""
    import numpy as np
    rng = np.random.default_rng(4)
    base = rng.normal(size=(60, 64)).astype("float32").tolist()
    rows = [(i, f"w{i}", base[i % 60]) for i in range(180)]  # three ids per vector
    vocab = spark.createDataFrame(rows, "id int, word string, vector array<float>")
    qs = [(i, [x * 1.5 for x in base[i % 60]]) for i in range(90)]
    q = spark.createDataFrame(qs, "qid long, vector array<double>")
    for how in ({}, {"max_broadcast_values": 64 * 7}):
        got = {r["qid"]: r["word_id"] for r in N.nearest(q, vocab, **how).collect()}
        assert got == {i: i % 60 for i in range(90)}
        top = N.nearest(q, vocab, k=4, **how).where("qid = 3").orderBy("rank").collect()
        assert [r["word_id"] for r in top[:3]] == [3, 63, 123]


def test_nearest_keeps_every_row_and_needs_a_vocabulary(spark):
    vocab = spark.createDataFrame([(0, "up", [0.0, 1.0]), (1, "right", [1.0, 0.0])],
                                  "id int, word string, vector array<float>")
    q = spark.createDataFrame([(7, [0.0, 1.0]), (7, [1.0, 0.0]), (8, [0.0, 2.0])],
                              "qid long, vector array<double>")
    for bound in (1 << 20, 2):
        got = sorted((r["qid"], r["word"]) for r in
                     N.nearest(q, vocab, max_broadcast_values=bound).collect())
        assert got == [(7, "right"), (7, "up"), (8, "up")]
    with pytest.raises(ValueError, match="no vectors"):
        N.nearest(q, vocab.where("false"))


def test_top_slices_agree(monkeypatch):
    import numpy as np
    rng = np.random.default_rng(0)
    q, v = rng.normal(size=(37, 5)), rng.normal(size=(11, 5))
    ids = np.arange(11)
    for k in (1, 3, 20):
        whole = N._top(q, v, np.linalg.norm(v, axis=1), ids, k)
        with monkeypatch.context() as m:
            m.setattr(N, "SIM_VALUES_PER_SLICE", 20)  # 1 query row per slice
            sliced = N._top(q, v, np.linalg.norm(v, axis=1), ids, k)
        assert (whole[0] == sliced[0]).all() and np.allclose(whole[1], sliced[1])
        sims = (q @ v.T) / np.outer(np.linalg.norm(q, axis=1), np.linalg.norm(v, axis=1))
        assert (whole[0] == np.argsort(-sims, axis=1, kind="stable")[:, :k]).all()


def test_decode_sentence(spark):
    vocab = spark.createDataFrame([(0, "up", [0.0, 1.0]), (1, "right", [1.0, 0.0])],
                                  "id int, word string, vector array<float>")
    long = spark.createDataFrame([(7, 1, [0.9, 0.1]), (7, 0, [0.1, 0.8]), (8, 0, [0.2, 0.1])],
                                 "sid long, pos int, vector array<float>")
    out = {r["sid"]: r["sentence"] for r in N.decode_sentence(long, vocab, "sid").collect()}
    assert out == {7: "up right", 8: "right"}


def test_decode_sentence_repeated_vectors_both_plans(spark, monkeypatch):
    # many rows share one (pad) vector; words come back without a lookup join
    vocab = spark.createDataFrame([(3, "pad", [0.0, 0.0]), (4, "up", [0.0, 1.0]),
                                   (5, "right", [1.0, 0.0])],
                                  "id int, word string, vector array<float>")
    rows = [(s, p, [0.0, 0.0] if p % 2 else [1.0, 0.2]) for s in range(6) for p in range(5)]
    long = spark.createDataFrame(rows, "sid long, pos int, vector array<float>")
    want = {s: "right pad right pad right" for s in range(6)}
    got = {r["sid"]: r["sentence"] for r in N.decode_sentence(long, vocab, "sid").collect()}
    assert got == want
    orig = N.nearest

    def blocked(q, v, **kw):
        return orig(q, v, max_broadcast_values=2, **kw)
    monkeypatch.setattr(N, "nearest", blocked)
    got = {r["sid"]: r["sentence"] for r in N.decode_sentence(long, vocab, "sid").collect()}
    assert got == want


def test_top_dedupes_repeated_queries():
    import numpy as np
    v = np.array([[1.0, 0.0], [0.0, 1.0]])
    q = np.array([[0.0, 2.0], [3.0, 0.1], [0.0, 2.0], [0.0, 0.0]])
    idx, sim = N._top(q, v, np.linalg.norm(v, axis=1), np.arange(2), 1)
    assert list(idx[:, 0]) == [1, 0, 1, 0]
    assert sim[0, 0] == sim[2, 0] == 1.0 and sim[3, 0] == 0.0


def test_make_submission_missing_prediction_fails(spark):
    ids = spark.createDataFrame([(1,), (2,)], "id long")
    preds = spark.createDataFrame([(1, 1)], "id long, pred int")
    with pytest.raises(Exception, match="no prediction for test id 2"):
        make_submission(ids, preds).collect()
    full = spark.createDataFrame([(1, 1), (2, 0)], "id long, pred int")
    assert sorted(make_submission(ids, full).collect()) == [(1, "positive"), (2, "negative")]


def test_linear_score(spark):
    w = spark.createDataFrame([(0, [3.0, 4.0], 2.0, 1.0)], "out int, w array<double>, g double, b double")
    x = spark.createDataFrame([(1, [1.0, 1.0])], "id long, vector array<double>")
    r = N.linear_score(x, w).collect()[0]
    assert r["out"] == 0 and abs(r["score"] - (2 * 7 / 5 + 1)) < 1e-12
    assert F is not None


def test_linear_score_blocks_and_zero_norm(spark):
    rows = [(i, [float(i), 1.0], 1.0, 0.5) for i in range(5)] + [(9, [0.0, 0.0], 1.0, 7.0)]
    w = spark.createDataFrame(rows, "out int, w array<double>, g double, b double")
    x = spark.createDataFrame([(1, [1.0, 1.0]), (2, [0.5, -1.0])], "id long, vector array<double>")
    whole = sorted(tuple(r) for r in N.linear_score(x, w).collect())
    parts = sorted(tuple(r) for r in N.linear_score(x, w, max_values=2).collect())
    assert whole == parts and len(whole) == 12
    assert {r[2] for r in whole if r[1] == 9} == {7.0}


def test_linear_score_reads_its_blocks_in_tasks(spark):
    """Many blocks, named units, one without a name: one pass of the input, and
    the scores of a plain product. No units, no rows."""
    rng = np.random.default_rng(3)
    mat, g, b = rng.normal(size=(60, 5)), rng.normal(size=60), rng.normal(size=60)
    vecs = rng.normal(size=(40, 5))
    names = [f"unit {i}" for i in range(59)] + [None]
    w = spark.createDataFrame([(n, *map(float, (g[i], b[i])), mat[i].tolist())
                               for i, n in enumerate(names)], "out string, g double, b double, w array<double>")
    x = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vecs)],
                              "out2 long, vector array<double>").repartition(3)
    out = N.linear_score(x, w, key="out2", max_values=50)
    got = {(r.out2, r.out): r.score for r in out.collect()}
    want = vecs @ (g[:, None] * mat / np.linalg.norm(mat, axis=1, keepdims=True)).T + b
    assert len(got) == 2400
    assert all(abs(got[i, n] - want[i, j]) < 1e-9 for i in range(40) for j, n in enumerate(names))
    assert out._jdf.queryExecution().optimizedPlan().toString().count("MapInPandas") == 1
    assert N.linear_score(x, w.where("false"), key="out2").collect() == []


def test_repeated_keys_fail(spark):
    from polarity.operators import model as T
    vocab = spark.createDataFrame([(0, "a")], "id int, word string")
    for rows in ([(1, ["a"]), (1, ["b"])], [(1, []), (1, None)]):
        toks = spark.createDataFrame(rows, "id long, tokens array<string>")
        for bound in (10, 0):
            with pytest.raises(Exception, match="more than one row with id 1"):
                V.lookup_ids(toks, vocab, "id", n=4, max_broadcast_rows=bound).collect()
    lab = spark.createDataFrame([(1, ["a"], 1.0), (2, ["b"], 0.0)],
                                "id long, tokens array<string>, p double")
    m = T.fit_nb(lab, "tokens", "p")
    twice = spark.createDataFrame([(1, ["a"]), (1, ["b"])], "id long, tokens array<string>")
    for bound in (10, 0):
        with pytest.raises(Exception, match="more than one row with id 1"):
            T.score_nb(twice, m, "id", max_broadcast_rows=bound).collect()
    with pytest.raises(ValueError, match="both classes"):
        T.fit_nb(lab.where("p = 1"), "tokens", "p")


def test_dealt_lookup_has_no_hot_partition(spark):
    """Zipf counts, 2,000 partitions: warm keys of every rank are dealt by
    their counts, and so are nulls and a frequent word that the table lacks."""
    from polarity.operators import joins as J
    counts = {f"w{i}": 120_000 // i for i in range(1, 4001)}
    counts["lost"] = 60_000
    table = spark.createDataFrame([(w, i) for i, w in enumerate(counts) if w != "lost"],
                                  "word string, v int")
    freq = spark.createDataFrame(list(counts.items()), "word string, n long")
    left = (freq.withColumn("i", F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))))
            .select("word", "i").unionAll(spark.range(100_000).selectExpr(
                "cast(null as string) as word", "cast(id as int) as i")))
    conf = {"spark.sql.shuffle.partitions": "2000", "spark.sql.adaptive.enabled": "false",
            "spark.sql.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        share = J.task_share(spark, sum(counts.values()), least=1)
        out = J.dealt_lookup(left, "word", table, freq, F.xxhash64("word", "i"), share)
        assert out.columns == ["word", "i", "v"]
        out = out.withColumn("p", F.spark_partition_id()).groupBy("p").agg(
            F.count(F.lit(1)).alias("n"), F.count("v").alias("found"),
            F.count_if(F.col("word") == "lost").alias("lost")).collect()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert sum(r["found"] for r in out) == sum(counts.values()) - 60_000
    assert sum(r["lost"] for r in out) == 60_000
    assert sum(r["n"] for r in out) == sum(counts.values()) + 100_000
    sizes = sorted(r["n"] for r in out)
    assert len(sizes) > 1900 and sizes[-1] <= 3 * sizes[len(sizes) // 2]


def _skewed_tokens(spark):
    rows = [(i, ["the"] * 30 + [f"w{i % 7}", "zzz-unknown", "movie"]) for i in range(40)]
    rows += [(100, []), (101, None), (102, ["movie"])]
    return spark.createDataFrame(rows, "id long, tokens array<string>")


def test_lookup_ids_dealt_equals_broadcast(spark, monkeypatch):
    toks = _skewed_tokens(spark)
    vocab = V.build_vocabulary(toks, min_count=1, max_size=None)
    want = {r["id"]: list(r["ids"]) for r in V.lookup_ids(toks, vocab, "id", n=40).collect()}
    monkeypatch.setattr(V, "ROWS_PER_TASK", 7)  # "the", "movie" and the unknown word are warm
    for vv in (vocab, vocab.drop("n")):
        got = V.lookup_ids(toks, vv, "id", n=40, max_broadcast_rows=0)
        assert {r["id"]: list(r["ids"]) for r in got.collect()} == want
    assert want[100] == [-1] * 40 and want[101] == [-1] * 40


def test_score_nb_dealt_equals_broadcast(spark, monkeypatch):
    from polarity.operators import model as T
    toks = _skewed_tokens(spark)
    lab = toks.filter("id < 40").withColumn("p", (F.col("id") % 2).cast("double"))
    m = T.fit_nb(lab, "tokens", "p")
    want = {r["id"]: round(r["score"], 9) for r in T.score_nb(toks, m, "id").collect()}
    monkeypatch.setattr(T, "ROWS_PER_TASK", 7)
    got = {r["id"]: round(r["score"], 9)
           for r in T.score_nb(toks, m, "id", max_broadcast_rows=0).collect()}
    assert got == want and len(want) == 43
    assert want[100] == want[101] == round(m.prior, 9)


def test_lookup_ids_broadcasts_frequent_words_and_keeps_every_row(spark, monkeypatch):
    """A vocabulary beyond the bound: a few words broadcast, the others through
    the shuffle join, whatever the key, batch and document sizes."""
    rows = [(i, ["the"] * (i % 40) + [f"w{j % 23}" for j in range(i % 31)] + ["lost"], i % 3)
            for i in range(300)] + [(None, ["w1", "rare", "the"], 1), (900, [], 2), (901, None, None)]
    toks = spark.createDataFrame(rows, "id long, tokens array<string>, word2 int")
    words = ["the", "rare", *[f"w{i}" for i in range(23)]]
    count = {w: sum((r[1] or []).count(w) for r in rows) for w in words}
    vocab = spark.createDataFrame([(i, w, count[w]) for i, w in enumerate(words)],
                                  "id int, word string, n long")
    place = {w: i for i, w in enumerate(words)}
    want = {r[0]: ([place.get(w, 7777) for w in (r[1] or [])], r[2]) for r in rows}
    monkeypatch.setattr(V, "ROWS_PER_TASK", 7)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "50")
    try:
        for hot in (0, 4, 100):
            monkeypatch.setattr(V, "HOT_WORDS", hot)
            for n, bound, table in ((None, 0, vocab), (None, 100, vocab), (5, 0, vocab.drop("n"))):
                out = V.lookup_ids(toks, table, "id", n=n, unk=7777, pad=None,
                                   max_broadcast_rows=bound, carry=("word2",)).collect()
                assert len(out) == len(rows)
                assert {r["id"]: (list(r["ids"]), r["word2"]) for r in out} == {
                    k: (v[:n], c) for k, (v, c) in want.items()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_lookup_ids_moves_no_tokens_within_the_bound(spark, monkeypatch):
    toks = _skewed_tokens(spark)
    vocab = spark.createDataFrame([(0, "the"), (1, "movie")], "id int, word string")
    plans = []
    kept = V.checkpoint
    monkeypatch.setattr(V, "checkpoint", lambda df, *a: plans.append(
        df._jdf.queryExecution().executedPlan().toString()) or kept(df, *a))
    V.lookup_ids(toks, vocab, "id", n=5).collect()
    assert plans and not any("hashpartitioning" in p or "Sort " in p for p in plans)


def test_frequent_keys_fit_the_bound(spark):
    from polarity.operators import joins as J
    counts = spark.createDataFrame([(f"w{i}", 1000 // i) for i in range(1, 501)], "word string, n long")
    for most in (0, 3, 100, 10_000):
        got = {r["word"] for r in J.frequent_keys(counts, "word", most).collect()}
        assert len(got) <= most and got == {f"w{i}" for i in range(1, 501)
                                            if 1000 // i >= min([1000 // int(w[1:]) for w in got], default=9e9)}
    assert J.frequent_keys(counts, "word", 10_000).count() == 500


def test_embed_frequent_ids_first(spark, monkeypatch):
    """Beyond the bound: every position once, with its vector, however many of
    the ids are broadcast; a null vector counts as zeros."""
    vecs = spark.createDataFrame([(i, [float(i), 1.0] if i % 6 else None) for i in reversed(range(20))],
                                 "id int, vector array<float>")
    docs = [(d, [(d * 3 + j * j) % 25 - 2 for j in range(d % 12)]) for d in range(60)]
    ids = spark.createDataFrame(docs, "id long, ids array<int>")
    want = sorted((d, p, [float(i), 1.0] if 0 <= i < 20 and i % 6 else [0.0, 0.0])
                  for d, xs in docs for p, i in enumerate(xs))
    monkeypatch.setattr(V, "ROWS_PER_TASK", 5)
    for hot in (0, 64, 1 << 20):
        monkeypatch.setattr(V, "HOT_BYTES", hot)
        got = V.embed(ids, vecs, "id", max_broadcast_bytes=0).collect()
        assert sorted((r["id"], r["pos"], list(r["vector"])) for r in got) == want


def test_scores_with_some_words_broadcast(spark, monkeypatch):
    """Beyond the bound, any share of the words broadcast: the plain sums, with
    carried columns, words the model lacks, empty rows and a null key."""
    from polarity.operators import logistic as L
    from polarity.operators import model as T
    rows = [(i, [f"w{(i * 5 + j * j) % 30}" for j in range(i % 13)] + ["the"] * 3 + ["odd"] * (i % 2), i % 2)
            for i in range(60)] + [(None, ["w1", "new"], None), (100, [], None), (101, None, None)]
    toks = spark.createDataFrame(rows, "id long, tokens array<string>, label int")
    m = T.fit_nb(toks.where("id < 40").select("tokens", F.col("label").alias("p")), "tokens", "p")
    weight = {r["word"]: r["weight"] for r in m.weights.collect()}
    want = {r[0]: (round(m.prior + sum(weight.get(w, 0.0) for w in r[1] or []), 9), r[2]) for r in rows}
    terms = T.term_table(toks.where("id is not null"), "id", "tokens", ("label",))
    counts = terms.where("word is not null").groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    monkeypatch.setattr(T, "ROWS_PER_TASK", 7)
    monkeypatch.setattr(L, "ROWS_PER_TASK", 7)
    for hot in (0, 5, 1000):
        monkeypatch.setattr(T, "HOT_WORDS", hot)
        monkeypatch.setattr(L, "HOT_WORDS", hot)
        for model in (m, T.NBModel(m.weights.drop("mass"), m.prior, m.n_words)):
            out = T.score_nb(toks, model, "id", max_broadcast_rows=0, carry=("label",)).collect()
            assert {r["id"]: (round(r["score"], 9), r["label"]) for r in out} == want
            assert len(out) == len(rows)
            out = T.score_terms(terms, model, "id", max_broadcast_rows=0).collect()
            assert {r["id"]: round(r["score"], 9) for r in out} == {
                k: v[0] for k, v in want.items() if k is not None}
        z = L._margins(terms, "id", m.weights.select("word", F.col("weight").alias("v")), counts,
                       m.n_words, 2_000_000, "z").collect()
        assert {r["id"]: round(r["z"] + m.prior, 9) for r in z} == {
            k: v[0] for k, v in want.items() if k is not None}


def test_nearest_blocks_hold_a_bounded_number_of_values(spark, monkeypatch, tmp_path):
    vocab = spark.createDataFrame([(i, f"w{i}", [float(i % 7), 1.0, i / 50]) for i in range(50)],
                                  "id int, word string, vector array<float>")
    q = spark.createDataFrame([(i, [float(i), 2.0, 0.5]) for i in range(9)], "qid long, vector array<double>")
    whole = sorted(N.nearest(q, vocab, k=3).collect())
    asked = []
    monkeypatch.setattr(N, "BLOCK_VALUES", 30)
    search = N._search
    monkeypatch.setattr(N, "_search", lambda root, blocks, *a: asked.append(blocks) or search(root, blocks, *a))
    got = sorted(N.nearest(q, vocab, k=3).collect())
    assert asked == [5] and [r[:4] for r in got] == [r[:4] for r in whole]


@pytest.mark.parametrize("how", [{}, {"max_broadcast_bytes": 0}])
def test_embedded_rows_of_one_id_come_together(spark, monkeypatch, how):
    """Else every row is written with its whole vector; 60 positions at a time."""
    monkeypatch.setattr(V, "SORTED_POSITIONS", 60)
    ids = [[(i * j) % 7 - 1 for j in range(i % 13)] for i in range(40)] + [None, [], [None, 2, None]]
    df = spark.createDataFrame([(k % 30, x) for k, x in enumerate(ids)], "id long, ids array<int>")
    vecs = spark.createDataFrame([(k, [float(k), 1.0]) for k in range(5)], "id int, vector array<float>")
    rows = V.embed(df.coalesce(1), vecs, "id", **how).collect()
    want = [(k % 30, p, [float(t), 1.0] if t in range(5) else [0.0, 0.0])
            for k, x in enumerate(ids) for p, t in enumerate(x or [])]
    assert sorted((r.id, r.pos, r.vector) for r in rows) == sorted(want)
    runs = 1 + sum(a.vector != b.vector for a, b in zip(rows, rows[1:]))
    assert runs <= 7 * (len(want) // 60 + 1)


def test_grams_of_neighbouring_places_come_together(spark, monkeypatch):
    """The widest first, by their first place; counts of repeated ones, of rows of one key
    apart, with blanks and nulls in tokens, a few tokens at a time."""
    monkeypatch.setattr(V, "GRAM_TOKENS", 11)
    docs = [["a", "b", "a", "b", "a", "b", "c"], [], None, ["x", "y"], ["a b", "c", "a", "b c", "d"],
            ["p", None, "q", "p", "q", None], ["z"] * 9, list("abcabcabd"), list("abcdefghijklm")]
    df = spark.createDataFrame([(k // 2, t) for k, t in enumerate(docs)], "id long, tokens array<string>")
    rows = V.ngram_features(df.coalesce(1), "id", widths=(2, 3, 5)).collect()
    want = []
    for k, t in enumerate(t or [] for t in docs):
        seen = {}
        for i in range(len(t)):
            for w in (5, 3, 2):
                if i + w <= len(t):
                    g = (w, " ".join(x for x in t[i:i + w] if x is not None))
                    seen[g] = seen.get(g, 0) + 1
        want += [(k // 2, w, g, n) for (w, g), n in seen.items()]
    assert [(r.id, r.width, r.gram, r.n) for r in rows] == want
