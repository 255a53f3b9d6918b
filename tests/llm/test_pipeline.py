"""The pipeline against its stages' brute-force versions on a small corpus."""

import random

import corpus_pipeline as P
import pytest
import test_native as N
import test_ngram_join as J
import test_packing as K

from polarity.llm import toxicity as T


@pytest.fixture(scope="module")
def folder(tmp_path_factory, spark):
    rng = random.Random(10)
    word = lambda: "".join(rng.choice(["ba", "ko", "ti", "re", "lu"]) for _ in range(3))
    passage = " ".join(word() for _ in range(53))  # 370 bytes: under op9's depth
    rows, labels = [], []
    for i in range(160):
        ws = [word() for _ in range(rng.choice([8, 60, 150]))]
        if i % 8 == 0:
            ws[rng.randrange(len(ws))] = "grumpf"
        if i % 10 == 3:
            ws = ws + passage.split()
        text = " ".join(ws)
        if i % 9 == 5 and rows[-1][1]:
            text = rows[-1][1] + " more"
        rows.append((i, text, "en", f"s{i % 3}", len(text)))
        labels.append((i, 1, int("grumpf" in text)))
    rows += [(500, None, None, None, None), (501, "", "en", "s0", 0)]
    d = tmp_path_factory.mktemp("corpus")
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"
                          ).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(
        f"{d}/labels.parquet")
    return str(d)


def test_stages_match_brute_force(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    assert [n for n, _ in P.STAGES] == ["toxicity", "ngram_jaccard_join", "suffix_array_dedup",
                                        "source_mix", "best_fit_packing"]
    seen = [docs]
    for k, (name, stage) in enumerate(P.STAGES):
        stage(spark, seen[-1], folder).write.parquet(f"{tmp_path}/{k}")
        seen.append(spark.read.parquet(f"{tmp_path}/{k}"))
        if k < len(P.STAGES) - 1:
            assert seen[-1].columns == docs.columns
    rows = [[tuple(r) for r in s.collect()] for s in seen]
    key = lambda r: (r[0], r[1] or "")
    # toxicity: what scores below the limit stays as it is
    import pyarrow as pa
    model = T.train(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    score, _ = T.score_texts(model, pa.array([r[1] for r in rows[0]], pa.string()))
    assert sorted(rows[1], key=key) == sorted((r for r, s in zip(rows[0], score) if s < 0.5), key=key)
    assert sum("grumpf" in (r[1] or "") for r in rows[1]) <= 1
    # near duplicates: the smallest id of each component stays
    comp = J.brute([(r[0], r[1]) for r in rows[1]])
    assert {r[0] for r in rows[2]} == {c for _, _, c in comp}
    # repeats: texts are what the removal leaves
    import test_suffix_dedup as D
    left = D.brute([r[1] for r in rows[2]], P.REPEATED_BYTES)
    texts = {r[0]: r[1] for r in rows[3]}
    import hashlib
    for r, (_, removed, _, sha) in zip(rows[2], left):
        assert hashlib.sha256((texts[r[0]] or "").encode()).hexdigest() == sha
    assert sum(x[1] for x in left) > 0
    # the mix: words per source meet the targets
    size, taken = {}, {}
    for r in rows[3]:
        size[r[3]] = size.get(r[3], 0) + len(N.words(r[1]))
    for r in rows[4]:
        taken[r[3]] = taken.get(r[3], 0) + len(N.words(r[1]))
    want = N.brute_targets(size)
    assert all(abs(taken.get(s, 0) - want[s]) <= 0.5 + 1e-6 for s in size)
    # packing: every token of every document, in few sequences
    ids = [sum(K.whole([r[1]]), []) + [0] for r in rows[4]]
    total, lengths = sum(map(len, ids)), [r[3] for r in rows[5]]
    assert sum(lengths) == total
    assert len({r[5] for r in rows[5]}) <= -(-total // 2048) + 2


def test_run_and_no_documents(spark, folder, tmp_path):
    assert P.run(spark, folder).count() > 0
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    docs.where("false").write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{folder}/labels.parquet").write.parquet(f"{tmp_path}/labels.parquet")
    assert P.run(spark, str(tmp_path)).collect() == []
