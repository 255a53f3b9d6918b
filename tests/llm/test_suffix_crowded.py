"""Repeated bytes that very many texts share, at the edges of a passage."""

import random

import test_suffix_dedup as D

from polarity.llm import suffix_dedup as S


def corpus(n=300):
    """A passage longer than what a part's windows share, in a third of the
    texts, between letters of which some are alike by chance."""
    rng = random.Random(12)
    make = lambda k: "".join(rng.choice("abcdefgh") for _ in range(k))
    passage = make(60)
    texts = [make(25) + passage + make(25) for _ in range(n)]
    texts += [make(rng.randrange(30, 110)) for _ in range(2 * n)]
    return texts + texts[:3] + [None, "", passage]


def test_no_task_gets_all_parts_of_a_key(spark, monkeypatch):
    monkeypatch.setattr(S, "HOT_SEGMENTS", 20)
    monkeypatch.setattr(S, "PART", 4)
    monkeypatch.setattr(S, "SHARD_BYTES", 1000)
    real = S._shard

    def limited(depth):
        sort = real(depth)

        def run(batches):
            held = list(batches)
            rows = sum(map(len, held))
            assert rows <= 150, f"{rows} parts in one task"
            yield from sort(iter(held))
        return run
    monkeypatch.setattr(S, "_shard", limited)
    texts = corpus()
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = {r.doc_id: tuple(r)[1:] for r in S.digests(df, depth=40, k=8).collect()}
    want = D.brute(texts, 40)
    assert got == dict(enumerate(want))
    assert sum(w[1] > 0 for w in want) >= 300


def test_neighbouring_ranges_reach_a_text_as_one(spark, monkeypatch):
    """Windows that are counted one by one gave a text a range each."""
    monkeypatch.setattr(S, "HOT_SEGMENTS", 20)
    monkeypatch.setattr(S, "PART", 4)
    texts = corpus()
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    found = {bytes(r.tk).hex(): [tuple(s) for s in r.spans or []]
             for r in S.repeated_runs(df, 40, 8).collect()}
    assert sum(map(len, found.values())) >= 290
    for spans in found.values():
        assert all(x[1] < y[0] for x, y in zip(spans, spans[1:]))
    for t, want in zip(texts, D.brute(texts, 40)):
        spans = found.get(D.hashlib.md5((t or "").encode()).hexdigest(), [])
        assert not spans or (len(spans), sum(b - a for a, b in spans)) == (want[2], want[1])
