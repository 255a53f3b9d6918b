"""Elias-Fano sequences, shards and the round trip of whole tables."""

import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from test_packing import TEXTS, whole

from polarity.llm import elias_fano as E


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 50), st.integers(0, 2 ** 63)), max_size=400), st.data())
def test_sequences(values, data):
    values.sort()
    raw = E.EliasFano.encode(np.array(values, np.uint64))
    ef = E.EliasFano(raw + b"more")
    assert (ef.n, ef.size) == (len(values), len(raw))
    assert ef.slice(0, len(values)).tolist() == values
    assert [ef.select(i) for i in range(len(values))] == values
    a = data.draw(st.integers(0, len(values)))
    b = data.draw(st.integers(a, len(values)))
    assert ef.slice(a, b).tolist() == values[a:b]


def test_sequences_are_small_and_ascend():
    rng = np.random.default_rng(1)
    bounds = np.cumsum(rng.integers(1, 800, 200_000)).astype(np.uint64)
    raw = E.EliasFano.encode(bounds)
    mean = int(bounds[-1]) / len(bounds)
    assert 8 * len(raw) < len(bounds) * (2 + np.log2(mean) + 32 / E.SAMPLE + 0.1)
    assert (E.EliasFano(raw).slice(123_456, 123_999) == bounds[123_456:123_999]).all()
    with pytest.raises(ValueError):
        E.EliasFano.encode(np.array([2, 1], np.uint64))


def test_one_shard(tmp_path, monkeypatch):
    monkeypatch.setattr(E, "READ_BYTES", 64)
    rng = np.random.default_rng(5)
    docs = [(None, 3), (None, 1), (-9, 1), (-9, 500), (4, 1), (2 ** 60, 40)] + [
        (2 ** 60 + i, int(n)) for i, n in enumerate(rng.integers(1, 30, 300))]
    for width, top in ((2, 1 << 16), (4, 1 << 32)):
        w = E.ShardWriter(str(tmp_path), width)
        ids = [rng.integers(0, top, n).astype("<u4") for _, n in docs]
        for (d, _), x in zip(docs, ids):
            w.add(d, x.tobytes())
        uri, n_docs, n_ids = w.close()
        s = E.Shard(uri)
        assert (n_docs, n_ids) == (len(docs), sum(n for _, n in docs))
        at = 0
        for i, ((d, n), x) in enumerate(zip(docs, ids)):
            doc, start, got = s.document(i)
            assert (doc, start, got.tolist()) == (d, at, x.tolist())
            at += n
        blocks = list(s.blocks())
        assert [d for b in blocks for d in b[0]] == [d for d, _ in docs]
        assert np.concatenate([b[2] for b in blocks]).tolist() == np.concatenate(ids).tolist()
        s.close()
    assert E.ShardWriter(str(tmp_path), 2).close() is None
    (tmp_path / "other").write_bytes(b"x" * 100)
    with pytest.raises(ValueError):
        E.Shard(str(tmp_path / "other"))


def brute(rows, end):
    out, at = [], 0
    for (d, _), ids in zip(rows, whole([t for _, t in rows])):
        ids = ids + [end]
        out.append((d, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


@pytest.mark.parametrize("shards,end", [(1, 2), (7, 70_000)])
def test_round_trip(spark, tmp_path, shards, end):
    rows = [(3 * i - 50, t) for i, t in enumerate(TEXTS)]
    df = spark.createDataFrame([(d, t, "x", 0) for d, t in reversed(rows)],
                               "doc_id long, text string, start string, part int").repartition(5)
    index = E.write(df, str(tmp_path / "ids"), shards=shards, end_id=end)
    out = E.read(index, with_ids=True)
    got = sorted(map(tuple, out.collect()))
    assert [g[:4] for g in got] == brute(rows, end)
    assert all(zlib.crc32(g[4]) == g[3] and len(g[4]) == 4 * g[2] for g in got)
    assert index.agg({"n_docs": "sum"}).first()[0] == len(rows)


def test_repeated_and_null_ids_and_empty(spark):
    rows = [(None, "b"), (None, None), (5, "one two"), (5, "one two"), (5, "three"), (7, "")]
    df = spark.createDataFrame(rows * 40, "doc_id long, text string")
    got = sorted(E.read(E.write(df, shards=6)).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == [None] * 80 + [5] * 120 + [7] * 40
    at = 0
    for r in got:
        assert r.start == at
        at += r.n_tokens
    want = sorted(len(i) + 1 for i in whole([t for _, t in rows] * 40))
    assert sorted(r.n_tokens for r in got) == want
    assert E.read(E.write(df.where("false"))).collect() == []


def test_query(spark, tmp_path):
    from polarity.llm.queries import op12_token_ids
    rows = [(i, t) for i, t in enumerate(TEXTS)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(map(tuple, op12_token_ids(spark, str(tmp_path)).collect()))
    assert got == brute(rows, 2)
