import zlib
from collections import defaultdict

import numpy as np
from tokenizers import Tokenizer

from polarity.llm import packing as P

TEXTS = ["", None, "  \n", "Hello, world!", "Café café İstanbul Σσς",
         "tab\there\x0bvt\x0cff\rcr nbsp em", "a" * 300, "it's we'll I'D 12345 x_y",
         "<|endoftext|> <|startoftext|>x", "a<|endoftext|>B<|ENDOFTEXT|> <|end", "word " * 5000, "你好世界 \U0001F600\U0001F600",
         "\x1cfs\x1dgs\x85nel ​zw"] + [f"doc {i} " * (i * 7 % 60) for i in range(60)]


def whole(texts):
    t = Tokenizer.from_file(P.tokenizer_path())
    return [t.encode(x or "", add_special_tokens=False).ids for x in texts]


def test_word_by_word_ids_equal_whole_text_ids():
    enc = P.WordEncoder(P.tokenizer_path())
    got = enc.encode([(t or "").encode() for t in TEXTS])
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == whole(TEXTS)


def check(rows, texts, capacity):
    ids = {i: t + [P.END_ID] for i, t in enumerate(whole(texts))}
    seqs, docs = defaultdict(list), defaultdict(list)
    for r in rows:
        docs[r.doc_id].append(r)
        seqs[r.sequence_id].append(r)
    assert set(docs) == set(ids)
    for d, pieces in docs.items():
        pieces.sort(key=lambda r: r.piece)
        assert [p.piece for p in pieces] == list(range(len(pieces)))
        at = 0
        for p in pieces:
            assert p.start == at and 0 < p.length <= capacity
            part = ids[d][at:at + p.length]
            assert p.ids_crc32 == zlib.crc32(np.asarray(part, "<u4").tobytes())
            at += p.length
        assert at == len(ids[d])
        assert all(p.length == capacity for p in pieces[:-1])
        assert len(pieces) == -(-len(ids[d]) // capacity)
    for pieces in seqs.values():
        pieces.sort(key=lambda r: r.offset)
        at = 0
        for p in pieces:
            assert p.offset == at
            at += p.length
        assert at <= capacity
    total = sum(map(len, ids.values()))
    return len(seqs), -(-total // capacity)


def test_round_trip_and_few_sequences(spark, monkeypatch):
    monkeypatch.setattr(P, "ITEMS_PER_TASK", 8)
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string").repartition(5)
    used, least = check(P.pack(df, capacity=128).collect(), TEXTS, 128)
    assert used <= least * 1.05 + 2


def test_unmergeable_items_stop(spark, monkeypatch):
    monkeypatch.setattr(P, "ITEMS_PER_TASK", 4)
    texts = ["x " * 70] * 40
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(6)
    used, _ = check(P.pack(df, capacity=128).collect(), texts, 128)
    assert used == 40


def test_ids_and_empty_table(spark):
    df = spark.createDataFrame([(1, "some words"), (None, "more")], "doc_id long, text string")
    rows = P.pack(df, with_ids=True).collect()
    assert len({r.sequence_id for r in rows}) == 1
    assert all(zlib.crc32(bytes(r.ids)) == r.ids_crc32 for r in rows)
    assert P.pack(df.where("false")).collect() == []


def test_best_fit_is_tight():
    lengths = np.array([70, 60, 40, 30, 58, 100])
    at, offset = P.best_fit(lengths, 100)
    assert int(at.max()) + 1 == 4
    for b in set(at):
        inside = sorted((offset[i], lengths[i]) for i in np.flatnonzero(at == b))
        assert inside[0][0] == 0 and all(o + n == p for (o, n), (p, _) in zip(inside, inside[1:]))
