import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from polarity.llm import induced as I
from polarity.llm import suffix_dedup as S


def brute(texts, depth):
    """(n_bytes, n_removed, n_spans, sha256 of the rest) of every text."""
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i:i + depth] for d in data for i in range(len(d) - depth + 1))
    out = []
    for d in data:
        gone = np.zeros(len(d) + 2, bool)
        for i in range(len(d) - depth + 1):
            if seen[d[i:i + depth]] > 1:
                gone[i + 1:i + 1 + depth] = True
        spans = int((gone[1:] & ~gone[:-1]).sum())
        rest = bytes(b for b, g in zip(d, gone[1:]) if not g)
        out.append((len(d), int(gone.sum()), spans, hashlib.sha256(rest).hexdigest()))
    return out


def corpus(seed, n=60):
    rng = random.Random(seed)
    alphabet = "ab é\U0001F600the quick"
    make = lambda k: "".join(rng.choice(alphabet) for _ in range(k))
    passages = [make(rng.randrange(30, 120)) for _ in range(5)]
    texts = [None, "", "x", "ab" * 200, "Ther " * 60, "-" * 150 + "a", "-" * 150]
    for _ in range(n):
        parts = [rng.choice(passages + [make(rng.randrange(0, 50))] * 4)
                 for _ in range(rng.randrange(1, 6))]
        texts.append("".join(parts))
    texts += [texts[-1], texts[-2], texts[-1]]
    return texts


@pytest.mark.parametrize("seed,shard,hot,part", [
    (1, S.SHARD_BYTES, S.HOT_SEGMENTS, S.PART), (2, 2000, 1, 7), (3, 500, 3, 16), (4, 900, 1, 64)])
def test_against_brute_force(spark, monkeypatch, seed, shard, hot, part):
    """One shard; many; and anchors split into parts."""
    monkeypatch.setattr(S, "SHARD_BYTES", shard)
    monkeypatch.setattr(S, "HOT_SEGMENTS", hot)
    monkeypatch.setattr(S, "PART", part)
    texts = corpus(seed)
    rows = [(i, t, "w") for i, t in enumerate(texts)] + [(None, "own " * 30, "w")]
    df = spark.createDataFrame(rows, "doc_id long, text string, tk string").repartition(4)
    out = S.digests(df, depth=40, k=8).collect()
    got = {r.doc_id: tuple(r)[1:] for r in out}
    want = brute([r[1] for r in rows], 40)
    assert len(out) == len(rows)
    assert got == {r[0]: w for r, w in zip(rows, want)}


def test_repeated_rows_and_ids(spark):
    text = "one two three four five six seven eight nine ten"
    rows = [(1, text), (1, text), (2, "short"), (2, "short"), (3, text[5:] + " and more words here")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(tuple(r) for r in S.digests(df, depth=40, k=8).collect())
    assert got == sorted((r[0], *w) for r, w in zip(rows, brute([r[1] for r in rows], 40)))


def test_empty_table_and_columns(spark):
    df = spark.createDataFrame([], "doc_id long, text string, n_chars int, spans string")
    out = S.without_repeats(df)
    assert out.columns == df.columns and out.collect() == []


def test_readable_texts(spark):
    shared = "é" * 30
    rows = [(1, "a" + shared + "b", 32, "x"), (2, "\U0001F600" + shared + "éc", 33, None),
            (3, None, None, "y")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_chars int, tk string")
    out = {r.doc_id: r for r in S.without_repeats(df, depth=40, k=8).collect()}
    assert (out[1].text, out[1].n_chars) == ("ab", 2)
    assert out[2].text.endswith("c") and out[2].n_chars == len(out[2].text)
    assert out[3].text is None and out[3].tk == "y"


def test_pieces_of_long_texts(monkeypatch):
    """A text in pieces has the same windows as in one."""
    import pyarrow as pa
    text = "".join(random.Random(4).choice("abc") for _ in range(2000))
    col = pa.array([text], pa.string())

    def picked():
        out = {}
        for _, _, shift, _, (row, start, count, anchor, h) in S.text_runs(col, 40, 8):
            for s, c, a, x in zip(start, count, anchor, h):
                for w in range(int(c)):
                    out[int(shift[0]) + int(s) + w] = (int(shift[0]) + int(a), int(x))
        return out
    whole = picked()
    monkeypatch.setattr(S, "PIECE", 123)
    assert picked() == whole and len(whole) == 2000 - 40 + 1


@pytest.mark.parametrize("seed", range(40))
def test_induced_sorting(monkeypatch, seed):
    rng = random.Random(seed)
    monkeypatch.setattr(I, "CHUNK", rng.choice([3, 7, 64, 1 << 19]))
    monkeypatch.setattr(I, "SPILL", rng.choice([20, 1000, 1 << 22]))
    alphabet = rng.choice([b"a", b"ab", b"abc", b"the quick", bytes(range(0, 0x7F))])
    make = lambda n: bytes(rng.choice(alphabet) for _ in range(n))
    base = make(rng.choice([5, 30, 200]))
    segs = [b"".join(rng.choice([base, make(rng.randrange(60)), base[rng.randrange(len(base)):]])
                     for _ in range(rng.randrange(1, 4))) for _ in range(rng.choice([1, 2, 5, 12]))]
    depth = rng.choice([1, 2, 3, 5, 9, 16, 17, 40])
    text, starts = I.join_segments(segs)
    n = len(text) - I.MARGIN
    body = bytes(text[:n])
    seen = Counter(body[i:i + depth] for i in range(n - depth + 1))
    got = I.repeated(text, n, depth)
    for i in range(n - depth + 1):
        if I.SEP not in body[i:i + depth]:
            assert got[i] == (seen[body[i:i + depth]] > 1)


@pytest.mark.parametrize("seed", [0, 1, 6, 8, 12])
def test_induced_sorting_of_words(seed):
    """Substrings between left-most-S places that end where a round of eight
    bytes ends, beside longer ones with the same bytes."""
    rng = random.Random(seed)

    def word():
        return "".join(rng.choice("bc") + "fkps"[:rng.randrange(3, 5)]
                       + rng.choice(["me", "mec", "mcb", "meb"]))
    words = [word() for _ in range(12)]
    segs = ["".join(rng.choice(words) for _ in range(60)).encode() for _ in range(30)]
    depth = rng.choice([16, 24, 40])
    text, starts = I.join_segments(iter(segs))
    got = I.repeated(text, len(text) - I.MARGIN, depth)
    seen = Counter(s[i:i + depth] for s in segs for i in range(len(s) - depth + 1))
    for s, at in zip(segs, starts):
        n = len(s) - depth + 1
        assert [seen[s[i:i + depth]] > 1 for i in range(n)] == got[at:at + n].tolist()
