"""The trie against plain sequences of turns."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest

from polarity.llm import prefix_trie as P


def brute(rows):
    """rows of (conv_id, turn, role, text) -> node tuples of the contract."""
    by = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            by[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(r, t) for _, _, r, t in sorted(v)] for c, v in by.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        built[c] = tuple(own.get(c - c % 20, [])[:h] + turns[h:])
    members, ends = defaultdict(list), defaultdict(list)
    for c in sorted(built):
        for d in range(len(built[c]) + 1):
            members[built[c][:d]].append(c)
        ends[built[c]].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        leaves[node] = sum(leaves[k] for k in children[node]) or 1
        words = len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        saved[node] = (len(members[node]) - 1) * words + sum(saved[k] for k in children[node])
    return sorted((m[0], len(node), members[node[:-1]][0] if node else None, len(m),
                   len(children[node]), leaves[node], saved[node],
                   hashlib.sha256(",".join(map(str, ends[node])).encode()).hexdigest())
                  for node, m in members.items())


def corpus(seed, n=150, long=40):
    rng = random.Random(seed)
    say = lambda: rng.choice(["", None, "yes", "no way", "tell me more please", "a b c\td\n e"])
    rows = []
    for c in rng.sample(range(400), n):
        start = rng.choice([0, 0, 7])
        turns = [(rng.choice(["user", None]), say()) for _ in range(rng.choice([1, 2, 3, 5, 8]))]
        if c % 5 == 0:  # copies of one conversation
            turns = [("user", "hi"), ("assistant", "well hello there")] * 3 + turns[:1]
        rows += [(c, start + i, r, t) for i, (r, t) in enumerate(turns)]
    rows += [(500, i, "user", f"turn {i % 3}") for i in range(long)]          # a hot conversation
    rows += [(None, 0, "user", "lost"), (501, None, "user", "b"), (501, None, "user", "a"),
             (501, 3, "x", "y"), (501, 3, "x", "y"), (9, None, None, None), (2 ** 61, 0, "u", "v")]
    rng.shuffle(rows)
    return rows


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(*r, "more", 1) for r in rows],
                                 "conv_id long, turn long, role string, text string, words string, "
                                 "depth int").repartition(parts)


def found(df):
    key = lambda r: (r[0], r[1])
    return sorted(map(tuple, P.trie(df).collect()), key=key)


@pytest.mark.parametrize("seed,piece,children", [(1, 4096, 10_000), (2, 3, 2)])
def test_nodes_equal_brute_force(spark, monkeypatch, seed, piece, children):
    monkeypatch.setattr(P, "PIECE", piece)
    monkeypatch.setattr(P, "CHILDREN", children)
    rows = corpus(seed)
    assert found(frame(spark, rows)) == brute(rows)


def test_one_conversation_over_many_partitions(spark):
    """Its turns are dealt over all range partitions and composed again."""
    rows = [(20, i, "user", f"t {i % 11} {i // 300}") for i in range(3000)] + [
        (21 + k, i, "user", f"t {i % 11} 0") for k in range(5) for i in range(4)]
    df = frame(spark, rows)
    turns = P.stored_turns(df, 0)
    assert turns.select("conv_id", "place").distinct().count() == len(rows)
    assert found(df) == brute(rows)


def test_scan_equals_definition():
    rng = np.random.default_rng(4)
    conv = np.sort(rng.integers(0, 6, 200))
    h1, h2 = rng.integers(-2 ** 63, 2 ** 63 - 1, (2, 200))
    base = P.bases(0)
    t = P.digests(h1, h2)
    for cut in (1, 7, 64, 200):
        scan, place, prints = P.Scan(base), [], []
        for a in range(0, 200, cut):
            n, _, x = scan.add(conv[a:a + cut], h1[a:a + cut], h2[a:a + cut])
            place += n.tolist()
            prints.append(np.array(x))
        prints = np.concatenate(prints, axis=1)
        want = {}
        for i in range(200):
            n, h = want.get(conv[i], (0, [0] * 4))
            n += 1
            h = [(a + int(t[k][i]) * pow(base[k], n, P.PRIMES[k])) % P.PRIMES[k]
                 for k, a in enumerate(h)]
            want[conv[i]] = (n, h)
            assert (place[i], prints[:, i].tolist()) == (n, h)
        ends = {c: (n, list(h)) for c, n, *h in scan.ends()}
        assert ends == {c: want[c] for c in (conv[0], conv[-1])}


def test_ambiguous_fingerprints_are_noticed(spark, monkeypatch):
    """Digests of a few bits: equal fingerprints of different turns."""
    df = frame(spark, corpus(3))
    real = P.digests
    monkeypatch.setattr(P, "PRIMES", (2, 2, 2, 2))
    monkeypatch.setattr(P, "bases", lambda salt: [1, 1, 1, 1])
    with pytest.raises(RuntimeError, match="ambiguous"):
        P.trie(df)
    assert real is P.digests


def test_empty_and_turnless(spark):
    df = frame(spark, [(1, 0, "user", "x")])
    assert P.trie(df.where("false")).collect() == []
    assert P.trie(frame(spark, [(None, 0, "user", "x")])).collect() == []
    rows = [(c, 0, "user", "x y") for c in range(1, 18)]  # bases absent: some are turnless
    assert found(frame(spark, rows)) == brute(rows)
