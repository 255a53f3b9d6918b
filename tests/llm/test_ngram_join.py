import random
import re

import pytest

from polarity.llm import ngram_join as J
from polarity.llm.components import components


def brute(docs, width=J.WIDTH):
    """(doc_id -> (n, component)) by comparing every pair."""
    sets = {}
    for i, (doc, text) in enumerate(docs):
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        ws = re.findall(r"[^\x20\x09-\x0D]+", low)
        sets[i] = ({tuple(ws[k:k + width]) for k in range(len(ws) - width + 1)}
                   if len(ws) >= width else {tuple(ws)} if ws else set())
    parent = list(range(len(docs)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a in sets:
        for b in range(a):
            both, union = len(sets[a] & sets[b]), len(sets[a] | sets[b])
            if sets[a] and sets[b] and 100 * both >= J.PERCENT * union:
                parent[find(a)] = find(b)
    least = {}
    for i, (doc, _) in enumerate(docs):
        r = find(i)
        if doc is not None:
            least[r] = min(least.get(r, doc), doc)
    return sorted(((d, len(sets[i]), least.get(find(i)) if sets[i] else d)
                   for i, (d, _) in enumerate(docs)), key=repr)


def got(spark, docs):
    df = spark.createDataFrame(docs, "doc_id long, text string")
    return sorted((tuple(r) for r in J.join_components(df).collect()), key=repr)


def corpus(seed=5, groups=6, copies=12):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(300)]
    passage = [rng.choice(vocab) for _ in range(40)]
    docs, i = [], 0
    for g in range(groups):
        base = [rng.choice(vocab) for _ in range(rng.choice([5, 30, 60, 150]))]
        if g % 2:
            base = passage + base
        for _ in range(copies):
            words = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 3])):
                words[rng.randrange(len(words))] = rng.choice(vocab)
            docs.append((i * 7 % 1000, " ".join(words)))
            i += 1
    docs += [(2000, None), (2001, ""), (2002, " \n\t"), (2003, "one"), (2004, "ONE"),
             (2005, "one two"), (2006, "one  two\n"), (None, "one"), (2007, "a b c d"),
             (2007, "a b c d"), (2008, "x" * 5000), (2009, "Été été")]
    return docs


def test_against_brute_force(spark):
    docs = corpus()
    assert got(spark, docs) == brute(docs)


def test_blocks_smaller_than_lists(spark, monkeypatch):
    """Long lists dealt into many blocks lose no link."""
    monkeypatch.setattr(J, "BLOCK", 3)
    monkeypatch.setattr(J, "PAIRS", 4)
    docs = corpus(seed=9, groups=4, copies=20)
    assert got(spark, docs) == brute(docs)


def test_no_rows(spark):
    assert got(spark, []) == []


def test_one_of_each_keeps_columns(spark):
    rows = [(3, "a b c d e", "x"), (1, "a b c d e", "y"), (1, "a b c d e", "y"), (7, None, "z"),
            (8, "", None), (9, "p q r s t u", "w")]
    df = spark.createDataFrame(rows, "doc_id long, text string, cls string")
    out = J.one_of_each(df)
    assert out.columns == df.columns
    assert sorted(map(tuple, out.collect()), key=repr) == sorted(
        [(1, "a b c d e", "y"), (7, None, "z"), (8, "", None), (9, "p q r s t u", "w")], key=repr)


def test_one_of_each_decides_by_text(spark):
    a, near, b = " ".join(f"w{i}" for i in range(60)), " ".join(f"w{i}" for i in range(62)), "p q r s t u v"
    kept = lambda rows: sorted(
        map(tuple, J.one_of_each(spark.createDataFrame(rows, "doc_id long, text string, _id string")
                                 ).collect()), key=repr)
    # an unrelated text under a dropped id stays; two near copies under one id do not
    assert kept([(1, near, "x"), (5, a, "y"), (5, b, "z")]) == [(1, near, "x"), (5, b, "z")]
    assert len(kept([(7, a, "x"), (7, near, "y"), (7, b, "z")])) == 2
    # rows without an id: one of each component, none before a row with one
    assert len(kept([(None, a, "x"), (None, near, "y"), (None, b, "z")])) == 2
    assert kept([(None, a, "x"), (9, near, "y")]) == [(9, near, "y")]
    # equal rows are one, rows without words all stay
    assert len(kept([(1, a, "x")] * 3 + [(1, a, "y"), (2, "", "x"), (2, "", "x"), (None, None, None)])) == 4


@pytest.mark.parametrize("links", [
    [(b"a", b"b"), (b"b", b"c"), (b"d", b"e"), (b"x", b"x"), (b"c", b"a")],
    [(bytes([i]), bytes([i + 1])) for i in range(60)],
])
def test_components(spark, links):
    df = spark.createDataFrame([(bytearray(u), bytearray(v)) for u, v in links],
                               "u binary, v binary")
    got = {bytes(r[0]): bytes(r[1]) for r in components(df).collect()}
    parent = {}
    for u, v in links:
        if u != v:
            a, b = parent.setdefault(u, {u}), parent.setdefault(v, {v})
            if a is not b:
                a |= b
                for n in b:
                    parent[n] = a
    assert got == {n: min(s) for n, s in parent.items()}
