"""Cover-tree Lloyd against plain loops over whole numbers."""

import hashlib
import math

import numpy as np
import pytest

from polarity.llm import vector_codes as V


def brute(rows, parts=4, entries=256, rounds=4):
    """rows of (vec_id, vector, label), ids unique -> {vec_id: (code, error, label_error, sha)}."""
    kept = {i: ([math.floor(1024 * float(np.float32(x))) for x in v], lab) for i, v, lab in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)}
    longest = max((len(v) for v, _ in kept.values()), default=0)
    w = -(-longest // parts)
    cut = {i: [(v + [0] * (parts * w - len(v)))[p * w:(p + 1) * w] for p in range(parts)]
           for i, (v, _) in kept.items()}
    ids = sorted(cut)
    books = [[list(cut[i][p]) for i in ids[:entries]] for p in range(parts)]

    def best(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), e) for e, c in enumerate(book))
    for _ in range(rounds):
        for p in range(parts):
            groups = {}
            for i in ids:
                groups.setdefault(best(cut[i][p], books[p])[1], []).append(cut[i][p])
            for e, xs in groups.items():
                books[p][e] = [sum(col) // len(xs) for col in zip(*xs)]
    sha = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    found = {i: [best(cut[i][p], books[p]) for p in range(parts)] for i in ids}
    error = {i: sum(d for d, _ in f) for i, f in found.items()}
    per = {}
    for i in ids:
        per[kept[i][1]] = per.get(kept[i][1], 0) + error[i]
    return {i: ("".join(f"{e:02x}" for _, e in f), error[i], per[kept[i][1]], sha)
            for i, f in found.items()}


def frame(spark, rows, parts=1):
    return spark.createDataFrame([(i, v, lab, "x") for i, v, lab in rows],
                                 "vec_id long, embedding array<float>, label int, code string"
                                 ).repartition(parts)


def corpus(n, seed=1, dim=12):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(5, dim))
    v = centres[rng.integers(0, 5, n)] + rng.normal(scale=0.05, size=(n, dim))
    rows = [(i, [float(np.float32(x)) for x in v[i]], None if i % 7 == 0 else i % 3)
            for i in range(n)]
    rows += [(1000 + i, rows[3][1], 2) for i in range(60)]                  # one vector many times
    rows += [(5000, None, 1), (5001, [1.0] * 11 + [None], 1), (5002, [float("nan")] * dim, 1),
             (5003, [float("inf")] + [0.0] * (dim - 1), 1), (5004, [-0.0] * dim, None),
             (-3, [-1.5] * dim, 1), (5005, [0.25], 1)]
    return rows


@pytest.mark.parametrize("entries,block", [(256, 4096), (9, 40)])
def test_codes_equal_brute_force(spark, monkeypatch, entries, block):
    monkeypatch.setattr(V, "BLOCK", block)
    rows = corpus(300)
    out = V.codes(frame(spark, rows, 3), entries=entries)
    assert out.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    got = {r[0]: tuple(r)[1:] for r in out.collect()}
    assert got == brute(rows, entries=entries)


def test_trees_cover_and_give_whole_subtrees():
    rng = np.random.default_rng(2)
    points = (rng.integers(0, 4, (3000, 1)) * 5000 + rng.integers(-40, 40, (3000, 6))).astype(np.int64)
    tree = V.cover_tree(points)
    sums = V.node_sums(points, tree)
    assert sorted(tree["order"]) == list(range(3000))
    for k in range(len(tree["start"])):
        rows = tree["order"][tree["start"][k]:tree["end"][k]]
        gap = np.sqrt(((points[rows] - points[rows[0]]) ** 2).sum(1))
        assert gap.max() <= tree["radius"][k] and (points[rows].sum(0) == sums[k]).all()
        below = range(tree["first"][k], tree["last"][k])
        if below:
            assert sum(tree["end"][c] - tree["start"][c] for c in below) == len(rows)
            heads = points[tree["order"][tree["start"][list(below)]]]
            apart = np.sqrt(V.squared(heads, heads).astype(float))[~np.eye(len(heads), dtype=bool)]
            assert len(heads) == 1 or apart.min() > tree["radius"][k] / 2
    centres = points[::300]
    nodes, at, singles, single_at = V.assign(points, tree, centres)
    want = ((points[:, None] - centres[None]) ** 2).sum(2).argmin(1)
    seen = np.full(3000, -1)
    for node, e in zip(nodes, at):
        rows = tree["order"][tree["start"][node]:tree["end"][node]]
        assert (seen[rows] == -1).all()
        seen[rows] = e
    assert (seen[singles] == -1).all()
    seen[singles] = single_at
    assert (seen == want).all()
    # four far groups: most points go with their subtree
    far = points[[np.flatnonzero(points[:, 0] // 2500 == 2 * g)[0] for g in (0, 1)]]
    assert len(V.assign(points, tree, far)[2]) < 300


def test_large_numbers_are_exact():
    rng = np.random.default_rng(3)
    points = rng.integers(-V.LARGEST, V.LARGEST, (40, 5))
    d = V.squared(points, points[:7])
    want = [[sum((int(a) - int(b)) ** 2 for a, b in zip(p, c)) for c in points[:7]] for p in points]
    assert d.tolist() == want


def test_ties_nulls_and_empty(spark):
    same = [(i, [0.5] * 4, None) for i in range(5)]
    got = [tuple(r) for r in V.codes(frame(spark, same)).collect()]
    assert {g[1:4] for g in got} == {("00000000", 0, 0)} and len(got) == 5
    assert V.codes(frame(spark, [(1, None, 1)])).collect() == []
    assert V.codes(frame(spark, same).where("false")).collect() == []
    short = V.codes(frame(spark, [(1, [], 1), (None, [1.0, 2.0], 1), (2, [3.0], None)])).collect()
    assert sorted((r[0] is None, r[0] or 0, r[2]) for r in short) == [
        (False, 1, 0), (False, 2, 0), (True, 0, 0)]
    with pytest.raises(Exception, match="too large"):
        V.codes(frame(spark, [(1, [1e30, 0.0], 1)])).collect()
