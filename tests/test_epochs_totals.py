"""Permuted epochs, running totals over partitions, unbounded histograms."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from polarity.operators import epochs as E
from polarity.operators.metrics import exponential_histogram
from polarity.operators.ordering import running_total


@pytest.mark.parametrize("n", [1, 2, 3, 10, 97, 1000, 12_345])
def test_permutation_is_a_bijection(n):
    a, b = E.grid(n)
    assert a * b >= n and a * b - n < max(a, b)
    seen = set()
    for epoch in range(3):
        keys = E.round_keys("s", epoch)
        cells = E._pass(np.arange(a * b, dtype=np.int64), keys, a, b)
        assert sorted(cells.tolist()) == list(range(a * b))
        x = E._pass(np.arange(n, dtype=np.int64), keys, a, b)
        for _ in range(E.walks(n, keys) - 1):
            x = np.where(x < n, x, E._pass(x, keys, a, b))
        assert sorted(x.tolist()) == list(range(n))
        seen.add(tuple(x.tolist()))
    assert n < 50 or len(seen) == 3


def test_orders_look_random():
    n, keys = 10_000, E.round_keys(7, 3)
    a, b = E.grid(n)
    x = E._pass(np.arange(n, dtype=np.int64), keys, a, b)
    assert abs(np.corrcoef(np.arange(n), x)[0, 1]) < 0.05
    assert (np.diff(x) > 0).mean() == pytest.approx(0.5, abs=0.05)


def test_epoch_batches(spark):
    df = spark.range(1003).withColumnRenamed("id", "k")
    out = E.epoch_batches(df, 10, 10, seed=3, id_cols="k")
    rows = out.collect()
    assert len(rows) == 10_030
    orders = {}
    for r in rows:
        orders.setdefault(r.epoch, {})[10 * r.batch_id + r.slot] = r.k
    assert all(sorted(o) == list(range(1003)) and sorted(o.values()) == list(range(1003))
               for o in orders.values())
    assert len({tuple(v for _, v in sorted(o.items())) for o in orders.values()}) == 10
    again = E.epoch_batches(df.repartition(7), 10, 10, seed=3, id_cols="k")
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, rows))
    assert E.epoch_batches(df, 10, 10, 3, "k", drop_last=True).count() == 10_000
    plan = E.epoch_batches(df, 10, 10, 3, "k")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert E.epoch_batches(df.where("false"), 10, 2, 3, "k").collect() == []


@pytest.mark.parametrize("parts", [1, 7])
def test_running_totals(spark, parts):
    rng = random.Random(4)
    rows = [(rng.choice(["hot", "hot", "hot", "a", "b", None]), i, rng.choice([None, 1, 2, -3]))
            for i in range(900)]
    df = spark.createDataFrame(rows, "g string, i long, x long").repartition(5)
    out = running_total(df, ["i"], {"t": "x"}, ["g"],
                        num_partitions=parts)
    assert out.columns == ["g", "i", "x", "t"]
    got = {r.i: r.t for r in out.collect()}
    at, want = Counter(), {}
    for g, i, x in rows:
        at[g] += x or 0
        want[i] = at[g]
    assert got == want
    whole = {r.i: r.t for r in running_total(df, ["i"], {"t": "x"}, num_partitions=parts).collect()}
    assert whole == dict(enumerate(np.cumsum([x or 0 for _, _, x in rows]).tolist()))
    assert running_total(df.where("false"), ["i"], {"t": "x"}, ["g"]).collect() == []


def test_exponential_histogram(spark):
    edges = [s * v for v in [2.0 ** k for k in range(-60, 60)] + [5e-324, 1.7e308] for s in (1, -1)]
    near = [math.nextafter(v, d) for v in edges for d in (0, math.copysign(math.inf, v))]
    rng = random.Random(2)
    xs = edges + near + [0.0, -0.0, 1 / 3, math.inf, -math.inf, math.nan] + [
        rng.gauss(0, 10 ** rng.uniform(-6, 6)) for _ in range(500)]
    xs = [x for x in xs if not (math.isinf(x) and x in near)]
    df = spark.createDataFrame([("a", xs[:300]), ("a", xs[300:]), ("b", [None, 1.0]), ("c", None)],
                               "role string, vector array<double>")
    rows = exponential_histogram(df, by=["role"], sub=4).collect()
    assert sum(r.n for r in rows) == len(xs) + 1
    got = {(r.sign, r.exponent, r.sub_bucket): r for r in rows if r.role == "a"}
    want = Counter()
    for x in xs:
        if math.isnan(x):
            want[2, None, None] += 1
        elif math.isinf(x):
            want[int(math.copysign(3, x)), None, None] += 1
        elif x == 0:
            want[0, None, None] += 1
        else:
            m, e = math.frexp(abs(x))
            want[int(math.copysign(1, x)), e - 1, int((2 * m - 1) * 4)] += 1
            r = got[int(math.copysign(1, x)), e - 1, int((2 * m - 1) * 4)]
            assert r.lo <= x <= r.hi
    assert {k: r.n for k, r in got.items()} == want
    with pytest.raises(ValueError):
        exponential_histogram(df, sub=3)
