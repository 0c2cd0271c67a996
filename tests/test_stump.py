"""The exact first split against brute force and against MLlib."""

import random

import pytest

from storelake.operators import sequence, stump


def rows(seed, n):
    g = random.Random(seed)
    return [(float(g.randint(0, 30)) + (10 if k % 3 else 0), g.choice([1.0, 2.0, 3.0, None]) if seed % 2 else g.choice([1.0, 2.0]),
             float(g.randint(0, n)), 7.0) for k in range(n)]


def brute(data, names):
    data = [r for r in data if None not in r]
    best = None
    for k, f in enumerate(names, 1):
        values = sorted({r[k] for r in data})
        for lo, hi in zip(values, values[1:]):
            left, right = [r[0] for r in data if r[k] <= lo], [r[0] for r in data if r[k] > lo]
            gain = sum(left) ** 2 / len(left) + sum(right) ** 2 / len(right) - sum(left + right) ** 2 / len(data)
            key = (-round(gain, 6), k, (lo + hi) / 2)
            if best is None or key < best[0]:
                best = key, (f, (lo + hi) / 2, len(left), len(right), sum(left) / len(left), sum(right) / len(right))
    return best and best[1]


@pytest.mark.parametrize("seed", range(4))
def test_best_split_equals_brute_force(spark, seed):
    data = rows(seed, 120)
    df = spark.createDataFrame(data, "y double, a double, b double, c double")
    r = stump.best_split(df, "y", ["a", "b", "c"]).first()
    want = brute(data, ["a", "b", "c"])
    assert (r.feature, r.threshold, r.left_rows, r.right_rows) == want[:4]
    assert (r.left_mean, r.right_mean) == pytest.approx(want[4:])


def test_no_split(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (None, 6.0)], "y double, a double")
    assert stump.best_split(df, "y", ["a"]).collect() == []
    assert stump.best_split(df.limit(0), "y", ["a"]).collect() == []


def test_running_sums_over_chunks(spark):
    df = spark.createDataFrame([(k % 2 == 0, k, 1 if k % 5 else None) for k in range(300)], "k boolean, v int, one int")
    c = sequence.chunk_rows(df, ["k"], ["v"], num_chunks=9)
    got = {r.v: r.sum_one for r in sequence.add_running_sums(c, ["v"], ["one"]).collect()}
    for parity in (0, 1):
        total = None
        for v in range(parity, 300, 2):
            total = (total or 0) + 1 if v % 5 else total
            assert got[v] == total


def test_sums_of_labels_are_exact(spark):
    from decimal import Decimal
    data = [(0.1, 1.0), (-0.3, 1.0), (-7.12345678, 2.0), (12345678.25, 2.0), (-1e9, 3.0)] * 3
    df = spark.createDataFrame(data, "y double, a double")
    best = stump.split_gains(df, "y", ["a"]).orderBy("threshold").collect()
    whole = sum((Decimal(repr(y)) for y, _ in data), Decimal(0))
    for r in best:
        left = sum((Decimal(repr(y)) for y, a in data if a < r.threshold), Decimal(0))
        assert r.feature == "a" and (r.left_mean, r.right_mean) == pytest.approx((float(left) / r.left_rows, float(whole - left) / r.right_rows), rel=1e-14)


def test_the_sums_add_longs(spark):
    from storelake.plans.registry import QUERIES
    seen = []
    real, stump.materialize = stump.materialize, lambda df, name: seen.append(df) or real(df, name)
    try:
        QUERIES["delay_best_split"](spark, "/root/testdata/sf0.001")
    finally:
        stump.materialize = real
    p = seen[0]._jdf.queryExecution().optimizedPlan().toString()
    assert "Expand" in p and "Generate" not in p
    assert not [x for x in p.splitlines() if "Aggregate" in x and "sum(cast" in x]
