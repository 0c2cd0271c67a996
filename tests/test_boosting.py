"""Boosted trees over packed rows against MLlib's."""

import numpy as np
import pytest

from conftest import SF_MID
from storelake.operators import boosting
from storelake.operators import models as m
from storelake.plans import registry
from storelake.sources.sinks import materialize


def table(spark, spec):
    df = registry._delay_table(spark, SF_MID) if spec is m.DELAY else registry._price_table(spark, SF_MID)
    key = ["order_id", *[c for c in df.columns if c != "order_id"]]
    return m.split(materialize(m.model_input(df, spec).repartition(3, "order_id").sortWithinPartitions(*key), "rows"), key="order_id")


def nodes(tree):
    def walk(n):
        if "Internal" not in n.getClass().getSimpleName():
            return [("leaf", n.prediction(), n.impurity(), n.impurityStats().count(), float(n.impurityStats().rawCount()))]
        s = n.split()
        at = s.threshold() if "Continuous" in s.getClass().getSimpleName() else tuple(s.leftCategories())
        return [((s.featureIndex(), at), n.prediction(), n.impurity(), n.gain())] + walk(n.leftChild()) + walk(n.rightChild())
    return walk(tree._java_obj.rootNode())


@pytest.mark.parametrize("spec", [m.DELAY, m.PRICE], ids=["delay", "price"])
def test_trees_equal_mllib(spark, spec):
    train, test = table(spark, spec)
    kw = {"max_iter": 12, "max_depth": 5}
    ours, theirs = m.fit(train, spec, **kw), m.pipeline(spec, **kw).fit(train)
    a, b = ours.stages[-1], theirs.stages[-1]
    assert a.getNumTrees == b.getNumTrees == 12 and a.treeWeights == b.treeWeights and a.numFeatures == b.numFeatures
    assert a.getMaxDepth() == a.trees[0].getMaxDepth() == 5
    alike = 0
    for x, y in ((nodes(one), nodes(two)) for one, two in zip(a.trees, b.trees)):
        other = next((k for k, (p, q) in enumerate(zip(x, y)) if p[0] != q[0]), None)
        for p, q in zip(x[:other], y[:other]):
            assert p[1:] == pytest.approx(q[1:], rel=1e-6, abs=1e-3)
        if other is not None:       # splits of the same gain, of which MLlib takes what rounding favours
            assert x[other][1:] == pytest.approx(y[other][1:], rel=1e-9)
            break
        alike += 1
    assert alike >= 3
    p, q = [[r[0] for r in x.transform(test).orderBy(*train.columns).select("prediction").collect()] for x in (ours, theirs)]
    assert len(p) > 1000 and sum(u != pytest.approx(v, rel=1e-9) for u, v in zip(p, q, strict=True)) <= len(p) // 50


def small(spark, rows):
    spec = m.ModelSpec(label="y", numeric=("a", "b"), categorical=("c",), required=("y",))
    return spec, spark.createDataFrame(rows, "y double, a double, b double, c string").repartition(1)


@pytest.mark.parametrize("rows", [
    [(5.0, float(k), 2.0, "x") for k in range(9)],                                        # nothing to learn
    [(float(k % 2), 1.0, 1.0, "xy"[k % 2]) for k in range(40)],                           # a category alone, pure children
    [(float(k // 3), float(-k), 0.0 if k % 2 else -0.0, None if k % 7 == 0 else "abcdef"[k % 6]) for k in range(300)],
    [(float(k), None if k % 5 == 0 else float("nan") if k % 7 == 0 else float(k % 11), float(k % 2), "x") for k in range(200)],
], ids=["flat", "category", "mixed", "missing"])
def test_edges_equal_mllib(spark, rows):
    spec, df = small(spark, rows)
    ours, theirs = m.fit(df, spec, max_iter=6), m.pipeline(spec, max_iter=6).fit(df)
    want = [r[0] for r in theirs.transform(df).select("prediction").collect()]
    assert [r[0] for r in ours.transform(df).select("prediction").collect()] == pytest.approx(want, rel=1e-9, abs=1e-12)


def test_all_rows_are_counted_once_in_few_bytes(spark, monkeypatch):
    """MLlib kept an object of some 200 bytes a row."""
    monkeypatch.setattr(boosting, "BLOCK_ROWS", 1000)
    train, _ = table(spark, m.DELAY)
    seen = {}
    held = lambda: spark.sparkContext._jsc.sc().getPersistentRDDs().size()
    before = held()
    real = boosting.packed_rows

    def keep(data, label, columns, bins, rows):
        codes, left, path = real(data, label, columns, bins, rows)
        blocks = codes.zip(left).collect()
        seen["rows"] = sum(len(y) for _, y in blocks if y is not None)
        seen["bytes"] = sum(c.nbytes + y.nbytes for c, y in blocks if y is not None)
        assert rows == seen["rows"] and all(c.shape[1] == len(y) for c, y in blocks if y is not None)
        return codes, left, path
    monkeypatch.setattr(boosting, "packed_rows", keep)
    model = m.fit(train, m.DELAY, max_iter=3)
    want = train.na.drop(subset=[c for c in m.DELAY.numeric]).count()
    assert seen["rows"] == want and seen["bytes"] <= 40 * want
    root = model.stages[-1].trees[2]._java_obj.rootNode()
    assert root.impurityStats().rawCount() == want
    assert held() == before


def test_kept_split_number_divides_alike(spark):
    df = spark.range(500).withColumnRenamed("id", "order_id")
    for one, two in zip(m.split(df, key="order_id"), m.split(m.with_split_number(df, "order_id"), key="order_id")):
        assert sorted(r[0] for r in one.collect()) == sorted(r[0] for r in two.collect()) != []
    other = m.split(m.with_split_number(df, "order_id", seed=7), key="order_id")[0]
    assert sorted(r[0] for r in other.collect()) == sorted(r[0] for r in m.split(df, key="order_id")[0].collect())


def test_groups_hold_all_features_apart():
    g = np.random.default_rng(1)
    sizes = [32, 2, 7, 32, 32, 1, 26, 12, 512, 24]
    bins = boosting.Bins([None if n == 26 else np.arange(n - 1) + 0.0 for n in sizes], sizes)
    values = [g.integers(0, n, 500) for n in sizes]
    codes = bins.packed([v.astype(float) for v in values])
    labels = g.normal(size=500)
    sums = boosting.Sums(bins, 1)
    sums.add(codes, labels, [None])
    got = sums.result()[0][0]
    for f, v in enumerate(values):
        part = got[:, bins.starts[f]:bins.starts[f + 1]]
        assert np.array_equal(part[0], np.bincount(v, minlength=sizes[f]))
        assert part[1] == pytest.approx(np.bincount(v, labels, sizes[f]))
        left = g.random(sizes[f]) < 0.5
        group, right = bins.goes_right(f, left)
        assert np.array_equal(right[codes[group]], ~left[v])
