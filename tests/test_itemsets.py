"""Level-wise itemsets against all subsets, and against FP-growth."""

import itertools
import math
import random
from collections import Counter

import pytest

from storelake.operators import baskets as B
from storelake.operators import itemsets as I


def frame(spark, rows):
    return spark.createDataFrame(list(enumerate(rows)), "order_id long, items array<string>")


def baskets(seed, n, items="abcdefgh"):
    g = random.Random(seed)
    out = []
    for _ in range(n):
        b = {x for x in items if g.random() < 0.12 + 0.05 * items.index(x)}
        out.append(sorted(b | ({"a", "b", "c", "d"} if g.random() < 0.15 else set())))
    return [b for b in out if b]


def all_sets(rows, support):
    n = Counter(s for b in rows for k in range(1, len(b) + 1) for s in itertools.combinations(sorted(b), k))
    return {s: c for s, c in n.items() if c >= math.ceil(support * len(rows))}


def named(sets, items):
    name = {r.no: r["item"] for r in items.collect()}
    return {tuple(sorted(name[x] for x in r["items"])): r.freq for r in sets.collect()}


@pytest.mark.parametrize("seed, support", [(1, 0.02), (2, 0.1), (3, 0.4)])
def test_sets_equal_all_subsets(spark, seed, support):
    rows = baskets(seed, 150)
    sets, items, n = I.frequent_itemsets(frame(spark, rows), support)
    assert n == len(rows) and named(sets, items) == all_sets(rows, support)


def test_rules_equal_fp_growth(spark):
    rows = baskets(4, 200)
    df = frame(spark, rows)
    got = {(frozenset(r.antecedent), r.consequent[0]): (r.confidence, r.lift, r.support) for r in I.rules(df, 0.05, 0.3).collect()}
    want = {(frozenset(r.antecedent), r.consequent[0]): (r.confidence, r.lift, r.support) for r in B.fit_rules(df, 0.05, 0.3).collect()}
    assert got == want and any(len(a) > 2 for a, _ in got)


def test_antecedents_stand_from_the_rarest_on(spark):
    rows = baskets(5, 120)
    single = Counter(x for b in rows for x in b)
    for r in I.rules(frame(spark, rows), 0.05, 0.2).collect():
        assert r.antecedent == sorted(r.antecedent, key=lambda x: (single[x], x))


def test_limits(spark):
    rows = baskets(6, 80)
    sets, items, _ = I.frequent_itemsets(frame(spark, rows), 0.05, max_items=2)
    assert max(len(s) for s in named(sets, items)) == 2
    none = spark.createDataFrame([], "order_id long, items array<string>")
    assert I.rules(none).count() == 0
    assert I.rules(frame(spark, [["a"], ["b"], ["c"]]), 0.9).count() == 0


def test_a_candidate_with_a_rare_subset_is_dropped(spark):
    level = spark.createDataFrame([([1, 2], 5), ([1, 3], 5), ([2, 3], 5), ([2, 4], 5)], "items array<int>, freq long")
    assert [r["items"] for r in I.candidates(level).collect()] == [[1, 2, 3]]


def test_equal_baskets_are_counted_once(spark, monkeypatch):
    rows = baskets(7, 60) * 5
    sizes, real = {}, I.materialize

    def counted(df, name):
        out = real(df, name)
        sizes[name] = out.count()
        return out

    monkeypatch.setattr(I, "materialize", counted)
    sets, items, n = I.frequent_itemsets(frame(spark, rows), 0.1)
    assert n == len(rows) and named(sets, items) == all_sets(rows, 0.1)
    assert max(v for k, v in sizes.items() if k in ("equal-baskets", "numbered-baskets")) <= 60


def test_many_candidates_and_items_are_not_broadcast(spark, monkeypatch):
    from storelake.operators import joins
    rows = baskets(8, 100)
    monkeypatch.setattr(I, "broadcast_if_small", lambda df, max_rows=1: joins.broadcast_if_small(df, 1))
    sets, items, n = I.frequent_itemsets(frame(spark, rows), 0.05)
    assert named(sets, items) == all_sets(rows, 0.05)


def test_baskets_are_dealt_by_order_once(spark):
    from conftest import SF_SMALL
    from storelake.plans.registry import _basket_fact
    p = B.baskets(_basket_fact(spark, SF_SMALL, "product_category_name"), "product_category_name")._jdf.queryExecution().executedPlan().toString()
    assert "l_orderkey" in p and p.count("Exchange hashpartitioning(order_id") == 2
    joins = [x for x in p.splitlines() if "BroadcastHashJoin" in x]
    assert not any(k in x for x in joins for k in ("order_id#", "product_id#"))
