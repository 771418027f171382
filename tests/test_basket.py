"""Basket reports; the triple search against brute force, with large baskets and skewed products."""

import random
from collections import Counter
from decimal import Decimal
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from caseloom.operators import basket as op
from caseloom.operators.impact import share_of_parent

from .conftest import rows

LINES = [
    (1, 10, "s1", "A", 2, "5.00", "0.10", "t"), (1, 11, "s1", "A", 1, "10.00", "0.00", "t"), (1, 12, "s2", "A", 1, "4.00", "0.50", "t"),
    (2, 10, "s1", "A", 1, "5.00", "0.00", "f"), (2, 13, "s3", "B", 3, "7.00", "0.10", "f"), (3, 13, "s3", "B", 1, "7.00", "0.00", "t"),
    (3, 13, "s3", "B", 1, "7.00", "0.00", "t"),
]


@pytest.fixture(scope="module")
def lines(spark):
    data = [(*r[:5], Decimal(r[5]), Decimal(r[6]), r[7]) for r in LINES]
    return spark.createDataFrame(data, "txn_id int, product_id int, segment string, category string, quantity int, price decimal(10,2), discount decimal(4,2), member string")


def test_totals_and_averages(lines):
    assert [float(x) for x in op.sales_totals(lines).first()] == [10, 64.0, 5.1, 3]
    average = op.average_basket(lines).first()
    assert average.avg_products == round(6 / 3, 4) and average.avg_revenue == round(64 / 3, 4) and average.avg_discount == 1.7
    members = {r.member: (r.transactions, r.avg_revenue, r.share) for r in op.member_baskets(lines).collect()}
    assert members == {"t": (2, 19.0, 66.67), "f": (1, 26.0, 33.33)}


def test_percentiles(lines):
    assert rows(op.basket_percentiles(lines)) == [(0.25, 19.0), (0.5, 24.0), (0.75, 25.0)]


def test_products(lines):
    assert [(r.product_id, float(r.revenue)) for r in op.top_products(lines).collect()] == [(13, 35.0), (10, 15.0), (11, 10.0)]
    assert rows(op.top_per_parent(lines, "segment"), "segment", "product_id", "quantity") == [("s1", 10, 3), ("s2", 12, 1), ("s3", 13, 5)]
    assert rows(op.penetration(lines)) == [(10, 2, 66.6667), (11, 1, 33.3333), (12, 1, 33.3333), (13, 2, 66.6667)]
    rollup = {(r.category, r.segment, r.level): r.quantity for r in op.sales_rollup(lines).collect()}
    assert rollup == {("A", "s1", 0): 4, ("A", "s2", 0): 1, ("B", "s3", 0): 5, ("A", None, 1): 5, ("B", None, 1): 5, (None, None, 3): 10}
    shares = share_of_parent(lines.withColumn("revenue", op.gross()), ["category"], ["segment"], "revenue")
    assert rows(shares, "segment", "share") == [("s1", 86.21), ("s2", 13.79), ("s3", 100.0)]


def brute_force(baskets):
    counts = Counter(t for items in baskets for t in combinations(sorted(set(items)), 3))
    most = max(counts.values(), default=0)
    return sorted((*t, n) for t, n in counts.items() if n == most)


def random_baskets(seed, n, products, sizes):
    rng = random.Random(seed)
    weights = [1 / (i + 1) for i in range(products)]
    return [set(rng.choices(range(products), weights, k=rng.choice(sizes))) for _ in range(n)]


CASES = {
    "ordinary": random_baskets(1, 80, 12, [2, 3, 4, 5]),
    "one large basket": random_baskets(2, 40, 15, [2, 3, 4]) + [set(range(15))],
    "several large baskets": random_baskets(3, 30, 20, [2, 3, 4]) + random_baskets(4, 12, 20, [20, 30]),
    "only large baskets": [set(range(8)), set(range(4, 12)), {1, 5, 6, 7, 9, 10}],
    "ties": [{1, 2, 3}, {4, 5, 6}],
    "none": [{1, 2}, {3}],
}


@pytest.mark.parametrize("name", CASES)
@pytest.mark.parametrize("seed_items", [3, 40])
def test_triples(spark, name, seed_items):
    data = [(i, p, 1) for i, items in enumerate(CASES[name]) for p in items]
    # Repeated lines and lines without quantity must not matter.
    data += data[::3] + [(0, 99, 0)]
    df = spark.createDataFrame(data, "txn_id int, product_id int, quantity int")
    found = op.basket_triples(df, seed_items)
    assert sorted(tuple(r) for r in found.collect()) == brute_force(CASES[name])


def test_triples_with_a_basket_of_thousands(spark):
    baskets = [set(range(2000))] + [{1, 5, 9, 100 + k} for k in range(4)] + [{3, 4, 2000 + k} for k in range(9)]
    df = spark.createDataFrame([(i, p, 1) for i, items in enumerate(baskets) for p in items], "txn_id int, product_id int, quantity int")
    assert sorted(tuple(r) for r in op.basket_triples(df).collect()) == [(1, 5, 9, 5)]


def test_large_baskets_are_projected_not_paired(spark):
    """A transaction of n products is n - 2 arrays wherever rows are shuffled or written, and weak pairs are not."""
    shared = [(t, p) for t in range(2) for p in range(2000)]
    items = spark.createDataFrame(shared + [(t, 5000 + t) for t in range(2)], "_t int, _i int")
    support = items.groupBy("_i").agg(F.count(F.lit(1)).alias("_s"))
    conditional = op.conditional_baskets(op._baskets(items, support))
    assert conditional.count() == 2 * 1999
    assert op._strong_pairs(conditional, 3).count() == 0


def test_a_product_in_very_many_transactions_is_dealt_to_salts(spark):
    baskets = random_baskets(7, 200, 9, [3, 4, 5])
    items = spark.createDataFrame([(t, p) for t, ps in enumerate(baskets) for p in ps], "_t int, _i int")
    support = items.groupBy("_i").agg(F.count(F.lit(1)).alias("_s"))
    whole, salted = (op.conditional_baskets(op._baskets(items, support), block) for block in (1 << 16, 10))
    assert salted.select("a", "_salt").distinct().count() > 3 * whole.select("a", "_salt").distinct().count()
    assert rows(op._strong_pairs(salted, 5)) == rows(op._strong_pairs(whole, 5)) != []


def test_tasks_follow_the_rows(spark, monkeypatch):
    """Transactions and pairs are dealt to as many tasks as their number asks for, whatever few bytes they are when shuffled."""
    baskets = random_baskets(8, 200, 30, [4, 5, 6])
    data = [(t, p, 1) for t, ps in enumerate(baskets) for p in ps]
    items = spark.createDataFrame(data, "_t int, _i int, _q int").drop("_q")
    support = items.groupBy("_i").agg(F.count(F.lit(1)).alias("_s"))
    monkeypatch.setattr(op, "TASK_ROWS", 50)
    dealt = op._baskets(items, support, len(data))
    assert dealt.rdd.getNumPartitions() == -(-len(data) // 50)
    conditional = op.conditional_baskets(dealt)
    pairs = sum(len(p) * (len(p) - 1) // 2 for p in baskets)
    plan = op._strong_pairs(conditional, 5, pairs)._jdf.queryExecution().optimizedPlan().toString()
    assert [line for line in plan.splitlines() if "RepartitionByExpression [a#" in line and line.endswith(f", {-(-pairs // 50)}")]
    assert rows(op._strong_pairs(conditional, 5, pairs)) == rows(op._strong_pairs(conditional, 5)) != []
    found = op.basket_triples(spark.createDataFrame(data, "txn_id int, product_id int, quantity int"))
    assert sorted(tuple(r) for r in found.collect()) == brute_force(baskets)
