"""Hot-key-safe helpers against plain windows, NumPy and brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import Window, functions as F

from caseloom.operators import grouped as g

from .conftest import rows


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows belong to one key, some to no key at all."""
    rng = random.Random(7)
    keys = [1] * 200 + [None] * 20 + [rng.randrange(2, 30) for _ in range(380)]
    data = [(k, rng.randrange(12), i, rng.randrange(-50, 50)) for i, k in enumerate(keys)]
    return spark.createDataFrame(data, "k int, day int, id int, x int")


def test_number_rows(skewed):
    ours = g.number_rows(skewed, ["k"], ["day", "id"], F.col("day"))
    plain = skewed.withColumn("rn", F.row_number().over(Window.partitionBy("k").orderBy("day", "id")).cast("long"))
    assert rows(ours, "k", "day", "id", "rn") == rows(plain, "k", "day", "id", "rn")


@pytest.mark.parametrize("chunk", [5, 7, 1000])
def test_rows_frame_over_chunk_borders(skewed, chunk):
    ours = g.rows_frame(skewed, ["k"], ["day", "id"], F.col("day"), 4, {"s": F.sum("x"), "n": F.count("x")}, chunk)
    w = Window.partitionBy("k").orderBy("day", "id").rowsBetween(-4, 0)
    plain = skewed.withColumns({"s": F.sum("x").over(w), "n": F.count("x").over(w)})
    assert ours.count() == 600
    assert rows(ours, "k", "id", "s", "n") == rows(plain, "k", "id", "s", "n")


def test_steps_keep_peers_together(spark):
    df = spark.createDataFrame([("a", 1, 10), ("a", 1, -4), ("a", 3, 5), ("b", 2, 1)], "k string, day int, x int")
    assert rows(g.steps(df, ["k"], "day", F.col("x"))) == [("a", 1, 6, 2, 6), ("a", 3, 5, 1, 11), ("b", 2, 1, 1, 1)]


def test_top_values_keep_ties(spark):
    df = spark.createDataFrame([("a", 5), ("b", 5), ("c", 3), ("d", 1), ("e", None)], "k string, v int")
    assert rows(g.with_top_values(df, "v", 2), "k", "rnk") == [("a", 1), ("b", 1), ("c", 2)]
    assert rows(g.with_top_values(df, "v", 1, ascending=True), "k", "rnk") == [("d", 1)]


@pytest.mark.parametrize("listed,expected", [
    ([1], [2, 3]), ([1, 1, 9], [2, 3]), ([], [1, 2, 3, None]), ([1, None], []), ([9], [1, 2, 3]),
])
def test_not_in_follows_sql(spark, listed, expected):
    df = spark.createDataFrame([(1,), (2,), (3,), (None,)], "x int")
    sub = spark.createDataFrame([(v,) for v in listed], "y int")
    df.createOrReplaceTempView("outer_rows")
    sub.createOrReplaceTempView("listed_rows")
    plain = spark.sql("SELECT * FROM outer_rows WHERE x NOT IN (SELECT y FROM listed_rows)")
    ours = g.not_in(df, "x", sub, "y")
    assert rows(ours) == rows(plain) == sorted([(e,) for e in expected], key=repr)


@pytest.mark.parametrize("cells", [16, 4096])
@pytest.mark.parametrize("values", [
    [5], [1, 2], [7] * 10, list(range(100)), [-3, 0, 0, 1, 10**9], [random.Random(1).randrange(10**6) for _ in range(333)],
])
def test_order_statistics(spark, values, cells):
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v long")
    fractions = [0.0, 0.25, 0.5, 0.75, 0.95, 1.0]
    found = {r.fraction: r.value for r in g.order_statistics(df, "v", fractions, cells).collect()}
    assert sorted(found) == fractions
    assert np.allclose([found[f] for f in fractions], np.quantile(values, fractions))


@pytest.fixture
def seen_by_windows(monkeypatch):
    """Rows in the largest partition of each window of the selection."""
    sizes, plain = [], g.running_cells

    def watched(cells, keys):
        sizes.append(cells.groupBy(*keys).count().agg(F.max("count")).first()[0] or 0)
        return plain(cells, keys)

    monkeypatch.setattr(g, "running_cells", watched)
    return sizes


def test_outliers_do_not_fill_a_window(spark, seen_by_windows):
    values = [*range(5000), -(2**62), 2**62, 2**63 - 1, -(2**63)]
    df = spark.createDataFrame([(v,) for v in values], "v long")
    found = {r.fraction: r.value for r in g.order_statistics(df, "v", [0.0, 0.5, 1.0], cells=64).collect()}
    assert found == {0.0: -(2.0**63), 0.5: 2499.5, 1.0: 2.0**63}
    assert max(seen_by_windows) <= 64 and len(seen_by_windows) > 8


def test_a_million_values_in_one_group(spark, seen_by_windows):
    df = spark.range(1_000_000).selectExpr("'hot' AS k", "(id * 7919) % 1000003 AS v").unionByName(spark.createDataFrame([("one", 5), (None, 3), (None, 9), ("none", None)], "k string, v long"))
    found = {(r.k, r.fraction): r.value for r in g.order_statistics(df, "v", [0.5, 0.999], cells=256, keys=["k"]).collect()}
    hot = np.sort(np.arange(1_000_000) * 7919 % 1000003)
    assert max(seen_by_windows) <= 256
    assert found == pytest.approx({("hot", 0.5): np.quantile(hot, 0.5), ("hot", 0.999): np.quantile(hot, 0.999), ("one", 0.5): 5, ("one", 0.999): 5, (None, 0.5): 6, (None, 0.999): 8.994})


def test_ranks_of_other_types(spark):
    df = spark.sql("SELECT * FROM VALUES (DATE '1969-12-30', 1.25BD, 7S), (DATE '2020-02-29', -3.50BD, -7S), (DATE '1970-01-01', 0.01BD, 0S) AS t(d, m, s)")
    last = lambda total: [F.struct((total - 1).alias("rank"))]
    for name in df.columns:
        found = g.radix_select(df, [], name, last, cells=32)
        assert found.schema[name].dataType == df.schema[name].dataType
        assert found.first()[name] == sorted(r[name] for r in df.collect())[1]
    with pytest.raises(TypeError):
        g.radix_select(df.selectExpr("double(m) AS x"), [], "x", last)
    assert g.radix_select(df.limit(0), [], "s", last).count() == 0
