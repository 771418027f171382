"""Stays, nearest-rank percentiles and interval joins."""

import datetime as dt
import random
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from caseloom.operators import intervals as op
from caseloom.sources.views import Views

from .conftest import rows
from .tables import d, t


@pytest.fixture(scope="module")
def nodes(spark):
    return spark.createDataFrame([
        (1, 1, 4, d("2020-01-01"), d("2020-01-11")), (1, 1, 4, d("2020-01-12"), d("2020-01-17")),
        (1, 1, 2, d("2020-01-18"), d("9999-12-31")), (2, 1, 3, d("2020-01-01"), d("2020-01-05")),
        (3, 2, 3, d("2020-01-01"), d("2020-01-08")),
    ], "customer_id int, region_id int, node_id int, start_date date, end_date date")


def test_counts_and_stays(nodes):
    assert rows(op.unique_nodes(nodes)) == [(3,)]
    assert rows(op.node_counts(nodes)) == [(1, 4, 2), (2, 1, 1)]
    assert rows(op.stay_days(nodes)) == [(1, 1, 4, 15), (2, 1, 3, 4), (3, 2, 3, 7)]
    assert rows(op.average_stay(nodes)) == [(8, 26 / 3, 3)]


def test_nearest_rank_against_sorting(spark):
    rng = random.Random(3)
    groups = {g: [rng.randrange(40) for _ in range(n)] for g, n in {"a": 1, "b": 2, "c": 10, "e": 33, "f": 250}.items()}
    df = spark.createDataFrame([(g, v) for g, vs in groups.items() for v in vs], "g string, v int")
    found = {(r.g, r.percentile): r.v for r in op.nearest_rank(df, ["g"], "v").collect()}
    expected = {}
    for g, vs in groups.items():
        for label, p in op.PERCENTILES.items():
            rank = max(1, int((Decimal(len(vs)) * Decimal(p)).quantize(Decimal(1), ROUND_HALF_UP)))
            expected[g, label] = sorted(vs)[rank - 1]
    assert found == expected


def test_interval_join_matches_every_interval(spark):
    points = spark.createDataFrame([
        (1, t("2020-01-01 00:00:00")), (2, t("2020-01-02 12:00:00")), (3, t("2020-01-05 23:59:59")), (4, t("2020-02-01 00:00:00")), (5, None),
    ], "id int, at timestamp_ntz")
    intervals = spark.createDataFrame([
        ("whole", t("2019-01-01 00:00:00"), t("9999-12-31 00:00:00")), ("second", t("2020-01-02 06:00:00"), t("2020-01-02 12:00:00")),
        ("days", t("2020-01-02 12:00:01"), t("2020-01-05 23:59:59")), ("never", t("2018-01-01 00:00:00"), t("2018-02-01 00:00:00")),
    ], "name string, s timestamp_ntz, e timestamp_ntz")
    assert rows(op.interval_join(points, intervals, "at", "s", "e"), "id", "name") == [
        (1, "whole"), (2, "second"), (2, "whole"), (3, "days"), (3, "whole"), (4, "whole"), (5, None)
    ]
    first = op.first_interval(points, intervals.filter("name != 'whole'"), "at", "s", "e", "name")
    assert rows(first, "id", "name") == [(1, None), (2, "second"), (3, "days"), (4, None), (5, None)]


def test_open_end_is_not_a_stay(nodes):
    assert op.closed_intervals(nodes).count() == 4
    assert op.closed_intervals(nodes.withColumn("end_date", F.lit(None).cast("date"))).count() == 0


def test_open_ends_and_keys(spark):
    points = spark.createDataFrame([(1, t("2020-01-05 10:00")), (2, t("2020-01-05 10:00")), (1, t("2019-12-31 00:00"))], "customer_id int, at timestamp_ntz")
    spans = spark.createDataFrame([(1, "a", t("2020-01-01 00:00"), None), (2, "b", t("2020-01-06 00:00"), None), (2, "c", t("2020-01-01 00:00"), t("2020-01-05 09:00"))], "customer_id int, name string, lo timestamp_ntz, hi timestamp_ntz")
    keyed = op.interval_join(points, spans, "at", "lo", "hi", by=["customer_id"])
    assert rows(keyed, "customer_id", "at", "name") == [(1, t("2019-12-31 00:00"), None), (1, t("2020-01-05 10:00"), "a"), (2, t("2020-01-05 10:00"), None)]
    first = op.first_interval(points, spans.drop("customer_id"), "at", "lo", "hi", "name")
    assert rows(first, "customer_id", "name") == [(1, "a"), (1, None), (2, "a")]


def test_any_length_against_brute_force(spark):
    """Intervals of a second to centuries, open and empty ones, points that share a second, NULL keys and moments."""
    rng = random.Random(11)
    base = dt.datetime(2020, 1, 1)
    moment = lambda: base + dt.timedelta(seconds=rng.choice([rng.randrange(100), rng.randrange(10**5), rng.randrange(10**8)]))
    points = [(k, rng.choice([1, 1, 2, None]), rng.choice([moment(), base + dt.timedelta(seconds=50), None])) for k in range(150)]
    spans = []
    for k in range(80):
        lo = rng.choice([moment(), base - dt.timedelta(days=200 * 365), base - dt.timedelta(seconds=rng.randrange(50))])
        hi = rng.choice([lo, lo + dt.timedelta(seconds=rng.randrange(200)), lo + dt.timedelta(days=rng.randrange(40_000)), lo - dt.timedelta(seconds=1), None, None])
        spans.append((rng.choice([1, 1, 2, None]), k, lo, hi))
    p = spark.createDataFrame(points, "id int, g int, at timestamp_ntz").repartition(3)
    s = spark.createDataFrame(spans, "g int, name int, lo timestamp_ntz, hi timestamp_ntz")
    for by in ([], ["g"]):
        expected = []
        for i, g, at in points:
            held = [n for h, n, lo, hi in spans if at and (not by or (g is not None and g == h)) and lo <= at and (hi is None or at <= hi)]
            expected += [(i, n) for n in held or [None]]
        found = op.interval_join(p, s if by else s.drop("g"), "at", "lo", "hi", by=by)
        assert rows(found, "id", "name") == sorted(expected, key=repr)
    first = {i: min(((lo, n) for _, n, lo, hi in spans if at and lo <= at and (hi is None or at <= hi)), default=(None, None))[1] for i, _, at in points}
    assert rows(op.first_interval(p, s.drop("g"), "at", "lo", "hi", "name"), "id", "name") == sorted(first.items(), key=repr)


def test_nodes_per_interval_are_few(spark):
    ends = [(k, a, a + 2**k + d) for k in range(36) for a in (0, 1, 12345, -7) for d in (-1, 0, 1)]
    frame = spark.createDataFrame(ends, "k int, a long, b long")
    nodes = op.interval_nodes(frame, F.col("a"), F.col("b"))
    counts = nodes.groupBy("k", "a", "b").agg(F.count("*").alias("n"), F.count_distinct("_level").alias("levels"), F.max("_level").alias("l"))
    worst = counts.agg(F.max("n"), F.max("levels"), F.count("*"), F.max(F.expr("l - k"))).first()
    assert worst[0] <= 2 ** (op.DEPTH + 1) + 1 and worst[1] == 1 and worst[2] == len(set(ends)) and worst[3] <= 1 - op.DEPTH + 3


def test_dates_and_timestamps_meet(spark):
    points = spark.createDataFrame([(1, dt.date(2020, 1, 5)), (2, dt.date(2020, 1, 6))], "id int, at date")
    spans = spark.createDataFrame([("a", t("2020-01-05 00:00"), t("2020-01-05 23:59")), ("b", t("2020-01-05 00:01"), t("2020-01-06 00:00"))], "name string, lo timestamp, hi timestamp")
    assert rows(op.interval_join(points, spans, "at", "lo", "hi"), "id", "name") == [(1, "a"), (2, "b")]


def test_all_nodes_of_a_day_are_stays(spark, tmp_path):
    """Three nodes on one day: two end that day, the last stays until the day before the next order."""
    day = lambda d: f"TIMESTAMP_NTZ '1995-01-{d:02d} 00:00:00'"
    orders = [(1, day(3), "'2-HIGH'"), (1, day(3), "'5-LOW'"), (1, day(3), "'2-HIGH'"), (1, day(3), "'1-URGENT'"), (1, day(9), "'1-URGENT'"), (2, day(4), "NULL")]
    values = ", ".join(f"({k}L, {at}, {p})" for k, at, p in orders)
    spark.sql(f"SELECT * FROM VALUES {values} AS t(o_custkey, o_orderdate, o_orderpriority)").write.parquet(f"{tmp_path}/orders.parquet")
    spark.sql("SELECT * FROM VALUES (1L, 7), (2L, 7) AS t(c_custkey, c_nationkey)").write.parquet(f"{tmp_path}/customer.parquet")
    spark.sql("SELECT 7 AS n_nationkey, 3 AS n_regionkey").write.parquet(f"{tmp_path}/nation.parquet")
    on, end = lambda n: dt.date(1995, 1, n), dt.date(9999, 12, 31)
    found = rows(Views(spark, str(tmp_path)).nodes, "customer_id", "node_id", "start_date", "end_date")
    assert found == [(1, 1, on(3), on(3)), (1, 1, on(9), end), (1, 2, on(3), on(3)), (1, 5, on(3), on(8)), (2, None, on(4), end)]


def test_lookups_are_merged_not_broadcast(spark, tmp_path):
    """Small files become many rows per node and level, so no side of the lookup may be broadcast on a size estimated before that."""
    spark.range(40).selectExpr("id % 4 AS o_custkey", "TIMESTAMP_NTZ '1995-01-03 00:00:00' + make_dt_interval(int(id)) AS o_orderdate", "concat(id % 5 + 1, '-X') AS o_orderpriority").write.parquet(f"{tmp_path}/orders.parquet")
    spark.sql("SELECT id AS c_custkey, 7 AS c_nationkey FROM range(4)").write.parquet(f"{tmp_path}/customer.parquet")
    spark.sql("SELECT 7 AS n_nationkey, 3 AS n_regionkey").write.parquet(f"{tmp_path}/nation.parquet")
    nodes = Views(spark, str(tmp_path)).nodes
    days = nodes.select("customer_id", F.col("start_date").alias("day"))
    for by in ([], ["customer_id"]):
        found = op.intervals_at(days, nodes if by else nodes.drop("customer_id"), "day", "start_date", "end_date", by)
        plan = found._jdf.queryExecution().sparkPlan().toString()
        joined = [line for line in plan.splitlines() if "Join" in line]
        assert [line for line in joined if "_at_node" in line or "customer_id" in line]
        assert not [line for line in joined if "Broadcast" in line and ("_at_node" in line or "customer_id" in line)]
    assert rows(nodes.groupBy().count()) == [(40,)]


def test_levels_differ_from_key_to_key(spark):
    """One key with a second's interval, one with a century's, one with none, and no key."""
    spans = spark.createDataFrame([(1, "s", t("2020-01-05 10:00"), t("2020-01-05 10:00")), (2, "c", t("1990-01-01 00:00"), t("2090-01-01 00:00"))], "g int, name string, lo timestamp_ntz, hi timestamp_ntz")
    points = spark.createDataFrame([(1, t("2020-01-05 10:00")), (2, t("2020-01-05 10:00")), (3, t("2020-01-05 10:00")), (1, t("1999-01-01 00:00")), (None, t("2020-01-05 10:00"))], "g int, at timestamp_ntz")
    assert rows(op.intervals_at(points, spans, "at", "lo", "hi", ["g"]), "g", "name") == [(1, "s"), (2, "c")]
