"""Monthly metrics: presence, removal, extremes, audits."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from caseloom.operators import clean, tenure as op
from caseloom.sources.readers import inline_rows, json_field, json_fields

from .conftest import rows


def m(n):
    return dt.date(2018, n, 1)


DATA = [(1, n, 10.0 + n, n, 50.0 + n) for n in (7, 8, 9)] + [(2, n, 20.0 - n, n, 90.0) for n in (7, 8, 9)] + [
    (3, 7, 12.0, 5, 1.0), (3, 7, 12.0, 5, 1.0), (3, 8, 19.0, 5, 99.0), (4, 9, 99.0, 1, 7.0), (None, 7, 5.0, 1, 1.0), (None, None, 5.0, 1, 1.0),
    (5, None, 5.0, 9, 1.0),
]


@pytest.fixture(scope="module")
def metrics(spark):
    data = [(i, None if n is None else m(n), c, r, p) for i, n, c, r, p in DATA]
    return spark.createDataFrame(data, "interest_id long, month_year date, composition double, ranking int, percentile_ranking double")


def test_cleaning(spark):
    raw = inline_rows(spark, "interest_metrics", [
        ("3", "2021", "03-2021", "512", 4.25, 3, 88.5), ("NULL", "NULL", "NULL", "NULL", 1.5, 2, 1.0), ("8", "2018", "08-2018", "x1", 1.5, 2, 1.0),
    ])
    assert rows(clean.clean_metrics(raw), "_month", "month_year", "interest_id") == [
        (3, dt.date(2021, 3, 1), 512), (8, m(8), None), (None, None, None)
    ]


def test_json_rows_with_dotted_keys(spark):
    text = '{"month": 7, "month_year": "07-2018", "a.attribute_interest_id": 32486, "average_composition": 11.89}'
    raw = inline_rows(spark, "json_data", [(text,), ("not json",)])
    typed = json_fields(raw, "raw_data", "month int, `a.attribute_interest_id` int, average_composition double")
    assert set(rows(typed)) == {(7, 32486, 11.89), (None, None, None)}
    assert rows(raw.select(json_field(F.col("raw_data"), "a.attribute_interest_id"))) == [("32486",), (None,)]


def test_counts_put_null_first(metrics):
    counts = [tuple(r) for r in op.counts_with_total(metrics).collect()]
    assert counts == [(None, 2, 13), (m(7), 5, 13), (m(8), 3, 13), (m(9), 3, 13)]


def test_presence_and_tenure(metrics):
    assert rows(op.present_in_all(metrics)) == [(1, 3), (2, 3)]
    # Interest 3 has two records in July: distinct months are the default.
    assert dict(rows(op.tenures(metrics)))[3] == 2 and dict(rows(op.tenures(metrics, distinct=False)))[3] == 3
    assert [tuple(r) for r in op.tenure_cumulative(metrics).orderBy(F.desc("total_periods")).collect()] == [
        (3, 2, 40.0), (2, 1, 60.0), (1, 1, 80.0), (0, 1, 100.0)
    ]


def test_removal_drops_null_ids(metrics):
    assert rows(op.removed_points(metrics, 2)) == [(2, 2)]
    kept = op.without_short_lived(metrics, 2)
    assert rows(kept.select("interest_id").distinct()) == [(1,), (2,), (3,)]
    assert rows(op.interests_per_month(kept)) == [(m(7), 3), (m(8), 3), (m(9), 2)]


def test_top_and_bottom_keep_the_month(metrics):
    kept = op.without_short_lived(metrics, 2)
    found = rows(op.top_and_bottom(kept, k=2), "side", "interest_id", "month_year", "max_value", "rnk")
    assert found == [
        ("bottom", 1, m(9), 19.0, 2), ("bottom", 2, m(7), 13.0, 1), ("bottom", 3, m(8), 19.0, 2),
        ("top", 1, m(9), 19.0, 1), ("top", 2, m(7), 13.0, 2), ("top", 3, m(8), 19.0, 1),
    ]


def test_volatility_and_extremes(metrics):
    assert [r.interest_id for r in op.lowest_average(op.without_short_lived(metrics, 2), n=2).collect()] == [3, 1]
    assert [r.interest_id for r in op.most_volatile(metrics, n=2).collect()] == [3, 1]
    extremes = {r.interest_id: tuple(r)[2:] for r in op.extreme_months(metrics.filter("interest_id IS NOT NULL"), n=3).collect()}
    assert extremes[3] == (m(8), 99.0, m(7), 1.0)
    # Equal values: the latest month of the maximum, the earliest of the minimum.
    assert extremes[2] == (m(9), 90.0, m(7), 90.0)
    # A month without a value is no extreme.
    gaps = metrics.sparkSession.createDataFrame([(1, m(7), 5.0), (1, m(8), None), (1, m(9), 9.0)], "interest_id long, month_year date, percentile_ranking double")
    assert tuple(op.extreme_months(gaps).first())[2:] == (m(9), 9.0, m(7), 5.0)


def test_key_audit_counts_keys_and_rows(spark):
    left = spark.createDataFrame([(1,), (1,), (2,), (2,), (2,), (None,)], "k int")
    right = spark.createDataFrame([(1,), (3,), (4,), (4,)], "k int")
    assert rows(op.key_audit(left, "k", right, "k")) == [(2, 3, 1, 2, 3, 3)]


def test_records_before_creation(spark, metrics):
    registry = spark.createDataFrame([(1, dt.datetime(2018, 7, 20, 9)), (2, dt.datetime(2018, 9, 1, 0))], "id int, created_at timestamp_ntz")
    # Interest 1: July 1 lies before July 20 but not before its month. Interest 2: July and August lie before both.
    assert rows(op.before_created(metrics, registry)) == [(3, 2)]
