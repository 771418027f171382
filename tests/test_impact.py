"""Weekly sales: cleaning, shares, before and after."""

import datetime as dt
from decimal import Decimal

import pytest

from caseloom.operators import clean, impact as op
from caseloom.sources.readers import inline_rows

from .conftest import rows
from .tables import d

RAW = [
    # Base week 2020-06-15; the week before it, three and four weeks before, one after, one far away.
    ("15/6/20", "ASIA", "Retail", "C1", "New", 10, Decimal("100.00")), ("22/6/20", "ASIA", "Shopify", "F3", "New", 4, Decimal("50.00")),
    ("8/6/20", "ASIA", "Retail", "C1", "New", 5, Decimal("80.00")), ("25/5/20", "EUROPE", "Retail", "null", "Guest", 3, Decimal("40.00")),
    ("18/5/20", "EUROPE", "Retail", "F2", "Guest", 1, Decimal("10.00")), ("17/6/19", "ASIA", "Retail", "C4", "New", 2, Decimal("30.00")),
    ("10/6/19", "ASIA", "Retail", "C4", "New", 2, Decimal("20.00")),
]


@pytest.fixture(scope="module")
def weekly(spark):
    return clean.clean_weekly(inline_rows(spark, "weekly_sales", RAW))


def test_cleaning(weekly):
    cleaned = {str(r.week_date): r for r in weekly.collect()}
    base = cleaned["2020-06-15"]
    assert (base.week_number, base.month_number, base.calendar_year, base.age_band, base.demographic) == (24, 6, 2020, "Young Adults", "Couples")
    unknown = cleaned["2020-05-25"]
    assert (unknown.segment, unknown.age_band, unknown.demographic) == ("unknown",) * 3
    assert unknown.avg_transaction == Decimal("13.33") and cleaned["2020-06-22"].age_band == "Retirees"
    assert rows(op.weekdays_used(weekly)) == [("Monday", 7)]


def test_missing_weeks(weekly):
    missing = rows(op.missing_weeks(weekly, 52).filter("calendar_year = 2020"), "week_number")
    present = {24, 25, 23, 21, 20}
    assert {w for w, in missing} == set(range(1, 53)) - present


def test_before_and_after(weekly):
    assert rows(op.before_after(weekly, "2020-06-15", 4)) == [
        (Decimal("130.00"), Decimal("150.00"), Decimal("20.00"), 15.38)
    ]
    years = {r.calendar_year: tuple(r)[1:] for r in op.before_after_years(weekly, 24, 4).collect()}
    assert years[2019] == (Decimal("20.00"), Decimal("30.00"), Decimal("10.00"), 50.0)
    assert years[2020][:2] == (Decimal("130.00"), Decimal("150.00"))


def test_windows_reach_into_the_neighbouring_year(spark):
    days = [dt.date(2019, 10, 7) + dt.timedelta(7 * k) for k in range(40)]
    weekly = spark.createDataFrame([(day, day.year, (day.timetuple().tm_yday - 1) // 7 + 1, Decimal(1)) for day in days], "week_date date, calendar_year int, week_number int, sales decimal(12,2)")
    years = {r.calendar_year: tuple(r)[1:3] for r in op.before_after_years(weekly, 4, 12).collect()}
    assert years == {2019: (0, 0), 2020: (12, 12)} or years == {2020: (12, 12)}


def test_impact_by_dimension(weekly):
    impact = {(r.dimension, r.value): (r.sales_before, r.sales_after, r.percent_change) for r in op.impact_by_dimension(weekly, "2020-06-15", 4).collect()}
    assert {k for k, _ in impact} == set(op.DIMENSIONS)
    assert impact["region", "ASIA"] == (Decimal("80.00"), Decimal("150.00"), 87.5)
    assert impact["region", "EUROPE"] == (Decimal("50.00"), Decimal("0.00"), -100.0)
    assert impact["platform", "Shopify"] == (Decimal("0.00"), Decimal("50.00"), None)
    for dimension in op.DIMENSIONS:
        assert sum(b for (k, _), (b, _, _) in impact.items() if k == dimension) == Decimal("130.00")


def test_shares_sum_to_one_hundred(weekly):
    shares = op.share_of_parent(weekly, ["calendar_year"], ["platform"], "sales")
    by_year = {}
    for r in shares.collect():
        by_year[r.calendar_year] = by_year.get(r.calendar_year, 0) + r.share
    assert {y: round(s, 1) for y, s in by_year.items()} == {2019: 100.0, 2020: 100.0}
    assert rows(op.top_contributors(weekly, ["age_band", "demographic"], "Retail"), "age_band", "demographic", "sales") == [
        ("Young Adults", "Couples", Decimal("180.00"))
    ]


def test_weighted_average_is_not_the_mean_of_averages(weekly):
    found = {(r.calendar_year, r.platform): (r.avg_transaction, r.mean_of_averages) for r in op.weighted_average(weekly).collect()}
    assert found[2020, "Retail"] == (Decimal("12.11"), Decimal("12.33"))


def test_totals(weekly):
    assert rows(op.totals(weekly, ["calendar_year"])) == [(2019, 4, Decimal("50.00")), (2020, 23, Decimal("280.00"))]
    assert d("2020-06-15").weekday() == 0
