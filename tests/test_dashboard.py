"""Dashboard panel queries (J6) on hand-made aggregates, alerts, reports and segments."""

import datetime as dt
from decimal import Decimal

import pytest

from cartwheel.operators import dashboard

T0 = dt.datetime(2024, 1, 15, 10, 0)


@pytest.fixture(scope="module")
def aggs(spark):
    rows = [
        (T0, T0 + dt.timedelta(minutes=10), "PROD-001", 10, 4, 1),
        (T0, T0 + dt.timedelta(minutes=10), "PROD-002", 5, 0, 1),
        (T0 + dt.timedelta(minutes=1), T0 + dt.timedelta(minutes=11), "PROD-001", 30, 2, 0),
        (T0 + dt.timedelta(hours=5), T0 + dt.timedelta(hours=5, minutes=10), "PROD-003", 0, 0, 0),
    ]
    return spark.createDataFrame(rows, "window_start timestamp, window_end timestamp, product_id string, "
                                       "view_count long, cart_count long, purchase_count long")


def test_series_closed_range_and_legend(aggs):
    end = T0 + dt.timedelta(minutes=11)
    series = dashboard.views_series(aggs, T0 + dt.timedelta(minutes=10), end)
    assert [(r.metric, r.value) for r in series.collect()] == [("PROD-001", 10), ("PROD-002", 5), ("PROD-001", 30)]
    legend = {r.metric: (r.max_value, r.mean_value) for r in dashboard.views_legend(series).collect()}
    assert legend["PROD-001"] == (30, 20.0)


def test_funnel_long_form(aggs):
    out = dashboard.funnel(aggs).where(f"time = timestamp'{T0 + dt.timedelta(minutes=10)}'").collect()
    assert {r.metric: r.value for r in out} == {"Views": 15, "Add to Cart": 4, "Purchases": 2}


def test_conversion_top_and_bands(aggs):
    out = dashboard.conversion_top(aggs, limit=2).collect()
    assert [(r.metric, r.value, r.status) for r in out] == [
        ("PROD-002", Decimal("0.2000"), "green"),
        ("PROD-001", Decimal("0.0250"), "red"),
    ]


def test_alert_panels(spark):
    rows = [("P1", 200, 0, T0, T0 + dt.timedelta(minutes=10), "m", T0 + dt.timedelta(minutes=1)),
            ("P2", 150, 1, T0, T0 + dt.timedelta(minutes=10), "m", T0 + dt.timedelta(minutes=2))]
    alerts = spark.createDataFrame(rows, "product_id string, view_count long, purchase_count long, "
                                         "window_start timestamp, window_end timestamp, alert_message string, "
                                         "created_at timestamp")
    count = dashboard.alert_count(alerts).first()
    assert (count.alert_count, count.status) == (2, "orange")
    log = dashboard.alert_log(alerts, display=True)
    assert log.columns == ["Product ID", "Views", "Purchases", "Recommendation", "Triggered At"]
    assert [r[0] for r in log.collect()] == ["P2", "P1"]
    notes = dashboard.alert_annotations(alerts).collect()
    assert notes[0].text == "P1 — Flash Sale Triggered" and notes[0].tags == "Flash Sale"


def test_date_panels(spark):
    day = dt.date(2024, 1, 15)
    segs = spark.createDataFrame(
        [(day, "u1", "Buyer", 3, 1), (day, "u2", "Window Shopper", 9, 0), (day, "u3", "Buyer", 1, 2),
         (dt.date(2024, 1, 14), "u4", "Buyer", 1, 1)],
        "segment_date date, user_id string, segment string, total_views long, total_purchases long")
    assert dashboard.segment_count(segs, "Buyer", day).first().users == 2
    detail = dashboard.segment_detail(segs, day).collect()
    assert [(r.user_id, r.colour) for r in detail] == [("u3", "green"), ("u1", "green"), ("u2", "blue")]
    report = spark.createDataFrame(
        [(day, 2, "P2", 5, 1, Decimal("0.2000")), (day, 1, "P1", 9, 0, Decimal("0.0000"))],
        "report_date date, rank smallint, product_id string, total_views long, total_purchases long, "
        "conversion_rate decimal(6,4)")
    assert [r.product_id for r in dashboard.daily_top(report, day).collect()] == ["P1", "P2"]
