"""Window membership (FIXTURES §4) and strict flash-sale thresholds (§3)."""

import datetime as dt

from pyspark.sql import functions as F

from cartwheel.operators import alerts, windows

from helpers import ts, typed


def test_ten_windows_per_event_half_open(spark):
    rows = [
        ("a", "u", "PROD-001", "Laptops", "view", ts("2024-01-15 00:05:00")),
        ("b", "u", "PROD-002", "Laptops", "view", ts("2024-01-15 00:05:59.999999")),
        ("c", "u", "PROD-003", "Laptops", "view", None),
    ]
    out = windows.sliding_counts(typed(spark, rows), "10 minutes", "1 minute")
    got = {}
    for r in out.collect():
        got.setdefault(r.product_id, set()).add(r.window_start)
    expect = {dt.datetime(2024, 1, 14, 23, 56) + dt.timedelta(minutes=i) for i in range(10)}
    assert got["PROD-001"] == expect
    assert got["PROD-002"] == expect
    assert "PROD-003" not in got  # NULL time joins no window
    assert dt.datetime(2024, 1, 14, 23, 55) not in got["PROD-001"]


def test_out_of_domain_type_makes_zero_row(spark):
    rows = [("a", "u", "PROD-001", None, "error", ts("2024-01-15 00:05:00"))]
    out = windows.sliding_counts(typed(spark, rows), "10 minutes", "1 minute").collect()
    assert len(out) == 10
    assert all((r.view_count, r.cart_count, r.purchase_count) == (0, 0, 0) for r in out)


def test_strict_thresholds(spark):
    cases = [(100, 0, False), (101, 0, True), (101, 4, True), (101, 5, False), (0, 0, False)]
    df = spark.createDataFrame(
        [(f"P{i}", v, 0, p, dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 1, 0, 10))
         for i, (v, p, _) in enumerate(cases)],
        "product_id string, view_count long, cart_count long, purchase_count long, "
        "window_start timestamp, window_end timestamp",
    )
    fired = {r.product_id for r in alerts.flash_sale(df).collect()}
    assert fired == {f"P{i}" for i, (_, _, yes) in enumerate(cases) if yes}


def test_alert_row_shape(spark):
    df = spark.createDataFrame(
        [("P", 101, 0, 0, dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 1, 0, 10))],
        "product_id string, view_count long, cart_count long, purchase_count long, "
        "window_start timestamp, window_end timestamp",
    )
    out = alerts.flash_sale(df, created_at=F.lit(dt.datetime(2024, 1, 2)))
    assert out.columns == ["product_id", "view_count", "purchase_count", "window_start", "window_end",
                           "alert_message", "created_at"]
    assert out.first().alert_message.startswith("High interest detected")


def test_long_form_counts(spark):
    rows = [("a", "u", "PROD-001", "Laptops", "view", ts("2024-01-15 00:05:00")),
            ("b", "u", "PROD-001", "Laptops", "purchase", ts("2024-01-15 00:05:00"))]
    out = windows.window_event_type_counts(typed(spark, rows), "10 minutes", "2 minutes")
    assert out.count() == 10  # 5 windows x 2 types


def test_bucketed_windows_equal_spark_window(spark):
    from pyspark.sql import functions as F

    from cartwheel.operators import windows
    from cartwheel.plans import tables as TB

    events = TB.decoded(spark, "/root/testdata/sf0.001")
    for width, slide in (("10 minutes", "1 minute"), ("6 hours", "1 hour"), ("7 minutes", "3 minutes")):
        got = windows.sliding_counts(events, width, slide)
        want = (events.groupBy(F.window("event_time", width, slide).alias("w"), "product_id")
                .agg(*windows.type_counts())
                .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                        "product_id", "view_count", "cart_count", "purchase_count"))
        assert got.schema == want.schema, (width, slide)
        assert sorted(got.collect()) == sorted(want.collect()), (width, slide)
    plan = windows.sliding_counts(events, "10 minutes", "1 minute")._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan  # events are counted per bucket, not once per window
