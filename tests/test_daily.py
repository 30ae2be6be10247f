"""Daily jobs on hand-made events of 2024-01-15 (FIXTURES §6)."""

import datetime as dt
from decimal import Decimal

import pytest

from cartwheel import constants as C
from cartwheel.operators import daily
from cartwheel.sinks import reports

from helpers import typed

DAY = dt.datetime(2024, 1, 15)


def _rows():
    rows = []
    n = 0

    def add(product, category, etype, count, user="USER-A", at=None):
        nonlocal n
        for i in range(count):
            n += 1
            rows.append((f"e{n}", user, product, category, etype,
                         at or DAY + dt.timedelta(hours=1, seconds=n)))

    add("PROD-001", "Laptops", "view", 31)
    add("PROD-001", "Laptops", "view", 1, at=DAY)  # border: midnight counts
    add("PROD-001", "Laptops", "purchase", 1, user="USER-B")
    add("PROD-001", "Laptops", "view", 1, at=DAY + dt.timedelta(days=1))  # next day: out
    add("PROD-006", "Smartphones", "view", 32)
    add("PROD-006", "Smartphones", "purchase", 8, user="USER-B")
    add("PROD-011", None, "view", 10)
    add("PROD-011", None, "purchase", 2, user="USER-B")
    add("PROD-016", "TVs", "purchase", 3, user="USER-B")
    add("PROD-016", "TVs", "add_to_cart", 1, user="USER-C")
    return rows


@pytest.fixture(scope="module")
def events(spark):
    return typed(spark, _rows()).cache()


def test_top_products(events):
    out = daily.daily_top_products(events, "2024-01-15", "2024-01-16").orderBy("rank").collect()
    got = [(r.rank, r.product_id, r.total_views, r.total_purchases, r.conversion_rate) for r in out]
    assert got == [
        (1, "PROD-001", 32, 1, Decimal("0.0313")),
        (2, "PROD-006", 32, 8, Decimal("0.2500")),
        (3, "PROD-011", 10, 2, Decimal("0.2000")),
        (4, "PROD-016", 0, 3, Decimal("0.0000")),
    ]


def test_top_products_limit_and_days(spark, events):
    out = daily.daily_top_products(events, "2024-01-15", "2024-01-17", top_n=2).collect()
    assert sorted((str(r.report_date), r.rank, r.product_id) for r in out) == [
        ("2024-01-15", 1, "PROD-001"), ("2024-01-15", 2, "PROD-006"), ("2024-01-16", 1, "PROD-001"),
    ]


def test_conversion_report_and_categories(events):
    conv = daily.conversion_by_product(events, "2024-01-15", "2024-01-16")
    rows = conv.orderBy(*daily.conversion_order()).collect()
    assert [(r.category, r.product_id, str(r.conversion_rate)) for r in rows] == [
        ("Laptops", "PROD-001", "0.0313"),
        ("Smartphones", "PROD-006", "0.2500"),
        ("Unknown", "PROD-011", "0.2000"),
    ]
    cats = {r.category: r.conversion_text for r in daily.category_conversion(conv).collect()}
    assert cats == {"Laptops": "3.12%", "Smartphones": "25.00%", "Unknown": "20.00%"}


def test_segments(events):
    seg = {r.user_id: (r.segment, r.total_views, r.total_purchases)
           for r in daily.user_segments(events, "2024-01-15", "2024-01-16").collect()}
    assert seg["USER-A"] == ("Window Shopper", 74, 0)
    assert seg["USER-B"] == ("Buyer", 0, 14)
    assert seg["USER-C"] == ("Window Shopper", 0, 0)
    three = {r.user_id: r.segment
             for r in daily.user_segments(events, "2024-01-15", "2024-01-16", three_way=True).collect()}
    assert three["USER-C"] == C.SEGMENT_PROSPECTIVE


def test_text_reports(spark, events):
    days = reports.report_days(spark, "2024-01-15", "2024-01-17")
    report = daily.daily_top_products(events, "2024-01-15", "2024-01-17")
    lines = reports.top_products_lines(report.where("report_date = date'2024-01-15'"), days)
    by_day = {}
    for r in lines.orderBy("report_date", "line_no").collect():
        by_day.setdefault(str(r.report_date), []).append(r.line)
    assert by_day["2024-01-15"][:6] == [
        C.TOP_PRODUCTS_TITLE, "Report Date: 2024-01-15", "", C.TOP_PRODUCTS_COLUMNS,
        C.TOP_PRODUCTS_RULE, "1 | PROD-001 | 32 | 1 | 3.13%",
    ]
    assert by_day["2024-01-15"][-1] == "4 | PROD-016 | 0 | 3 | 0.00%"
    assert by_day["2024-01-16"][-1] == C.TOP_PRODUCTS_EMPTY

    conv = daily.conversion_by_product(events, "2024-01-15", "2024-01-16")
    cat_lines = reports.category_summary_lines(daily.category_conversion(conv), days)
    got = [r.line for r in cat_lines.where("report_date = date'2024-01-15'").orderBy("line_no").collect()]
    assert got[5:] == ["Laptops | 32 | 1 | 3.12%", "Smartphones | 32 | 8 | 25.00%", "Unknown | 10 | 2 | 20.00%"]
    empty = [r.line for r in cat_lines.where("report_date = date'2024-01-16'").orderBy("line_no").collect()]
    assert empty[-1] == C.CATEGORY_SUMMARY_EMPTY


def test_report_files(spark, events, scratch):
    import glob

    days = reports.report_days(spark, "2024-01-15", "2024-01-17")
    report = daily.daily_top_products(events, "2024-01-15", "2024-01-16")
    reports.write_text(reports.top_products_lines(report, days), f"{scratch}/txt")
    text = open(glob.glob(f"{scratch}/txt/report_date=2024-01-15/part-*")[0]).read().splitlines()
    assert text[0] == C.TOP_PRODUCTS_TITLE and text[5] == "1 | PROD-001 | 32 | 1 | 3.13%"
    conv = daily.conversion_by_product(events, "2024-01-15", "2024-01-16")
    reports.write_csv(reports.conversion_csv_rows(conv), f"{scratch}/csv")
    csv = open(glob.glob(f"{scratch}/csv/report_date=2024-01-15/part-*")[0]).read().splitlines()
    assert csv[0] == ",".join(C.CSV_HEADER)
    assert csv[1] == "Laptops,PROD-001,32,1,0.0313"


def test_rate_overflow_is_flagged(spark):
    from cartwheel.operators import quality
    from cartwheel.functions.rates import conversion_rate

    df = spark.createDataFrame([(1, 100), (1, 99)], "total_views long, total_purchases long")
    df = df.withColumn("conversion_rate", conversion_rate("total_purchases", "total_views"))
    got = sorted((r.total_purchases, r.fits_decimal) for r in quality.rate_fits(df).collect())
    assert got == [(99, True), (100, False)]
