"""Daily batch operators over raw events.

Each takes a half-open time range ``[start, end)``. By default it works per UTC calendar
day inside it, so a long range back-fills every day in one job (one scan, one shuffle per
aggregate). With ``as_date`` the whole range is one scheduled interval, dated by it,
wherever in the day the interval starts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cartwheel import constants as C
from cartwheel.functions.rates import conversion_rate, double_percent_text
from cartwheel.sources.adapter import category_of, product_id_of
from cartwheel.sources.tables import in_range


def _views():
    return F.count_if(F.col("event_type") == "view").alias("total_views")


def _purchases():
    return F.count_if(F.col("event_type") == "purchase").alias("total_purchases")


def _carts():
    return F.count_if(F.col("event_type") == "add_to_cart").alias("total_carts")


def day_events(events: DataFrame, start, end, day_col: str, time_col: str = "event_time", as_date=None) -> DataFrame:
    """Events of ``[start, end)`` with their UTC day, or ``as_date``; the range predicate reaches the scan."""
    day = F.to_date(F.col(time_col)) if as_date is None else F.lit(str(as_date)).cast("date")
    return in_range(events, start, end, time_col).withColumn(day_col, day)


def product_day_counts(events: DataFrame, start, end, as_date=None) -> DataFrame:
    """Views and purchases per (day, product); products with purchases only are kept (A2)."""
    return (
        day_events(events, start, end, "report_date", as_date=as_date)
        .groupBy("report_date", "product_id")
        .agg(_views(), _purchases())
    )


def daily_top_products(
    events: DataFrame, start, end, top_n: int = C.TOP_N, strict: bool = True, created_at=None, as_date=None
) -> DataFrame:
    """Top products per day by views, ties by product_id, with a 4-place rate.

    ``row_number() <= n`` per day: Spark inserts a WindowGroupLimit below the
    shuffle, so each task forwards at most ``n`` rows per day. The stored rate is
    DECIMAL(6,4); ``strict`` makes an overflow (ratio >= 100) fail as the database
    column does, otherwise it becomes NULL.
    """
    counts = product_day_counts(events, start, end, as_date)
    order = Window.partitionBy("report_date").orderBy(F.desc("total_views"), F.asc("product_id"))
    ranked = counts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top_n)
    rate = conversion_rate("total_purchases", "total_views")
    rate = rate.cast("decimal(6,4)") if strict else rate.try_cast("decimal(6,4)")
    cols = [
        "report_date",
        F.col("rank").cast("smallint").alias("rank"),
        "product_id",
        "total_views",
        "total_purchases",
        rate.alias("conversion_rate"),
    ]
    if created_at is not None:
        cols.append(created_at.alias("created_at"))
    return ranked.select(*cols)


def user_segments(
    events: DataFrame, start, end, three_way: bool = False, created_at=None, as_date=None
) -> DataFrame:
    """Per (day, user): Buyer when any purchase, else Window Shopper.

    ``three_way`` adds Prospective Buyer for users with a cart addition but no
    purchase (D3). The per-user aggregate combines map-side, so a user holding a
    large share of the events costs one partial row per task.
    """
    agg = (
        day_events(events, start, end, "segment_date", as_date=as_date)
        .groupBy("segment_date", "user_id")
        .agg(_views(), _purchases(), _carts())
    )
    segment = F.when(F.col("total_purchases") > 0, F.lit(C.SEGMENT_BUYER))
    if three_way:
        segment = segment.when(F.col("total_carts") > 0, F.lit(C.SEGMENT_PROSPECTIVE))
    segment = segment.otherwise(F.lit(C.SEGMENT_WINDOW_SHOPPER))
    cols = ["segment_date", "user_id", segment.alias("segment"), "total_views", "total_purchases"]
    if created_at is not None:
        cols.append(created_at.alias("created_at"))
    return agg.select(*cols)


def conversion_by_product(events: DataFrame, start, end, as_date=None) -> DataFrame:
    """Per (day, category or 'Unknown', product) with views > 0 and a 4-place rate."""
    return (
        day_events(events, start, end, "report_date", as_date=as_date)
        .groupBy(
            "report_date",
            F.coalesce(F.col("category"), F.lit(C.UNKNOWN_CATEGORY)).alias("category"),
            "product_id",
        )
        .agg(_views(), _purchases())
        .where(F.col("total_views") > 0)
        .withColumn("conversion_rate", conversion_rate("total_purchases", "total_views"))
    )


def conversion_order():
    """Report order: category, rate desc, views desc, product (L2)."""
    return [
        F.asc("category"),
        F.desc("conversion_rate"),
        F.desc("total_views"),
        F.asc("product_id"),
    ]


def category_conversion(conversion: DataFrame) -> DataFrame:
    """Category roll-up of the per-product rows: ratio of sums, unrounded.

    Runs after the views > 0 filter, so purchases of products without views stay out.
    """
    return (
        conversion.groupBy("report_date", "category")
        .agg(
            F.sum("total_views").alias("total_views"),
            F.sum("total_purchases").alias("total_purchases"),
        )
        .withColumn(
            "conversion_pct",
            F.col("total_purchases").cast("double") / F.col("total_views").cast("double") * F.lit(100.0),
        )
        .withColumn("conversion_text", double_percent_text("total_purchases", "total_views"))
    )


def catalogue(spark: SparkSession) -> DataFrame:
    """The product catalogue (product_id, category): a fixed 20-row table."""
    return (
        spark.range(1, C.PRODUCT_COUNT + 1)
        .select(product_id_of(F.col("id")).alias("product_id"), category_of(F.col("id")).alias("category"))
    )


# a category map is broadcast without measuring it only when its row count is known to be
# at most this (the fixed catalogue); otherwise AQE measures it at run time
MAP_BROADCAST_ROWS = 1_000_000


def category_map_conversion(
    events: DataFrame, start, end, categories: DataFrame, map_rows: int | None = None
) -> DataFrame:
    """Per-day product metrics joined with a category map, rate in percent.

    ``map_rows`` is a known bound on the map's rows (the catalogue's product count):
    within ``MAP_BROADCAST_ROWS`` the map is broadcast and the metrics never shuffle
    for the join. A map of unknown size gets no hint: AQE broadcasts it only when its
    measured size is under the broadcast threshold and joins by shuffle otherwise.
    """
    metrics = product_day_counts(events, start, end)
    if map_rows is not None and map_rows <= MAP_BROADCAST_ROWS:
        categories = F.broadcast(categories)
    return metrics.join(categories, "product_id", "left").select(
        "report_date",
        "product_id",
        F.coalesce(F.col("category"), F.lit(C.UNKNOWN_CATEGORY)).alias("category"),
        "total_views",
        "total_purchases",
        (conversion_rate("total_purchases", "total_views") * F.lit(100))
        .cast("decimal(24,2)").alias("conversion_rate_pct"),
    )


def segment_share(segments: DataFrame) -> DataFrame:
    """Users per segment and day with their share in percent, 2 places."""
    counts = segments.groupBy("segment_date", "segment").agg(F.count(F.lit(1)).alias("users"))
    total = F.sum("users").over(Window.partitionBy("segment_date"))
    return counts.withColumn("day_users", total).withColumn(
        "share_pct", (conversion_rate("users", "day_users") * F.lit(100)).cast("decimal(24,2)")
    )


def top_from_aggregates(aggregates: DataFrame, top_n: int = C.TOP_N) -> DataFrame:
    """Top products ranked from window aggregates instead of raw events."""
    sums = aggregates.groupBy("product_id").agg(
        F.sum("view_count").alias("total_views"), F.sum("purchase_count").alias("total_purchases")
    )
    order = Window.orderBy(F.desc("total_views"), F.asc("product_id"))
    return (
        sums.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= top_n)
        .withColumn("conversion_rate", conversion_rate("total_purchases", "total_views"))
    )
