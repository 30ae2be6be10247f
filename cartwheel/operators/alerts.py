"""Flash-sale rule on window aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel import constants as C


def flash_sale(
    aggregates: DataFrame,
    min_views: int = C.FLASH_SALE_MIN_VIEWS,
    max_purchases: int = C.FLASH_SALE_MAX_PURCHASES,
    message: str = C.ALERT_MESSAGE,
    created_at=None,
) -> DataFrame:
    """Windows with ``view_count > min_views AND purchase_count < max_purchases``.

    Both comparisons are strict. ``created_at`` defaults to the batch clock.
    """
    stamp = created_at if created_at is not None else F.current_timestamp()
    return aggregates.where(
        (F.col("view_count") > F.lit(min_views)) & (F.col("purchase_count") < F.lit(max_purchases))
    ).select(
        "product_id",
        "view_count",
        "purchase_count",
        "window_start",
        "window_end",
        F.lit(message).alias("alert_message"),
        stamp.alias("created_at"),
    )
