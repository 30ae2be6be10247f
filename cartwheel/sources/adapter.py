"""Adapter from the driver's generic ``events`` table to clickstream events.

The generic table has ``event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT,
event_type STRING, value DOUBLE, props STRING`` and no product stream; the
product, category and clickstream event type are derived from it by a fixed
rule so that every engine can reproduce them:

* ``k = props.k`` (0..99); product = ``PROD-`` + zero padded ``k % 20 + 1``
* category: five products per category in catalogue order, NULL when ``k >= 95``
* ``click`` -> ``view``, ``signup`` -> ``add_to_cart``; other types pass as they are
  (``error`` stays out of domain and is quarantined by validation)
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwheel import constants as C
from cartwheel.functions.once import once

_TYPE_MAP = {"click": "view", "signup": "add_to_cart"}


def _k(props: Column) -> Column:
    return F.get_json_object(props, "$.k").try_cast("int")


def product_id_of(product_number: Column) -> Column:
    return F.concat(F.lit("PROD-"), F.lpad(product_number.cast("string"), 3, "0"))


def category_of(product_number: Column) -> Column:
    """Catalogue rule: products 1-5 Laptops, 6-10 Smartphones, 11-15 Accessories, 16-20 TVs."""
    idx = F.floor((product_number - 1) / C.PRODUCTS_PER_CATEGORY).cast("int") + 1
    return F.element_at(F.array(*[F.lit(c) for c in C.CATEGORIES]), idx)


def clickstream_from_events(events: DataFrame) -> DataFrame:
    """Typed clickstream events: event_id, user_id, product_id, category, event_type, event_time.

    ``event_time`` keeps the source column's type (TIMESTAMP_NTZ here) so range
    filters on it reach the Parquet scan; the session time zone is UTC, so the
    instant is the same as a TIMESTAMP.
    """
    with_k = events.select("event_id", "ts", "user_id", "event_type", once(_k(F.col("props"))).alias("k"))
    k = F.col("k")
    product_number = (k % C.PRODUCT_COUNT) + 1
    event_type = F.col("event_type")
    for src, dst in _TYPE_MAP.items():
        event_type = F.when(F.col("event_type") == src, F.lit(dst)).otherwise(event_type)
    return with_k.select(
        F.col("event_id").cast("string").alias("event_id"),
        F.concat(F.lit("USER-"), F.lpad(F.col("user_id").cast("string"), 5, "0")).alias("user_id"),
        product_id_of(product_number).alias("product_id"),
        F.when(k >= 95, F.lit(None).cast("string"))
        .otherwise(category_of(product_number)).alias("category"),
        event_type.alias("event_type"),
        F.col("ts").alias("event_time"),
    )


def iso_timestamp_text(ts: Column) -> Column:
    """ISO-8601 text with a UTC offset; the fraction is left out when it is zero."""
    whole = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    frac = F.date_format(ts, "SSSSSS")
    return F.concat(
        whole,
        F.when(frac == "000000", F.lit("")).otherwise(F.concat(F.lit("."), frac)),
        F.lit("+00:00"),
    )


def wire_from_events(events: DataFrame, topic: str = "clickstream-events") -> DataFrame:
    """Kafka-shaped records (``key, value BINARY, topic, partition, offset, timestamp``).

    The value is the JSON event as the producer sends it; session, device and
    referrer are filled by fixed rules from the user and event ids. A NULL
    category is left out of the JSON, as a missing field.
    """
    base = clickstream_from_events(events).withColumn("_uid", F.col("event_id").cast("long"))
    user_num = F.regexp_extract(F.col("user_id"), r"(\d+)$", 1).cast("long")
    payload = F.struct(
        "event_id",
        "user_id",
        "product_id",
        "category",
        "event_type",
        iso_timestamp_text(F.col("event_time")).alias("timestamp"),
        F.concat(F.lit("SESSION-"), F.col("user_id"), F.lit("-"),
                 F.date_format("event_time", "yyyyMMdd")).alias("session_id"),
        F.element_at(F.array(*[F.lit(d) for d in C.DEVICES]),
                     (user_num % len(C.DEVICES) + 1).cast("int")).alias("device"),
        F.element_at(F.array(*[F.lit(r) for r in C.REFERRERS]),
                     (F.col("_uid") % len(C.REFERRERS) + 1).cast("int")).alias("referrer"),
    )
    return base.select(
        F.lit(None).cast("binary").alias("key"),
        F.to_json(payload).cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
        F.lit(0).alias("partition"),
        F.col("_uid").alias("offset"),
        F.col("event_time").cast("timestamp").alias("timestamp"),
    )
