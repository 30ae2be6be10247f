"""JSON decode, projection and validation of events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel import constants as C
from cartwheel.functions.once import once
from cartwheel.schemas import EVENT_SCHEMA, RAW_COLUMNS, WIDE_RAW_EXTRA

REQUIRED = ("event_id", "user_id", "product_id", "event_type")
LENGTH_LIMITS = (
    ("event_id", C.MAX_ID_LENGTH),
    ("user_id", C.MAX_ID_LENGTH),
    ("product_id", C.MAX_ID_LENGTH),
    ("category", C.MAX_ID_LENGTH),
    ("event_type", C.MAX_EVENT_TYPE_LENGTH),
)


def decode_events(records: DataFrame, value_col: str = "value", keep=("timestamp", "partition", "offset")) -> DataFrame:
    """Parse the JSON ``value`` (binary or string) by the fixed event schema.

    PERMISSIVE: malformed text gives a row of NULL fields, a NULL value a NULL
    struct; both are caught by :func:`validate`. ``event_time`` uses
    ``try_to_timestamp`` so a bad timestamp is NULL instead of an error under ANSI.
    Kafka's own timestamp is kept as ``kafka_timestamp`` next to ``partition`` and
    ``offset`` when present (they order duplicates for the raw table).
    """
    extra = []
    for name in keep:
        if name in records.columns:
            extra.append(F.col(name).alias("kafka_timestamp" if name == "timestamp" else name))
    # parsed once per row although validation tests many fields (explode_outer keeps NULL values)
    parsed = records.select(
        once(F.from_json(F.col(value_col).cast("string"), EVENT_SCHEMA)).alias("data"), *extra
    )
    return parsed.select(
        "data.*",
        F.try_to_timestamp(F.col("data.timestamp")).alias("event_time"),
        *[c for c in parsed.columns if c != "data"],
    )


def _failures(df: DataFrame):
    checks = []
    for name in REQUIRED:
        checks.append((F.col(name).isNull(), f"missing_{name}"))
    checks.append((F.col("event_time").isNull(), "bad_event_time"))
    checks.append(
        (F.col("event_type").isNotNull() & ~F.col("event_type").isin(*C.EVENT_TYPES), "bad_event_type")
    )
    for name, limit in LENGTH_LIMITS:
        if name in df.columns:
            checks.append((F.length(F.col(name)) > F.lit(limit), f"too_long_{name}"))
    return checks


def with_reason(df: DataFrame) -> DataFrame:
    """Add ``reason``: comma list of failed rules, NULL when the row is valid (Q6)."""
    parts = [F.when(cond, F.lit(label)) for cond, label in _failures(df)]
    reason = F.concat_ws(",", *parts)
    return df.withColumn("reason", F.when(reason == "", F.lit(None)).otherwise(reason))


def is_valid(df: DataFrame):
    """Boolean: no rule fails (a plain conjunction, cheap to evaluate and to push down)."""
    cond = F.lit(True)
    for failed, _ in _failures(df):
        cond = cond & ~F.coalesce(failed, F.lit(False))
    return cond


def validate(df: DataFrame):
    """Split into (valid, quarantined) rows; quarantined rows carry ``reason``."""
    valid = df.where(is_valid(df))
    bad = with_reason(df.where(~is_valid(df)))
    return valid, bad


def raw_projection(df: DataFrame, ingested_at=None, extra=(), wide: bool = False) -> DataFrame:
    """The six stored event fields plus ``ingested_at``.

    ``wide`` also keeps session, device, referrer and the Kafka timestamp where the
    input has them (D7).
    """
    stamp = ingested_at if ingested_at is not None else F.current_timestamp()
    kept = [c for c in WIDE_RAW_EXTRA if c in df.columns] if wide else []
    return df.select(*RAW_COLUMNS, *kept, stamp.alias("ingested_at"), *extra)
