"""Schema of the wire event, and keys and columns of the stored tables."""

from pyspark.sql.types import StringType, StructField, StructType

# fixed values: names, order and nullability of the JSON payload of one event, as producers send it
# (nullability documents intent; from_json does not enforce it)
EVENT_SCHEMA = StructType(
    [
        StructField("event_id", StringType(), False),
        StructField("user_id", StringType(), False),
        StructField("product_id", StringType(), False),
        StructField("category", StringType(), True),
        StructField("event_type", StringType(), False),
        StructField("timestamp", StringType(), False),
        StructField("session_id", StringType(), True),
        StructField("device", StringType(), True),
        StructField("referrer", StringType(), True),
    ]
)

# primary / unique keys of the stored tables
KEYS = {
    "clickstream_events": ("event_id",),
    "product_view_aggregates": ("window_start", "window_end", "product_id"),
    "flash_sale_alerts": ("product_id", "window_start", "window_end"),
    "user_segments": ("segment_date", "user_id"),
    "daily_product_report": ("report_date", "rank"),
}

RAW_COLUMNS = ("event_id", "user_id", "product_id", "category", "event_type", "event_time")
# wider raw record of the diagram variant (D7): the decoded fields the raw table drops
WIDE_RAW_EXTRA = ("session_id", "device", "referrer", "kafka_timestamp")
