import datetime as dt
import json

from pyspark.sql import types as T

WIRE_SCHEMA = T.StructType([
    T.StructField("value", T.BinaryType()),
    T.StructField("timestamp", T.TimestampType()),
])

CATEGORY = {1: "Laptops", 6: "Smartphones", 11: "Accessories", 16: "TVs"}


def event(event_id, product="PROD-001", etype="view", ts="2024-01-15T10:00:00.123456+00:00",
          user="USER-1A2B3C4D", category="Laptops", **extra):
    d = {"event_id": event_id, "user_id": user, "product_id": product, "category": category,
         "event_type": etype, "timestamp": ts, "session_id": "s-1", "device": "mobile",
         "referrer": "organic"}
    d.update(extra)
    return {k: v for k, v in d.items() if v is not None}


def wire(spark, payloads):
    """Kafka-shaped rows from dicts / raw strings / None."""
    rows = []
    for p in payloads:
        if p is None:
            rows.append((None, dt.datetime(2024, 1, 15)))
        elif isinstance(p, str):
            rows.append((bytearray(p.encode()), dt.datetime(2024, 1, 15)))
        else:
            rows.append((bytearray(json.dumps(p).encode()), dt.datetime(2024, 1, 15)))
    return spark.createDataFrame(rows, WIRE_SCHEMA)


def typed(spark, rows):
    """Typed clickstream events: (event_id, user_id, product_id, category, event_type, event_time)."""
    schema = ("event_id string, user_id string, product_id string, category string, "
              "event_type string, event_time timestamp")
    return spark.createDataFrame(rows, schema)


def ts(s):
    return dt.datetime.fromisoformat(s)
