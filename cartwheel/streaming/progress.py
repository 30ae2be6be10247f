"""Progress metrics of streaming queries as a DataFrame."""

from __future__ import annotations

import collections
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQueryListener

from cartwheel import constants as C
from cartwheel.operators import decode

PROGRESS_SCHEMA = T.StructType([
    T.StructField("query_name", T.StringType()),
    T.StructField("batch_id", T.LongType()),
    T.StructField("num_input_rows", T.LongType()),
    T.StructField("input_rows_per_second", T.DoubleType()),
    T.StructField("processed_rows_per_second", T.DoubleType()),
    T.StructField("state_rows_total", T.LongType()),
    T.StructField("rows_dropped_by_watermark", T.LongType()),
])


def progress_rows(progress: list) -> list:
    """Flatten ``query.recentProgress`` entries (one per micro-batch, bounded by retention)."""
    rows = []
    for p in progress:
        ops = p.get("stateOperators") or []
        rows.append((
            p.get("name"),
            int(p.get("batchId", -1)),
            int(p.get("numInputRows", 0)),
            float(p.get("inputRowsPerSecond") or 0.0),
            float(p.get("processedRowsPerSecond") or 0.0),
            int(sum(o.get("numRowsTotal", 0) for o in ops)),
            int(sum(o.get("numRowsDroppedByWatermark", 0) for o in ops)),
        ))
    return rows


def progress_frame(spark: SparkSession, progress: list) -> DataFrame:
    return spark.createDataFrame(progress_rows(progress), PROGRESS_SCHEMA)


def progress_line(p: dict) -> str:
    """One log line per micro-batch: query, batch, input rows and the two rates."""
    return (f"[progress] {p.get('name')} batch={p.get('batchId')} input_rows={p.get('numInputRows', 0)} "
            f"input_rows_per_s={float(p.get('inputRowsPerSecond') or 0.0):.1f} "
            f"processed_rows_per_s={float(p.get('processedRowsPerSecond') or 0.0):.1f}")


class ProgressLog(StreamingQueryListener):
    """Listener that sees every micro-batch of every query in the session.

    ``recentProgress`` of a query keeps only the last few batches; the listener prints
    one line per batch and keeps the last ``keep`` progress entries (bounded memory).
    Register with ``spark.streams.addListener(log)``.
    """

    def __init__(self, keep: int = 1000, echo: bool = True):
        self.recent = collections.deque(maxlen=keep)
        self.echo = echo

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        entry = json.loads(p.json) if hasattr(p, "json") else dict(p)
        self.recent.append(entry)
        if self.echo:
            print(progress_line(entry), flush=True)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


#: Fields of a stored progress record: the progress of one micro-batch and what was observed in it.
METRICS_SCHEMA = T.StructType([
    *PROGRESS_SCHEMA.fields, T.StructField("run_id", T.StringType()),
    T.StructField("observed", T.MapType(T.StringType(), T.MapType(T.StringType(), T.LongType()))),
])


def watched(decoded: DataFrame, name: str = "decoded") -> DataFrame:
    """The same rows, counted on their way: all, valid, without a time (F10), and valid ones of each type.

    The counts of a micro-batch come with its progress; a batch without rows counts zero (F8).
    """
    valid = decode.is_valid(decoded)
    return decoded.observe(
        name, F.count(F.lit(1)).alias("rows"), F.count_if(valid).alias("valid"),
        F.count_if(F.col("event_time").isNull()).alias("without_time"),
        *[F.count_if(valid & (F.col("event_type") == t)).alias(t) for t in C.EVENT_TYPES])


class MetricsTable(StreamingQueryListener):
    """Keeps the progress of every micro-batch of the session as a table: one small JSON file each in ``folder``.

    Nothing is held in memory, and no entry is dropped; a record that comes twice has the same name.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        entry = json.loads(event.progress.json)
        row = dict(zip(PROGRESS_SCHEMA.names, progress_rows([entry])[0])) | {
            "run_id": entry["runId"], "observed": entry.get("observedMetrics") or {}}
        place = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{entry['runId']}-{row['batch_id']}.json")
        out = place.getFileSystem(self.spark._jsc.hadoopConfiguration()).create(place, True)
        out.write(bytearray(json.dumps(row).encode()))
        out.close()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def read_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(METRICS_SCHEMA).json(folder)


class Supervision(StreamingQueryListener):
    """How the session's queries ended (T9): one entry for each query that terminated, seen by its id."""

    def __init__(self):
        self.names: dict[str, str] = {}
        self.ended: list[tuple[str, str, str | None]] = []

    def onQueryStarted(self, event) -> None:
        self.names[str(event.id)] = event.name

    def onQueryProgress(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.ended.append((self.names.get(str(event.id)), "failed" if event.exception else "stopped",
                           event.errorClassOnException))


def settle(spark: SparkSession, milliseconds: int = 30_000) -> None:
    """Waits until listeners have seen every event that was posted."""
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(milliseconds)
