"""Scans of the stored tables and of raw events by time range."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException


def load_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """``<root>/<name>.parquet`` (driver layout) or ``<root>/<name>`` (our layout)."""
    path = f"{root}/{name}.parquet" if not root.endswith(name) else root
    return spark.read.parquet(path)


def nothing_stored(error: AnalysisException) -> bool:
    """Whether a read failed because no file is there yet; any other fault is the caller's."""
    return error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def spread_small_input(df: DataFrame, slots: int | None = None) -> DataFrame:
    """Spread an input of fewer splits than task slots round-robin over the slots.

    One small file with one row group is one split, so the whole map side of a plan
    over it (JSON extraction, decode, window expansion, partial aggregates) would run
    in one task. A table of many splits - any large table - is returned as it is:
    no shuffle is added at scale.
    """
    try:
        sc = df.sparkSession.sparkContext
    except Exception:  # noqa: BLE001 - a remote (Connect) session: leave the input as it is
        return df
    slots = slots or sc.defaultParallelism
    if df.rdd.getNumPartitions() >= slots:
        return df
    return df.repartition(slots)


def as_timestamp(value) -> dt.datetime:
    """A naive UTC time; a time with a zone is brought to UTC first."""
    if isinstance(value, dt.date) and not isinstance(value, dt.datetime):
        return dt.datetime(value.year, value.month, value.day)
    found = value if isinstance(value, dt.datetime) else dt.datetime.fromisoformat(str(value))
    return found if found.tzinfo is None else found.astimezone(dt.timezone.utc).replace(tzinfo=None)


def time_literal(df: DataFrame, column: str, value):
    """Literal of the column's own timestamp type, so the predicate stays sargable.

    Built from text, which Spark reads in the session's zone (UTC); a Python datetime would
    be read in the zone of the driver's machine.
    """
    return F.lit(as_timestamp(value).isoformat(sep=" ")).cast(df.schema[column].dataType)


def in_range(df: DataFrame, start, end, column: str = "event_time") -> DataFrame:
    """Half-open ``start <= column < end``; either bound may be None (F2)."""
    cond = F.lit(True)
    if start is not None:
        cond = cond & (F.col(column) >= time_literal(df, column, start))
    if end is not None:
        cond = cond & (F.col(column) < time_literal(df, column, end))
    return df.where(cond)


def in_closed_range(df: DataFrame, start, end, column: str) -> DataFrame:
    """Closed ``start <= column <= end`` as the dashboard time macro."""
    cond = F.lit(True)
    if start is not None:
        cond = cond & (F.col(column) >= time_literal(df, column, start))
    if end is not None:
        cond = cond & (F.col(column) <= time_literal(df, column, end))
    return df.where(cond)


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder of any file system that Spark reads; none when it is missing."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = place.getFileSystem(spark._jsc.hadoopConfiguration())
    return [s.getPath().getName() for s in store.listStatus(place)] if store.exists(place) else []


def batch_records(spark: SparkSession, table_path: str, kind: str) -> list[int]:
    """Numbers of a log's batches with a record of this kind (``begun`` or ``committed``), kept in a folder beside the table."""
    names = [n.partition("-") for n in folder_names(spark, f"{table_path.rstrip('/')}.batches")]
    return [int(number) for name, _, number in names if name == kind]


def last_committed(spark: SparkSession, table_path: str) -> int | None:
    """The last batch of a log that was committed; None for a table written without such records."""
    return max(batch_records(spark, table_path, "committed"), default=None)


def committed_rows(spark: SparkSession, table_path: str, df: DataFrame) -> DataFrame:
    """The rows of whole batches: what a crashed write left behind is not seen. Batches of a log are written in
    ascending order, so one number tells them apart, and it prunes folders."""
    last = last_committed(spark, table_path) if "batch_id" in df.columns else None
    return df if last is None else df.where(F.col("batch_id") <= F.lit(last))


def read_partitions(spark: SparkSession, table_path: str, column: str, values, below: str = "") -> DataFrame | None:
    """Only the folders ``<table>/<column>=<value>[/<below>]`` of the given values, or None when none exists.

    The glob limits both the file listing and the scan to those folders, so the cost
    follows the values asked for, not the size of the table. ``below`` names a
    sub-folder (e.g. ``batch_id=7``) to read under each of them.
    """
    values = sorted({str(v) for v in values})
    if not values:
        return None
    pattern = f"{table_path.rstrip('/')}/{column}={{{','.join(values)}}}" + (f"/{below}" if below else "")
    try:
        return committed_rows(spark, table_path, spark.read.option("basePath", table_path).parquet(pattern))
    except AnalysisException as error:
        if not nothing_stored(error):
            raise
        return None


def dates_of(start, end) -> list[dt.date]:
    """Every date of ``[start, end)``; the last one counts if ``end`` has a time of day."""
    first, last = as_timestamp(start).date(), as_timestamp(end)
    n = (last.date() - first).days + (1 if last.time() != dt.time() else 0)
    return [first + dt.timedelta(days=i) for i in range(n)]


def dates_between(start, end) -> list[dt.date]:
    """Every date from ``start``'s to ``end``'s, both included."""
    first, last = as_timestamp(start).date(), as_timestamp(end).date()
    return [first + dt.timedelta(days=i) for i in range((last - first).days + 1)]


def read_events_range(spark: SparkSession, path: str, start, end) -> DataFrame:
    """Raw events of ``[start, end)`` from the stored raw table (partitioned by event_date).

    With both bounds only the date folders of the range are listed and read; the time
    predicate is pushed to Parquet. A table without date folders is read whole and filtered.
    """
    df = None
    if start is not None and end is not None:
        df = read_partitions(spark, path, "event_date", dates_between(start, end))
    if df is None:
        df = committed_rows(spark, path, spark.read.parquet(path))
    if "event_date" in df.columns:
        if start is not None:
            df = df.where(F.col("event_date") >= F.lit(as_timestamp(start).date()))
        if end is not None:
            df = df.where(F.col("event_date") <= F.lit(as_timestamp(end).date()))
    return in_range(df, start, end)


def report_rows(report: DataFrame, report_date) -> DataFrame:
    """Rows of one report date in rank order."""
    return report.where(F.col("report_date") == F.lit(as_timestamp(report_date).date())) \
        .orderBy("rank")
