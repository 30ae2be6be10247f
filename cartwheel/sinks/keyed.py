"""Keyed tables over Parquet without a transactional table format.

A table is a folder of micro-batch slices ``<table>/batch_id=<N>/`` or, for a
partitioned log, ``<table>/<partition>=<v>/batch_id=<N>/`` (raw events by
``event_date``, window logs by ``window_date``, the date of the window start: a
function of the key, so every version of a key sits in one date folder and a read
of a time range lists only its dates). Each slice is written with overwrite, so a
replayed batch replaces its own slice and changes nothing else (idempotent
at-least-once delivery).

Beside a table, ``<table>.batches`` has an empty record ``begun-<N>`` of a batch that is being written and
``committed-<N>`` of the last whole one. A batch that was begun before is a second try: what the first one wrote, in
whatever folders, goes first. Readers see the batches up to the last committed one. A record ``schema`` has the columns
of the first batch: a table whose batches were all empty has no file to tell them, and reads as no rows of that schema.

* insert-ignore (raw events): a slice only holds keys not seen in earlier slices;
  the table is the union of the slices.
* upsert (aggregates, alerts): the table is the latest row per key by batch id.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from cartwheel.sources.tables import (batch_records, committed_rows, folder_names, last_committed, nothing_stored,
                                      read_partitions)

BATCH_COL = "batch_id"
# layout column of the upsert logs of windows: the UTC date of window_start
WINDOW_DATE = "window_date"
# keys of one micro-batch broadcast for the history probe: at most this many keys and this
# many estimated bytes (key text + row overhead); larger batches use a shuffle anti join
BROADCAST_KEY_LIMIT = 2_000_000
BROADCAST_KEY_BYTES = 64 * 1024 * 1024
KEY_ROW_OVERHEAD = 32


def slice_path(table_path: str, batch_id: int) -> str:
    return f"{table_path}/{BATCH_COL}={int(batch_id)}"


def write_slice(df: DataFrame, table_path: str, batch_id: int, partition_by=()) -> None:
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(slice_path(table_path, batch_id))


def drop_slice(spark: SparkSession, table_path: str, batch_id: int) -> None:
    _drop_folder(spark, slice_path(table_path, batch_id))


def read_log(spark: SparkSession, table_path: str, schema=None) -> DataFrame | None:
    """All slices with their ``batch_id``; when there are none, an empty frame of ``schema`` or of the recorded one, or None."""
    try:
        return committed_rows(spark, table_path, spark.read.option("basePath", table_path).parquet(table_path))
    except AnalysisException as error:
        if not nothing_stored(error):
            raise
        schema = schema or recorded_schema(spark, table_path)
        if schema is None:
            return None
        return spark.createDataFrame([], schema).withColumn(BATCH_COL, F.lit(0))


def _record(spark: SparkSession, table_path: str, name: str, text: str = "") -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(f"{table_path.rstrip('/')}.batches/{name}")
    out = place.getFileSystem(spark._jsc.hadoopConfiguration()).create(place, True)
    out.write(bytearray(text.encode()))
    out.close()


def recorded_schema(spark: SparkSession, table_path: str) -> T.StructType | None:
    """The columns of a log's first committed batch; None before any was committed."""
    if last_committed(spark, table_path) is None:
        return None
    place = f"{table_path.rstrip('/')}.batches"
    if "schema" not in folder_names(spark, place):  # a log of an older version
        return None
    return T.StructType.fromJson(json.loads(spark.read.text(f"{place}/schema", wholetext=True).first()[0]))


def begin_batch(spark: SparkSession, table_path: str, batch_id: int, levels: int = 0) -> None:
    """Records that a batch is being written; of an earlier try at it nothing stays.

    ``levels`` is the depth of the partition folders above ``batch_id=<N>``. They are listed for a second try alone.
    """
    last = last_committed(spark, table_path)
    again = batch_id in batch_records(spark, table_path, "begun") or (last is not None and batch_id <= last)
    if again:
        pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{table_path}/{'*=*/' * levels}{BATCH_COL}={int(batch_id)}")
        store = pattern.getFileSystem(spark._jsc.hadoopConfiguration())
        for found in store.globStatus(pattern) or []:
            store.delete(found.getPath(), True)
    else:
        _record(spark, table_path, f"begun-{int(batch_id)}")


def commit_batch(spark: SparkSession, table_path: str, batch_id: int) -> None:
    """Makes a written batch visible: one new record, then the older ones go."""
    last = last_committed(spark, table_path)
    if last is None or last < batch_id:
        _record(spark, table_path, f"committed-{int(batch_id)}")
    stays = batch_id if last is None else max(batch_id, last)
    for kind, least in (("committed", stays), ("begun", batch_id + 1)):
        for number in batch_records(spark, table_path, kind):
            if number < least:
                _drop_folder(spark, f"{table_path.rstrip('/')}.batches/{kind}-{number}")


def first_per_key(batch: DataFrame, key: str, order_cols) -> DataFrame:
    """One row per key: the first by ``order_cols`` (delivery order), combined map-side."""
    values = [c for c in batch.columns if c != key]
    order = F.struct(*[F.col(c) for c in order_cols], *[F.col(c) for c in values])
    picked = batch.groupBy(key).agg(F.min_by(F.struct(*values), order).alias("_row"))
    return picked.select(key, "_row.*")


def write_log_rows(df: DataFrame, table_path: str, batch_id: int, partition_by=(), observe: bool = False):
    """Write a batch's rows; partitioned logs keep the batch id below the partition folders.

    Dynamic overwrite replaces exactly the folders ``<partition>=<v>/batch_id=<N>`` the
    batch writes, so a replayed batch replaces its own rows and nothing else. With
    ``observe`` the values of the first partition column written are gathered during
    the write (a few dates per batch) and returned; None when they are not known.
    """
    spark = df.sparkSession
    begin_batch(spark, table_path, batch_id, len(partition_by))
    if last_committed(spark, table_path) is None:
        _record(spark, table_path, "schema", df.schema.json())
    if not partition_by:
        write_slice(df, table_path, batch_id)
        commit_batch(spark, table_path, batch_id)
        return None
    seen = Observation(f"written_{uuid.uuid4().hex}") if observe else None
    if seen is not None:
        df = df.observe(seen, F.collect_set(F.col(partition_by[0])).alias("values"))
    # few files: rows are gathered by partition value, and a large value is split by its measured size
    (
        df.hint("rebalance", *partition_by)
        .withColumn(BATCH_COL, F.lit(int(batch_id)))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by, BATCH_COL)
        .parquet(table_path)
    )
    commit_batch(spark, table_path, batch_id)
    if seen is None:
        return None
    try:
        return set(seen.get["values"])
    except Exception:  # noqa: BLE001 - metrics can be missing for an empty input
        return None


def read_batch(spark: SparkSession, table_path: str, batch_id: int, partition_col: str | None = None,
               values=None) -> DataFrame | None:
    """The rows one batch wrote, or None when it wrote none.

    For a partitioned log only ``<partition>=<v>/batch_id=<N>`` is listed: the given
    values, or every value folder when they are not known.
    """
    below = f"{BATCH_COL}={int(batch_id)}"
    if partition_col is None:
        try:
            return spark.read.parquet(slice_path(table_path, batch_id))
        except AnalysisException as error:
            if not nothing_stored(error):
                raise
            return None
    if values is not None:
        return read_partitions(spark, table_path, partition_col, values, below)
    try:
        return spark.read.option("basePath", table_path).parquet(f"{table_path}/{partition_col}=*/{below}")
    except AnalysisException as error:
        if not nothing_stored(error):
            raise
        return None


def history_keys(
    spark: SparkSession,
    table_path: str,
    batch: DataFrame,
    batch_id: int,
    key: str,
    probe_by: str | None = None,
    probe_range: str | None = None,
    with_bytes: bool = False,
):
    """Keys of earlier slices a batch could collide with, and the batch's key count.

    ``probe_by`` names a partition column whose value is fixed for a key: only the
    folders of the batch's values are listed and read. ``probe_range`` names a column
    whose value is also fixed for a key (the event time, when ids come back only as
    exact copies): per value of ``probe_by`` only history rows between the batch's least
    and greatest value can match, and that range is pushed to Parquet, which skips row
    groups outside it. An id that comes back with another value of either column is not
    found. Returns ``(keys or None, n_keys)``, with ``with_bytes`` also the total length
    of the batch's key text (measured in the same pass).
    """
    stats = [F.count(F.lit(1)).alias("_n"),
             F.coalesce(F.sum(F.octet_length(F.col(key).cast("string"))), F.lit(0)).alias("_b")]

    def result(keys, rows):
        n_keys = sum(r["_n"] for r in rows)
        return (keys, n_keys, sum(r["_b"] for r in rows)) if with_bytes else (keys, n_keys)

    if not probe_by:
        log = read_log(spark, table_path)
        totals = [batch.agg(*stats).first()]
        if log is None:
            return result(None, totals)
        return result(log.where(F.col(BATCH_COL) < F.lit(int(batch_id))).select(key), totals)
    if probe_range:
        # as text, which Spark reads back in the session's zone whatever the machine's zone is
        stats += [F.min(probe_range).cast("string").alias("_lo"), F.max(probe_range).cast("string").alias("_hi")]
    # one row per value in the batch (the dates of one micro-batch): bounded metadata
    per_value = batch.groupBy(probe_by).agg(*stats).collect()
    log = read_partitions(spark, table_path, probe_by, [r[probe_by] for r in per_value])
    if log is None:
        return result(None, per_value)
    log = log.where(F.col(BATCH_COL) < F.lit(int(batch_id)))
    if probe_range:
        kind = log.schema[probe_range].dataType
        cond = None
        for r in per_value:
            one = F.col(probe_by) == F.lit(r[probe_by])
            if r["_lo"] is not None:
                one = one & F.col(probe_range).between(F.lit(r["_lo"]).cast(kind), F.lit(r["_hi"]).cast(kind))
            cond = one if cond is None else cond | one
        log = log.where(cond)
    return result(log.select(key), per_value)


def insert_ignore(
    spark: SparkSession,
    batch: DataFrame,
    table_path: str,
    batch_id: int,
    key: str = "event_id",
    order_cols=("event_time",),
    partition_by=("event_date",),
    probe_by: str | None = None,
    probe_range: str | None = None,
    broadcast_limit: int = BROADCAST_KEY_LIMIT,
    order_only=(),
    broadcast_bytes: int = BROADCAST_KEY_BYTES,
) -> None:
    """Append the batch's rows whose key is in no earlier slice; first row wins inside the batch.

    ``order_only`` names columns that serve the first-row choice only (e.g. the source
    offsets); they are not stored.

    The history is probed with the batch's keys: a semi join against the broadcast
    keys scans history column-pruned to the key and never shuffles it. When the
    batch has more keys than ``broadcast_limit``, or more estimated bytes than
    ``broadcast_bytes`` (key text measured with the count, plus a row overhead), a
    shuffle anti join is used.

    ``probe_by`` names a partition column whose value is fixed for a key (for events,
    the date of the event time: a redelivered event carries its own time); the probe
    then lists only the batch's date folders, so its cost follows the batch, not the
    table. ``probe_range`` (the event time) also skips row groups outside the batch's
    time span, for keys that only ever come back as exact copies (see
    ``history_keys``). None probes the whole history.
    """
    first = first_per_key(batch, key, order_cols).persist()
    try:
        seen_keys, n_keys, key_bytes = history_keys(spark, table_path, first, batch_id, key, probe_by,
                                                    probe_range, with_bytes=True)
        if seen_keys is not None:
            batch_keys = first.select(key)
            size = key_bytes + KEY_ROW_OVERHEAD * n_keys
            if n_keys <= broadcast_limit and size <= broadcast_bytes:
                seen = seen_keys.join(F.broadcast(batch_keys), key, "left_semi")
                fresh = first.join(F.broadcast(seen), key, "left_anti")
            else:
                fresh = first.join(seen_keys, key, "left_anti")
        else:
            fresh = first
        write_log_rows(fresh.drop(*order_only), table_path, batch_id, partition_by)
    finally:
        first.unpersist()


def latest_per_key(log: DataFrame, keys, layout=(WINDOW_DATE,)) -> DataFrame:
    """Current state of an upsert log: per key the row of the highest batch id (partial aggregate).

    Layout columns present in the log are functions of the key: they group along and stay.
    """
    group = list(keys) + [c for c in layout if c in log.columns and c not in keys]
    values = [c for c in log.columns if c not in group and c != BATCH_COL]
    # one aggregate a column: with fixed-width columns Spark hashes, a struct would make it sort the whole log
    return log.groupBy(*group).agg(*[F.max_by(c, BATCH_COL).alias(c) for c in values])


def upsert(batch: DataFrame, table_path: str, batch_id: int, partition_by=(), observe: bool = False):
    """Record the batch's rows as the newest version of their keys (K2, K3).

    ``partition_by`` (e.g. ``window_date``) must be a function of the key. Returns the
    written values of the first partition column when ``observe`` is set.
    """
    return write_log_rows(batch, table_path, batch_id, partition_by, observe)


def current(spark: SparkSession, table_path: str, keys, schema=None, dates=None,
            date_col: str = WINDOW_DATE) -> DataFrame:
    """Latest row per key. A log laid out by ``date_col`` is read through it: ``dates``
    limits the listing and the scan to those date folders; the column is not returned."""
    log = None
    if dates is not None:
        log = read_partitions(spark, table_path, date_col, dates)
        if log is None:
            full = read_log(spark, table_path, schema)
            if full is None:
                raise FileNotFoundError(table_path)
            log = full.where(F.lit(False))
    else:
        log = read_log(spark, table_path, schema)
    if log is None:
        raise FileNotFoundError(table_path)
    out = latest_per_key(log, keys, layout=(date_col,))
    return out.drop(date_col) if date_col in out.columns and date_col not in keys else out


def union_of_slices(spark: SparkSession, table_path: str, schema=None) -> DataFrame:
    """Insert-ignore table content: every slice's rows, without the batch column."""
    log = read_log(spark, table_path, schema)
    if log is None:
        raise FileNotFoundError(table_path)
    return log.drop(BATCH_COL)


def compact(spark: SparkSession, table_path: str, keys, out_path: str, upto_batch: int | None = None,
            date_col: str = WINDOW_DATE) -> None:
    """Write the current state of an upsert log as one snapshot slice of a new table.

    New slices go on being appended to the new table with higher batch ids; the old
    folder can then be dropped. Keeps reads and listings bounded as the log grows.
    A log laid out by ``date_col`` keeps that layout.
    """
    log = read_log(spark, table_path)
    if upto_batch is not None:
        log = log.where(F.col(BATCH_COL) <= F.lit(int(upto_batch)))
    snapshot_id = upto_batch if upto_batch is not None else 0
    latest = latest_per_key(log, keys, layout=(date_col,))
    layout = (date_col,) if date_col in latest.columns and date_col not in keys else ()
    write_log_rows(latest, out_path, snapshot_id, layout)


def compact_dates(spark: SparkSession, table_path: str, date_col: str, dates, keys=None, unique=("event_id",)) -> list:
    """Rewrite each given date of a date-first log as a single slice (fewer, larger files).

    An upsert log (``keys`` given) keeps only the latest row per key, so the versions
    merged into one slice stay unambiguous; an insert-ignore log keeps every row.

    The newest batch of the log stays as it is, since a restart may run it again. A date's older rows
    are written as ``<date_col>=<d>/batch_id=<a new negative id>``, which stands before every batch, and only
    then their folders are dropped: a crash between leaves rows twice for the next run to merge (raw
    rows by ``unique``), never none. Returns the dates rewritten; one job pair per date, dates are few.
    """
    log = read_log(spark, table_path)
    if log is None:
        return []
    newest = log.agg(F.max(BATCH_COL)).first()[0]
    done = []
    for d in sorted({str(v) for v in dates}):
        rows = read_partitions(spark, table_path, date_col, [d])
        if rows is None:
            continue
        rows = rows.where(F.col(BATCH_COL) < newest)
        old = sorted(r[0] for r in rows.select(BATCH_COL).distinct().collect())
        if not old or old == [old[0]] and old[0] < 0:
            continue
        if keys:
            merged = latest_per_key(rows, keys, layout=(date_col,))
        else:
            merged = rows.dropDuplicates(list(unique)) if unique and set(unique) <= set(rows.columns) else rows
        folder = f"{table_path.rstrip('/')}/{date_col}={d}"
        merged.drop(date_col, BATCH_COL).repartition(1 + len(old) // 64).write.mode("overwrite").parquet(
            f"{folder}/{BATCH_COL}={min(old[0], 0) - 1}")
        for batch in old:
            _drop_folder(spark, f"{folder}/{BATCH_COL}={batch}")
        done.append(d)
    return done


def _drop_folder(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
