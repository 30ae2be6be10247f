"""The real-time job.

Queries over one decoded stream:

* raw events (T5): of the valid rows of an ``event_id`` the first one by delivery goes to the raw table
  partitioned by ``event_date`` (K1). The first row of each id is state in RocksDB, so the cost of a batch
  follows the batch and uniqueness has no limit of date; other ways are options;
* quarantine (append): bad rows with a reason;
* window aggregates (update, T4): watermark + sliding window counts per product;
  each micro-batch is upserted into the aggregates log (K2), then read back from
  the shared folder and filtered by the flash-sale rule into the alerts log (K3).
  Both logs are laid out by window date, then batch id.
  One stateful query feeds both outputs, so state is kept once (T11). Alerts are
  latched: update mode emits no retraction (T10).

Checkpoints live under the session's shared checkpoint folder unless given.
"""

from __future__ import annotations

import contextlib
import datetime as dt
import time
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.utils import AnalysisException

from cartwheel.config import StreamSettings
from cartwheel.operators import alerts as alert_ops
from cartwheel.operators import decode
from cartwheel.operators.windows import duration, sliding_counts
from cartwheel.schemas import KEYS, RAW_COLUMNS, WIDE_RAW_EXTRA
from cartwheel.session import checkpoint_root
from cartwheel.sinks import keyed, zones
from cartwheel.sources.tables import (as_timestamp, dates_between, folder_names, in_closed_range, nothing_stored,
                                      read_events_range)
from cartwheel.streaming import panes, progress


# most partitions of a query's state by default. Each task of a stateful stage reports on every partition of the state,
# so what the driver takes in grows with their square, and each partition costs its own files in every micro-batch
STATE_PARTITIONS = 48
# the window query's state is one row per product and open window, whatever the number of events
WINDOW_STATE_PARTITIONS = 12
STATE_STORE = "spark.sql.streaming.stateStore"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextlib.contextmanager
def stateful(spark: SparkSession, partitions: int):
    """Settings of a query that is started inside: it takes a copy of them, and the session's own stay as they were.

    At most ``partitions`` partitions of state, in RocksDB off the JVM heap with uploads of changes, unless the session
    names another store. A checkpoint that has begun keeps what it began with.
    """
    wanted = {"spark.sql.shuffle.partitions": str(min(int(partitions), int(spark.conf.get("spark.sql.shuffle.partitions"))))}
    if not spark.conf.get(f"{STATE_STORE}.providerClass", ""):
        wanted[f"{STATE_STORE}.providerClass"] = ROCKSDB
        wanted[f"{STATE_STORE}.rocksdb.changelogCheckpointing.enabled"] = "true"
    before = {key: spark.conf.get(key, None) for key in wanted}
    try:
        for key, value in wanted.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


@dataclass(frozen=True)
class JobPaths:
    """Folders of the job's tables. ``run`` names the checkpoints: another run over the same tables starts anew."""

    root: str
    run: str = ""

    @property
    def raw(self) -> str:
        return f"{self.root}/clickstream_events"

    @property
    def quarantine(self) -> str:
        return f"{self.root}/quarantine"

    @property
    def aggregates(self) -> str:
        return f"{self.root}/product_view_aggregates"

    @property
    def alerts(self) -> str:
        return f"{self.root}/flash_sale_alerts"

    @property
    def panes(self) -> str:
        return f"{self.checkpoint('aggregates')}-open-panes"

    def checkpoint(self, name: str) -> str:
        return f"{self.root}/_checkpoints{'-' + self.run if self.run else ''}/{name}"


def first_batch(spark: SparkSession, checkpoint: str, *logs: str) -> int:
    """What a run adds to its batch ids: one more than any id in the logs when its checkpoint was new.

    Kept beside the checkpoint, so a restart goes on with the same number. Slices of an earlier run over the
    same tables (a replay, other micro-batch borders) are then never overwritten, and the newer run's values win.
    """
    marker = f"{checkpoint}-first-batch"
    try:
        return spark.read.schema("first long").json(marker).first()["first"]
    except AnalysisException as error:
        if not nothing_stored(error):
            raise
    found = 0
    for path in logs:
        log = keyed.read_log(spark, path)
        last = log.agg(F.max(keyed.BATCH_COL)).first()[0] if log is not None else None
        found = max(found, 0 if last is None else int(last) + 1)
    try:  # a checkpoint that has begun without a marker counts from zero
        spark.read.text(f"{checkpoint}/metadata").first()
        found = 0
    except AnalysisException as error:
        if not nothing_stored(error):
            raise
    spark.createDataFrame([(found,)], "first long").write.json(marker)
    return found


def raw_batch_writer(spark: SparkSession, paths: JobPaths, order_cols=("event_time",),
                     strict_keys: bool = False, probe_time_span: bool = False, wide_raw: bool = False, first: int = 0):
    """foreachBatch function of the raw-events query.

    The insert-ignore probe reads only the raw folders of the event dates in the batch
    (a redelivered event keeps its time, hence its date); ``strict_keys`` probes the
    whole raw history instead, for ids that may come back on another date.
    ``probe_time_span`` further limits the probe to row groups within the batch's
    event-time span: exact only when an id never comes back with another time (true of
    producer redeliveries, not of an id reused later the same day), so it is off.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch_id += first
        batch = batch.persist()
        try:
            if batch.isEmpty():
                return
            tagged = decode.with_reason(batch)
            bad = tagged.where(F.col("reason").isNotNull())
            keyed.write_slice(
                bad.withColumn("received_at", F.current_timestamp()), paths.quarantine, batch_id
            )
            valid = tagged.where(F.col("reason").isNull()).drop("reason")
            order = [c for c in ("partition", "offset") if c in valid.columns] or list(order_cols)
            rows = decode.raw_projection(valid, extra=[F.col(c).alias(f"_o_{c}") for c in order],
                                         wide=wide_raw) \
                .withColumn("event_date", F.to_date("event_time"))
            keyed.insert_ignore(
                spark, rows, paths.raw, batch_id, key="event_id",
                order_cols=[f"_o_{c}" for c in order], order_only=[f"_o_{c}" for c in order],
                partition_by=("event_date",),
                probe_by=None if strict_keys else "event_date",
                probe_range="event_time" if probe_time_span and not strict_keys else None,
            )
        finally:
            batch.unpersist()

    return write


def first_writer(valid: DataFrame, known: DataFrame | None = None, columns=None) -> DataFrame:
    """Streaming rows whose id was never met before, of each id the first by (batch, partition, offset) (K1).

    A streaming aggregate keeps the first row of each id. Its order begins with the micro-batch's own time, which the
    checkpoint keeps, so a row of an earlier batch stays first whatever the offsets of later copies are, and a batch that
    is run again makes the same choice. Update mode gives every id that a batch touches; those whose first row is
    of this very batch are new. Without offsets copies are ordered by event time and content.
    ``known`` (``event_id``) are ids that stand before all others and are never given. ``columns`` are those of a row to
    keep and give (all by default); the order looks at all of them.
    """
    names = valid.columns
    placed = [c for c in ("partition", "offset") if c in names] or ["event_time"]
    order = F.struct(F.current_timestamp().alias("batch_time"), *placed, F.xxhash64(*names).alias("content"))
    rows = valid.select("event_id", order.alias("_order"), F.struct(*(columns or names)).alias("_row"))
    if known is not None:
        before = F.lit(0).cast("timestamp")
        rows = rows.unionByName(known.select(
            "event_id", F.struct(before.alias("batch_time"), *[F.lit(None).cast(valid.schema[c].dataType).alias(c) for c in placed],
                                 F.lit(0).cast("bigint").alias("content")).alias("_order"),
            F.lit(None).cast(rows.schema["_row"].dataType).alias("_row")))
    first = rows.groupBy("event_id").agg(F.min_by(F.struct("_order.batch_time", "_row"), "_order").alias("_first"))
    new = F.col("_first.batch_time") == F.current_timestamp()
    return first.where(new).select("_first._row.*")


def known_ids(spark: SparkSession, paths: JobPaths, first: int) -> DataFrame | None:
    """The ids that earlier runs wrote to the raw table, as a stream that brings them once; None for a first run.

    They are copied beside the checkpoint when the run starts, and go into its state with its first batch, so no
    later batch reads any history.
    """
    if not first:
        return None
    place = f"{paths.checkpoint('raw_events')}-known-ids"
    if "_SUCCESS" not in folder_names(spark, place):
        log = keyed.read_log(spark, paths.raw)
        ids = (log.where(F.col(keyed.BATCH_COL) < first).select("event_id") if log is not None
               else spark.createDataFrame([], "event_id string"))
        ids.write.mode("overwrite").parquet(place)
    return spark.readStream.schema("event_id string").parquet(place)


def unique_batch_writer(spark: SparkSession, paths: JobPaths, wide_raw: bool = False, first: int = 0, probe: bool = False):
    """foreachBatch function of the raw query when its state keeps ids unique: only a write.

    With ``probe`` the state forgets, and ids of earlier runs over the same table (``first`` > 0) are looked up there.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = decode.raw_projection(batch, wide=wide_raw).withColumn("event_date", F.to_date("event_time"))
        before = keyed.read_log(spark, paths.raw) if first and probe else None
        if before is not None:
            before = before.where(F.col(keyed.BATCH_COL) < first).select("event_id")
            rows = rows.join(before, "event_id", "left_anti").select(*rows.columns)
        keyed.write_log_rows(rows, paths.raw, batch_id + first, ("event_date",))

    return write


def quarantine_batch_writer(paths: JobPaths, first: int = 0):
    """foreachBatch function of the quarantine: bad rows with their reason; no folder for a batch without any."""

    def write(batch: DataFrame, batch_id: int) -> None:
        bad = decode.validate(batch)[1]
        if not bad.isEmpty():
            keyed.write_slice(bad.withColumn("received_at", F.current_timestamp()), paths.quarantine, batch_id + first)

    return write


def with_window_date(df: DataFrame) -> DataFrame:
    """Layout column of the window logs: the UTC date of the window start."""
    return df.withColumn(keyed.WINDOW_DATE, F.to_date(F.col("window_start")))


def aggregate_batch_writer(spark: SparkSession, paths: JobPaths, settings: StreamSettings, first: int = 0):
    """foreachBatch function of the window query: aggregates, then alerts from the written slice."""

    by_date = (keyed.WINDOW_DATE,)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch_id += first
        stamped = with_window_date(batch.withColumn("computed_at", F.current_timestamp()))
        # the window dates written are observed during the write: the read-back lists only them
        dates = keyed.upsert(stamped, paths.aggregates, batch_id, partition_by=by_date, observe=True)
        written = keyed.read_batch(spark, paths.aggregates, batch_id, keyed.WINDOW_DATE, dates)
        if written is None:
            return
        now = dt.datetime.now(dt.timezone.utc).isoformat(sep=" ")  # one reading of the clock for the batch
        found = alert_ops.flash_sale(
            written, settings.min_views, settings.max_purchases, settings.alert_message,
            created_at=F.lit(now).cast("timestamp"),
        )
        zones.forget(spark, paths.alerts, batch_id)
        dates = keyed.upsert(with_window_date(found), paths.alerts, batch_id, partition_by=by_date, observe=True)
        zones.put(spark, paths.alerts, batch_id, [(d, now, now) for d in sorted(dates or ())])

    return write


def start(
    spark: SparkSession,
    records: DataFrame,
    out_root: str,
    settings: StreamSettings = StreamSettings(),
    trigger: dict | None = None,
    aggregate_trigger: dict | None = None,
    validated_windows: bool = False,
    dedup_within_watermark: bool = False,
    strict_keys: bool = False,
    input_partitions: int | None = None,
    probe_time_span: bool = False,
    wide_raw: bool = False,
    unique_by: str = "state",
    unique_within: str | None = None,
    run: str = "",
    shared_panes: bool = False,
    state_partitions: int = STATE_PARTITIONS,
    window_partitions: int = WINDOW_STATE_PARTITIONS,
):
    """Start the queries over a streaming DataFrame of records with a ``value`` column.

    ``trigger`` / ``aggregate_trigger`` are ``writeStream.trigger`` keyword arguments,
    e.g. ``{"processingTime": "10 seconds"}`` and ``{"processingTime": "30 seconds"}``
    as in production, or ``{"availableNow": True}`` for replay and tests.
    ``validated_windows`` counts only valid events in the windows (off: every decoded
    event with a time counts, as the raw stream does). ``dedup_within_watermark`` drops
    repeated ``event_id``s from the window counts while the watermark still holds the
    first copy (off: windows count redeliveries, only the raw table is unique).
    ``unique_by`` says how the raw table knows the ids it has: ``"state"`` (the default) keeps the first row
    of every id in the query's RocksDB state (see ``first_writer``), about the size of the stored rows over all
    state partitions. ``state_partitions`` (and ``window_partitions`` of the window query) says how many these are at most; the
    session's ``spark.sql.shuffle.partitions``, where smaller, holds. Size them before the first start. ``unique_within`` bounds
    that state: an id alone is remembered, for that event-time span only, and of copies in one batch any may stay.
    ``"probe"`` reads the stored ids of the batch's dates instead and keeps the first copy by delivery order;
    there ``strict_keys`` probes all history and ``probe_time_span`` narrows it to the batch's event-time
    span (see ``raw_batch_writer``). ``wide_raw`` keeps session, device, referrer and the
    Kafka timestamp in the raw table (D7). ``run`` names another run over the same tables, with
    checkpoints of its own (a replay): its slices follow those that are there. ``input_partitions`` spreads the
    records of a source with few partitions (one file per micro-batch, a small topic)
    round-robin over that many tasks before the JSON decode; for Kafka prefer the
    source's ``minPartitions`` (``kafka.read_stream``). ``shared_panes`` keeps one state row per product and slide
    in place of ``window/slide`` and makes the windows when they are written (see ``panes``): the same windows; choose it
    before the first start, since the two states differ.
    """
    checkpoint_root(spark)
    paths = JobPaths(out_root, run)
    raw_first = first_batch(spark, paths.checkpoint("raw_events"), paths.raw, paths.quarantine)
    agg_first = first_batch(spark, paths.checkpoint("aggregates"), paths.aggregates, paths.alerts)
    if input_partitions:
        records = records.repartition(int(input_partitions))
    decoded = decode.decode_events(records)
    trig = trigger or {"processingTime": "10 seconds"}
    agg_trig = aggregate_trigger or trigger or {"processingTime": "30 seconds"}

    if unique_by not in ("state", "probe"):
        raise ValueError(f"unique_by must be 'state' or 'probe', not {unique_by!r}")
    if shared_panes and dedup_within_watermark:
        raise ValueError("shared_panes keep a longer watermark than dedup_within_watermark promises")
    by_state = unique_by == "state" and not (strict_keys or probe_time_span)
    # the raw query computes a batch once, so what passes it is counted there
    seen = progress.watched(decoded)
    raw_input, raw_writer = seen, raw_batch_writer(spark, paths, strict_keys=strict_keys,
                                                      probe_time_span=probe_time_span, wide_raw=wide_raw,
                                                      first=raw_first)
    more = {}
    if by_state:
        valid = decode.validate(seen)[0]
        stored = [*RAW_COLUMNS, *(c for c in WIDE_RAW_EXTRA if wide_raw and c in valid.columns)]
        raw_input = (valid.withWatermark("event_time", unique_within).dropDuplicatesWithinWatermark(["event_id"])
                     if unique_within else first_writer(valid, known_ids(spark, paths, raw_first), stored))
        raw_writer = unique_batch_writer(spark, paths, wide_raw, raw_first, probe=bool(unique_within))
        more["quarantine"] = (
            decoded.writeStream.outputMode("append")
            .foreachBatch(quarantine_batch_writer(paths, raw_first))
            .option("checkpointLocation", paths.checkpoint("quarantine"))
            .trigger(**trig)
            .queryName("quarantine")
            .start()
        )
    raw_stream = (
        raw_input.writeStream.outputMode("update" if by_state and not unique_within else "append")
        .foreachBatch(raw_writer)
        .option("checkpointLocation", paths.checkpoint("raw_events"))
        .trigger(**trig)
        .queryName("raw_events")
    )
    if by_state:
        with stateful(spark, state_partitions):
            raw_query = raw_stream.start()
    else:
        raw_query = raw_stream.start()
    window_input = decode.validate(decoded)[0] if validated_windows else decoded
    watermark = settings.watermark
    if dedup_within_watermark:
        window_input = (
            window_input.where(F.col("event_time").isNotNull())
            .withWatermark("event_time", settings.watermark)
            .dropDuplicatesWithinWatermark(["event_id"])
        )
        watermark = None  # already set upstream
    window_writer = aggregate_batch_writer(spark, paths, settings, agg_first)
    if shared_panes:
        windows = panes.pane_counts(window_input, settings.window, settings.slide, settings.watermark)
        window_writer = panes.batch_writer(spark, paths.panes, settings.window, settings.slide, settings.watermark,
                                           window_writer)
    else:
        windows = sliding_counts(window_input, settings.window, settings.slide, watermark=watermark)
    window_stream = (
        windows.writeStream.outputMode("update")
        .foreachBatch(window_writer)
        .option("checkpointLocation", paths.checkpoint("aggregates"))
        .trigger(**agg_trig)
        .queryName("window_aggregates")
    )
    # deduplication keeps every id that the watermark still holds
    with stateful(spark, state_partitions if dedup_within_watermark else window_partitions):
        agg_query = window_stream.start()
    return {"raw": raw_query, "aggregates": agg_query, **more, "paths": paths, "streams": spark.streams}


def await_all(queries: dict, timeout: float | None = None) -> None:
    """Wait until every query has ended; a failure of any of them is raised at once and the
    others are stopped (T9). ``timeout`` (seconds) bounds the whole wait."""
    running = [q for q in queries.values() if isinstance(q, StreamingQuery)]
    streams = queries.get("streams")
    deadline = time.monotonic() + timeout if timeout else None
    if streams is not None:
        streams.resetTerminated()  # only terminations from now on wake the wait; ours are checked below
    try:
        while True:
            for q in running:
                if q.exception():
                    raise q.exception()
            if not any(q.isActive for q in running):
                return
            if deadline is not None and deadline <= time.monotonic():
                return
            if streams is None:  # queries started elsewhere: wait on them in turn
                for q in running:
                    q.awaitTermination(max(1, int(deadline - time.monotonic()))) if deadline \
                        else q.awaitTermination()
                continue
            # returns when any query of the session ends (raising if it failed); whether it
            # was one of ours is decided by the checks at the top of the loop
            try:
                if deadline is not None:
                    streams.awaitAnyTermination(max(1, int(deadline - time.monotonic())))
                else:
                    streams.awaitAnyTermination()
            except Exception:  # noqa: BLE001 - re-raised above if the failed query is ours
                pass
            streams.resetTerminated()
    finally:
        for q in running:
            if q.isActive:
                q.stop()


def stop_gracefully(queries: dict, poll_seconds: float = 0.5, timeout: float | None = 60.0) -> None:
    """Stop each query between micro-batches: wait while a trigger runs, then stop.

    Best effort (a trigger may start between the check and the stop); a batch cut short
    is run again on restart and the sinks are idempotent per batch id, so no result
    depends on the stop landing between batches.
    """
    running = [q for q in queries.values() if isinstance(q, StreamingQuery)]
    deadline = time.monotonic() + timeout if timeout else None
    for q in running:
        while q.isActive and q.status.get("isTriggerActive") and (
                deadline is None or time.monotonic() < deadline):
            time.sleep(poll_seconds)
        if q.isActive:
            q.stop()


def tables(spark: SparkSession, paths: JobPaths, start=None, end=None,
           settings: StreamSettings = StreamSettings()) -> dict:
    """Current content of the job's tables.

    With a time range (``start``/``end``, as the dashboard's) only the folders that can hold its
    rows are read: raw events by event date, aggregates by the dates of windows of
    ``settings.window`` that end in the range. Alerts are asked for by ``created_at``, which may be
    any time after their window, so their zone map tells which slices decide the range (``sinks.zones``).
    """
    alert_keys = KEYS["flash_sale_alerts"]
    if start is None or end is None:
        return {
            "clickstream_events": keyed.union_of_slices(spark, paths.raw),
            "product_view_aggregates": keyed.current(spark, paths.aggregates, KEYS["product_view_aggregates"]),
            "flash_sale_alerts": keyed.current(spark, paths.alerts, alert_keys),
        }
    dates = dates_between(as_timestamp(start) - duration(settings.window), end)
    recent = in_closed_range(zones.current_in_range(spark, paths.alerts, alert_keys, "created_at", start, end),
                             start, None, "created_at")
    return {
        "clickstream_events": read_events_range(spark, paths.raw, start, end).drop(keyed.BATCH_COL),
        "product_view_aggregates": keyed.current(spark, paths.aggregates, KEYS["product_view_aggregates"],
                                                 dates=dates),
        "flash_sale_alerts": in_closed_range(recent, None, end, "created_at"),
    }
