"""Shared panes: one state row per product and slide, the same windows."""

import datetime as dt
import random

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from cartwheel.config import StreamSettings
from cartwheel.schemas import KEYS
from cartwheel.sinks import keyed
from cartwheel.streaming import job, panes, replay, state

from helpers import WIRE_SCHEMA, event, wire

SETTINGS = StreamSettings(window="10 minutes", slide="2 minutes", watermark="3 minutes")
T0 = dt.datetime(2024, 1, 15, 10, 0)


def deliver(spark, root, place, rows, expect=None, **options):
    """One pass of the job after ``rows`` (None: nothing new); the stored windows."""
    if rows is not None:
        wire(spark, rows).write.parquet(f"{root}/source/part={place:05d}")
    stream = replay.read_slices(spark, f"{root}/source", WIRE_SCHEMA, files_per_trigger=None)
    started = job.start(spark, stream, f"{root}/out", SETTINGS, trigger={"availableNow": True}, shared_panes=True, **options)
    if expect:
        with pytest.raises(StreamingQueryException, match=expect):
            job.await_all(started)
        return None
    job.await_all(started)
    paths = started["paths"]
    found = keyed.current(spark, paths.aggregates, KEYS["product_view_aggregates"]).collect()
    return paths, {(r.window_start.replace(tzinfo=None), r.product_id): (r.view_count, r.cart_count, r.purchase_count)
                   for r in found}


def run(spark, root, batches, **options):
    for place, rows in enumerate(batches):
        last = deliver(spark, root, place, rows, **options)
    return last


def at(seconds, product="PROD-001", etype="view", name=None):
    return event(name or f"{product}-{etype}-{seconds}", product=product, etype=etype,
                 ts=(T0 + dt.timedelta(seconds=seconds)).isoformat() + "+00:00")


def plain(batches, types=("view", "add_to_cart", "purchase")):
    """By the rule: an event counts for those of its windows whose end is past the latest time of the batches before
    it less the delay; a window's row is what it held when a batch last changed it while open."""
    found, latest = {}, None
    for rows in batches:
        closed = latest - dt.timedelta(minutes=3) if latest else None
        for e in rows:
            if "timestamp" not in e:
                continue
            t = dt.datetime.fromisoformat(e["timestamp"]).replace(tzinfo=None)
            first = t.replace(minute=t.minute // 2 * 2, second=0, microsecond=0)
            for k in range(5):
                start = first - dt.timedelta(minutes=2 * k)
                if closed is None or start + dt.timedelta(minutes=10) > closed:
                    found.setdefault((start, e["product_id"]), [0, 0, 0])[types.index(e["event_type"])] += 1
            latest = t if latest is None or t > latest else latest
    return {k: tuple(v) for k, v in found.items()}


def test_late_events_count_for_open_windows_only(spark, scratch):
    rnd = random.Random(4)
    batches = []
    for b in range(4):  # each batch reaches back over closed, half-closed and open windows
        rows = [at(rnd.randint(max(0, b * 500 - 1000), b * 500 + 500), f"PROD-00{rnd.randint(1, 3)}",
                   rnd.choice(["view", "add_to_cart", "purchase"]), f"{b}-{i}") for i in range(60)]
        batches.append(rows)
    no_time = event("none", ts=None)
    paths, found = run(spark, scratch, [batches[0] + [no_time], *batches[1:]])
    assert found == plain(batches)
    # open panes only, in the state and beside it; slices that no batch reads are gone
    kept = spark.read.parquet(f"{paths.panes}/batch_id=*").select("pane_start").distinct().count()
    assert kept <= 8 + 10
    slices = spark.read.option("basePath", paths.panes).parquet(paths.panes)
    assert slices.select("batch_id").distinct().count() <= 2
    open_panes = state.open_panes(spark, paths.checkpoint("aggregates"))
    last = max(dt.datetime.fromisoformat(e["timestamp"]) for rows in batches for e in rows).replace(tzinfo=None)
    first = open_panes.agg(F.min("pane_start")).first()[0].replace(tzinfo=None)
    assert first + dt.timedelta(minutes=10) > last - dt.timedelta(minutes=3)


def test_one_state_row_a_pane(spark, scratch):
    paths, found = run(spark, scratch, [[at(5), at(6, name="b")]])
    assert state.open_panes(spark, paths.checkpoint("aggregates")).count() == 1
    assert set(found.values()) == {(2, 0, 0)} and len(found) == 5


def test_no_window_alerts(spark, scratch):
    paths, _ = run(spark, scratch, [[at(5)]])
    assert keyed.current(spark, paths.alerts, KEYS["flash_sale_alerts"]).count() == 0


def test_restart_of_a_batch_reads_the_same_panes(spark, scratch, monkeypatch):
    batches = [[at(0), at(100)], [at(130), at(90, name="late")], [at(700)]]
    commit, failures = keyed.commit_batch, []

    def crash(session, table, batch_id):
        if table.endswith("product_view_aggregates") and batch_id == 2 and not failures:
            failures.append(batch_id)
            raise RuntimeError("planted between write and commit")
        commit(session, table, batch_id)

    monkeypatch.setattr(keyed, "commit_batch", crash)
    deliver(spark, scratch, 0, batches[0])
    deliver(spark, scratch, 1, batches[1], expect="planted" )
    deliver(spark, scratch, 1, None)
    _, found = deliver(spark, scratch, 2, batches[2])
    assert failures == [2] and found == plain(batches)


def test_sizes_and_options(spark, scratch):
    with pytest.raises(ValueError):
        panes.check_sizes("10 minutes", "3 minutes")
    with pytest.raises(ValueError):
        run(spark, scratch, [[at(0)]], dedup_within_watermark=True)
