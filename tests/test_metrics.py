"""Stored progress, observed metrics and supervision."""

from cartwheel.config import StreamSettings
from cartwheel.sinks import keyed
from cartwheel.streaming import job, progress, replay, state

from helpers import WIRE_SCHEMA, event, wire


def test_metrics_table_and_state(spark, scratch):
    no_time = event("n")
    del no_time["timestamp"]
    batches = [[event("a"), event("b", etype="purchase"), no_time], [event("x", etype="error")], ["not json"]]
    listener = progress.MetricsTable(spark, f"{scratch}/metrics")
    spark.streams.addListener(listener)
    try:
        for i, rows in enumerate(batches):
            wire(spark, rows).write.parquet(f"{scratch}/source/part={i:05d}")
            stream = replay.read_slices(spark, f"{scratch}/source", WIRE_SCHEMA, files_per_trigger=None)
            started = job.start(spark, stream, f"{scratch}/out", StreamSettings(), trigger={"availableNow": True})
            job.await_all(started)
        progress.settle(spark)
    finally:
        spark.streams.removeListener(listener)
    rows = progress.read_metrics(spark, f"{scratch}/metrics").where("query_name = 'raw_events'").orderBy("batch_id").collect()
    counts = [r["observed"]["decoded"] for r in rows if r["num_input_rows"]]
    assert [(c["rows"], c["valid"], c["without_time"], c["view"], c["purchase"]) for c in counts] == [
        (3, 2, 1, 1, 1), (1, 0, 0, 0, 0), (1, 0, 1, 0, 0)]
    # batches without valid rows add nothing to the raw table; a row without a time joins no window
    assert keyed.union_of_slices(spark, started["paths"].raw).count() == 2
    checkpoint = started["paths"].checkpoint("aggregates")
    open_now = state.open_windows(spark, checkpoint).collect()
    # the bad record's views are no type of the three, but its windows are there as the stream counts every decoded event
    assert {r["product_id"] for r in open_now} == {"PROD-001"} and max(r["view_count"] for r in open_now) == 1
    assert [r["operatorName"] for r in state.state_operators(spark, checkpoint).collect()] == ["stateStoreSave"]
