"""Physical-plan properties that matter at scale, checked on the registered queries."""

import os

import pytest

from cartwheel.plans import catalog as C

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(f"{SF}/events.parquet"), reason="test tables not present")


def _plan(spark, name):
    df = C.BATCH_QUERIES[name](spark, SF)
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_python_in_any_batch_query(spark):
    for name in C.BATCH_QUERIES:
        plan = _plan(spark, name)
        for node in ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "MapInPandas", "FlatMapGroupsInPandas"):
            assert node not in plan, (name, node)


def test_range_filter_reaches_scan_and_group_limit_below_shuffle(spark):
    df = C.BATCH_QUERIES["daily_top_products"](spark, SF)
    text = df._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    pushed = next(line for line in text.splitlines() if line.startswith("PushedFilters:"))
    for pred in ("IsNotNull(ts)", "GreaterThanOrEqual(ts,2024-01-01T00:00)", "LessThan(ts,2024-02-01T00:00)"):
        assert pred in pushed, pushed
    assert "WindowGroupLimit" in text and ", Partial" in text


def test_scan_reads_only_needed_columns(spark):
    df = C.BATCH_QUERIES["sliding_counts"](spark, SF)
    text = df._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string,props:string>" in text


def test_json_parsed_once_per_row(spark):
    for name in ("decode_valid", "quarantine", "raw_wide"):
        assert _plan(spark, name).count("from_json") == 1, name
    assert _plan(spark, "daily_top_products").count("get_json_object") == 1


def test_broadcast_only_for_the_catalogue(spark):
    for name in C.BATCH_QUERIES:
        plan = _plan(spark, name)
        if "BroadcastExchange" in plan:
            assert name == "category_map_conversion", name


def test_category_map_broadcast_needs_a_known_bound(spark):
    from cartwheel.operators import daily
    from cartwheel.plans import params as P
    from cartwheel.plans import tables as TB

    raw = TB.raw_events(spark, SF)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # no size-based broadcast
    try:
        hinted = daily.category_map_conversion(raw, P.START, P.END, daily.catalogue(spark), map_rows=20)
        unknown = daily.category_map_conversion(raw, P.START, P.END, daily.catalogue(spark))
        assert "BroadcastHashJoin" in hinted._jdf.queryExecution().executedPlan().toString()
        plan = unknown._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan
        assert sorted(hinted.collect()) == sorted(unknown.collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_spread_only_for_inputs_with_few_splits(spark):
    from cartwheel.sources.tables import spread_small_input

    one = spark.read.parquet(f"{SF}/events.parquet")
    assert one.rdd.getNumPartitions() == 1
    spread = spread_small_input(one, slots=4)
    assert spread.rdd.getNumPartitions() == 4
    assert "RoundRobinPartitioning(4)" in spread._jdf.queryExecution().executedPlan().toString()
    many = spark.range(0, 1000, numPartitions=6)
    assert spread_small_input(many, slots=4) is many  # enough splits: no shuffle added
    assert sorted(r.event_id for r in spread.collect()) == sorted(r.event_id for r in one.collect())


def test_panels_of_tables_without_alerts(spark, scratch):
    """Events of which no window is a flash sale: the panels and table checks show no alert and do not fail."""
    rows = [(n, f"2024-01-{n + 1:02d} 10:00:00", n % 3, "purchase", 1.0, '{"k": 4}') for n in range(14)]
    spark.createDataFrame(rows, "event_id long, at string, user_id long, event_type string, value double, props string").selectExpr(
        "event_id", "cast(at AS timestamp_ntz) AS ts", "user_id", "event_type", "value", "props").write.parquet(
            f"{scratch}/events.parquet")
    found = C.all_queries()
    run = lambda name: found[name](spark, scratch).collect()
    assert [r.alert_count for r in run("panel_alert_count")] == [0]
    assert run("panel_alert_log") == [] and run("panel_alert_annotations") == []
    assert {r.panel: r.rows for r in run("panel_display_names")}["alert_log"] == 0
    counts = {r.table_name: r.row_count for r in run("table_counts")}
    assert counts["flash_sale_alerts"] == 0 and counts["clickstream_events"] == 14
    assert {r.table_name: r.row_count for r in run("quality_duplicates")}["flash_sale_alerts"] == 0
