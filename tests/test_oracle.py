"""Every registered query against its reference SQL in DuckDB, on the smallest test tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.exists(f"{SF}/events.parquet"), reason="test tables not present")
def test_all_queries_match_sql(spark):
    from oracle_check import compare

    from cartwheel.plans.catalog import all_queries

    res = compare(spark, SF, verbose=False, names=list(all_queries()))
    bad = {k: v for k, v in res.items() if v[0] not in ("OK", "rows-only")}
    assert not bad, bad
    import __spark_entry__ as E
    assert set(E.oracle_sql()) <= set(E.queries())
    rows_only = [k for k in E.queries() if k not in E.oracle_sql() and k in all_queries()]
    assert rows_only == []


@pytest.mark.skipif(not os.path.exists(f"{SF}/events.parquet"), reason="test tables not present")
def test_entry(spark):
    import __spark_entry__ as E

    df = E.entry(spark)
    assert df.count() == 13
    assert df.columns == ["product_id", "view_count", "purchase_count", "window_start", "window_end",
                          "alert_message"]
