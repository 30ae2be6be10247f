"""Zone map of a log: the least and greatest value of a column in each slice, in a small table beside it.

A read of a range of that column goes to the zone map first and lists only slices that may hold its rows. In an upsert
log the newest version of a key decides, and all versions of a key lie in one layout folder (a date), so of a folder
with rows in the range the later slices are read too. Slices without a zone (a crash before it was written) are
always read.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from cartwheel.sinks import keyed
from cartwheel.sources.tables import committed_rows, folder_names, last_committed, nothing_stored, time_literal


ZONES = f"value string, least timestamp, most timestamp, {keyed.BATCH_COL} long"


def zones_path(table_path: str) -> str:
    return f"{table_path.rstrip('/')}.zones"


def forget(spark: SparkSession, table_path: str, batch_id: int) -> None:
    """To be called before a batch is written: zones of an earlier try at it must not hide its rows."""
    keyed._drop_folder(spark, f"{zones_path(table_path)}/{keyed.BATCH_COL}={int(batch_id)}")


def put(spark: SparkSession, table_path: str, batch_id: int, rows) -> None:
    """Writes the zones of a batch's slices, given as (layout value, least, greatest) in text; a batch may have none."""
    lines = [json.dumps({"value": str(value), "least": str(least), "most": str(most)}) for value, least, most in rows]
    place = spark._jvm.org.apache.hadoop.fs.Path(f"{zones_path(table_path)}/{keyed.BATCH_COL}={int(batch_id)}/zones.json")
    out = place.getFileSystem(spark._jsc.hadoopConfiguration()).create(place, True)
    out.write(bytearray("\n".join(lines).encode()))
    out.close()


def record(spark: SparkSession, table_path: str, batch_id: int, layout: str, column: str, values=None) -> None:
    """Finds the zones of a batch's slices in what it wrote, one for each layout value, and writes them."""
    rows = keyed.read_batch(spark, table_path, batch_id, layout, values)
    found = [] if rows is None else rows.groupBy(layout).agg(
        F.min(column).cast("string").alias("least"), F.max(column).cast("string").alias("most")).collect()
    put(spark, table_path, batch_id, found)


def read_range(spark: SparkSession, table_path: str, layout: str, column: str, start, end) -> DataFrame | None:
    """The slices of a log that decide the rows with ``start <= column <= end``; None when there are none."""
    where = zones_path(table_path)
    try:
        zones = spark.read.schema(ZONES).option("basePath", where).json(where)
    except AnalysisException as error:
        if not nothing_stored(error):
            raise
        return keyed.read_log(spark, table_path)
    limit = lambda name, value: time_literal(zones, name, value)
    after = zones.where(F.col("most") >= limit("most", start)) if start is not None else zones
    hit = F.max(F.col("least") <= limit("least", end)) if end is not None else F.lit(True)
    # one row for each folder of the range, with its slices: metadata
    chosen = after.groupBy("value").agg(hit.alias("hit"), F.collect_set(keyed.BATCH_COL).alias("late")).where("hit").collect()
    known = {int(n.partition("=")[2]) for n in folder_names(spark, where) if n.startswith(f"{keyed.BATCH_COL}=")}
    slices = []
    for row in chosen:
        folder = f"{table_path.rstrip('/')}/{layout}={row['value']}"
        there = {int(n.partition("=")[2]) for n in folder_names(spark, folder) if n.startswith(f"{keyed.BATCH_COL}=")}
        slices += [f"{folder}/{keyed.BATCH_COL}={b}" for b in sorted(there) if b in row["late"] or b not in known]
    last = last_committed(spark, table_path)
    if last is not None and last not in known:
        pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{table_path.rstrip('/')}/{layout}=*/{keyed.BATCH_COL}={last}")
        store = pattern.getFileSystem(spark._jsc.hadoopConfiguration())
        slices += [str(s.getPath()) for s in store.globStatus(pattern) or []]
    if not slices:
        return None
    return committed_rows(spark, table_path, spark.read.option("basePath", table_path).parquet(*sorted(set(slices))))


def current_in_range(spark: SparkSession, table_path: str, keys, column: str, start, end,
                     layout: str = keyed.WINDOW_DATE) -> DataFrame:
    """Current rows of an upsert log that may lie in the range, from the slices that decide them."""
    log = read_range(spark, table_path, layout, column, start, end)
    if log is None:
        log = keyed.read_log(spark, table_path)
        if log is None:
            raise FileNotFoundError(table_path)
        log = log.where(F.lit(False))
    return keyed.latest_per_key(log, keys, layout=(layout,)).drop(layout)
