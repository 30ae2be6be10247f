"""Text and CSV report artefacts.

Reports are built as line DataFrames ``(report_date, line_no, line)`` and written
one file per date; nothing is collected to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from cartwheel import constants as C
from cartwheel.functions.rates import decimal_percent_text, fixed4_text
from cartwheel.functions.text import pipe_line
from cartwheel.operators.daily import conversion_order
from cartwheel.sources.tables import as_timestamp, dates_of


def report_days(spark: SparkSession, start, end, name: str = "report_date") -> DataFrame:
    """Every UTC date of ``[start, end)`` (size set by the range, not by the data)."""
    first = as_timestamp(start).date()
    return spark.range(len(dates_of(start, end))).select(F.date_add(F.lit(first), F.col("id").cast("int")).alias(name))


def _header(days: DataFrame, title: str, columns: str, rule: str) -> DataFrame:
    lines = F.array(
        F.struct(F.lit(1).alias("line_no"), F.lit(title).alias("line")),
        F.struct(F.lit(2).alias("line_no"),
                 F.concat(F.lit("Report Date: "), F.col("report_date").cast("string")).alias("line")),
        F.struct(F.lit(3).alias("line_no"), F.lit("").alias("line")),
        F.struct(F.lit(4).alias("line_no"), F.lit(columns).alias("line")),
        F.struct(F.lit(5).alias("line_no"), F.lit(rule).alias("line")),
    )
    return days.select("report_date", F.inline(lines))


def _lines(days: DataFrame, header: DataFrame, rows: DataFrame, empty_text: str) -> DataFrame:
    """Header + row lines per day; a day without rows gets the fixed empty line instead.

    One pass over the rows: a placeholder line per day is dropped where the day has
    rows (a window over the few lines of one day), so the report is computed once and
    neither joined nor broadcast.
    """
    placeholder = days.select("report_date", F.lit(6).alias("line_no"), F.lit(empty_text).alias("line"))
    tagged = (
        header.withColumn("_kind", F.lit(0))
        .unionByName(rows.withColumn("_kind", F.lit(1)))
        .unionByName(placeholder.withColumn("_kind", F.lit(2)))
    )
    has_rows = F.max(F.when(F.col("_kind") == 1, 1).otherwise(0)).over(Window.partitionBy("report_date"))
    return (
        tagged.withColumn("_has_rows", has_rows)
        .where((F.col("_kind") != 2) | (F.col("_has_rows") == 0))
        .drop("_kind", "_has_rows")
    )


def top_products_lines(report: DataFrame, days: DataFrame) -> DataFrame:
    """Daily top-products text: 5 header lines, one line per rank, or the empty line."""
    rows = report.select(
        "report_date",
        (F.lit(5) + F.col("rank").cast("int")).alias("line_no"),
        pipe_line(F.col("rank"), F.col("product_id"), F.col("total_views"), F.col("total_purchases"),
                  decimal_percent_text(F.col("conversion_rate"))).alias("line"),
    )
    header = _header(days, C.TOP_PRODUCTS_TITLE, C.TOP_PRODUCTS_COLUMNS, C.TOP_PRODUCTS_RULE)
    return _lines(days, header, rows, C.TOP_PRODUCTS_EMPTY)


def conversion_csv_rows(conversion: DataFrame) -> DataFrame:
    """CSV rows per date in report order, rate as ``.4f`` text (K6, X11, L2)."""
    order = Window.partitionBy("report_date").orderBy(*conversion_order())
    return conversion.select(
        "report_date",
        F.row_number().over(order).alias("line_no"),
        "category",
        "product_id",
        "total_views",
        "total_purchases",
        fixed4_text(F.col("conversion_rate")).alias("conversion_rate"),
    )


def category_summary_lines(categories: DataFrame, days: DataFrame) -> DataFrame:
    """Category summary text sorted by category (code-point order), or the empty line."""
    order = Window.partitionBy("report_date").orderBy("category")
    rows = categories.select(
        "report_date",
        (F.lit(5) + F.row_number().over(order)).alias("line_no"),
        pipe_line(F.col("category"), F.col("total_views"), F.col("total_purchases"),
                  F.col("conversion_text")).alias("line"),
    )
    header = _header(days, C.CATEGORY_SUMMARY_TITLE, C.CATEGORY_SUMMARY_COLUMNS, C.CATEGORY_SUMMARY_RULE)
    return _lines(days, header, rows, C.CATEGORY_SUMMARY_EMPTY)


def write_text(lines: DataFrame, path: str) -> None:
    """One text file per date under ``report_date=<d>/``, lines in order; files of other dates stay."""
    (
        lines.repartition("report_date")
        .sortWithinPartitions("report_date", "line_no")
        .select("report_date", "line")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("report_date")
        .text(path)
    )


def write_csv(rows: DataFrame, path: str) -> None:
    """One CSV file with header per date under ``report_date=<d>/``, rows in report order; other dates stay."""
    cols = list(C.CSV_HEADER)
    (
        rows.repartition("report_date")
        .sortWithinPartitions("report_date", "line_no")
        .select("report_date", *cols)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("header", True)
        .partitionBy("report_date")
        .csv(path)
    )


def write_csv_parts(conversion: DataFrame, path: str, rows_per_file: int = 1_000_000, parts: int | None = None) -> None:
    """The CSV rows of each date in several files whose names sort in report order (K6, L2); other dates stay.

    Rows are range-partitioned by (date, report order), so a large date spreads over tasks and none numbers or
    sorts it whole; a task cuts its range into files of ``rows_per_file``. ``parts`` is the number of ranges (by
    default ``spark.sql.shuffle.partitions``). Every file has the header.
    """
    order = [F.asc("report_date"), *conversion_order()]
    parts = parts or int(conversion.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (
        conversion.repartitionByRange(parts, *order)
        .sortWithinPartitions(*order)
        .withColumn("conversion_rate", fixed4_text(F.col("conversion_rate")))
        .select("report_date", *C.CSV_HEADER)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", int(rows_per_file))
        .option("header", True)
        .partitionBy("report_date")
        .csv(path)
    )


def read_csv_parts(spark: SparkSession, path: str, schema) -> DataFrame:
    """Rows of :func:`write_csv_parts` with ``file`` and ``line_no``, their place in the date's files in order.

    Lines are numbered within a file and moved by the rows of the files before it, so no task holds a date.
    """
    place = ["report_date", "file"]
    rows = spark.read.option("header", True).schema(schema).csv(path).select(
        "*", F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_at"))
    nth = F.row_number().over(Window.partitionBy(*place).orderBy("_block", "_at"))
    ahead = Window.partitionBy("report_date").orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    bases = rows.groupBy(*place).agg(F.count("*").alias("_n")).select(
        *place, F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_base"))
    # the rows are dealt by date and file for their numbers already, so the merge join moves the counts alone
    return (rows.withColumn("_nth", nth).join(bases.hint("merge"), place)
            .withColumn("line_no", (F.col("_base") + F.col("_nth")).cast("int")).drop("_nth", "_base", "_block", "_at"))


def show_candidates(df: DataFrame, n: int = 20) -> bool:
    """Console sink (K9): print up to ``n`` rows untruncated, or a note when there are none.

    The query runs once: at most ``n`` rows come back and serve both the existence
    test (F9) and the printout.
    """
    head = df.limit(n).collect()
    if not head:
        print("[INFO] No flash-sale candidates found.", flush=True)
        return False
    df.sparkSession.createDataFrame(head, df.schema).show(n, truncate=False)
    return True
