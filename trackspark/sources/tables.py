"""Named tables, format switch and CSV reports."""

from __future__ import annotations

import posixpath
import uuid
from collections.abc import Iterable, Mapping, Sequence
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackspark.functions.times import clock_text, local_date
from trackspark.sources.checks import require_paths
from trackspark.sources.csv_files import CSV_DIALECT, CSV_OPTIONS
from trackspark.sources.schemas import TABLES

# Headings of the summary report.
SUMMARY_HEADINGS = {
    "id": "ID",
    "species": "Species",
    "date_tagged": "Date tagged",
    "sex": "Sex",
    "pcl": "PCL",
    "fl": "FL",
    "tl": "TL",
    "stl": "STL",
    "total_detections": "Total detections",
    "total_stations_detected": "Total Stations detected",
    "total_days_detected": "Total days detected",
    "first_appearance": "First appearance",
    "last_appearance": "Last appearance",
    "days_at_liberty": "Days at liberty",
    "residency_index": "Residency Index",
}
DAY_COLUMN = "date"
SPARE_DAYS = 32


def table_path(folder: str, name: str) -> str:
    return posixpath.join(folder, name)


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A named table; known tables are read with their declared schema."""
    reader = spark.read
    path = table_path(folder, name)
    if name in TABLES:
        # Detection tables keep their day partition column: a filter on it prunes files.
        day = f", {DAY_COLUMN} date" if name.startswith("det") else ""
        reader = reader.schema(TABLES[name] + day)
    return reader.parquet(path)


def read_tables(spark: SparkSession, folder: str, names: list[str]) -> dict[str, DataFrame]:
    """Several named tables; every missing one is named in the error."""
    require_paths(spark, [table_path(folder, n) for n in names])
    return {n: read_table(spark, folder, n).drop(DAY_COLUMN) for n in names}


def prune_days(df: DataFrame, start: str, end: str) -> DataFrame:
    """Filter a stored detection table on its day partition."""
    return df.where(F.col(DAY_COLUMN).between(F.lit(start).cast("date"), F.lit(end).cast("date")))


def read_detections(
    spark: SparkSession, folder: str, name: str, start: str | None = None, end: str | None = None
) -> DataFrame:
    """A stored detection table, only the days that a job with these bounds can use.

    Days are kept ``SPARE_DAYS`` beyond the bounds: the zone of the stored days may be another one, and monthly
    periods begin before their first bound. The job's own filter on the time then decides.
    """
    require_paths(spark, [table_path(folder, name)])
    rows = read_table(spark, folder, name)
    spare = timedelta(days=SPARE_DAYS)
    if start is not None:
        rows = rows.where(F.col(DAY_COLUMN) >= F.lit((datetime.fromisoformat(start) - spare).date()))
    if end is not None:
        rows = rows.where(F.col(DAY_COLUMN) <= F.lit((datetime.fromisoformat(end) + spare).date()))
    return rows.drop(DAY_COLUMN)


def _file_system(spark: SparkSession, path: str):
    """(file system, path) of Hadoop: whatever store Spark writes to."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def _beside(path: str, kind: str) -> str:
    """A new hidden name next to a path."""
    folder, name = posixpath.split(path.rstrip("/"))
    return posixpath.join(folder, f"_{kind}-{name.replace('=', '-')}-{uuid.uuid4().hex}")


def remove_path(spark: SparkSession, path: str) -> None:
    fs, place = _file_system(spark, path)
    fs.delete(place, True)


def swap_in(spark: SparkSession, written: str, path: str) -> None:
    """Put a finished folder in the place of another, which is kept until the new one stands there."""
    fs, new = _file_system(spark, written)
    _, target = _file_system(spark, path)
    old = _file_system(spark, _beside(path, "old"))[1]
    had = fs.exists(target)
    if had and not fs.rename(target, old):
        raise OSError(f"cannot move {path} aside")
    fs.mkdirs(target.getParent())
    if not fs.rename(new, target):
        if had:
            fs.rename(old, target)
        raise OSError(f"cannot move {written} to {path}")
    if had:
        fs.delete(old, True)


def _dated(df: DataFrame, tz: str | None) -> DataFrame:
    return df.withColumn(DAY_COLUMN, local_date(F.col("time"), tz))


def write_tables(
    tables: Mapping[str, DataFrame], folder: str, tz: str | None = "UTC", partitions: Mapping[str, str] | None = None
) -> None:
    """Write every table under its name; detection tables are partitioned by local day, others by ``partitions``.

    All tables are written beside their places first and swapped in when the last one is complete, so a job that fails
    leaves the old tables as they were, and a table may be computed from its own former content.

    The rebalance hint gives files of even size: small days are packed together, and a day that
    holds much of the data is split over several tasks.
    """
    staged: dict[str, str] = {}
    spark = next(iter(tables.values())).sparkSession if tables else None
    try:
        for name, df in tables.items():
            staged[name] = _beside(table_path(folder, name), "new")
            column = DAY_COLUMN if name.startswith("det") else (partitions or {}).get(name)
            if column is None:
                df.write.parquet(staged[name])
                continue
            rows = _dated(df, tz) if column == DAY_COLUMN else df
            rows.hint("rebalance", column).write.partitionBy(column).parquet(staged[name])
        for name, written in list(staged.items()):
            swap_in(spark, written, table_path(folder, name))
            del staged[name]
    finally:
        for written in staged.values():
            remove_path(spark, written)


def write_parts(df: DataFrame, folder: str, name: str, column: str, parts: Iterable) -> None:
    """Replace the given partitions of a stored table; the other partitions keep their files.

    The new partitions are written beside the table and swapped in one by one when all are complete. One without
    rows is removed. A run that breaks off during the swaps is mended by running it again.
    """
    spark, path = df.sparkSession, table_path(folder, name)
    parts = sorted(set(parts))
    written = _beside(path, "new")
    try:
        df.where(F.col(column).isin(*parts)).hint("rebalance", column).write.partitionBy(column).parquet(written)
        for part in parts:
            new, old = (f"{where}/{column}={part}" for where in (written, path))
            fs, place = _file_system(spark, new)
            if fs.exists(place):
                swap_in(spark, new, old)
            else:
                remove_path(spark, old)
    finally:
        remove_path(spark, written)


def write_days(df: DataFrame, folder: str, name: str, days: Iterable[date], tz: str | None = "UTC") -> None:
    """Replace the given local days of a stored detection table."""
    write_parts(_dated(df, tz), folder, name, DAY_COLUMN, days)


def read_days(spark: SparkSession, folder: str, name: str, days: Iterable[date]) -> DataFrame:
    """The given local days of a stored detection table; only their files are read."""
    require_paths(spark, [table_path(folder, name)])
    return read_table(spark, folder, name).where(F.col(DAY_COLUMN).isin(*sorted(set(days)))).drop(DAY_COLUMN)


def days_around(days: Iterable[date], reach: int) -> list[date]:
    """The days with those up to ``reach`` days before and after."""
    return sorted({day + timedelta(days=k) for day in days for k in range(-reach, reach + 1)})


def _format(path: str, fmt: str) -> str:
    if fmt == "auto":
        fmt = posixpath.splitext(path)[1].lstrip(".").lower()
    if fmt not in ("csv", "parquet"):
        raise ValueError(f"unsupported format: {fmt!r}")
    return fmt


def load_table(spark: SparkSession, path: str, fmt: str = "auto", multi_line: bool = True) -> DataFrame:
    """A table from csv (all text) or parquet, chosen by the extension.

    Quoted cells of a csv may hold line breaks; ``multi_line=False`` lets Spark split its files instead.
    """
    if _format(path, fmt) == "csv":
        return spark.read.options(**CSV_OPTIONS).option("multiLine", multi_line).csv(path)
    return spark.read.parquet(path)


def save_table(
    df: DataFrame, path: str, fmt: str = "auto", date_column: str | None = None, tz: str | None = "UTC"
) -> None:
    """Write a table as csv or parquet; csv shows the date column to the minute."""
    if _format(path, fmt) == "csv":
        if date_column:
            df = df.withColumn(date_column, clock_text(F.col(f"`{date_column}`"), tz))
        df.write.mode("overwrite").options(**CSV_DIALECT).option("header", "true").option("nullValue", "NA").csv(path)
    else:
        df.write.mode("overwrite").parquet(path)


def save_period_csv(
    df: DataFrame, path: str, headings: Mapping[str, str] | None = None, order_by: Sequence[str] = ()
) -> None:
    """CSV report with empty cells for nulls, one folder per period id in a single job.

    Rows are gathered by period into files of even size, usually one per period, and sorted in it.
    """
    period = ["interval_id"] if "interval_id" in df.columns else []
    df = df.hint("rebalance", *period)
    if order_by:
        df = df.sortWithinPartitions(*[F.col(c).asc_nulls_last() for c in (*period, *order_by)])
    renamed = df.withColumnsRenamed(dict(headings)) if headings else df
    writer = renamed.write.mode("overwrite").options(**CSV_DIALECT).option("header", "true").option("nullValue", "").option("emptyValue", "")
    if period:
        writer = writer.partitionBy(*period)
    writer.csv(path)
