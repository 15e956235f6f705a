"""Isolated detections: flag, removal and statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trackspark.functions.times import hours_between
from trackspark.operators.buckets import LONGEST_DAYS, ROWS_PER_BUCKET, bucket_of, day_number
from trackspark.session import shared_dir
from trackspark.sources.checks import require_columns, require_positive, require_timestamp

NULL_TIME_BUCKET = -(10**12)
NULL_TIME_SPREAD = 1024
KEYS = ("elasmo", "location")


def flag_single_detections(
    det: DataFrame,
    time_window_hours: float = 1,
    bucket_days: float | None = None,
    tie_break: Sequence[str] = (),
) -> DataFrame:
    """Flag detections with no neighbour of the same tag at the same location in the window.

    Adds ``time_diff_to_next`` and ``time_diff_to_prev`` (hours) and ``single_detection`` (0/1).
    A gap must be strictly longer than the window to isolate. Rows without a time are flagged.
    ``tie_break`` orders detections of equal time, which only decides which of them carries which
    gap.

    One resident tag at one receiver may hold a large share of the table, so the lead/lag window
    runs per (tag, location, time bucket). The neighbours across bucket borders come in as marker
    rows taken from a per-bucket aggregate, which leaves a single shuffle of the detections.
    The bucket width is measured on the data unless given: one aggregate per (tag, location, day), written once,
    gives the width and, where a bucket is whole days, the markers too, so the detections are read twice in all.
    """
    require_columns(det, ("elasmo", "location", "time"))
    require_timestamp(det, "time")
    require_positive("time_window_hours", time_window_hours)
    keys = list(KEYS)
    day = day_number(F.col("time"), det.schema["time"].dataType)
    times = [F.count("time").alias("_n"), F.min("time").alias("_first"), F.max("time").alias("_last")]
    timed = det.where(F.col("time").isNotNull())
    edges = None
    if bucket_days is None:
        shared_dir(det.sparkSession)
        daily = timed.groupBy(*keys, day.alias("_day")).agg(*times).checkpoint()
        busiest = daily.agg(F.max("_n")).first()[0]
        bucket_days = min(LONGEST_DAYS, ROWS_PER_BUCKET / max(1, busiest or 0))
        if bucket_days >= 1:
            whole = int(bucket_days)
            in_time = F.floor(day / whole)
            edges = daily.groupBy(*keys, F.floor(F.col("_day") / whole).alias("_bucket")).agg(
                F.min("_first").alias("_first"), F.max("_last").alias("_last")
            )
    if edges is None:
        in_time = bucket_of(F.col("time"), det.schema["time"].dataType, bucket_days)
        edges = timed.groupBy(*keys, in_time.alias("_bucket")).agg(*times[1:])
    spread = F.pmod(F.xxhash64(*det.columns), F.lit(NULL_TIME_SPREAD))
    rows = det.withColumn(
        "_bucket", F.when(F.col("time").isNull(), F.lit(NULL_TIME_BUCKET) - spread).otherwise(in_time)
    ).withColumn("_mark", F.lit(0))

    by_key = Window.partitionBy(*keys).orderBy("_bucket")
    outside = edges.select(
        *keys,
        "_bucket",
        F.lag("_last").over(by_key).alias("_before"),
        F.lead("_first").over(by_key).alias("_after"),
    )
    marks = outside.select(
        *keys,
        "_bucket",
        F.explode(
            F.array(
                F.struct(F.col("_before").alias("time"), F.lit(-1).alias("_mark")),
                F.struct(F.col("_after").alias("time"), F.lit(1).alias("_mark")),
            )
        ).alias("_edge"),
    ).select(*keys, "_bucket", "_edge.time", "_edge._mark")
    marks = marks.where(F.col("time").isNotNull())

    in_bucket = Window.partitionBy(*keys, "_bucket").orderBy(
        F.col("time").asc_nulls_last(), "_mark", *[F.col(c).asc_nulls_last() for c in tie_break]
    )
    to_next = hours_between(F.col("time"), F.lead("time").over(in_bucket))
    to_prev = hours_between(F.lag("time").over(in_bucket), F.col("time"))
    alone = (F.coalesce(F.col("time_diff_to_next") > time_window_hours, F.lit(True))) & (
        F.coalesce(F.col("time_diff_to_prev") > time_window_hours, F.lit(True))
    )
    return (
        rows.unionByName(marks, allowMissingColumns=True)
        .withColumns({"time_diff_to_next": to_next, "time_diff_to_prev": to_prev})
        .where(F.col("_mark") == 0)
        .withColumn("single_detection", alone.cast("int"))
        .drop("_bucket", "_mark")
    )


def remove_single_detections(flagged: DataFrame, keep_flags: bool = False) -> DataFrame:
    """Keep the rows that are not flagged; drop the flag columns unless asked otherwise."""
    require_columns(flagged, ["single_detection"])
    kept = flagged.where(F.col("single_detection") == 0)
    if keep_flags:
        return kept
    return kept.drop("single_detection", *[c for c in kept.columns if c.startswith("time_diff")])


def removal_stats(flagged: DataFrame) -> DataFrame:
    """One row: original, removed and remaining detections and the removed percentage."""
    require_columns(flagged, ["single_detection"])
    total, removed = F.count(F.lit(1)), F.coalesce(F.sum("single_detection"), F.lit(0))
    return removal_stats_of(flagged.agg(total.alias("original"), removed.alias("removed")))


def removal_stats_of(counts: DataFrame) -> DataFrame:
    """``removal_stats`` of one row (original, removed)."""
    return counts.select(
        "original",
        "removed",
        (F.col("original") - F.col("removed")).alias("remaining"),
        (F.try_divide(F.col("removed").cast("double"), F.col("original").cast("double")) * 100).alias("removal_pct"),
    )
