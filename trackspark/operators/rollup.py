"""Monthly roll-up of detections: exact counts of a month that merge over any months.

The grain is (tag, location, local month). A month's local days are bits of one number, so distinct days merge by ``or`` and
never count twice; distinct locations are distinct rows; tags of a species are bits of bitmaps, merged by ``or`` too.
A summary of any whole months, or of all time, reads the roll-up and no detection.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackspark.functions.times import days_between, first_of_month, hours_between, local_date, year_month
from trackspark.operators.summary import distinct_with_null
from trackspark.sources.checks import require_columns

MONTH = "ym"


def monthly_rollup(det: DataFrame, tz: str | None = "UTC") -> DataFrame:
    """(elasmo, location, ym, n, mintime, maxtime, days): one row per tag, location and local month.

    Bit i - 1 of ``days`` stands for day i of the month. Detections without a time have a null month and no days.
    """
    require_columns(det, ("elasmo", "location", "time"))
    time = F.col("time")
    day = F.call_function("shiftleft", F.lit(1), F.dayofmonth(local_date(time, tz)) - 1)
    return det.groupBy("elasmo", "location", year_month(time, tz).alias(MONTH)).agg(
        F.count(F.lit(1)).alias("n"), F.min("time").alias("mintime"), F.max("time").alias("maxtime"), F.bit_or(day).alias("days")
    )


def with_month_number(rollup: DataFrame) -> DataFrame:
    """The roll-up with ``interval_id``, months counted from the first one; rows without a month are dropped."""
    dated = rollup.where(F.col(MONTH).isNotNull())
    first = first_of_month(dated.agg(F.min(MONTH)).scalar())
    month = first_of_month(F.col(MONTH))
    number = (F.year(month) - F.year(first)) * 12 + F.month(month) - F.month(first) + 1
    return dated.withColumn("interval_id", number.cast("int"))


def totals_of_rollup(rollup: DataFrame, months: tuple[str, str] | None = None) -> DataFrame:
    """``detection_totals`` per (period and) tag from the roll-up, optionally of the months from one to another.

    All rows of a period and tag merge, whatever months they span.
    """
    rows = rollup if months is None else rollup.where(F.col(MONTH).between(*map(F.lit, months)))
    keys = ["interval_id", "elasmo"] if "interval_id" in rollup.columns else ["elasmo"]
    # Days merge within a month first; a missing time is a day of its own, as in the totals of detections.
    per_month = rows.groupBy(*keys, MONTH).agg(
        F.sum("n").alias("n"), F.min("mintime").alias("lo"), F.max("maxtime").alias("hi"), F.bit_or("days").alias("days")
    )
    days = F.when(F.col(MONTH).isNull(), 1).otherwise(F.bit_count("days"))
    totals = per_month.groupBy(*keys).agg(
        F.sum("n").alias("total_detection"), F.min("lo").alias("mintime"), F.max("hi").alias("maxtime"), F.sum(days).alias("nbrday")
    )
    stations = rows.groupBy(*[F.col(k).alias(f"_s_{k}") for k in keys]).agg(distinct_with_null("location").alias("nbrstation"))
    same = [F.col(k).eqNullSafe(F.col(f"_s_{k}")) for k in keys]
    lo, hi = F.col("mintime"), F.col("maxtime")
    return totals.join(stations, same).select(
        *keys, "total_detection", "mintime", "maxtime", "nbrstation", "nbrday", days_between(lo, hi).alias("difd"), hours_between(lo, hi).alias("difh")
    )


def tag_bitmaps(rollup: DataFrame, ind: DataFrame) -> DataFrame:
    """(species, ym, bucket, tags): the tags of a species detected in a month, as bits of buckets of tag numbers."""
    species = ind.select(F.col("acoustic_tag_id").alias("elasmo"), "species").distinct()
    seen = rollup.select("elasmo", MONTH).distinct().join(species, "elasmo")
    tag = F.col("elasmo")
    return seen.groupBy("species", MONTH, F.bitmap_bucket_number(tag).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(tag)).alias("tags")
    )


def merged_tags(bitmaps: DataFrame, period: Column, name: str = "period", keys: Sequence[str] = ("species",)) -> DataFrame:
    """Exact number of distinct tags per species and period, a period being any function of ``ym``."""
    merged = bitmaps.groupBy(*keys, period.alias(name), "bucket").agg(F.bitmap_or_agg("tags").alias("tags"))
    return merged.groupBy(*keys, name).agg(F.sum(F.bitmap_count("tags")).alias("active_count"))
