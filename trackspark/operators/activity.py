"""Weekly receiver activity: when receivers were out and when they recorded."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trackspark.functions.times import local_date
from trackspark.operators.combine import union_by_name
from trackspark.operators.joins import interval_join
from trackspark.operators.rows import ordinals
from trackspark.sources.checks import require_columns

# Labels of the two sources.
DEPLOYMENT_SOURCE = "Rec. mov."
DETECTION_SOURCE = "Det."


def clean_receiver_deployments(
    vmov: DataFrame, failed: DataFrame | None = None, corrected: DataFrame | None = None
) -> DataFrame:
    """Drop failed deployments and replace wrong retrieval times.

    ``failed`` lists (location, date_in), ``corrected`` lists (location, date_in, date_out);
    locations are normalised names.
    """
    out = vmov
    if failed is not None:
        out = out.join(failed.select("location", "date_in"), ["location", "date_in"], "left_anti")
    if corrected is not None:
        fixes = corrected.select("location", "date_in", F.col("date_out").alias("_date_out"))
        out = out.join(fixes, ["location", "date_in"], "left")
        out = out.withColumn("date_out", F.coalesce("_date_out", "date_out")).drop("_date_out")
    return out.select(*vmov.columns)


def _weeks(first: Column, last: Column) -> Column:
    """Every seventh day from the first to the last; an open or inverted range gives none."""
    return F.explode(F.when(first <= last, F.sequence(first, last, F.make_dt_interval(days=F.lit(7)))))


def unusable_ranges(vmov: DataFrame, tz: str | None = "UTC") -> DataFrame:
    """Report: deployments whose range is open or inverted and so has no weeks."""
    first, last = local_date(F.col("date_in"), tz), local_date(F.col("date_out"), tz)
    return vmov.where(~F.coalesce(first <= last, F.lit(False)))


def weekly_deployments(vmov: DataFrame, tz: str | None = "UTC") -> DataFrame:
    """One row per deployment and week, dates in the data zone."""
    dated = vmov.withColumns({c: local_date(F.col(c), tz) for c in ("date_in", "date_out")})
    return dated.withColumn("weeks", _weeks(F.col("date_in"), F.col("date_out"))).withColumn(
        "source", F.lit(DEPLOYMENT_SOURCE)
    )


def weekly_detections(det: DataFrame, vmov: DataFrame, agency: str, tz: str | None = "UTC") -> DataFrame:
    """One row per deployment and week between its first and last detection day.

    Only days matter, so detections are reduced to distinct (location, station, day) with
    map-side combine before they meet the deployments.
    """
    days = (
        det.where(F.col("agency") == agency)
        .select("location", "station", local_date(F.col("time"), tz).alias("date"))
        .where(F.col("date").isNotNull())
        .distinct()
    )
    deployed = vmov.select(
        "location",
        "station",
        "date_in",
        "date_out",
        local_date(F.col("date_in"), tz).alias("_in"),
        local_date(F.col("date_out"), tz).alias("_out"),
    ).distinct()
    matched = interval_join(days, deployed, ["location", "station"], "date", "_in", "_out")
    ranges = matched.groupBy("location", "station", "date_in", "date_out").agg(
        F.min("date").alias("start_date"), F.max("date").alias("end_date")
    )
    # One row per deployment by now, so a window per location stays small.
    per_location = F.min("start_date").over(Window.partitionBy("location"))
    return (
        ranges.withColumn("min_start_date", per_location)
        .withColumn("weeks", _weeks(F.col("start_date"), F.col("end_date")))
        .withColumn("source", F.lit(DETECTION_SOURCE))
    )


def add_offset(activity: DataFrame, offset: float = 0.4) -> DataFrame:
    """Add ``y_position``: the rank of the location name, shifted for detection rows."""
    require_columns(activity, ["location", "source"])
    names = activity.select(F.col("location").alias("_location")).where(F.col("_location").isNotNull()).distinct()
    ranks = ordinals(names, ["_location"], "_rank")
    shift = F.when(F.col("source") == DETECTION_SOURCE, F.lit(float(offset))).otherwise(F.lit(0.0))
    return (
        activity.join(ranks, F.col("location") == F.col("_location"), "left")
        .withColumn("y_position", F.col("_rank") + shift)
        .select(*activity.columns, "y_position")
    )


def receiver_activity(weekly_deployed: DataFrame, weekly_detected: DataFrame, offset: float = 0.4) -> DataFrame:
    """Both weekly tables stacked as (location, weeks, source) with their vertical position."""
    columns = ["location", "weeks", "source"]
    return add_offset(union_by_name(weekly_deployed.select(*columns), weekly_detected.select(*columns)), offset)
