"""Monthly share of deployed tags that were active."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trackspark.functions.times import first_of_month, year_month
from trackspark.operators.joins import asof_join
from trackspark.operators.rows import running_total


def active_tags(det: DataFrame, ind: DataFrame, tz: str | None = "UTC") -> DataFrame:
    """Distinct tags detected per species and month.

    Detections are reduced to distinct (tag, month) before they meet the tag table.
    """
    return active_from_months(tag_months(det, tz), ind)


def tag_months(det: DataFrame, tz: str | None = "UTC") -> DataFrame:
    """Distinct (tag, month) of the detections."""
    return det.select("elasmo", year_month(F.col("time"), tz).alias("ym")).distinct()


def active_from_months(months: DataFrame, ind: DataFrame) -> DataFrame:
    """Distinct tags per species and month, from distinct (tag, month)."""
    species = ind.select(F.col("acoustic_tag_id").alias("elasmo"), "species")
    joined = months.join(species, "elasmo", "inner")
    return joined.groupBy("species", "ym").agg(F.count_distinct("elasmo").alias("active_count"))


def deployed_tags(ind: DataFrame, det: DataFrame, tz: str | None = "UTC", scope: str = "species") -> DataFrame:
    """Running number of tags deployed by month, counting tags that were detected.

    ``scope="species"`` restarts the running total per species; ``"global"`` runs it over all
    rows in (species, month) order, as prefix sums of a sorted table.
    """
    if scope not in ("species", "global"):
        raise ValueError("scope must be 'species' or 'global'")
    detected = det.select(F.col("elasmo").alias("acoustic_tag_id")).distinct()
    counts = (
        ind.join(detected, "acoustic_tag_id", "left_semi")
        .groupBy("species", year_month(F.col("tagging_datetime"), tz).alias("date_tagged"))
        .agg(F.count_distinct("acoustic_tag_id").alias("_n"))
    )
    if scope == "global":
        return running_total(counts, ["species", "date_tagged"], "_n", "cs").select("species", "date_tagged", "cs")
    upto = Window.partitionBy("species").orderBy(F.col("date_tagged").asc_nulls_last())
    upto = upto.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return counts.select("species", "date_tagged", F.sum("_n").over(upto).alias("cs"))


def join_activity_deployment(active: DataFrame, deployed: DataFrame) -> DataFrame:
    """Each active month with the running total of the last deployment month up to it."""
    left = active.select("species", first_of_month(F.col("ym")).alias("roll_date"), "active_count")
    right = deployed.select("species", first_of_month(F.col("date_tagged")).alias("_month"), "cs")
    # Both sides are species by month, so one bucket per year needs no measuring.
    return asof_join(left, right, ["species"], "roll_date", "_month", bucket_days=365)


def skeleton_grid(joined: DataFrame, det: DataFrame, ind: DataFrame) -> DataFrame:
    """Every detected species with every month between the first and the last joined month."""
    detected = det.select(F.col("elasmo").alias("acoustic_tag_id")).distinct()
    species = ind.join(detected, "acoustic_tag_id", "left_semi").select("species").distinct()
    extent = joined.agg(F.struct(F.min("roll_date").alias("lo"), F.max("roll_date").alias("hi")).alias("r")).scalar()
    months = F.sequence(
        extent.getField("lo"), extent.getField("hi"), F.make_ym_interval(F.lit(0), F.lit(1))
    )
    return species.withColumn("roll_date", F.explode(months))


def monthly_proportions(joined: DataFrame, skeleton: DataFrame, empty: str = "zero") -> DataFrame:
    """Mean share of active tags per species and calendar month, shares rounded to one decimal.

    A month without deployed tags counts as 0 with ``empty="zero"``; with ``"nan"`` 0/0 gives NaN
    and x/0 infinity, which carry over into the mean.
    """
    if empty not in ("zero", "nan"):
        raise ValueError("empty must be 'zero' or 'nan'")
    facts = joined.select(F.col("species").alias("_species"), F.col("roll_date").alias("_date"), "active_count", "cs")
    same = F.col("species").eqNullSafe(F.col("_species")) & (F.col("roll_date") == F.col("_date"))
    filled = skeleton.join(facts, same, "left").na.fill(0, subset=["active_count", "cs"])
    if empty == "zero":
        undefined = F.lit(0.0)
    else:
        undefined = F.when(F.col("active_count") == 0, F.lit(float("nan"))).otherwise(F.lit(float("inf")))
    share = F.when(F.col("cs") == 0, undefined).otherwise(
        F.bround(F.col("active_count") / F.nullif(F.col("cs"), F.lit(0)), 1)
    )
    month = F.date_format("roll_date", "MM")
    return filled.groupBy("species", month.alias("month")).agg(F.avg(share).alias("mean_active_prop"))
