"""Per-animal summaries and location by tag counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackspark.functions.times import clock_text, days_between, hours_between, local_date
from trackspark.operators.rows import numbered_by_key
from trackspark.operators.sizes import settled
from trackspark.session import shared_dir
from trackspark.sources.checks import require_columns
from trackspark.sources.csv_files import CSV_DIALECT

# Tags of a block of matrix columns.
BLOCK_COLUMNS = 1_000


def distinct_with_null(c: str) -> Column:
    """Number of distinct values, a missing one counted as a value."""
    return F.count_distinct(F.col(c)) + F.coalesce(F.max(F.isnull(c).cast("int")), F.lit(0))


def detection_totals(det: DataFrame, tz: str | None = "UTC", min_days: int | None = None) -> DataFrame:
    """Per period and tag: detections, first and last time, distinct locations and local days.

    Detections are first reduced to one row per (period, tag, location, day), with map-side
    combine, so the distinct counts run over the reduced rows only.
    """
    require_columns(det, ("elasmo", "location", "time"))
    keys = ["interval_id", "elasmo"] if "interval_id" in det.columns else ["elasmo"]
    daily = det.groupBy(*keys, "location", local_date(F.col("time"), tz).alias("_day")).agg(
        F.count(F.lit(1)).alias("_n"), F.min("time").alias("_min"), F.max("time").alias("_max")
    )
    totals = daily.groupBy(*keys).agg(
        F.sum("_n").alias("total_detection"),
        F.min("_min").alias("mintime"),
        F.max("_max").alias("maxtime"),
        distinct_with_null("location").alias("nbrstation"),
        distinct_with_null("_day").alias("nbrday"),
    )
    totals = totals.withColumns(
        {
            "difd": days_between(F.col("mintime"), F.col("maxtime")),
            "difh": hours_between(F.col("mintime"), F.col("maxtime")),
        }
    )
    return totals if min_days is None else totals.where(F.col("nbrday") >= min_days)


def individual_summary(
    det: DataFrame, ind: DataFrame, tz: str | None = "UTC", min_days: int | None = None
) -> DataFrame:
    """Per period and animal: attributes, totals, days at liberty and residency index.

    Days at liberty are at least 1 and missing without a tagging time; numbers are rounded to two
    decimals, half to even.
    """
    return summary_of_totals(detection_totals(det, tz, min_days).drop("difd", "difh"), ind, tz)


def summary_of_totals(totals: DataFrame, ind: DataFrame, tz: str | None = "UTC") -> DataFrame:
    """``individual_summary`` from the totals of each period and tag."""
    joined = ind.join(totals, F.col("acoustic_tag_id") == F.col("elasmo"), "inner")
    liberty = F.when(
        F.col("tagging_datetime").isNotNull() & F.col("maxtime").isNotNull(),
        F.greatest(F.lit(1.0), days_between(F.col("tagging_datetime"), F.col("maxtime"))),
    )

    def two(c: Column) -> Column:
        return F.bround(c.cast("double"), 2)

    period = ["interval_id"] if "interval_id" in totals.columns else []
    return joined.withColumn("_liberty", liberty).select(
        *period,
        F.col("acoustic_tag_id").alias("id"),
        "species",
        clock_text(F.col("tagging_datetime"), tz).alias("date_tagged"),
        "sex",
        *[two(F.col(c)).alias(c) for c in ("pcl", "fl", "tl", "stl")],
        F.col("total_detection").alias("total_detections"),
        F.col("nbrstation").alias("total_stations_detected"),
        F.col("nbrday").alias("total_days_detected"),
        clock_text(F.col("mintime"), tz).alias("first_appearance"),
        clock_text(F.col("maxtime"), tz).alias("last_appearance"),
        two(F.col("_liberty")).alias("days_at_liberty"),
        two(F.col("nbrday") / F.col("_liberty")).alias("residency_index"),
    )


def detections_with_min_days(det: DataFrame, tz: str | None = "UTC", min_days: int = 1) -> DataFrame:
    """Detections of the tags that reach the minimum number of days, per period."""
    keys = ["interval_id", "elasmo"] if "interval_id" in det.columns else ["elasmo"]
    totals = settled(detection_totals(det, tz, min_days).select(*[F.col(k).alias(f"_{k}") for k in keys]))
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    return det.join(totals, same, "left_semi")


def detection_counts(det: DataFrame, group: str = "location") -> DataFrame:
    """Detections per (period,) group and tag: the long form of the matrix."""
    period = ["interval_id"] if "interval_id" in det.columns else []
    return det.groupBy(*period, group, "elasmo").agg(F.count(F.lit(1)).alias("n"))


def count_lists(counts: DataFrame, group: str = "location") -> DataFrame:
    """Per (period,) group the tags and counts as one array sorted by tag: a matrix of any number of tags."""
    period = ["interval_id"] if "interval_id" in counts.columns else []
    return counts.groupBy(*period, group).agg(F.sort_array(F.collect_list(F.struct("elasmo", "n"))).alias("counts"))


def tag_blocks(counts: DataFrame, width: int = BLOCK_COLUMNS) -> DataFrame:
    """(interval_id, block, elasmo, place): the tags of each period in blocks of at most ``width`` columns, place from 0.

    Tags stand in numeric order, a missing tag last. ``counts`` is the long form, best read from where it is stored.
    """
    shared_dir(counts.sparkSession)
    tags = counts.select("interval_id", "elasmo").distinct().withColumn("_missing", F.isnull("elasmo")).checkpoint()
    placed = numbered_by_key(tags, ["interval_id"], ["_missing", "elasmo"], "_n")
    at = F.col("_n") - 1
    return placed.select("interval_id", F.floor(at / width).cast("int").alias("block"), "elasmo", (at % width).cast("int").alias("place"))


def matrix_rows(counts: DataFrame, group: str = "location", width: int = BLOCK_COLUMNS) -> DataFrame:
    """The wide matrices of all periods as rows (interval_id, block, group, tags, counts): one per period, block and group.

    ``tags`` names the columns of the block, the same in all its rows; ``counts`` holds a number for each, 0 where the
    group did not detect the tag. A row holds at most ``width`` numbers, and all periods and blocks come from the same few
    shuffles, however many there are. Counts without periods are one period, ``all``.
    """
    if "interval_id" not in counts.columns:
        counts = counts.withColumn("interval_id", F.lit("all"))
    blocks = settled(tag_blocks(counts, width))
    name = F.coalesce(F.col("elasmo").cast("string"), F.lit("NA"))
    heads = blocks.groupBy("interval_id", "block").agg(F.sort_array(F.collect_list(F.struct("place", name.alias("name")))).alias("_tags"))
    heads = settled(heads.select(F.col("interval_id").alias("_h_period"), "block", F.col("_tags.name").alias("tags")))
    keys = ["interval_id", "block", group]

    def same(prefix: str, names: list[str]) -> list[Column]:
        return [F.col(c).eqNullSafe(F.col(f"{prefix}{c}")) for c in names]

    placed = blocks.select(F.col("interval_id").alias("_b_interval_id"), F.col("elasmo").alias("_b_elasmo"), "block", "place")
    cells = counts.join(placed, same("_b_", ["interval_id", "elasmo"])).groupBy(*keys)
    cells = cells.agg(F.map_from_entries(F.collect_list(F.struct("place", "n"))).alias("_cells"))
    found = cells.select(*[F.col(c).alias(f"_c_{c}") for c in keys], "_cells")
    # Every group of a period has a row in each of the period's blocks: that is the size of the result.
    every = counts.select("interval_id", group).distinct().join(heads, F.col("interval_id").eqNullSafe(F.col("_h_period")))
    none = F.lit(0).cast("bigint")
    filled = F.transform(F.sequence(F.lit(0), F.size("tags") - 1), lambda i: F.coalesce(F.try_element_at(F.col("_cells"), i), none))
    return every.join(found, same("_c_", keys), "left").select(*keys, "tags", filled.alias("counts"))


def matrix_lines(rows: DataFrame, group: str = "location") -> DataFrame:
    """``matrix_rows`` as CSV lines (interval_id, block, line), ready to be written by period and block.

    The heading of a block is its first line; rows follow by group, a missing group last. Each block of a period
    is gathered in one place, so that it is one file; its size is that of the matrix.
    """

    def line(first: Column, rest: Column) -> Column:
        quote = F.lit(CSV_DIALECT["quote"])
        quoted = F.concat(quote, F.replace(first, quote, F.lit(CSV_DIALECT["escape"] + CSV_DIALECT["quote"])), quote)
        cell = F.when(first.rlike('[,"\\r\\n]'), quoted).otherwise(F.coalesce(first, F.lit("")))
        return F.concat(cell, F.lit(","), rest)

    keys = ["interval_id", "block"]
    head = rows.select(*keys, "tags").dropDuplicates(keys).select(
        *keys, F.lit(0).alias("_at"), F.lit(None).cast("string").alias("_group"), line(F.lit(group), F.array_join("tags", ",")).alias("line")
    )
    body = rows.select(
        *keys,
        F.when(F.isnull(group), 2).otherwise(1).alias("_at"),
        F.col(group).cast("string").alias("_group"),
        line(F.col(group).cast("string"), F.array_join(F.col("counts").cast("array<string>"), ",")).alias("line"),
    )
    placed = head.unionAll(body).repartition(*keys)
    return placed.sortWithinPartitions(*keys, "_at", "_group").select(*keys, "line")


def detection_matrix(det: DataFrame, group_by_agency: bool = False, ids: Sequence[int] | None = None) -> DataFrame:
    """Location (or agency) by tag matrix of counts, empty cells 0, tags in numeric order.

    The tag ids become columns, so they must be known when the query is built: pass them or let
    them be listed, ``BLOCK_COLUMNS`` at most. ``count_lists`` and ``matrix_rows`` serve any number of tags.
    """
    group = "agency" if group_by_agency else "location"
    if ids is None:
        listed = det.select("elasmo").distinct().limit(BLOCK_COLUMNS + 1).collect()
        if len(listed) > BLOCK_COLUMNS:
            raise ValueError(f"more than {BLOCK_COLUMNS} tags: pass ids, or use matrix_rows")
        ids = sorted((r[0] for r in listed), key=lambda v: (v is None, v))
    names = ["NA" if v is None else str(v) for v in ids]
    period = ["interval_id"] if "interval_id" in det.columns else []
    keyed = det.select(*period, group, F.coalesce(F.col("elasmo").cast("string"), F.lit("NA")).alias("elasmo"))
    counted = keyed.groupBy(*period, group).pivot("elasmo", names).agg(F.count(F.lit(1)))
    return counted.na.fill(0, subset=names) if names else counted
