"""Derived tables: period summaries, receiver activity, timelines, residency."""

from __future__ import annotations

import posixpath
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import date, timedelta
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackspark.functions.times import clock_text
from trackspark.operators import activity, residency, rollup, summary, timeline
from trackspark.operators.periods import TimeGrid, assign_period, period_table, time_window
from trackspark.operators.sizes import settled
from trackspark.sources.tables import (
    SUMMARY_HEADINGS,
    read_days,
    read_detections,
    read_tables,
    save_period_csv,
    write_parts,
    write_tables,
)


@dataclass(frozen=True)
class SummaryConfig:
    tz: str = "US/Eastern"
    start: str | None = None
    end: str | None = None
    monthly: bool = False
    by_agency: bool = False
    min_days: int | None = None
    matrix_width: int = summary.BLOCK_COLUMNS


@dataclass(frozen=True)
class SummaryReport:
    periods: DataFrame
    summary: DataFrame
    counts: DataFrame
    kept: DataFrame | None
    detections: DataFrame


def period_summary(det: DataFrame, ind: DataFrame, config: SummaryConfig = SummaryConfig()) -> SummaryReport:
    """Per period: animal summary and location (or agency) by tag counts."""
    bounds = {"monthly": config.monthly, "start": config.start, "end": config.end, "tz": config.tz}
    rows = assign_period(det, **bounds)
    return SummaryReport(
        periods=period_table(det, **bounds),
        summary=summary.individual_summary(rows, ind, config.tz, config.min_days),
        counts=summary.detection_counts(rows, "agency" if config.by_agency else "location"),
        kept=None if config.min_days is None else summary.detections_with_min_days(rows, config.tz, config.min_days),
        detections=rows,
    )


def run_summary(
    spark: SparkSession, folder: str, out_folder: str, config: SummaryConfig = SummaryConfig()
) -> SummaryReport:
    """Write period breakpoints, summaries and matrices as CSV, one folder per period.

    A matrix has the tags of its period, in blocks of columns where there are many; one write makes them all. The detections kept go to
    ``det_cleaned_season`` beside the input tables, where the residency job looks for them.
    """
    t = read_tables(spark, folder, ["ind"])
    det = read_detections(spark, folder, "det_cleaned", config.start, config.end)
    report = period_summary(det, t["ind"], config)
    shown = report.periods.withColumn("period", clock_text(F.col("period"), config.tz, "yyyy-MM-dd HH:mm:ss"))
    save_period_csv(shown, posixpath.join(out_folder, "dattime"), order_by=["index"])
    save_period_csv(report.summary, posixpath.join(out_folder, "summary"), SUMMARY_HEADINGS, ["species", "id"])
    # What the residency job reads: the detections within the periods, of tags with enough days if asked for.
    write_tables({"det_cleaned_season": report.detections if report.kept is None else report.kept}, folder, config.tz)
    # The long form is always complete and written first; the matrices of the periods come from it.
    group = "agency" if config.by_agency else "location"
    write_tables({"counts_ind_location": report.counts}, out_folder)
    counts = spark.read.parquet(posixpath.join(out_folder, "counts_ind_location"))
    save_matrices(counts, posixpath.join(out_folder, "matrix_ind_location"), group, config.matrix_width)
    return report


def run_rollup(
    spark: SparkSession,
    folder: str,
    source: str = "det_cleaned",
    target: str = "rollup_month",
    tz: str = "US/Eastern",
    months: Sequence[str] | None = None,
) -> None:
    """Write the monthly roll-up of the detections; with ``months`` (``yyyy-MM``) only these are read and replaced."""
    month = rollup.MONTH
    if months is None:
        rolled = rollup.monthly_rollup(read_tables(spark, folder, [source])[source], tz)
        write_tables({target: rolled}, folder, tz, {target: month})
        return
    firsts = [date.fromisoformat(f"{m}-01") for m in months]
    days = [d + timedelta(days=k) for d in firsts for k in range(31)]
    write_parts(rollup.monthly_rollup(read_days(spark, folder, source, days), tz), folder, target, month, months)


def rollup_summaries(rolled: DataFrame, ind: DataFrame, tz: str = "US/Eastern") -> tuple[DataFrame, DataFrame]:
    """(monthly, full) summaries of the animals, both from the roll-up; the full period is number 1."""
    by_month = rollup.with_month_number(rolled)
    totals = [rollup.totals_of_rollup(rows) for rows in (by_month, by_month.withColumn("interval_id", F.lit(1)))]
    return tuple(summary.summary_of_totals(t.drop("difd", "difh"), ind, tz) for t in totals)


def run_rollup_summaries(spark: SparkSession, folder: str, out_folder: str, name: str = "rollup_month", tz: str = "US/Eastern") -> None:
    """Monthly and full summaries as CSV reports, from the stored roll-up."""
    t = read_tables(spark, folder, [name, "ind"])
    monthly, full = rollup_summaries(t[name], t["ind"], tz)
    save_period_csv(monthly, posixpath.join(out_folder, "summary_monthly"), SUMMARY_HEADINGS, ["species", "id"])
    save_period_csv(full, posixpath.join(out_folder, "summary_full"), SUMMARY_HEADINGS, ["species", "id"])


def save_matrices(counts: DataFrame, path: str, group: str, width: int = summary.BLOCK_COLUMNS) -> None:
    """The matrices of all periods as CSV, a folder per period and block of columns, in one write."""
    lines = summary.matrix_lines(summary.matrix_rows(counts, group, width), group)
    lines.write.mode("overwrite").partitionBy("interval_id", "block").text(path)


def receiver_activity(
    det: DataFrame,
    vmov: DataFrame,
    agency: str,
    tz: str = "US/Eastern",
    failed: DataFrame | None = None,
    corrected: DataFrame | None = None,
    offset: float = 0.4,
) -> DataFrame:
    """Weekly deployment and detection activity, ready to plot."""
    usable = activity.clean_receiver_deployments(vmov, failed, corrected)
    deployed = activity.weekly_deployments(usable, tz)
    detected = activity.weekly_detections(det, usable, agency, tz)
    return activity.receiver_activity(deployed, detected, offset)


def run_receiver_activity(spark: SparkSession, folder: str, out_folder: str, agency: str, **options) -> None:
    t = read_tables(spark, folder, ["det_cleaned", "vmov", "ind", "vloc"])
    write_tables(
        {"receiver_activity": receiver_activity(t["det_cleaned"], t["vmov"], agency, **options)}, out_folder
    )


@dataclass(frozen=True)
class TimelineConfig:
    tz: str = "US/Eastern"
    start: str | None = None
    end: str | None = None
    step_days: int = 4
    months_left: int = 0
    exclude_site: Sequence[str] | None = None
    species: str | None = None
    agency_country: Mapping[str, str] = field(default_factory=dict)
    dedupe_right: bool = False


@dataclass(frozen=True)
class Timeline:
    """Binned detections and the tables that label them, each built when asked for."""

    base: DataFrame
    ind: DataFrame
    config: TimelineConfig

    @cached_property
    def _grid(self) -> TimeGrid:
        return TimeGrid(self.base, self.config.step_days, self.config.months_left, self.config.tz)

    @cached_property
    def _tags(self) -> DataFrame:
        return settled(timeline.tag_ordinals(self.base))

    @cached_property
    def grid(self) -> DataFrame:
        return self._grid.table()

    @cached_property
    def rows(self) -> DataFrame:
        return timeline.binned_timeline(self.base, self._grid, self._tags, self.config.agency_country)

    @cached_property
    def markers(self) -> DataFrame:
        return timeline.tagging_markers(self.ind, self._grid, self._tags)

    @cached_property
    def legend(self) -> DataFrame:
        return timeline.legend_dimension(timeline.add_country(self.base, self.config.agency_country))

    @cached_property
    def label_positions(self) -> DataFrame:
        return timeline.species_label_positions(self.markers)


def timeline_tables(
    det: DataFrame, ind: DataFrame, vloc: DataFrame | None, config: TimelineConfig = TimelineConfig()
) -> Timeline:
    """Binned detections with the tables that label them."""
    return Timeline(_timeline_base(det, ind, vloc, config), ind, config)


def _timeline_base(det: DataFrame, ind: DataFrame, vloc: DataFrame | None, config: TimelineConfig) -> DataFrame:
    base = timeline.timeline_base(det, ind, vloc, config.exclude_site, config.species, config.dedupe_right)
    return time_window(base, config.start, config.end, config.tz)


def run_timeline(
    spark: SparkSession,
    folder: str,
    out_folder: str,
    config: TimelineConfig = TimelineConfig(),
    registry: str = "vloc_extended",
) -> Timeline:
    t = read_tables(spark, folder, ["ind", registry])
    bounds = (config.start, config.end) if config.start and config.end else ()
    det = read_detections(spark, folder, "det_cleaned", *bounds)
    # Five tables come from the same joined rows: they are written once and read back.
    write_tables({"timeline_base": _timeline_base(det, t["ind"], t[registry], config)}, out_folder)
    out = Timeline(read_tables(spark, out_folder, ["timeline_base"])["timeline_base"], t["ind"], config)
    write_tables(
        {
            "timeline_grid": out.grid,
            "timeline": out.rows,
            "timeline_markers": out.markers,
            "timeline_legend": out.legend,
            "timeline_labels": out.label_positions,
        },
        out_folder,
        config.tz,
    )
    return out


def monthly_residency(
    det: DataFrame,
    ind: DataFrame,
    tz: str | None = "US/Eastern",
    scope: str = "species",
    empty: str = "zero",
) -> DataFrame:
    """Mean share of deployed tags that were active, per species and calendar month.

    Every step needs the detections only as distinct (tag, month): these, and the joined species and months, are
    written once.
    """
    months = settled(residency.tag_months(det, tz))
    joined = settled(
        residency.join_activity_deployment(
            residency.active_from_months(months, ind), residency.deployed_tags(ind, months, tz, scope)
        )
    )
    return residency.monthly_proportions(joined, residency.skeleton_grid(joined, months, ind), empty)


def run_residency(spark: SparkSession, folder: str, out_folder: str, source: str = "det_cleaned_season", **options) -> None:
    t = read_tables(spark, folder, [source, "ind"])
    write_tables({"monthly_residency": monthly_residency(t[source], t["ind"], **options)}, out_folder)
