"""From imported tables to cleaned detections: compile, combine, clean."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from trackspark.functions.text import norm_name, tag_id
from trackspark.functions.times import local_date
from trackspark.operators import joins
from trackspark.operators.combine import most_precise_coordinates, union_by_name, update_receiver_registry
from trackspark.operators.isolation import flag_single_detections, remove_single_detections, removal_stats, removal_stats_of
from trackspark.sources.checks import require_paths
from trackspark.sources.tables import days_around, read_days, read_tables, table_path, write_days, write_tables

WAIT_HOURS = 24


@dataclass(frozen=True)
class Compiled:
    """Attributed detections and the two report tables."""

    detections: DataFrame
    unknown_tags: DataFrame
    tags_lost_to_time_filter: DataFrame


def compile_detections(
    det: DataFrame, vmov: DataFrame, ind: DataFrame, tz: str | None = "US/Eastern", skip_first_day: bool = True
) -> Compiled:
    """Detections of known tags after tagging, placed at the deployment in force."""
    det = det.withColumn("station", F.col("station").cast("string"))
    if dict(det.dtypes)["elasmo"] != dict(ind.dtypes)["acoustic_tag_id"]:
        det = det.withColumn("elasmo", tag_id(F.col("elasmo")))
        ind = ind.withColumn("acoustic_tag_id", tag_id(F.col("acoustic_tag_id")))
    tagged = joins.detections_after_tagging(det, ind, WAIT_HOURS if skip_first_day else 0, tz)
    placed = joins.assign_locations(tagged, vmov).where(F.col("location").isNotNull())
    known = joins.known_tags(det.select("elasmo").distinct(), ind)
    return Compiled(placed, joins.unknown_tags(det, ind), joins.tags_lost(known, tagged))


def run_compile(
    spark: SparkSession, folder: str, tz: str = "US/Eastern", skip_first_day: bool = True, days: Sequence[date] | None = None
) -> Compiled:
    """Write the attributed detections; with ``days`` only these local days are read and replaced."""
    t = read_tables(spark, folder, ["vmov", "ind"])
    det = read_tables(spark, folder, ["det"])["det"] if days is None else read_days(spark, folder, "det", days)
    out = compile_detections(det, t["vmov"], t["ind"], tz, skip_first_day)
    if days is None:
        write_tables({"det_compiled": out.detections}, folder, tz)
    else:
        write_days(out.detections, folder, "det_compiled", days, tz)
    return out


@dataclass(frozen=True)
class DepthTables:
    """Depths in metres by location name, for locations whose sheet lacks them."""

    instrument: Mapping[str, float] = field(default_factory=dict)
    bottom: Mapping[str, float] = field(default_factory=dict)


def combine_detections(
    compiled: DataFrame, vloc: DataFrame, foreign: list[DataFrame], depths: DepthTables = DepthTables()
) -> tuple[DataFrame, DataFrame]:
    """All detections (``det_tot``) and the extended receiver registry (``vloc``)."""
    orph = union_by_name(*foreign)
    orph = orph.withColumn("location", norm_name(F.col("location")))
    orph = most_precise_coordinates(orph).withColumn("elasmo", tag_id(F.col("elasmo")))
    registry = update_receiver_registry(vloc, orph, depths.instrument, depths.bottom)
    return union_by_name(compiled, orph.drop("deploy_long", "deploy_lat")), registry


def run_combine(
    spark: SparkSession,
    folder: str,
    foreign: list[DataFrame],
    depths: DepthTables = DepthTables(),
    tz: str = "US/Eastern",
    days: Sequence[date] | None = None,
) -> None:
    """Write all detections and the extended registry; with ``days`` only these local days of the detections are replaced."""
    # Foreign files are parsed and de-duplicated once: their rows are read for coordinates, union and registry.
    write_tables({"foreign_rows": union_by_name(*foreign)}, folder)
    stored = spark.read.parquet(table_path(folder, "foreign_rows"))
    vloc = read_tables(spark, folder, ["vloc"])["vloc"]
    name = "det_compiled"
    compiled = read_tables(spark, folder, [name])[name] if days is None else read_days(spark, folder, name, days)
    total, registry = combine_detections(compiled, vloc, [stored], depths)
    if days is None:
        write_tables({"det_tot": total, "vloc_extended": registry}, folder, tz)
    else:
        write_days(total, folder, "det_tot", days, tz)
        write_tables({"vloc_extended": registry}, folder)


def clean_detections(det: DataFrame, time_window_hours: float = 1) -> tuple[DataFrame, DataFrame]:
    """Detections without isolated ones, and the removal statistics."""
    flagged = flag_single_detections(det, time_window_hours)
    return remove_single_detections(flagged), removal_stats(flagged)


def run_clean(
    spark: SparkSession,
    folder: str,
    time_window_hours: float = 1,
    source: str = "det_tot",
    target: str = "det_cleaned",
    tz: str = "US/Eastern",
    days: Sequence[date] | None = None,
) -> DataFrame:
    """Write the cleaned detections and return the removal statistics, counted by the pass that writes.

    With ``days``, the local days whose detections have changed, only these and the days that the time window reaches from
    them are replaced, and the statistics are of the days replaced. A detection is isolated or not by those within the window
    alone, so the result is that of a full run.
    """
    if source == target:
        raise ValueError("a job never overwrites its input")
    require_paths(spark, [table_path(folder, source)])
    # A local day may have 23 hours.
    reach = int(time_window_hours // 23) + 1
    replaced = None if days is None else days_around(days, reach)
    if replaced is None:
        det = read_tables(spark, folder, [source])[source]
    else:
        det = read_days(spark, folder, source, days_around(replaced, reach))
    flagged = flag_single_detections(det, time_window_hours)
    if replaced is not None:
        flagged = flagged.where(local_date(F.col("time"), tz).isin(*replaced))
    seen = Observation()
    flagged = flagged.observe(seen, F.count(F.lit(1)).alias("original"), F.coalesce(F.sum("single_detection"), F.lit(0)).alias("removed"))
    kept = remove_single_detections(flagged)
    if replaced is None:
        write_tables({target: kept}, folder, tz)
    else:
        write_days(kept, folder, target, replaced, tz)
    original, removed = seen.get["original"], seen.get["removed"]
    # Tasks that ran twice, after the loss of an executor, are observed twice; the sizes of the files then tell.
    written = _stored_rows(spark, folder, target, replaced)
    if written != original - removed:
        original = _stored_rows(spark, folder, source, replaced)
        removed = original - written
    counts = spark.range(1).select(F.lit(original).cast("bigint").alias("original"), F.lit(removed).cast("bigint").alias("removed"))
    return removal_stats_of(counts)


def _stored_rows(spark: SparkSession, folder: str, name: str, days: Sequence[date] | None) -> int:
    """Rows of a stored table, from the footers of its files."""
    rows = read_tables(spark, folder, [name])[name] if days is None else read_days(spark, folder, name, days)
    return rows.count()
