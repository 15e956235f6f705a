"""Timeline tables: detections binned in time, with tag order, countries and tagging markers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackspark.functions.text import not_in
from trackspark.operators.joins import map_lookup
from trackspark.operators.periods import TimeGrid
from trackspark.operators.rows import ordinals

BASE_COLUMNS = (
    "time", "station", "elasmo", "agency", "location", "tagging_datetime", "species",
    "sex", "pcl", "fl", "tl", "stl", "latitude", "longitude",
)


def timeline_base(
    det: DataFrame,
    ind: DataFrame,
    vloc: DataFrame | None = None,
    exclude_site: Sequence[str] | None = None,
    species: str | None = None,
    dedupe_right: bool = False,
) -> DataFrame:
    """Detections with the attributes of their animal.

    The receiver registry adds no column here; it only repeats rows whose location it lists more
    than once. ``dedupe_right=True`` (or no registry) leaves that join out. Null keys never match.
    """
    animals = ind.where(not_in(F.col("site"), exclude_site))
    if species is not None:
        animals = animals.where(F.col("species") == species)
    animals = animals.select(F.col("acoustic_tag_id").alias("elasmo"), *[c for c in BASE_COLUMNS[5:]])
    out = det.select(*BASE_COLUMNS[:5]).join(animals, "elasmo", "inner")
    if vloc is not None and not dedupe_right:
        out = out.join(vloc.select("location"), "location", "left")
    return out.select(*BASE_COLUMNS)


def add_country(df: DataFrame, agency_country: Mapping[str, str]) -> DataFrame:
    """Country of each agency; unmatched agencies get null."""
    return map_lookup(df, agency_country, "agency", "country")


def tag_ordinals(df: DataFrame) -> DataFrame:
    """Rank (``indice``) of each tag when tags are listed by species, then id."""
    # Distinct pairs first: a minimum of texts alone would sort the detections.
    tags = df.select("elasmo", "species").distinct().groupBy("elasmo").agg(F.min("species").alias("species"))
    return ordinals(tags, ["species", "elasmo"], "indice")


def add_ordinal(df: DataFrame, tags: DataFrame) -> DataFrame:
    """Add the rank of each row's tag; tags not listed get null."""
    listed = tags.select(F.col("elasmo").alias("_elasmo"), "indice")
    return df.join(listed, F.col("elasmo").eqNullSafe(F.col("_elasmo")), "left").drop("_elasmo")


def binned_timeline(
    df: DataFrame, grid: TimeGrid, tags: DataFrame, agency_country: Mapping[str, str]
) -> DataFrame:
    """Timeline rows with bin, bin date, country and the rank of their tag in ``tags``."""
    binned = add_country(grid.add_bin(df, date="date"), agency_country)
    return add_ordinal(binned, tags)


def tagging_markers(ind: DataFrame, grid: TimeGrid, tags: DataFrame) -> DataFrame:
    """One row per tag-table row of a ranked tag, placed on the timeline's time grid."""
    animals = ind.select(F.col("acoustic_tag_id").alias("elasmo"), "species", "sex", "stl", "tagging_datetime")
    listed = animals.join(tags.select("elasmo", "indice"), "elasmo", "inner")
    return grid.add_bin(listed, "tagging_datetime", "_bin", "date").drop("_bin")


def legend_dimension(df: DataFrame) -> DataFrame:
    """Distinct (agency, country)."""
    return df.select("agency", "country").distinct()


def species_label_positions(markers: DataFrame) -> DataFrame:
    """First tag rank of each species."""
    return markers.groupBy("species").agg(F.min("indice").alias("position"))
