"""Utility jobs: date conversion of a file and comparison of two table versions."""

from __future__ import annotations

import posixpath
from collections.abc import Sequence
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from trackspark.operators import diff, joins, quality
from trackspark.sources.tables import load_table, save_table


def run_date_conversion(
    spark: SparkSession,
    source: str,
    target: str,
    column: str = quality.DATE_COLUMN,
    formats: tuple[str, ...] = quality.DATE_FORMATS,
    output_format: str = "parquet",
    tz: str = "UTC",
) -> DataFrame:
    """Convert the date column of a file, write it in the chosen format, return the statistics.

    The file is read once: the pass that writes counts what it could not read.
    """
    if output_format not in ("csv", "parquet"):
        raise ValueError("output_format must be 'csv' or 'parquet'")
    converted = quality.convert_dates(load_table(spark, source), column, formats, tz)
    path = f"{posixpath.splitext(target)[0]}.{output_format}"
    converted, seen = quality.observed_conversion(converted, column)
    save_table(converted, path, output_format, column, tz)
    return quality.conversion_stats_of(spark, seen.get["total"], seen.get["failed"])


class Comparison:
    """Two versions compared: equality, differences per variable, rows of either side only.

    Every part is a DataFrame that is planned when it is first asked for.
    """

    def __init__(self, new: DataFrame, old: DataFrame, pairs: diff.Alignment):
        self.new, self.old, self.pairs = new, old, pairs

    @cached_property
    def identical(self) -> DataFrame:
        return diff.tables_identical(self.new, self.old)

    @cached_property
    def row_counts(self) -> DataFrame:
        return self.pairs.counts()

    @cached_property
    def by_variable(self) -> DataFrame:
        return self.pairs.by_variable()

    @cached_property
    def rows_only_new(self) -> DataFrame:
        return joins.anti_join_null_safe(self.new, self.old)

    @cached_property
    def rows_only_old(self) -> DataFrame:
        return joins.anti_join_null_safe(self.old, self.new)


def compare_tables(
    new: DataFrame,
    old: DataFrame,
    keys: Sequence[str] | None = None,
    order_by: Sequence[str] | None = None,
    zone: str | None = None,
    force_zone: str | None = None,
    tolerance: float = diff.NUMBER_TOLERANCE,
) -> Comparison:
    """Compare two versions, texts standardised first."""
    new, old = (diff.standardise_types(t, zone, force_zone) for t in (new, old))
    return Comparison(new, old, diff.Alignment(new, old, keys, order_by, tolerance))


class Diagnosis:
    """Comparison with diagnostics and sample differences; every part is planned when it is first asked for."""

    def __init__(self, new: DataFrame, old: DataFrame, pairs: diff.Alignment, sample_size: int):
        self.new, self.old, self.pairs, self.sample_size = new, old, pairs, sample_size

    @cached_property
    def diagnostics(self) -> DataFrame:
        return diff.diagnostics(self.new, self.old)

    @cached_property
    def by_variable(self) -> DataFrame:
        return self.pairs.by_variable()

    @cached_property
    def differing_cells(self) -> DataFrame:
        return self.pairs.differing_cells()

    @cached_property
    def samples(self) -> DataFrame:
        return self.pairs.samples(self.sample_size)


def diagnose_tables(
    new: DataFrame,
    old: DataFrame,
    keys: Sequence[str] | None = None,
    order_by: Sequence[str] | None = None,
    cut_zone: str | None = None,
    samples: int = 5,
) -> Diagnosis:
    """Compare two versions with diagnostics and sample differences."""
    new, old = (diff.standardise_types(t, cut_zone=cut_zone) for t in (new, old))
    return Diagnosis(new, old, diff.Alignment(new, old, keys, order_by), samples)


def run_comparison(
    spark: SparkSession, folder: str, new_name: str, old_name: str, **options
) -> Comparison:
    new, old = (load_table(spark, posixpath.join(folder, n), "parquet") for n in (new_name, old_name))
    return compare_tables(new, old, **options)
