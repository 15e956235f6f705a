"""Date conversion as a table operator, and its statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from trackspark.functions.times import mixed_date_of_parts, text_parts
from trackspark.sources.checks import require_text

PARTS = "_date_parts"
DATE_COLUMN = "Date and Time (UTC)"
DATE_FORMATS = ("%m/%d/%y %H:%M", "%m/%d/%Y %H:%M")


def convert_dates(
    df: DataFrame,
    column: str = DATE_COLUMN,
    formats: tuple[str, ...] = DATE_FORMATS,
    tz: str | None = "UTC",
) -> DataFrame:
    """Replace a text column of mixed date formats by instants; other columns pass through.

    The parts of a text are a column of their own for a moment, so that one regular expression runs a row.
    """
    require_text(df, column)
    text = F.col(f"`{column}`")
    cut = df.withColumn(PARTS, text_parts(text))
    return cut.withColumn(column, mixed_date_of_parts(text, F.col(PARTS), tuple(formats), tz)).drop(PARTS)


def observed_conversion(df: DataFrame, column: str = DATE_COLUMN) -> tuple[DataFrame, Observation]:
    """The same rows, and the counts of all and of unparsed ones that whatever runs them first fills in."""
    seen = Observation()
    counts = [F.count(F.lit(1)).alias("total"), F.count_if(F.col(f"`{column}`").isNull()).alias("failed")]
    return df.observe(seen, *counts), seen


def conversion_stats_of(spark: SparkSession, total: int, failed: int) -> DataFrame:
    """``conversion_stats`` of known counts."""
    rate = F.bround(F.try_divide(F.lit(total - failed).cast("double"), F.lit(total).cast("double")) * 100, 2)
    return spark.range(1).select(F.lit(total).cast("bigint").alias("total"), F.lit(failed).cast("bigint").alias("failed"), rate.alias("success_rate"))


def conversion_stats(df: DataFrame, column: str = DATE_COLUMN) -> DataFrame:
    """One row: rows, unparsed rows and success rate in percent (two decimals)."""
    c = F.col(f"`{column}`")
    return df.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(c.isNull()).alias("failed"),
        F.bround(F.avg(c.isNotNull().cast("int")) * 100, 2).alias("success_rate"),
    )
