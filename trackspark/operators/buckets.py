"""Time buckets that keep the rows of one key and bucket within what one task can sort."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trackspark.functions.times import MICROS_PER_DAY

ROWS_PER_BUCKET = 2_000_000
LONGEST_DAYS = 365.0
MICROS_PER_SECOND = 1_000_000


def day_number(c: Column, dtype: T.DataType) -> Column:
    """Days since 1970 of a date or an instant."""
    if isinstance(dtype, T.DateType):
        return F.unix_date(c)
    return F.floor(F.unix_micros(c) / F.lit(MICROS_PER_DAY)).cast("int")


def measured_bucket_days(
    df: DataFrame, keys: Sequence[str], time: str, rows_per_bucket: int = ROWS_PER_BUCKET
) -> float:
    """Width at which the busiest key stays within ``rows_per_bucket`` rows per bucket.

    One aggregate over the key and time columns, combined before its shuffle, gives the rows of
    the busiest (key, day); a single number comes back to the driver. Where even a day holds too
    many rows the width is a fraction of it.
    """
    day = day_number(F.col(time), df.schema[time].dataType)
    busiest = df.groupBy(*keys, day.alias("_day")).agg(F.count(time).alias("_n")).agg(F.max("_n")).first()[0]
    return min(LONGEST_DAYS, rows_per_bucket / max(1, busiest or 0))


def bucket_of(c: Column, dtype: T.DataType, days: float) -> Column:
    """Bucket number of a date (whole days) or an instant (whole seconds)."""
    if isinstance(dtype, T.DateType):
        return F.floor(F.unix_date(c) / F.lit(max(1, int(days))))
    width = max(1, int(days * MICROS_PER_DAY) // MICROS_PER_SECOND) * MICROS_PER_SECOND
    return F.floor(F.unix_micros(c) / F.lit(width))
