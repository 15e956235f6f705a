"""Periods and regular time grids.

A grid is described by one row (start and length) that Spark reads as a scalar subquery; the bin
of a row is then arithmetic on its time, whatever the number of breakpoints.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackspark.functions.times import MICROS_PER_DAY, days_between, from_wall_clock, local_midnight, wall_clock
from trackspark.sources.checks import require_positive


def _instant(text: str | None, tz: str | None, name: str) -> Column | None:
    if text is None:
        return None
    try:
        datetime.fromisoformat(text)
    except ValueError as error:
        raise ValueError(f"{name} is not a date or time: {text!r}") from error
    return from_wall_clock(F.lit(text).cast("timestamp"), tz)


def time_window(df: DataFrame, start: str | None, end: str | None, tz: str | None = "UTC") -> DataFrame:
    """Rows with ``start <= time <= end``; off unless both bounds are given."""
    lo, hi = _instant(start, tz, "start"), _instant(end, tz, "end")
    if lo is None or hi is None:
        return df
    return df.where(F.col("time").between(lo, hi))


def _extent(det: DataFrame, start: str | None, end: str | None, tz: str | None) -> DataFrame:
    lo, hi = _instant(start, tz, "start"), _instant(end, tz, "end")
    return det.agg(
        (F.min("time") if lo is None else F.first(lo)).alias("lo"),
        (F.max("time") if hi is None else F.first(hi)).alias("hi"),
    )


def _month_floor(ts: Column, tz: str | None) -> Column:
    return F.date_trunc("month", wall_clock(ts, tz))


def _month_ceiling(ts: Column, tz: str | None) -> Column:
    """Start of the next month; an exact month start is its own ceiling."""
    floor = _month_floor(ts, tz)
    return F.when(floor == wall_clock(ts, tz), floor).otherwise(floor + F.make_ym_interval(F.lit(0), F.lit(1)))


def period_table(
    det: DataFrame,
    monthly: bool = False,
    start: str | None = None,
    end: str | None = None,
    tz: str | None = "UTC",
) -> DataFrame:
    """Breakpoints (index, period): local month starts, or the first time and one minute past the last."""
    extent = _extent(det, start, end, tz).where(F.col("lo") <= F.col("hi"))
    if monthly:
        first, last = _month_floor(F.col("lo"), tz), _month_ceiling(F.col("hi"), tz)
        points = F.sequence(first, last, F.make_ym_interval(F.lit(0), F.lit(1)))
        points = F.transform(points, lambda p: from_wall_clock(p, tz))
    else:
        points = F.array("lo", F.col("hi") + F.make_dt_interval(mins=F.lit(1)))
    at = extent.select(F.posexplode(points).alias("_pos", "period"))
    return at.select((F.col("_pos") + 1).cast("int").alias("index"), "period")


def assign_period(
    det: DataFrame,
    monthly: bool = False,
    start: str | None = None,
    end: str | None = None,
    tz: str | None = "UTC",
) -> DataFrame:
    """Add ``interval_id``, the half-open period a detection lies in; rows outside are dropped.

    One pass replaces a filter per period.
    """
    extent = _extent(det, start, end, tz).select(F.struct("lo", "hi").alias("r")).scalar()
    lo, hi, time = extent.getField("lo"), extent.getField("hi"), F.col("time")
    if monthly:
        first, clock = _month_floor(lo, tz), wall_clock(time, tz)
        months = (F.year(clock) - F.year(first)) * 12 + F.month(clock) - F.month(first)
        inside = (time >= from_wall_clock(first, tz)) & (time < from_wall_clock(_month_ceiling(hi, tz), tz))
        return det.where(inside).withColumn("interval_id", (months + 1).cast("int"))
    inside = (time >= lo) & (time < hi + F.make_dt_interval(mins=F.lit(1)))
    return det.where(inside).withColumn("interval_id", F.lit(1))


class TimeGrid:
    """Breakpoints every ``step_days`` days over the times of a table.

    The grid starts 30 days times ``months_left`` before the local midnight of the first time,
    runs in elapsed days for 1.4 times the span, and each breakpoint is moved to the local
    midnight of its date.
    """

    def __init__(self, df: DataFrame, step_days: int = 4, months_left: int = 0, tz: str | None = "UTC"):
        require_positive("step_days", step_days)
        if int(step_days) != step_days:
            raise ValueError("step_days must be a whole number of days")
        self.tz, self.step = tz, int(step_days) * MICROS_PER_DAY
        lead = F.make_dt_interval(days=F.lit(30 * months_left))
        span = df.agg(
            (local_midnight(F.min("time"), tz) - lead).alias("start"), local_midnight(F.max("time"), tz).alias("last")
        ).where(F.col("start").isNotNull())
        steps = F.ceil(days_between(F.col("start"), F.col("last"))) / F.lit(float(step_days))
        self.shape = span.select(
            F.unix_micros("start").alias("start"),
            F.ceil(steps + F.lit(0.4) * steps).cast("bigint").alias("n"),
        )

    def _point(self, start: Column, i: Column) -> Column:
        return local_midnight(F.timestamp_micros(start + i * F.lit(self.step)), self.tz)

    def table(self) -> DataFrame:
        """Breakpoints (bin, date)."""
        rows = self.shape.where(F.col("n") > 0).select(
            "start", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n") - 1)).alias("i")
        )
        return rows.select((F.col("i") + 1).cast("int").alias("bin"), self._point(F.col("start"), F.col("i")).alias("date"))

    def add_bin(self, df: DataFrame, column: str = "time", bin_name: str = "bin", date: str | None = None) -> DataFrame:
        """Add the number of breakpoints at or before the time and, if named, the latest of them.

        A breakpoint lies at most 25 hours before its unmoved position and steps are at least a
        day, so beyond the unmoved count only the next two breakpoints can still be at or before
        the time.
        """
        shape = self.shape.select(F.struct("start", "n").alias("s")).scalar()
        start, n = shape.getField("start"), shape.getField("n")
        time = F.col(column)
        passed = F.floor((F.unix_micros(time) - start) / F.lit(float(self.step))) + 1
        count = F.greatest(F.lit(0).cast("bigint"), F.least(n, passed))

        def one_more(i: Column) -> Column:
            return F.when((i < n) & (self._point(start, i) <= time), 1).otherwise(0)

        out = df.withColumn("_count", F.when(time.isNotNull(), count))
        total = F.col("_count") + one_more(F.col("_count")) + one_more(F.col("_count") + 1)
        out = out.withColumn(bin_name, total.cast("int")).drop("_count")
        if date:
            latest = self._point(start, F.col(bin_name).cast("bigint") - 1)
            out = out.withColumn(date, F.when(F.col(bin_name) > 0, latest))
        return out
