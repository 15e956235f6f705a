"""Joins: tag attribution, point in interval, as-of, lookups and anti joins."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trackspark.functions.times import add_clock_hours
from trackspark.operators.buckets import LONGEST_DAYS, ROWS_PER_BUCKET, bucket_of, day_number, measured_bucket_days
from trackspark.operators.rows import keep_first
from trackspark.operators.sizes import BROADCAST_MB, row_bytes

# Rows listed per time range, and further ones where points are shuffled, before slices get wider than they need to be.
LISTED, LISTED_FREE = 4, 100_000
# Ranges more that a point may meet for one look-up less.
EXTRA = 2.0
# Right rows of one key and slice that every left row there may meet in an as-of join.
DENSE = 1_000


def lookup_table(spark: SparkSession, mapping: Mapping[str, str], key: str, value: str) -> DataFrame:
    """Two-column table of a mapping held in the configuration.

    Built from Arrow it becomes a local relation: Spark knows its exact size and broadcasts it
    only below its threshold.
    """
    table = pa.table({key: pa.array(list(mapping), pa.string()), value: pa.array(list(mapping.values()), pa.string())})
    return spark.createDataFrame(table)


def map_lookup(
    df: DataFrame, mapping: Mapping[str, str], key: str, value: str, default: str | None = None
) -> DataFrame:
    """Add ``value`` looked up from ``key``; unmatched rows get ``default``."""
    table = lookup_table(df.sparkSession, mapping, "_key", "_value")
    found = F.col("_value") if default is None else F.coalesce("_value", F.lit(default))
    return df.join(table, F.col(key) == F.col("_key"), "left").withColumn(value, found).drop("_key", "_value")


def known_tags(det: DataFrame, ind: DataFrame) -> DataFrame:
    """Detections whose tag occurs in the tag table."""
    ids = ind.select(F.col("acoustic_tag_id").alias("elasmo"))
    return det.join(ids, "elasmo", "left_semi")


def unknown_tags(det: DataFrame, ind: DataFrame) -> DataFrame:
    """Report: tags detected but absent from the tag table, a missing tag included."""
    # Distinct before the set difference, so that it runs on tags, not on detections.
    return det.select("elasmo").distinct().subtract(ind.select(F.col("acoustic_tag_id").alias("elasmo")))


def detections_after_tagging(
    det: DataFrame, ind: DataFrame, hours: int = 0, tz: str | None = "UTC", order: Sequence[str] = ()
) -> DataFrame:
    """Detections of known tags at or after the tagging time, optionally some clock hours later.

    The first row per tag counts when a tag occurs more than once (``order`` tells which is
    first). A tag without a tagging time keeps no detections. Null tags never match.
    """
    first = keep_first(ind, ["acoustic_tag_id"], order)
    since = F.col("tagging_datetime")
    tagged = first.select(
        F.col("acoustic_tag_id").alias("elasmo"),
        (add_clock_hours(since, hours, tz) if hours else since).alias("_since"),
    )
    return det.join(tagged, "elasmo", "inner").where(F.col("time") >= F.col("_since")).select(*det.columns)


def tags_lost(before: DataFrame, after: DataFrame) -> DataFrame:
    """Report: tags present before a filter and absent after it."""
    return before.select("elasmo").distinct().subtract(after.select("elasmo").distinct())


def time_unit(c: Column, dtype: T.DataType) -> Column:
    """Whole seconds of an instant, whole days of a date, since 1970."""
    return F.unix_date(c).cast("bigint") if isinstance(dtype, T.DateType) else F.unix_seconds(c)


class _Level(NamedTuple):
    """Ranges whose length is at most 2^bits units and above half of it."""

    bits: int
    n: int
    busiest: int
    length: int
    first: int
    last: int


def slice_levels(levels: Sequence[_Level], free: int = 0) -> dict[int, int]:
    """For each level the bits of the slice width at which its ranges are listed.

    As a rule a range is listed in slices of its own length, two at most. Long ranges are listed in finer slices as long
    as the listing stays within ``LISTED`` rows a range and ``free`` further ones, so that points they hold are spread over time. A level
    joins the next longer one where that brings a point of the busiest key few more ranges, because every width costs a
    look-up of all points.
    """
    rows = sum(v.n for v in levels)
    budget = LISTED * rows + free

    def listing(cap: int) -> int:
        return sum(2 * v.n + ((v.length >> cap) if v.bits > cap else 0) for v in levels)

    cap = next(bits for bits in range(64) if listing(bits) <= budget)
    chosen: dict[int, int] = {}
    width, extra = None, 0.0
    for level in sorted(levels, reverse=True):
        if level.bits >= cap:
            width = cap
        else:
            met = level.busiest * 2.0 ** (width + 1) / (level.last - level.first + 1) if width is not None else 0.0
            if width is None or extra + met > EXTRA:
                width, extra = level.bits, 0.0
            else:
                extra += met
        chosen[level.bits] = width
    return chosen


class _Slices:
    """Time ranges listed once per slice of time they touch, for an equi join on (key, slice width, slice).

    The widths are powers of two of seconds (or days), those of ``slice_levels``: a point looks up one slice of each
    width and meets ranges near it only, however the lengths are mixed. A range has one width and a point
    lies in one slice of it, hence no duplicates. One aggregate over the ranges gives the widths and the size of the listing.
    """

    def __init__(self, ranges: DataFrame, keys: Sequence[str], first: Column, last: Column, broadcast_mb: int, free: int = 0):
        bits = F.ceil(F.log2(last - first + 1)).cast("int")
        sized = ranges.select(*keys, bits.alias("_bits"), first.alias("_first"), last.alias("_last"), row_bytes(ranges).alias("_bytes"))
        per_key = sized.groupBy(*keys, "_bits").agg(
            F.count(F.lit(1)).alias("n"),
            F.sum((F.col("_last") - F.col("_first") + 1).cast("decimal(38,0)")).alias("length"),
            F.min("_first").alias("first"),
            F.max("_last").alias("last"),
            F.max("_bytes").alias("bytes"),
        )
        found = per_key.groupBy("_bits").agg(
            F.sum("n").alias("n"), F.max("n").alias("busiest"), F.sum("length").alias("length"), F.min("first").alias("first"), F.max("last").alias("last"), F.max("bytes").alias("bytes")
        )
        # One row per power of two.
        rows = found.collect()
        levels = [_Level(r["_bits"], r.n, r.busiest, int(r.length), r.first, r.last) for r in rows]
        chosen = slice_levels(levels, free) if levels else {0: 0}
        self.widths = sorted(set(chosen.values()))
        listed = sum(2 * v.n + ((v.length >> chosen[v.bits]) if v.bits > chosen[v.bits] else 0) for v in levels)
        self.small = listed * max((r.bytes for r in rows), default=0) <= broadcast_mb * 1024 * 1024
        width = F.element_at(F.create_map(*[F.lit(x) for pair in chosen.items() for x in pair]), bits)
        self.ranges = ranges.withColumn("_width", width).withColumn(
            "_slice", F.explode(F.sequence(F.call_function("shiftright", first, F.col("_width")), F.call_function("shiftright", last, F.col("_width"))))
        )

    def looked_up(self, points: DataFrame, at: Column) -> DataFrame:
        """Each point once per slice width; points without a time go."""
        slices = F.array(*[F.struct(F.lit(w).alias("_width"), F.shiftright(at, w).alias("_slice")) for w in self.widths])
        return points.where(at.isNotNull()).select("*", F.inline(slices))

    def side(self) -> DataFrame:
        """The right side of the join, hinted for broadcast when measured small."""
        return F.broadcast(self.ranges) if self.small else self.ranges


def _sliced(
    points: DataFrame, ranges: DataFrame, keys: Sequence[str], at: Column, first: Column, last: Column, broadcast_mb: int
) -> _Slices:
    """The listing of the ranges. One that is too big to broadcast is cut to the extent of the points, so that all its
    slices lie where there are points and spread them."""
    slices = _Slices(ranges, keys, first, last, broadcast_mb)
    if slices.small:
        return slices
    lo, hi = points.agg(F.min(at), F.max(at)).first()
    if lo is None:
        return slices
    return _Slices(ranges.where((last >= lo) & (first <= hi)), keys, F.greatest(first, F.lit(lo)), F.least(last, F.lit(hi)), broadcast_mb, LISTED_FREE)


def interval_join(
    points: DataFrame,
    intervals: DataFrame,
    on: Sequence[str],
    point: str,
    start: str,
    end: str,
    broadcast_mb: int = BROADCAST_MB,
) -> DataFrame:
    """Inner join of each point to the intervals of its key that contain it, both ends closed.

    Overlapping intervals multiply rows; an interval with an open or inverted range matches
    nothing; null keys match nothing. Columns of ``intervals`` other than the key are added.

    The join is an equi join on (key, slice width, time slice) with the exact range as residual. The intervals
    are broadcast only when measured below ``broadcast_mb``, otherwise both sides shuffle.
    """
    usable = intervals.where(F.col(start) <= F.col(end)).dropna(subset=list(on))
    dtype = points.schema[point].dataType
    at = time_unit(F.col(point), dtype)
    slices = _sliced(points, usable, on, at, time_unit(F.col(start), dtype), time_unit(F.col(end), dtype), broadcast_mb)
    keyed = slices.looked_up(points, at)
    joined = keyed.join(slices.side(), [*on, "_width", "_slice"], "inner")
    out = [*points.columns, *[c for c in intervals.columns if c not in points.columns]]
    return joined.where(F.col(point).between(F.col(start), F.col(end))).select(*out)


def assign_locations(det: DataFrame, vmov: DataFrame) -> DataFrame:
    """Location of the receiver deployment in force at the time of each detection."""
    deployments = vmov.select("station", "location", "date_in", "date_out")
    return interval_join(det.drop("location"), deployments, ["station"], "time", "date_in", "date_out").drop(
        "date_in", "date_out"
    )


def asof_join(
    left: DataFrame,
    right: DataFrame,
    by: Sequence[str],
    left_time: str,
    right_time: str,
    bucket_days: float | None = None,
    broadcast_mb: int = BROADCAST_MB,
) -> DataFrame:
    """Each left row with the last right row of its key at or before its time.

    Left rows without an earlier right row stay, with nulls. Null keys match each other. Of right
    rows of one key and time the greatest by the other columns counts. Nulls inside a matched row are kept.

    The right side is counted per key and day first. Where it is small and no day is crowded it is
    broadcast, and the left side is not shuffled. Otherwise (or when ``bucket_days`` is given, which skips measuring) both
    sides are stacked and read by a window per key and time bucket, a bucket so short that neither side crowds it.
    """
    kinds = left.schema[left_time].dataType, right.schema[right_time].dataType
    if kinds[0] != kinds[1]:
        raise TypeError(f"{left_time} is {kinds[0].simpleString()}, {right_time} is {kinds[1].simpleString()}")
    dated = _one_per_time(right.where(F.col(right_time).isNotNull()), [*by, right_time])
    if bucket_days is None:
        shape = _RightSide(dated, by, right_time)
        if shape.broadcast_days(broadcast_mb):
            return _asof_slices(left, dated, by, left_time, right_time, shape, shape.broadcast_days(broadcast_mb))
        bucket_days = min(measured_bucket_days(left, by, left_time), ROWS_PER_BUCKET / max(1, shape.busiest), LONGEST_DAYS)
    return _asof_stacked(left, dated, by, left_time, right_time, bucket_days)


class _RightSide:
    """Size and crowding of the right side of an as-of join, from one aggregate per (key, day)."""

    def __init__(self, right: DataFrame, by: Sequence[str], time: str):
        day = day_number(F.col(time), right.schema[time].dataType)
        daily = right.groupBy(*by, day.alias("_day")).agg(F.count(F.lit(1)).alias("n"), F.max(row_bytes(right)).alias("bytes"))
        per_key = daily.groupBy(*by).agg(F.sum("n").alias("n"), F.max("n").alias("busiest"), F.max("bytes").alias("bytes"), F.min("_day").alias("first"), F.max("_day").alias("last"))
        row = per_key.agg(
            F.count(F.lit(1)).alias("keys"), F.sum("n").alias("n"), F.max("busiest").alias("busiest"), F.max("bytes").alias("bytes"), F.max("last").alias("last"), F.sum("first").alias("firsts")
        ).first()
        self.rows, self.busiest, self.bytes, self.last_day = row.n or 0, row.busiest or 0, row.bytes or 0, row["last"] or 0
        # Days from each key's first right row to the last day of all.
        self.days = row["keys"] * self.last_day - (row.firsts or 0) + row["keys"]

    def broadcast_days(self, megabytes: int) -> int | None:
        """Slice width in days at which the listed right side is small, or None."""
        if self.busiest > DENSE:
            return None
        width = max(1, -(-self.days // max(1, self.rows)))
        width = min(width, max(1, DENSE // max(1, self.busiest)))
        listed = self.rows + self.days // width + 1
        return width if listed * self.bytes <= megabytes * 1024 * 1024 else None


def _one_per_time(right: DataFrame, keys: Sequence[str]) -> DataFrame:
    payload = [c for c in right.columns if c not in keys]
    if not payload:
        return right.distinct()
    return right.groupBy(*keys).agg(F.max(F.struct(*payload)).alias("_one")).select(*keys, "_one.*").select(*right.columns)


def _asof_slices(
    left: DataFrame, right: DataFrame, by: Sequence[str], left_time: str, right_time: str, shape: _RightSide, days: int
) -> DataFrame:
    """As-of join as a range join to a small right side: a right row holds until the next of its key.

    Open ends are listed up to the last slice of the table, where later left rows look them up.
    """
    dtype = left.schema[left_time].dataType
    payload = [c for c in right.columns if c not in (*by, right_time)]
    following = F.lead(right_time).over(Window.partitionBy(*by).orderBy(right_time))
    held = right.select(
        *[F.col(c).alias(f"_r_{c}") for c in by],
        F.col(right_time).alias("_from"),
        following.alias("_until"),
        *[F.col(c).alias(f"_p_{c}") for c in payload],
    )

    def place(day: Column) -> Column:
        return F.floor(day / F.lit(days))

    until = F.coalesce(day_number(F.col("_until"), dtype), F.lit(shape.last_day))
    touched = F.sequence(place(day_number(F.col("_from"), dtype)), place(until))
    side = F.broadcast(held.withColumn("_r_slice", F.explode(touched)))
    time = F.col(left_time)
    conditions = [F.col(c).eqNullSafe(F.col(f"_r_{c}")) for c in by]
    conditions += [F.col("_slice") == F.col("_r_slice"), F.col("_from") <= time]
    conditions.append(F.coalesce(time < F.col("_until"), F.lit(True)))
    return (
        left.withColumn("_slice", F.when(time.isNotNull(), place(F.least(day_number(time, dtype), F.lit(shape.last_day)))))
        .join(side, conditions, "left")
        .select(*left.columns, *[F.col(f"_p_{c}").alias(c) for c in payload])
    )


def _asof_stacked(
    left: DataFrame, right: DataFrame, by: Sequence[str], left_time: str, right_time: str, days: float
) -> DataFrame:
    """As-of join by a window over both sides stacked, per (key, time bucket).

    What holds at the start of a bucket comes in as one marker row per bucket, so no key is read
    by a single task. The right columns travel as one struct.
    """
    payload = [c for c in right.columns if c not in (*by, right_time)]
    dtype = left.schema[left_time].dataType

    lefts = left.withColumns(
        {"_t": F.col(left_time), "_side": F.lit(1), "_bucket": bucket_of(F.col(left_time), dtype, days)}
    )
    rights = right.select(
        *by,
        F.col(right_time).alias("_t"),
        F.lit(0).alias("_side"),
        bucket_of(F.col(right_time), dtype, days).alias("_bucket"),
        F.struct(F.col(right_time).alias("_matched"), *payload).alias("_right"),
    )
    # One row per key and bucket on either side; the frame ends before the current bucket.
    read = lefts.where(F.col("_bucket").isNotNull()).select(*by, "_bucket", "_side").distinct()
    offered = rights.groupBy(*by, "_bucket").agg(
        F.max_by("_right", F.col("_right._matched")).alias("_right"), F.lit(0).alias("_side")
    )
    earlier = Window.partitionBy(*by).orderBy("_bucket").rangeBetween(Window.unboundedPreceding, -1)
    carried = (
        read.unionByName(offered, allowMissingColumns=True)
        .withColumn("_right", F.last("_right", ignorenulls=True).over(earlier))
        .where((F.col("_side") == 1) & F.col("_right").isNotNull())
        .select(*by, "_bucket", "_right", F.col("_right._matched").alias("_t"), F.lit(0).alias("_side"))
    )
    upto = (
        Window.partitionBy(*by, "_bucket")
        .orderBy(F.col("_t").asc_nulls_last(), "_side")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    found = F.when(F.col(left_time).isNotNull(), F.last("_right", ignorenulls=True).over(upto))
    stacked = lefts.unionByName(rights, allowMissingColumns=True).unionByName(carried, allowMissingColumns=True)
    return (
        stacked.withColumn("_found", found)
        .where(F.col("_side") == 1)
        .select(*left.columns, *[F.col("_found")[c].alias(c) for c in payload])
    )


def anti_join_null_safe(left: DataFrame, right: DataFrame) -> DataFrame:
    """Left rows that no right row equals on all shared columns; nulls equal nulls.

    Left duplicates are kept. Copies on the right are collapsed before the shuffle.
    """
    shared = [c for c in left.columns if c in right.columns]
    if not shared:
        raise ValueError("the tables share no column")
    other = right.select(*[F.col(c).alias(f"_r_{i}") for i, c in enumerate(shared)]).distinct()
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_r_{i}")) for i, c in enumerate(shared)])
    return left.join(other, same, "left_anti")
