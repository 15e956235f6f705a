import random
from datetime import datetime, timedelta, timezone

import pytest
from conftest import bag
from pyspark.sql import functions as F

from trackspark.operators import joins

START = datetime(2024, 1, 1, tzinfo=timezone.utc)
POINTS = "station string, time timestamp, n int"
SPANS = "station string, date_in timestamp, date_out timestamp, location string"


@pytest.fixture(params=["broadcast", "shuffled"])
def strategy(request, spark):
    """The same join once with a measured broadcast, once with both sides shuffled."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    if request.param == "shuffled":
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield request.param, 0 if request.param == "shuffled" else 64
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_both_ends_closed_and_overlaps_multiply(spark, ts, strategy):
    points = spark.createDataFrame(
        [("1", ts("2024-01-01 00:00:00"), 1), ("1", ts("2024-01-03 00:00:00"), 2), ("1", ts("2024-01-03 00:00:00.000001"), 3),
         ("2", ts("2024-01-02 00:00:00"), 4), (None, ts("2024-01-02 00:00:00"), 5), ("1", None, 6), ("3", ts("2024-01-02 00:00:00"), 7)],
        POINTS,
    )
    spans = spark.createDataFrame(
        [("1", ts("2024-01-01 00:00:00"), ts("2024-01-03 00:00:00"), "a"), ("1", ts("2024-01-02 00:00:00"), ts("2024-01-03 00:00:00"), "b"),
         ("2", ts("2024-01-01 00:00:00"), None, "open"), (None, ts("2024-01-01 00:00:00"), ts("2024-01-05 00:00:00"), "c"),
         ("3", ts("2024-01-05 00:00:00"), ts("2024-01-01 00:00:00"), "inverted")],
        SPANS,
    )
    out = joins.interval_join(points, spans, ["station"], "time", "date_in", "date_out", strategy[1])
    assert sorted((r.n, r.location) for r in out.collect()) == [(1, "a"), (2, "a"), (2, "b")]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert ("BroadcastHashJoin" in plan) == (strategy[0] == "broadcast")


def test_interval_join_agrees_with_brute_force(spark, strategy):
    rng = random.Random(3)
    spans = []
    for i in range(60):
        lo = START + timedelta(hours=rng.randrange(24 * 90))
        # Mostly short, one very long: the slice width is set by the average.
        hours = 24 * 2000 if i == 0 else rng.randrange(0, 24 * 20)
        spans.append((str(rng.choice([1, 1, 1, 2, 3])), lo, lo + timedelta(hours=hours), f"l{i}"))
    points = [(str(rng.choice([1, 1, 2, 3, 4])), START + timedelta(minutes=rng.randrange(60 * 24 * 120)), n) for n in range(500)]
    out = joins.interval_join(
        spark.createDataFrame(points, POINTS), spark.createDataFrame(spans, SPANS), ["station"], "time", "date_in", "date_out", strategy[1]
    )
    expected = sorted((n, l) for s, t, n in points for k, lo, hi, l in spans if k == s and lo <= t <= hi)
    assert sorted((r.n, r.location) for r in out.collect()) == expected


def candidates(slices, points, keys, at):
    """Pairs that meet on (key, width, slice), before the exact range is looked at."""
    keyed = slices.looked_up(points, at)
    return keyed.join(slices.ranges, [*keys, "_width", "_slice"], "inner")


def test_mixed_lengths_stay_spread(spark):
    seconds = 365 * 86400
    short = spark.range(100_000).select(
        F.lit("1").alias("station"), F.timestamp_seconds(F.pmod(F.xxhash64("id"), F.lit(seconds))).alias("date_in")
    )
    short = short.withColumn("date_out", F.col("date_in") + F.expr("INTERVAL 1 SECOND"))
    long = spark.range(1000).select(
        (F.col("id") % 50 + 1).cast("string").alias("station"),
        (F.lit("1800-01-01").cast("timestamp") + F.make_dt_interval(days=F.col("id").cast("int"))).alias("date_in"),
        F.lit("2130-01-01").cast("timestamp").alias("date_out"),
    )
    spans = short.unionByName(long)
    points = spark.range(2000).select(F.lit("1").alias("station"), F.timestamp_seconds(F.col("id") * (seconds // 2000)).alias("time"))
    first, last = (F.unix_seconds(c) for c in ("date_in", "date_out"))
    slices = joins._sliced(points, spans, ["station"], F.unix_seconds("time"), first, last, 0)
    assert 2 <= len(slices.widths) <= 4
    met = candidates(slices, points, ["station"], F.unix_seconds("time"))
    # 20 deployments of centuries hold every point; beside them a point meets hardly any.
    assert met.count() <= 2000 * (20 + 3)
    assert slices.ranges.count() <= joins.LISTED * 101_000 + joins.LISTED_FREE
    # The points of one key and width lie in many slices, those of the long deployments too.
    groups = slices.looked_up(points, F.unix_seconds("time")).groupBy("_width", "_slice").count()
    assert groups.agg(F.max("count")).first()[0] < 50


def test_slice_widths_follow_the_lengths():
    level = joins._Level
    # One length only: slices of about that length.
    assert joins.slice_levels([level(18, 1000, 10, 1000 << 18, 0, 1 << 27)]) == {18: 17}
    # Few rows of a shorter length share the wider slices; a crowd of them has its own.
    long = level(20, 1000, 10, 1000 << 20, 0, 1 << 27)
    assert joins.slice_levels([long, level(10, 10, 1, 10 << 10, 0, 1 << 27)]) == {20: 19, 10: 19}
    assert joins.slice_levels([long, level(10, 10_000, 10_000, 10_000 << 10, 0, 1 << 27)])[10] == 10
    # Very long ranges are cut into as many slices as the listing may hold.
    short = level(0, 100_000, 100_000, 100_000, 0, 1 << 25)
    chosen = joins.slice_levels([short, level(34, 1000, 10, 1000 << 34, -(1 << 33), 1 << 33)], joins.LISTED_FREE)
    assert chosen[0] == 0 and 100 <= 2**34 / 2 ** chosen[34] <= 500


def test_interval_join_of_dates(spark):
    points = spark.sql("SELECT 'a' AS k, date'2024-01-01' + CAST(id AS INT) AS day FROM range(40)")
    spans = spark.sql("SELECT 'a' AS k, date'2024-01-05' AS lo, date'2024-01-07' AS hi UNION ALL SELECT 'a', date'1990-01-01', date'2024-01-02'")
    out = joins.interval_join(points, spans, ["k"], "day", "lo", "hi")
    assert sorted(str(r.day)[-2:] for r in out.collect()) == ["01", "02", "05", "06", "07"]


def test_interval_join_without_intervals(spark, ts):
    points = spark.createDataFrame([("1", ts("2024-01-01"), 1)], POINTS)
    assert joins.interval_join(points, spark.createDataFrame([], SPANS), ["station"], "time", "date_in", "date_out").count() == 0


def test_assign_locations_replaces_location(spark, ts):
    det = spark.createDataFrame([("1", ts("2024-01-02"), 1, "old")], POINTS + ", location string")
    spans = spark.createDataFrame([("1", ts("2024-01-01"), ts("2024-01-03"), "a")], SPANS)
    out = joins.assign_locations(det, spans)
    assert bag(out.select("n", "location")) == [(1, "a")] and "date_in" not in out.columns


def test_after_tagging(spark, ts):
    det = spark.createDataFrame(
        [(1, ts("2024-01-01 12:00:00"), 1), (1, ts("2024-01-02 12:00:00"), 2), (2, ts("2024-01-02"), 3), (3, ts("2024-01-02"), 4), (None, ts("2024-01-02"), 5)],
        "elasmo bigint, time timestamp, n int",
    )
    ind = spark.createDataFrame(
        [(1, ts("2024-01-01 12:00:00"), 0), (1, ts("2025-01-01"), 1), (2, None, 2), (9, ts("2024-01-01"), 3)],
        "acoustic_tag_id bigint, tagging_datetime timestamp, o int",
    )
    kept = joins.detections_after_tagging(det, ind, order=["o"])
    assert sorted(r.n for r in kept.collect()) == [1, 2]
    later = joins.detections_after_tagging(det, ind, 24, "US/Eastern", ["o"])
    assert [r.n for r in later.collect()] == [2]
    known = joins.known_tags(det, ind)
    assert sorted(r.n for r in known.collect()) == [1, 2, 3]
    assert bag(joins.unknown_tags(det, ind)) == [(3,), (None,)]
    assert bag(joins.tags_lost(known, kept)) == [(2,)]


@pytest.mark.parametrize("days, megabytes", [(None, 64), (None, 0), (1 / 24, 64), (1, 64), (365, 64)])
def test_asof_agrees_with_brute_force(spark, days, megabytes):
    rng = random.Random(5)
    keys = ["k", "k", "k", "m", None]
    right, seen = [], set()
    for i in range(80):
        key, hour = rng.choice(keys), rng.randrange(24 * 60)
        if (key, hour) not in seen:
            seen.add((key, hour))
            right.append((key, START + timedelta(hours=hour), None if i % 7 == 0 else i))
    left = [(rng.choice([*keys, "none"]), None if n % 50 == 0 else START + timedelta(hours=rng.randrange(24 * 60)), n) for n in range(400)]
    out = joins.asof_join(
        spark.createDataFrame(left, "k string, t timestamp, n int"), spark.createDataFrame(right, "k string, at timestamp, v int"), ["k"], "t", "at", days, megabytes
    )
    def match(key, time):
        earlier = [(a, v) for k, a, v in right if k == key and time is not None and a <= time]
        return max(earlier, key=lambda e: e[0])[1] if earlier else None
    assert sorted((r.n, r.v) for r in out.collect()) == sorted(((n, match(k, t)) for k, t, n in left), key=lambda x: x[0])
    assert out.columns == ["k", "t", "n", "v"]
    # A small right side is looked up in place; otherwise both sides go through a window.
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert ("BroadcastHashJoin" in plan) == (days is None and megabytes == 64)


def test_asof_with_a_crowded_key(spark):
    """A key with most of the right side, all within days: it is spread over time buckets, not broadcast."""
    right = spark.range(6000).select(F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 40)).alias("k"), F.timestamp_seconds(F.col("id") * 7).alias("at"), F.col("id").alias("v"))
    left = spark.range(3000).select(F.lit("hot").alias("k"), F.timestamp_seconds(F.col("id") * 13 + 5).alias("t"), F.col("id").alias("n"))
    out = joins.asof_join(left, right, ["k"], "t", "at")
    assert "BroadcastHashJoin" not in out._jdf.queryExecution().executedPlan().toString()
    def last(t):
        v = min(t // 7, 5999)
        return v if v % 3 else (v - 1 if v else None)
    assert sorted((r.n, r.v) for r in out.collect()) == [(i, last(13 * i + 5)) for i in range(3000)]


def test_asof_with_an_empty_side(spark, ts):
    left = spark.createDataFrame([("a", ts("2024-01-03"))], "k string, t timestamp")
    right = spark.createDataFrame([], "k string, at timestamp, v int")
    for days in (None, 1):
        assert bag(joins.asof_join(left, right, ["k"], "t", "at", days).select("v")) == [(None,)]
        assert joins.asof_join(left.limit(0), right, ["k"], "t", "at", days).count() == 0


def test_asof_keeps_a_null_inside_the_matched_row(spark, ts):
    left = spark.createDataFrame([("a", ts("2024-01-03"))], "k string, t timestamp")
    right = spark.createDataFrame([("a", ts("2024-01-01"), 1), ("a", ts("2024-01-02"), None)], "k string, at timestamp, v int")
    assert bag(joins.asof_join(left, right, ["k"], "t", "at").select("v")) == [(None,)]


def test_anti_join_is_null_safe_and_keeps_duplicates(spark):
    new = spark.createDataFrame([(1, None), (1, None), (2, "x"), (2, "x"), (3, None)], "a int, b string")
    old = spark.createDataFrame([(3, None), (3, None), (2, "y")], "a int, b string")
    assert bag(joins.anti_join_null_safe(new, old)) == [(1, None), (1, None), (2, "x"), (2, "x")]
    assert bag(joins.anti_join_null_safe(new, new)) == []
    with pytest.raises(ValueError):
        joins.anti_join_null_safe(new, old.toDF("x", "y"))


def test_map_lookup(spark):
    df = spark.createDataFrame([("c1",), ("cx",), (None,)], "c string")
    assert bag(joins.map_lookup(df, {"c1": "A"}, "c", "agency", "")) == [("c1", "A"), ("cx", ""), (None, "")]
    assert bag(joins.map_lookup(df, {}, "c", "agency")) == [("c1", None), ("cx", None), (None, None)]
    plan = joins.map_lookup(df, {"c1": "A"}, "c", "agency").select(F.col("agency"))._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan


def test_asof_takes_one_right_row_per_time_on_either_path(spark):
    left = spark.createDataFrame([(1, 10)], "k int, t int").selectExpr("k", "timestamp_seconds(t) as t")
    right = spark.createDataFrame([(1, 5, "b"), (1, 5, "c"), (1, 5, "a")], "k int, s int, v string")
    right = right.selectExpr("k", "timestamp_seconds(s) as at", "v")
    for days in (None, 1.0):
        assert bag(joins.asof_join(left, right, ["k"], "t", "at", days).select("v")) == [("c",)]
    with pytest.raises(TypeError, match="at is date"):
        joins.asof_join(left, right.withColumn("at", right["at"].cast("date")), ["k"], "t", "at")
