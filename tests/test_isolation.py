import random
from datetime import datetime, timedelta, timezone

import pytest
from conftest import bag
from pyspark.sql import functions as F

from trackspark.operators import buckets
from trackspark.operators.isolation import flag_single_detections, remove_single_detections, removal_stats

SCHEMA = "elasmo bigint, location string, time timestamp, n int"


def flags(df):
    return {r.n: (r.time_diff_to_prev, r.time_diff_to_next, r.single_detection) for r in df.collect()}


def brute(rows, hours):
    """Neighbours by sorting each group in Python, times missing last."""
    out, groups = {}, {}
    for tag, place, time, n in rows:
        groups.setdefault((tag, place), []).append((time is None, time or 0, n))
    for items in groups.values():
        items.sort(key=lambda i: (i[0], i[1] if not i[0] else 0, i[2]))
        for i, (missing, time, n) in enumerate(items):
            def gap(j, sign):
                if missing or not 0 <= j < len(items) or items[j][0]:
                    return None
                return sign * (items[j][1] - time).total_seconds() / 3600
            before, after = gap(i - 1, -1), gap(i + 1, 1)
            out[n] = (before, after, int((before is None or before > hours) and (after is None or after > hours)))
    return out


def same(got, expected):
    assert got.keys() == expected.keys()
    for n in got:
        for a, b in zip(got[n], expected[n]):
            assert (a is None) == (b is None) and (a is None or abs(a - b) < 1e-9), (n, got[n], expected[n])


def test_gap_must_be_strictly_longer(spark, ts):
    rows = [
        (1, "a", ts("2024-01-01 00:00:00"), 1),
        (1, "a", ts("2024-01-01 01:00:00"), 2),
        (1, "a", ts("2024-01-01 02:00:00.001"), 3),
        (1, "b", ts("2024-01-01 00:30:00"), 4),
        (2, "a", ts("2024-01-01 00:30:00"), 5),
    ]
    got = flags(flag_single_detections(spark.createDataFrame(rows, SCHEMA)))
    assert [got[n][2] for n in range(1, 6)] == [0, 0, 1, 1, 1]
    assert got[1][:2] == (None, 1.0)


def test_null_location_and_null_time(spark, ts):
    rows = [
        (1, None, ts("2024-01-01 00:00:00"), 1),
        (1, None, ts("2024-01-01 00:10:00"), 2),
        (1, None, None, 3),
        (None, None, ts("2024-01-01 00:10:00"), 4),
        (1, "a", None, 5),
    ]
    got = flags(flag_single_detections(spark.createDataFrame(rows, SCHEMA)))
    assert got[1][2] == got[2][2] == 0 and got[2][1] is None
    assert got[3] == got[5] == (None, None, 1) and got[4][2] == 1


@pytest.mark.parametrize("days", [None, 1 / 86400, 1 / 24, 1, 400])
def test_any_bucket_width_agrees_with_brute_force(spark, days):
    rng = random.Random(7)
    start = datetime(2024, 1, 1, tzinfo=timezone.utc)
    rows = []
    for n in range(600):
        # A third of the rows belong to one tag at one location.
        tag, place = (1, "hot") if n % 3 == 0 else (rng.randrange(5), rng.choice(["a", "b", None]))
        time = None if rng.random() < 0.05 else start + timedelta(seconds=rng.randrange(0, 5 * 86400, 600))
        rows.append((tag, place, time, n))
    rng.shuffle(rows)
    det = spark.createDataFrame(rows, SCHEMA).repartition(7)
    got = flags(flag_single_detections(det, 0.5, bucket_days=days, tie_break=["n"]))
    same(got, brute(rows, 0.5))


def test_measured_width_splits_a_busy_key(spark):
    df = spark.range(9000).select(
        F.lit(1).cast("bigint").alias("elasmo"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("location"),
        F.timestamp_seconds(F.col("id")).alias("time"),
    )
    # 3,000 rows of the busy pair on one day, at most 500 wanted: a sixth of a day.
    assert buckets.measured_bucket_days(df, ["elasmo", "location"], "time", 500) == pytest.approx(1 / 6)
    assert buckets.measured_bucket_days(df, ["elasmo", "location"], "time") == buckets.LONGEST_DAYS
    assert buckets.measured_bucket_days(df.limit(0), ["elasmo"], "time") == buckets.LONGEST_DAYS


def test_detections_are_shuffled_once(spark):
    df = spark.range(10).select(
        F.col("id").alias("elasmo"), F.lit("a").alias("location"), F.timestamp_seconds("id").alias("time"), F.lit("payload").alias("p")
    ).repartition(2)
    plan = flag_single_detections(df, 1, bucket_days=1)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Window [lead") == 1 and "BroadcastNestedLoopJoin" not in plan and "SortMergeJoin" not in plan


def test_remove_and_statistics(spark, ts):
    rows = [(1, "a", ts("2024-01-01 00:00:00"), 1), (1, "a", ts("2024-01-01 00:05:00"), 2), (1, "b", ts("2024-01-01 00:05:00"), 3)]
    flagged = flag_single_detections(spark.createDataFrame(rows, SCHEMA))
    assert remove_single_detections(flagged).columns == ["elasmo", "location", "time", "n"]
    assert "time_diff_to_next" in remove_single_detections(flagged, keep_flags=True).columns
    assert sorted(r.n for r in remove_single_detections(flagged).collect()) == [1, 2]
    (total, removed, remaining, pct), = bag(removal_stats(flagged))
    assert (total, removed, remaining) == (3, 1, 2) and pct == pytest.approx(100 / 3)
    assert bag(removal_stats(flagged.limit(0))) == [(0, 0, 0, None)]


def test_bad_input(spark):
    det = spark.createDataFrame([], SCHEMA)
    for hours in (0, -1, "1", True):
        with pytest.raises(ValueError):
            flag_single_detections(det, hours)
    with pytest.raises(ValueError, match="location"):
        flag_single_detections(det.drop("location"))
    with pytest.raises(TypeError):
        flag_single_detections(det.withColumn("time", F.lit("x")))
    with pytest.raises(ValueError):
        remove_single_detections(det)
