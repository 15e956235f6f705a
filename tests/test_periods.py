import math
import random
from bisect import bisect_right
from datetime import datetime, timedelta, timezone
from zoneinfo import ZoneInfo

import pytest
from conftest import bag
from pyspark.sql import functions as F

from trackspark.operators.periods import TimeGrid, assign_period, period_table, time_window

UTC = timezone.utc


def table(spark, texts):
    return spark.createDataFrame([(n, datetime.fromisoformat(t).replace(tzinfo=UTC) if t else None) for n, t in enumerate(texts)], "n int, time timestamp")


def test_full_period(spark):
    df = table(spark, ["2024-01-05 10:00:00", "2024-02-01 00:00:00", None])
    assert bag(period_table(df)) == [(1, "2024-01-05 10:00:00"), (2, "2024-02-01 00:01:00")]
    assert bag(assign_period(df).select("n", "interval_id")) == [(0, 1), (1, 1)]


def test_monthly_periods_in_the_data_zone(spark):
    df = table(spark, ["2024-01-01 03:00:00", "2024-01-01 06:00:00", "2024-03-10 12:00:00", "2024-04-01 03:59:00"])
    # 03:00 UTC on New Year's Day is still December in the east; 03:59 on April 1 is March in summer time.
    assert bag(period_table(df, True, tz="US/Eastern")) == [
        (1, "2023-12-01 05:00:00"), (2, "2024-01-01 05:00:00"), (3, "2024-02-01 05:00:00"),
        (4, "2024-03-01 05:00:00"), (5, "2024-04-01 04:00:00"),
    ]
    assert bag(assign_period(df, True, tz="US/Eastern").select("n", "interval_id")) == [(0, 1), (1, 2), (2, 4), (3, 4)]


def test_last_time_at_an_exact_month_start_has_no_period(spark):
    df = table(spark, ["2024-01-05 00:00:00", "2024-02-01 00:00:00"])
    assert bag(period_table(df, True)) == [(1, "2024-01-01 00:00:00"), (2, "2024-02-01 00:00:00")]
    assert bag(assign_period(df, True).select("n", "interval_id")) == [(0, 1)]
    lone = table(spark, ["2024-02-01 00:00:00"])
    assert bag(period_table(lone, True)) == [(1, "2024-02-01 00:00:00")] and assign_period(lone, True).count() == 0


def test_bounds_replace_the_data_extent(spark):
    df = table(spark, ["2024-01-05 00:00:00", "2024-02-10 00:00:00", "2024-03-10 00:00:00"])
    out = assign_period(df, True, "2024-02-03", "2024-02-20", "UTC")
    assert bag(out.select("n", "interval_id")) == [(1, 1)]
    assert bag(period_table(df, True, "2024-02-03", "2024-02-20")) == [(1, "2024-02-01 00:00:00"), (2, "2024-03-01 00:00:00")]


def test_empty_table(spark):
    df = table(spark, ["2024-01-05 00:00:00"]).limit(0)
    assert period_table(df, True).count() == 0 and assign_period(df, True).count() == 0
    grid = TimeGrid(df, 4)
    assert grid.table().count() == 0 and grid.add_bin(df).columns == ["n", "time", "bin"]


def test_time_window_is_closed_and_optional(spark):
    df = table(spark, ["2024-01-05 05:00:00", "2024-01-06 05:00:00", "2024-01-06 05:00:01", None])
    assert bag(time_window(df, "2024-01-05", "2024-01-06", "US/Eastern").select("n")) == [(0,), (1,)]
    assert time_window(df, "2024-01-05", None).count() == 4
    with pytest.raises(ValueError, match="end"):
        time_window(df, "2024-01-05", "soon")


def test_time_window_reaches_the_scan(spark, tmp_path):
    table(spark, ["2024-01-05 05:00:00"]).write.parquet(str(tmp_path / "t"))
    plan = time_window(spark.read.parquet(str(tmp_path / "t")), "2024-01-05", "2024-01-06", "US/Eastern")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(time" in text and "LessThanOrEqual(time" in text


def model_grid(times, step, left, tz):
    """The grid in plain Python: elapsed steps, each cut to its local midnight."""
    zone = ZoneInfo(tz)

    def midnight(t):
        local = t.astimezone(zone)
        return datetime(local.year, local.month, local.day, tzinfo=zone).astimezone(UTC)

    first = midnight(min(times)) - timedelta(days=30 * left)
    days = (midnight(max(times)) - first).total_seconds() / 86400
    l = math.ceil(days) / step
    return [midnight(first + timedelta(days=step * i)) for i in range(math.ceil(l + 0.4 * l))]


@pytest.mark.parametrize("step, left, tz", [(4, 0, "UTC"), (4, 2, "US/Eastern"), (1, 1, "US/Eastern"), (7, 0, "Europe/Berlin"), (1, 0, "Australia/Lord_Howe")])
def test_grid_and_bins_over_zone_changes(spark, step, left, tz):
    rng = random.Random(step)
    base = datetime(2023, 9, 1, 13, 20, tzinfo=UTC)
    times = [base + timedelta(seconds=rng.randrange(86400 * 420)) for _ in range(400)]
    grid = model_grid(times, step, left, tz)
    times += [g for g in grid if g <= max(times)] + [g - timedelta(seconds=1) for g in grid if g <= max(times)]
    far = [max(times), base - timedelta(days=4000), base + timedelta(days=4000), None]
    source = spark.createDataFrame([(t,) for t in times if base <= t], "time timestamp")
    grid = model_grid([t for t in times if base <= t], step, left, tz)
    made = TimeGrid(source, step, left, tz)
    expected = [(i + 1, g.replace(tzinfo=None).isoformat(sep=" ")) for i, g in enumerate(grid)]
    assert sorted(bag(made.table())) == expected
    probe = spark.createDataFrame(list(enumerate(times + far)), "n int, time timestamp")
    out = made.add_bin(probe, date="date").select("n", "bin", F.col("date").cast("timestamp_ntz").alias("date")).collect()
    for n, got, date in out:
        t = (times + far)[n]
        k = None if t is None else bisect_right(grid, t)
        assert got == k, (t, got, k)
        assert date == (grid[k - 1].replace(tzinfo=None) if k else None)


def test_grid_steps(spark):
    df = table(spark, ["2024-01-05 00:00:00"])
    for step in (0, -1, 1.5):
        with pytest.raises(ValueError):
            TimeGrid(df, step)
