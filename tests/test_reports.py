import random
from datetime import timedelta

import pytest
from conftest import bag
from pyspark.sql import functions as F

from trackspark.operators import activity, residency, rollup, summary, timeline
from trackspark.operators.periods import assign_period
from trackspark.plans import reports

DET = "elasmo bigint, location string, agency string, station string, time timestamp"
IND = (
    "acoustic_tag_id bigint, tagging_datetime timestamp, species string, sex string, pcl double, fl double, tl double, "
    "stl double, latitude string, longitude string, site string"
)


@pytest.fixture
def det(spark, ts):
    return spark.createDataFrame(
        [
            (1, "a", "AG0", "s1", ts("2024-01-01 03:00:00")),
            (1, "a", "AG0", "s1", ts("2024-01-01 06:00:00")),
            (1, None, "AG1", "s2", ts("2024-01-05 06:00:00")),
            (2, "b", None, "s2", ts("2024-01-05 06:00:00")),
            (9, "b", "AG0", "s2", ts("2024-01-05 06:00:00")),
            (None, "b", "AG0", "s2", ts("2024-01-05 06:00:00")),
        ],
        DET,
    )


@pytest.fixture
def ind(spark, ts):
    return spark.createDataFrame(
        [
            (1, ts("2023-12-31 06:00:00"), "x", "F", 1.005, 2.345, 0.125, None, "1", "2", "one"),
            (2, None, "y", "M", None, None, None, None, None, None, None),
            (3, ts("2024-01-05 00:00:00"), "y", "M", None, None, None, None, None, None, "two"),
        ],
        IND,
    )


def test_totals_count_a_missing_location(det):
    got = {r.elasmo: r for r in summary.detection_totals(det, "US/Eastern").collect()}
    one = got[1]
    # 03:00 UTC is the day before in the east.
    assert (one.total_detection, one.nbrstation, one.nbrday) == (3, 2, 3)
    assert one.difd == pytest.approx(4.125) and one.difh == pytest.approx(99)
    assert got[2].nbrday == 1 and got[None].total_detection == 1


def test_summary(det, ind):
    got = {r.id: r for r in summary.individual_summary(det, ind, "UTC").collect()}
    assert set(got) == {1, 2}
    assert got[1].tl == 0.12 and got[1].days_at_liberty == 5.0 and got[1].residency_index == 0.4
    assert got[1].date_tagged == "2023-12-31 06:00" and got[1].last_appearance == "2024-01-05 06:00"
    # Without a tagging time the time at liberty is unknown, not one day.
    assert got[2].days_at_liberty is None and got[2].residency_index is None


def test_short_liberty_counts_as_one_day(spark, ts):
    det = spark.createDataFrame([(1, "a", "x", "s", ts("2024-01-01 12:00:00")), (1, "a", "x", "s", ts("2024-01-02 00:00:00"))], DET)
    ind = spark.createDataFrame([(1, ts("2024-01-01 12:00:00"), *[None] * 9)], IND)
    row = summary.individual_summary(det, ind).first()
    assert row.days_at_liberty == 1.0 and row.residency_index == 2.0


def test_minimum_days(det, ind):
    assert [r.id for r in summary.individual_summary(det, ind, "UTC", 2).collect()] == [1]
    assert summary.detections_with_min_days(det, "UTC", 2).count() == 3
    assert summary.detections_with_min_days(det, "UTC", 1).count() == 6


def test_matrix_and_long_form_agree(det):
    matrix = summary.detection_matrix(det)
    assert matrix.columns == ["location", "1", "2", "9", "NA"]
    assert bag(matrix) == [("a", 2, 0, 0, 0), ("b", 0, 1, 1, 1), (None, 1, 0, 0, 0)]
    assert sum(r.n for r in summary.detection_counts(det).collect()) == 6
    by_agency = summary.detection_matrix(det, True, ids=[1, 2])
    assert bag(by_agency) == [("AG0", 2, 0), ("AG1", 1, 0), (None, 0, 1)]
    blocks = [(r.block, r.location, r.tags, r.counts) for r in summary.matrix_rows(summary.detection_counts(det), width=3).collect()]
    assert sorted(blocks, key=str) == [
        (0, "a", ["1", "2", "9"], [2, 0, 0]), (0, "b", ["1", "2", "9"], [0, 1, 1]), (0, None, ["1", "2", "9"], [1, 0, 0]),
        (1, "a", ["NA"], [0]), (1, "b", ["NA"], [1]), (1, None, ["NA"], [0]),
    ]
    lists = summary.count_lists(summary.detection_counts(det)).collect()
    assert {r.location: [tuple(x) for x in r.counts] for r in lists}["b"] == [(None, 1), (2, 1), (9, 1)]
    empty = summary.detection_matrix(det.limit(0))
    assert empty.columns == ["location"] and empty.count() == 0


def test_period_summary_per_month(det, ind):
    report = reports.period_summary(det, ind, reports.SummaryConfig(monthly=True, min_days=2))
    assert bag(report.periods.select("index")) == [(1,), (2,), (3,)]
    assert bag(report.summary.select("interval_id", "id")) == [(2, 1)]
    assert bag(report.kept.select("interval_id", "elasmo")) == [(2, 1), (2, 1)]
    assert {(r.interval_id, r.location, r.elasmo): r.n for r in report.counts.collect()}[(2, "a", 1)] == 1


VMOV = "location string, station string, date_in timestamp, date_out timestamp"


@pytest.fixture
def vmov(spark, ts):
    return spark.createDataFrame(
        [
            ("a", "s1", ts("2024-01-01 03:00:00"), ts("2024-01-15 12:00:00")),
            ("b", "s2", ts("2024-01-02 12:00:00"), ts("2024-01-08 12:00:00")),
            ("b", "s3", ts("2024-01-02 12:00:00"), None),
            ("b", "s4", ts("2024-02-02 12:00:00"), ts("2024-01-02 12:00:00")),
        ],
        VMOV,
    )


def test_weekly_deployments(vmov):
    out = activity.weekly_deployments(vmov, "US/Eastern")
    got = sorted((r.location, str(r.weeks)) for r in out.collect())
    assert got == [("a", "2023-12-31"), ("a", "2024-01-07"), ("a", "2024-01-14"), ("b", "2024-01-02")]
    assert {r.source for r in out.collect()} == {"Rec. mov."}
    assert sorted(r.station for r in activity.unusable_ranges(vmov).collect()) == ["s3", "s4"]


def test_weekly_detections(spark, ts, vmov):
    det = spark.createDataFrame(
        [
            (1, "a", "AG0", "s1", ts("2024-01-01 03:00:00")),
            (1, "a", "AG0", "s1", ts("2024-01-10 03:00:00")),
            (1, "a", "AG1", "s1", ts("2024-01-15 03:00:00")),
            (1, "b", "AG0", "s2", ts("2024-01-08 23:00:00")),
            (1, "b", "AG0", "s2", ts("2024-01-20 23:00:00")),
            (1, "b", "AG0", "s1", ts("2024-01-05 23:00:00")),
        ],
        DET,
    )
    out = activity.weekly_detections(det, vmov, "AG0", "US/Eastern")
    got = sorted((r.location, str(r.start_date), str(r.end_date), str(r.min_start_date), str(r.weeks)) for r in out.collect())
    # The end day counts in full: 23:00 on the day of retrieval still matches.
    assert got == [
        ("a", "2023-12-31", "2024-01-09", "2023-12-31", "2023-12-31"),
        ("a", "2023-12-31", "2024-01-09", "2023-12-31", "2024-01-07"),
        ("b", "2024-01-08", "2024-01-08", "2024-01-08", "2024-01-08"),
    ]
    both = activity.receiver_activity(activity.weekly_deployments(vmov, "US/Eastern"), out)
    assert {(r.location, r.source): r.y_position for r in both.collect()} == {
        ("a", "Rec. mov."): 1.0, ("b", "Rec. mov."): 2.0, ("a", "Det."): 1.4, ("b", "Det."): 2.4,
    }


def test_clean_receiver_deployments(spark, ts, vmov):
    failed = spark.createDataFrame([("a", ts("2024-01-01 03:00:00"))], "location string, date_in timestamp")
    fixed = spark.createDataFrame([("b", ts("2024-01-02 12:00:00"), ts("2024-03-01"))], "location string, date_in timestamp, date_out timestamp")
    out = activity.clean_receiver_deployments(vmov, failed, fixed)
    assert out.columns == vmov.columns
    assert bag(out.select("station", "date_out")) == [
        ("s2", "2024-03-01 00:00:00"), ("s3", "2024-03-01 00:00:00"), ("s4", "2024-01-02 12:00:00"),
    ]
    assert bag(activity.clean_receiver_deployments(vmov)) == bag(vmov)


def test_offset_needs_a_source(vmov):
    with pytest.raises(ValueError):
        activity.add_offset(vmov)


def test_timeline_base(spark, det, ind):
    vloc = spark.createDataFrame([("a", "AGx"), ("a", "AGy"), ("b", "AGz")], "location string, agency string")
    out = timeline.timeline_base(det, ind, vloc)
    assert out.columns == list(timeline.BASE_COLUMNS)
    # Location a is listed twice, so its two detections appear twice; the agency stays the detection's.
    assert out.count() == 6 and {r.agency for r in out.collect()} == {"AG0", "AG1", None}
    assert timeline.timeline_base(det, ind, vloc, dedupe_right=True).count() == 4
    # A tag without a site stays when another site is left out.
    assert timeline.timeline_base(det, ind, None, ["one"]).select("elasmo").distinct().collect()[0][0] == 2
    assert timeline.timeline_base(det, ind, None, species="x").count() == 3


def test_timeline_tables(spark, det, ind):
    out = reports.timeline_tables(det, ind, None, reports.TimelineConfig(tz="UTC", step_days=2, agency_country={"AG0": "North"}))
    rows = sorted((r.elasmo, r.bin, str(r.date)[:10], r.country, r.indice) for r in out.rows.collect() if r.agency)
    assert rows == [(1, 1, "2024-01-01", "North", 1), (1, 1, "2024-01-01", "North", 1), (1, 3, "2024-01-05", None, 1)]
    markers = {r.elasmo: (r.indice, r.date) for r in out.markers.collect()}
    # Tagged before the first breakpoint, or at an unknown time: no date.
    assert markers == {1: (1, None), 2: (2, None)}
    assert bag(out.legend) == [("AG0", "North"), ("AG1", None), (None, None)]
    assert bag(out.label_positions) == [("x", 1), ("y", 2)]


def test_tag_of_two_species_is_listed_once(spark, ts):
    df = spark.createDataFrame([(7, "b"), (7, "a"), (5, "a"), (6, "b")], "elasmo bigint, species string")
    assert bag(timeline.tag_ordinals(df)) == [(5, "a", 1), (6, "b", 3), (7, "a", 2)]


@pytest.fixture
def years(spark, ts):
    det = spark.createDataFrame(
        [(1, ts("2020-01-10")), (1, ts("2020-01-20")), (2, ts("2020-01-15")), (1, ts("2020-04-01")), (3, ts("2020-02-01")), (4, ts("2020-03-01"))],
        "elasmo bigint, time timestamp",
    )
    ind = spark.createDataFrame(
        [(1, "x", ts("2020-01-05")), (2, "x", ts("2020-02-05")), (3, "y", ts("2020-03-05")), (5, "y", ts("2020-01-01"))],
        "acoustic_tag_id bigint, species string, tagging_datetime timestamp",
    )
    return det, ind


def test_residency_steps(years):
    det, ind = years
    active = residency.active_tags(det, ind)
    assert bag(active) == [("x", "2020-01", 2), ("x", "2020-04", 1), ("y", "2020-02", 1)]
    assert bag(residency.deployed_tags(ind, det)) == [("x", "2020-01", 1), ("x", "2020-02", 2), ("y", "2020-03", 1)]
    everywhere = residency.deployed_tags(ind, det, scope="global")
    assert bag(everywhere) == [("x", "2020-01", 1), ("x", "2020-02", 2), ("y", "2020-03", 3)]
    joined = residency.join_activity_deployment(active, residency.deployed_tags(ind, det))
    got = sorted((r.species, str(r.roll_date), r.active_count, r.cs) for r in joined.collect())
    assert got == [("x", "2020-01-01", 2, 1), ("x", "2020-04-01", 1, 2), ("y", "2020-02-01", 1, None)]
    assert residency.skeleton_grid(joined, det, ind).count() == 8
    with pytest.raises(ValueError):
        residency.deployed_tags(ind, det, scope="all")


def test_monthly_residency_modes(years):
    det, ind = years
    zero = {(r.species, r.month): r.mean_active_prop for r in reports.monthly_residency(det, ind, "UTC").collect()}
    assert zero == {
        ("x", "01"): 2.0, ("x", "02"): 0.0, ("x", "03"): 0.0, ("x", "04"): 0.5,
        ("y", "01"): 0.0, ("y", "02"): 0.0, ("y", "03"): 0.0, ("y", "04"): 0.0,
    }
    raw = {(r.species, r.month): str(r.mean_active_prop) for r in reports.monthly_residency(det, ind, "UTC", empty="nan").collect()}
    assert raw[("x", "02")] == "nan" and raw[("y", "02")] == "inf" and raw[("x", "04")] == "0.5"
    with pytest.raises(ValueError):
        reports.monthly_residency(det, ind, "UTC", empty="null")


def test_detections_are_read_once_for_residency(spark, years, tmp_path):
    det, ind = years
    det.write.parquet(str(tmp_path / "det"))
    out = reports.monthly_residency(spark.read.parquet(str(tmp_path / "det")), ind, "UTC")
    out.collect()
    # Tags and months were written once; nothing reads the detections again.
    assert "parquet" not in out._jdf.queryExecution().executedPlan().toString()


def test_matrix_of_many_tags_and_of_a_periods_own_tags(spark):
    det = spark.range(12_000).selectExpr("id as elasmo", "'a' as location", "id % 2 as interval_id", "1L as n")
    rows = sorted(summary.matrix_rows(det, width=4000).collect())
    assert [(r.interval_id, r.block, len(r.tags), sum(r.counts)) for r in rows] == [(0, 0, 4000, 4000), (0, 1, 2000, 2000), (1, 0, 4000, 4000), (1, 1, 2000, 2000)]
    assert rows[2].tags[:3] == ["1", "3", "5"]
    with pytest.raises(ValueError, match="matrix_rows"):
        summary.detection_matrix(det.select("elasmo", "location"))


def test_all_matrices_are_one_write(spark, tmp_path):
    names = ["b", 'a "q", x', None]
    counts = spark.createDataFrame([(p, names[t % 3], t, t + 1) for p in range(1, 7) for t in range(p * 4)], "interval_id int, location string, elasmo bigint, n bigint")
    counts = counts.unionByName(spark.createDataFrame([(1, "b", None, 7)], counts.schema))
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("matrices", "all matrices")
    reports.save_matrices(counts, str(tmp_path / "m"), "location", 5)
    few = len(tracker.getJobIdsForGroup("matrices"))
    spark.sparkContext.setJobGroup("one matrix", "one matrix")
    reports.save_matrices(counts.where("interval_id = 2"), str(tmp_path / "one"), "location", 100)
    # Jobs follow neither the periods nor the blocks.
    assert few == len(tracker.getJobIdsForGroup("one matrix"))
    spark.sparkContext.setJobGroup("other", "other")
    folders = {str(f.relative_to(tmp_path / "m")) for f in (tmp_path / "m").glob("*/*")}
    assert folders == {f"interval_id={p}/block={b}" for p in range(1, 7) for b in range((p * 4 + (p == 1) + 4) // 5)}
    files = list((tmp_path / "m" / "interval_id=1").rglob("*.txt"))
    assert len(files) == 1
    assert files[0].read_text().splitlines() == ["location,0,1,2,3,NA", '"a ""q"", x",0,2,0,0,0', "b,1,0,0,4,7", ",0,0,3,0,0"]
    back = [line for f in (tmp_path / "m").rglob("*.txt") for line in f.read_text().splitlines()[1:]]
    assert sum(int(v) for line in back for v in line.rsplit('"')[-1].split(",")[1:]) == sum(r.n for r in counts.collect())




def test_rollup_merges_to_the_totals_of_detections(spark, ts):
    rng = random.Random(6)
    rows = [
        (rng.choice([1, 2, None]), rng.choice(["a", "b", None]), None if i % 40 == 0 else ts("2024-01-30") + timedelta(hours=rng.randrange(24 * 70)))
        for i in range(400)
    ]
    det = spark.createDataFrame(rows, "elasmo bigint, location string, time timestamp")
    rolled = rollup.monthly_rollup(det, "US/Eastern")
    assert bag(rollup.totals_of_rollup(rolled).select(*summary.detection_totals(det).columns)) == bag(summary.detection_totals(det, "US/Eastern"))
    dated = det.where("time is not null")
    monthly = assign_period(dated, monthly=True, tz="US/Eastern")
    want = summary.detection_totals(monthly, "US/Eastern")
    assert bag(rollup.totals_of_rollup(rollup.with_month_number(rolled)).select(*want.columns)) == bag(want)


def test_tags_of_any_months_merge(spark):
    rolled = spark.createDataFrame([(1, "2024-01"), (1, "2024-02"), (40_000, "2024-02"), (-7, "2024-03"), (1, "2024-03"), (9, "2024-03")], "elasmo bigint, ym string")
    ind = spark.createDataFrame([(1, "s"), (40_000, "s"), (-7, "s"), (9, "t")], "acoustic_tag_id bigint, species string")
    bitmaps = rollup.tag_bitmaps(rolled, ind)
    assert bag(rollup.merged_tags(bitmaps, F.col("ym"))) == [("s", "2024-01", 1), ("s", "2024-02", 2), ("s", "2024-03", 2), ("t", "2024-03", 1)]
    assert bag(rollup.merged_tags(bitmaps, F.lit("all"))) == [("s", "all", 3), ("t", "all", 1)]
