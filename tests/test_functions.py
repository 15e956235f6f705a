import random
from datetime import datetime, timedelta
from zoneinfo import ZoneInfo

import pytest
from conftest import bag
from pyspark.sql import functions as F

from trackspark.functions import text as tx
from trackspark.functions import times


def one(spark, column, **cells):
    """Value of a column expression over one literal row."""
    row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in cells.items()])
    out = row.select(column.alias("v"))
    if dict(out.dtypes)["v"] == "timestamp":
        out = out.select(F.date_format("v", "yyyy-MM-dd HH:mm:ss"))
    return out.first()[0]


def test_norm_name(spark):
    assert one(spark, tx.norm_name(F.col("c")), c="  Deep\t Drop  2 ") == "deep_drop_2"


def test_suffix_id(spark):
    assert one(spark, tx.suffix_id(F.col("c")), c="VR2W-100001") == "100001"
    assert one(spark, tx.suffix_id(F.col("c")), c="plain") == "plain"
    assert one(spark, tx.suffix_id(F.col("c")), c="A-") is None


@pytest.mark.parametrize("text, tag", [("5001", 5001), (" 5001.0 ", 5001), ("NA", None), ("12.5", None), ("", None)])
def test_tag_id(spark, text, tag):
    assert one(spark, tx.tag_id(F.col("c")), c=text) == tag


def test_serial_text(spark):
    assert one(spark, tx.serial_text(F.col("c")), c=123456789.0) == "123456789"
    assert one(spark, tx.serial_text(F.col("c")), c="100001.0") == "100001"
    assert one(spark, tx.serial_text(F.col("c")), c="abc") == "abc"


def test_first_t_only(spark):
    assert one(spark, tx.first_t_to_blank(F.col("c")), c="2024-01-01T08:00:00 EST") == "2024-01-01 08:00:00 EST"


def test_rules_in_order(spark):
    rules = [("PIER", "pier"), ("pierWEST", "Westpier")]
    assert one(spark, tx.replace_in_order(F.col("c"), rules), c="PIERWEST") == "Westpier"


def test_not_in_keeps_null(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "c string")
    assert bag(df.where(tx.not_in(F.col("c"), ["a"]))) == [("b",), (None,)]
    assert df.where(tx.not_in(F.col("c"), None)).count() == 3


def test_missing_to_null(spark):
    df = spark.createDataFrame([("NA",), ("<NA>",), ("",), ("x",), (None,)], "c string")
    assert df.select(tx.missing_to_null(F.col("c")).alias("c")).where("c is not null").count() == 1


def test_snake_names():
    names = ["Date and Time (UTC)", "INS_MODEL_NO", "deployLat", "a b", "a_b", "1st", "%", "#tags"]
    assert tx.snake_names(names) == [
        "date_and_time_utc", "ins_model_no", "deploy_lat", "a_b", "a_b_2", "x1st", "percent", "number_tags",
    ]


@pytest.mark.parametrize(
    "text, fmt, expected",
    [
        ("2024-01-05 13:02:11", "%Y-%m-%d %H:%M:%S", "2024-01-05 13:02:11"),
        ("2024-1-5 3:02:11", "%Y-%m-%d %H:%M:%S", "2024-01-05 03:02:11"),
        ("2024-01-05 13:02:11.250Z", "%Y-%m-%d %H:%M:%S", "2024-01-05 13:02:11"),
        ("2024-01-05 13:02:11", "%Y-%m-%d %H:%M", "2024-01-05 13:02:00"),
        ("2024-13-05 13:02:11", "%Y-%m-%d %H:%M:%S", None),
        ("2024-01-05 13:02:1Z", "%Y-%m-%d %H:%M:%S", "2024-01-05 13:02:01"),
        ("2024-01-05 13:02 +1", "%Y-%m-%d %H:%M:%S", None),
        ("2024-01-05 13:02 +1", "%Y-%m-%d %H:%M", "2024-01-05 13:02:00"),
        ("2024-01-05T13:02:11", "%Y-%m-%d %H:%M:%S", None),
        ("  2024-01-05   3:2:1", "%Y-%m-%d %H:%M:%S", "2024-01-05 03:02:01"),
        ("2024-02-30 13:02:11", "%Y-%m-%d %H:%M:%S", None),
        ("2024-01-05 24:02:11", "%Y-%m-%d %H:%M:%S", None),
        ("2024-01-05", "%Y-%m-%d %H:%M:%S", None),
        ("2022-xxxxx", "%Y-%m-%d %H:%M:%S", None),
        (None, "%Y-%m-%d %H:%M:%S", None),
    ],
)
def test_parse_clock(spark, text, fmt, expected):
    assert one(spark, times.parse_clock(F.col("c").cast("string"), fmt), c=text) == expected


def test_parse_clock_rejects_unknown_format():
    with pytest.raises(ValueError):
        times.parse_clock(None, "%Y-%j")


@pytest.mark.parametrize(
    "text, expected",
    [
        ("4/8/25 9:05", "2025-04-08 09:05:00"),
        ("4/8/2025 09:05", "2025-04-08 09:05:00"),
        ("4/8/2019 09:05", "2019-04-08 09:05:00"),
        ("4/8/75 9:05", "1975-04-08 09:05:00"),
        ("4/8/68 9:05", "2068-04-08 09:05:00"),
        ("2/29/96 9:05", "1996-02-29 09:05:00"),
        ("4/8/2025 09:05:30", "2025-04-08 09:05:30"),
        ("04-08-2025 09:05", "2025-04-08 09:05:00"),
        ("04-08-2025 09:05:30", "2025-04-08 09:05:30"),
        ("04.08.75 09:05", "1975-04-08 09:05:00"),
        ("Apr 8 2025 09:05", "2025-04-08 09:05:00"),
        ("13/8/2025 09:05", None),
        ("2/30/2025 09:05", None),
        ("not a date", None),
        (None, None),
    ],
)
def test_mixed_date(spark, text, expected):
    assert one(spark, times.mixed_date(F.col("c").cast("string")), c=text) == expected


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("4/8/25 9:05 ", "2025-04-08 09:05:00"),
        ("4/8/2025 09:05 PM", None),
        ("4/8/2025 09:05junk", None),
    ],
)
def test_mixed_date_reads_whole_texts(spark, text, expected):
    assert one(spark, times.mixed_date(F.col("c")), c=text) == expected


def by_patterns(c):
    """What the formats and the fallback read, each by a regular expression over the whole text."""
    shape = r"^\W*(\d{1,2}|[A-Za-z]{3,9})[\W_]+(\d{1,2})[\W_]+(\d{4}|\d{2})[\W_]+(\d{1,2})[\W_]+(\d{1,2})(?:[\W_]+(\d{1,2}))?\W*$"
    part = [F.regexp_extract(c, shape, i) for i in range(1, 7)]
    name = F.array_position(F.array(*[F.lit(m) for m in times.MONTHS]), F.lower(F.substring(part[0], 1, 3))).cast("int")
    month = F.coalesce(part[0].try_cast("int"), F.nullif(name, F.lit(0)))
    year = part[2].try_cast("int")
    full = F.when(F.length(part[2]) == 4, year).when(year + 2000 > 2068, year + 1900).otherwise(year + 2000)
    second = F.coalesce(part[5].try_cast("decimal(8,6)"), F.lit(0).cast("decimal(8,6)"))
    rest = F.try_make_timestamp(full, month, *[part[i].try_cast("int") for i in (1, 3, 4)], second, F.lit("UTC"))
    first = [times.parse_clock(c, f, whole=True) for f in ("%m/%d/%y %H:%M", "%m/%d/%Y %H:%M")]
    return F.coalesce(*first, F.when(c.rlike(shape), rest))


def test_parts_decide_as_patterns_do(spark):
    rng = random.Random(12)
    pieces = ["4", "12", "31", "2025", "75", "007", "0", "13", "Apr", "sept", "ja", "Decembers", "/", "/", "-", ".", ":", ":", " ", " ", "\t", "_", ",", "é", "\n", "PM"]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randrange(14))) for _ in range(3000)]
    for _ in range(6000):
        seps = [rng.choice(["/", "/", "-", " ", ".", "_", "/ ", ", ", ""]) for _ in range(6)]
        nums = [rng.choice(["4", "12", "04", "Apr", "March", "13"]), rng.choice(["8", "30", "31"]), rng.choice(["25", "2025", "75", "125", "5"])]
        clock = [rng.choice(["9", "09", "23", "24"]), rng.choice(["05", "5", "60"]), rng.choice(["", "30", "7"])]
        joins = [seps[0], seps[0], rng.choice([" ", "  ", seps[1]]), rng.choice([":", seps[2]]), ":" if clock[2] else ""]
        body = "".join(a + b for a, b in zip([*nums, *clock], [*joins, ""], strict=True))
        texts.append(rng.choice(["", "", " ", "_", "*"]) + body + rng.choice(["", "", " ", "_", "!", " PM"]))
    df = spark.createDataFrame([(t,) for t in texts], "c string")
    shown = df.select("c", by_patterns(F.col("c")).cast("string").alias("want"), times.mixed_date(F.col("c")).cast("string").alias("got"))
    rows = shown.collect()
    assert [r for r in rows if r.want != r.got] == []
    assert sum(r.got is not None for r in rows) > 400


def test_formats_that_parts_cannot_tell_are_read_by_pattern(spark):
    text = {"c": "20240701 0930"}
    assert one(spark, times.mixed_date(F.col("c"), ("%Y%m%d %H%M",)), **text) == one(spark, times.parse_clock(F.col("c"), "%Y%m%d %H%M", whole=True), **text)
    assert one(spark, times.mixed_date(F.col("c"), ("%Y-%m-%d %H:%M:%S",)), c=" 2024-07-01  09:30:59 ") == "2024-07-01 09:30:59"
    assert one(spark, times.mixed_date(F.col("c"), ("%d.%m.%Y",)), c="31.12.2024") == "2024-12-31 00:00:00"
    with pytest.raises(ValueError):
        times.mixed_date(F.lit("x"), ("%j",))


def test_one_regular_expression_a_row(spark):
    from trackspark.operators.quality import convert_dates

    df = spark.createDataFrame([("4/8/25 9:05", 1)], "c string, v int")
    plan = convert_dates(df, "c")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all") == 1 and "RLIKE" not in plan and "regexp_replace" not in plan


def test_mixed_date_in_zone(spark):
    assert one(spark, times.mixed_date(F.col("c"), tz="US/Eastern"), c="7/1/2024 12:00") == "2024-07-01 16:00:00"


def test_clock_hours_across_dst(spark):
    t = F.col("c").cast("timestamp")
    # 2023-03-11 12:00 Eastern is 17:00 UTC; a clock day later it is summer time.
    assert one(spark, times.add_clock_hours(t, 24, "US/Eastern"), c="2023-03-11 17:00:00") == "2023-03-12 16:00:00"
    assert one(spark, times.add_clock_hours(t, 24, "UTC"), c="2023-03-11 17:00:00") == "2023-03-12 17:00:00"


def test_zone_relabelling(spark):
    t = F.col("c").cast("timestamp")
    assert one(spark, times.relabel_zone(t, "UTC", "US/Eastern"), c="2024-07-01 12:00:00") == "2024-07-01 16:00:00"
    assert one(spark, times.clock_seconds_as_utc(t, "US/Eastern"), c="2024-07-01 12:00:00.75") == "2024-07-01 08:00:00"


def test_serial_clock_round_trips_every_second(spark):
    day = spark.range(86400).select(
        F.date_format(F.timestamp_seconds("id"), "HH:mm:ss").alias("clock"),
        times.serial_to_clock(F.col("id") / F.lit(86400.0)).alias("back"),
    )
    assert day.where("clock <> back").count() == 0


def test_fractional_gaps(spark):
    a, b = F.col("a").cast("timestamp"), F.col("b").cast("timestamp")
    assert one(spark, times.hours_between(a, b), a="2024-01-01 00:00:00", b="2024-01-01 00:30:00.9") == 1800.9 / 3600
    assert one(spark, times.days_between(b, a), a="2024-01-01 00:00:00", b="2024-01-02 12:00:00") == -1.5


def test_local_dates_match_zoneinfo(spark):
    tz = ZoneInfo("US/Eastern")
    start = datetime(2024, 3, 9, 3, 30, tzinfo=ZoneInfo("UTC"))
    moments = [start + timedelta(hours=7 * i) for i in range(20)]
    df = spark.createDataFrame([(m,) for m in moments], "t timestamp")
    got = [r[0] for r in df.select(times.local_date(F.col("t"), "US/Eastern")).collect()]
    assert got == [m.astimezone(tz).date() for m in moments]
