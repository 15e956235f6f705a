from datetime import date

import pytest
from conftest import bag
from pyspark.sql import functions as F

from trackspark.functions.text import clean_names
from trackspark.sources import checks, csv_files, tables


def write(folder, name, text):
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)


def test_columns_are_bound_by_header_name(spark, tmp_path):
    write(tmp_path, "a.csv", "x,y\n1,2\n")
    write(tmp_path, "sub/b.csv", "y,x\n4,3\n")
    write(tmp_path, "sub/deep/c.csv", "x,z\n5,6\n")
    write(tmp_path, "notes.txt", "x,y\n9,9\n")
    out = csv_files.scan_csv_by_name(spark, str(tmp_path))
    assert bag(out.select("x", "y", "z")) == [("1", "2", None), ("3", "4", None), ("5", None, "6")]
    assert {r[0].rsplit("/", 1)[1] for r in out.select("_source_file").distinct().collect()} == {"a.csv", "b.csv", "c.csv"}


def test_directory_layout_refuses_a_differing_header(spark, tmp_path):
    write(tmp_path, "d1/a.csv", "x,y\n1,2\n")
    write(tmp_path, "d2/b.csv", "y,x\n4,3\n")
    out = csv_files.scan_csv_by_name(spark, str(tmp_path), layout="directory")
    assert bag(out.select("x", "y")) == [("1", "2"), ("3", "4")]
    write(tmp_path, "d1/c.csv", "y,x\n4,3\n")
    with pytest.raises(Exception, match="(?i)header"):
        csv_files.scan_csv_by_name(spark, str(tmp_path), layout="directory").collect()
    with pytest.raises(ValueError):
        csv_files.scan_csv_by_name(spark, str(tmp_path), layout="flat")


def test_ragged_rows_and_missing_tokens(spark, tmp_path):
    write(tmp_path, "a.csv", 'a,b,c,d\n1,2\nNA,,"  ",  x \n')
    out = csv_files.scan_csv_by_name(spark, str(tmp_path)).drop("_source_file")
    assert bag(out) == [("1", "2", None, None), (None, None, None, "x")]


def test_no_file_matches(spark, tmp_path):
    write(tmp_path, "a.txt", "x\n")
    with pytest.raises(FileNotFoundError):
        csv_files.scan_csv_by_name(spark, str(tmp_path))


def jobs_of(spark, group, run):
    spark.sparkContext.setJobGroup(group, group)
    out = run()
    spark.sparkContext.setJobGroup("other", "other")
    return out, len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def test_headers_of_many_files_are_one_catalogue(spark, tmp_path):
    for i in range(2000):
        write(tmp_path, f"d {i % 7}+/f{i}.csv", f"a,b\n{i},1\n" if i % 3 else f"b,a\n1,{i}\n")
    groups, jobs = jobs_of(spark, "many headers", lambda: csv_files.header_groups(spark, str(tmp_path)))
    assert {h: len(p) for h, p in groups.items()} == {("a", "b"): 1333, ("b", "a"): 667}
    write(tmp_path / "few", "x.csv", "a,b\n1,1\n")
    write(tmp_path / "few", "y.csv", "b,a\n1,1\n")
    _, few = jobs_of(spark, "few headers", lambda: csv_files.header_groups(spark, str(tmp_path / "few")))
    # Jobs follow the number of headers, not of files.
    assert jobs <= few + 2
    out = csv_files.scan_csv_by_name(spark, str(tmp_path), pattern="f*.csv")
    assert out.count() == 2000 and {r.b for r in out.select("b").distinct().collect()} == {"1"}
    assert out.agg(F.sum(F.col("a").cast("bigint"))).first()[0] == sum(range(2000))


def test_one_header_is_one_scan_of_the_folder(spark, tmp_path):
    for i in range(30):
        write(tmp_path, f"s/f{i}.csv", f"a,b\n{i},1\n")
    write(tmp_path, "s/empty.csv", "")
    assert csv_files.header_groups(spark, str(tmp_path)) == {("a", "b"): [str(tmp_path)]}
    assert csv_files.scan_csv_by_name(spark, str(tmp_path)).count() == 30


def test_a_big_file_is_read_for_its_first_line_only(spark, tmp_path):
    write(tmp_path, "big.csv", "a,b\n" + "1,2\n" * 2_000_000)
    write(tmp_path, "small.csv", "b,a\n1,2\n")
    lines = csv_files.header_catalogue(spark, str(tmp_path))
    assert sorted((r.path.rsplit("/", 1)[1], r.line) for r in lines.collect()) == [("big.csv", "a,b"), ("small.csv", "b,a")]
    assert spark.conf.get("spark.sql.files.openCostInBytes") != str(csv_files.WHOLE_FILES)
    out = csv_files.scan_csv_by_name(spark, str(tmp_path))
    assert out.count() == 2_000_001


def test_headers_with_line_breaks(spark, tmp_path):
    write(tmp_path, "a.csv", '"x\none",y\n1,2\n')
    write(tmp_path, "b.csv", '"x\ntwo",y\n3,4\n')
    out = csv_files.scan_csv_by_name(spark, str(tmp_path), multi_line=True).drop("_source_file")
    assert sorted(out.columns) == ["x\none", "x\ntwo", "y"] and out.count() == 2


def test_only_wanted_columns_are_read(spark, tmp_path):
    write(tmp_path, "a.csv", "x,y,z\n1,2,3\n")
    out = csv_files.scan_csv_by_name(spark, str(tmp_path), columns=["z"])
    assert out.columns == ["z", "_source_file"]
    assert "ReadSchema: struct<z:string>" in out._jdf.queryExecution().executedPlan().toString()


def test_input_order_columns(spark, tmp_path):
    write(tmp_path, "a.csv", "x\n" + "\n".join(str(i) for i in range(50)) + "\n")
    out = csv_files.scan_csv_by_name(spark, str(tmp_path), with_order=True)
    assert [r.x for r in out.orderBy(*csv_files.SOURCE_ORDER).collect()] == [str(i) for i in range(50)]


def test_read_sheet(spark, tmp_path):
    write(tmp_path, "s.csv", "INS_SERIAL_NO,event_ts,Name Of\n100001.0,0.5,a\nbad,NA,b\n")
    out = clean_names(csv_files.read_sheet(spark, str(tmp_path), with_order=False).drop("_source_file"))
    assert bag(out) == [(100001.0, "12:00:00", "a"), (None, None, "b")]
    honoured = csv_files.read_sheet(spark, str(tmp_path), cast_overrides={"event_ts": "float"}, clock_column=None)
    assert dict(honoured.dtypes)["event_ts"] == "float" and dict(honoured.dtypes)["INS_SERIAL_NO"] == "string"


def test_format_switch(spark, tmp_path, ts):
    df = spark.createDataFrame([(ts("2024-01-05 13:02:11"), "a"), (None, None)], "`Date and Time (UTC)` timestamp, v string")
    tables.save_table(df, f"{tmp_path}/t.csv", date_column="Date and Time (UTC)")
    back = tables.load_table(spark, f"{tmp_path}/t.csv")
    assert bag(back) == [("2024-01-05 13:02", "a"), (None, None)]
    tables.save_table(df, f"{tmp_path}/t.parquet")
    assert bag(tables.load_table(spark, f"{tmp_path}/t.parquet")) == bag(df)
    tables.save_table(df, f"{tmp_path}/plain", "parquet")
    assert tables.load_table(spark, f"{tmp_path}/plain", "parquet").count() == 2
    for path, fmt in (("t.rds", "auto"), ("t", "auto"), ("t.csv", "xlsx")):
        with pytest.raises(ValueError, match="unsupported"):
            tables.save_table(df, f"{tmp_path}/{path}", fmt)


def test_csv_cells_of_all_kinds_survive(spark, tmp_path):
    rows = [('lost "buoy", found', "two\nlines", "C:\\dir\\", "z"), ('"', ",", "\\\\", "z"), (None, 'a""b', "x\\\"y", None)]
    df = spark.createDataFrame(rows, "a string, b string, c string, d string")
    tables.save_table(df, f"{tmp_path}/t.csv")
    assert bag(tables.load_table(spark, f"{tmp_path}/t.csv")) == bag(df)
    text = "".join(p.read_text() for p in (tmp_path / "t.csv").glob("*.csv"))
    assert 'lost ""buoy"", found' in text
    tables.save_period_csv(df, f"{tmp_path}/report")
    assert bag(csv_files.read_sheet(spark, f"{tmp_path}/report", with_order=False).drop("_source_file")) == bag(df)


def test_period_csv(spark, tmp_path):
    rows = [(1, 9, 0.25), (2, 8, 0.5), (1, 7, None)]
    df = spark.createDataFrame(rows, "interval_id int, id int, residency_index double").repartition(3)
    tables.save_period_csv(df, str(tmp_path / "out"), tables.SUMMARY_HEADINGS, ["id"])
    files = {p.parent.name: p.read_text() for p in (tmp_path / "out").rglob("*.csv")}
    assert files == {"interval_id=1": "ID,Residency Index\n7,\n9,0.25\n", "interval_id=2": "ID,Residency Index\n8,0.5\n"}


def test_named_tables_by_local_day(spark, tmp_path, ts):
    det = spark.createDataFrame(
        [(ts("2024-01-05 03:00:00"), "1", 5, None, None, "A", "l"), (ts("2024-01-07 03:00:00"), "1", 6, None, None, "A", "l")],
        "time timestamp, station string, elasmo bigint, sensor_value string, sensor_unit string, agency string, location string",
    )
    vloc = spark.createDataFrame([("x", 1.0)], "location string, deploy_lat double")
    tables.write_tables({"det_cleaned": det, "other": vloc}, str(tmp_path), "US/Eastern")
    stored = tables.read_table(spark, str(tmp_path), "det_cleaned")
    assert sorted((r.elasmo, r.date) for r in stored.collect()) == [(5, date(2024, 1, 4)), (6, date(2024, 1, 6))]
    one_day = tables.prune_days(stored, "2024-01-06", "2024-01-06")
    assert [r.elasmo for r in one_day.collect()] == [6]
    bounded = tables.read_detections(spark, str(tmp_path), "det_cleaned", "2024-03-01", "2024-03-05")
    assert bounded.count() == 0 and "date" not in bounded.columns
    assert "PartitionFilters: [isnotnull(date" in bounded._jdf.queryExecution().executedPlan().toString()
    wide = tables.read_detections(spark, str(tmp_path), "det_cleaned", "2024-01-31")
    assert wide.count() == 2
    assert "PartitionFilters: [isnotnull(date" in one_day._jdf.queryExecution().executedPlan().toString()
    assert tables.read_tables(spark, str(tmp_path), ["det_cleaned"])["det_cleaned"].columns == det.columns
    with pytest.raises(FileNotFoundError, match="vmov.*ind"):
        tables.read_tables(spark, str(tmp_path), ["det_cleaned", "vmov", "ind"])


def test_checks(spark):
    df = spark.createDataFrame([], "a string, t timestamp")
    checks.require_columns(df, ["a"])
    with pytest.raises(ValueError, match="b, c"):
        checks.require_columns(df, ["a", "b", "c"])
    with pytest.raises(TypeError):
        checks.require_timestamp(df, "a")
    with pytest.raises(TypeError):
        checks.require_text(df.withColumn("a", F.lit(1)), "a")
    checks.require_list("x", None)
    checks.require_list("x", ["a"])
    for bad in ("a", [1]):
        with pytest.raises(ValueError):
            checks.require_list("x", bad)


def rows_of(spark, folder, name):
    return bag(tables.read_table(spark, str(folder), name).select("time", "elasmo", "date"))


def test_a_failed_write_leaves_the_old_tables(spark, tmp_path, ts):
    old = spark.createDataFrame([(ts("2024-01-01"), 1)], "time timestamp, elasmo bigint")
    tables.write_tables({"det_x": old, "other": old}, str(tmp_path))
    broken = old.withColumn("elasmo", F.raise_error(F.lit("stop")).cast("bigint"))
    with pytest.raises(Exception, match="stop"):
        tables.write_tables({"det_x": old.withColumn("elasmo", F.lit(2).cast("bigint")), "other": broken}, str(tmp_path))
    # Neither table changed, and nothing lies about.
    assert rows_of(spark, tmp_path, "det_x") == [("2024-01-01 00:00:00", 1, date(2024, 1, 1))]
    assert spark.read.parquet(str(tmp_path / "other")).count() == 1
    assert sorted(p.name for p in tmp_path.iterdir() if not p.name.startswith(".")) == ["det_x", "other"]


def test_a_table_can_be_computed_from_itself(spark, tmp_path):
    for _ in range(3):
        path = tmp_path / "t"
        rows = spark.read.parquet(str(path)) if path.exists() else spark.range(1)
        tables.write_tables({"t": rows.unionAll(rows)}, str(tmp_path))
    assert spark.read.parquet(str(tmp_path / "t")).count() == 8


def test_only_the_given_days_are_replaced(spark, tmp_path, ts):
    def det(*rows):
        return spark.createDataFrame([(ts(t), n) for t, n in rows], "time timestamp, elasmo bigint")

    tables.write_tables({"det_x": det(("2024-01-01", 1), ("2024-01-02", 2), ("2024-01-03", 3))}, str(tmp_path))
    before = {f for f in (tmp_path / "det_x" / "date=2024-01-01").iterdir()}
    # Rows of other days are not written, a day without rows goes.
    change = det(("2024-01-02", 20), ("2024-01-05", 50), ("2024-01-01", 9))
    tables.write_days(change, str(tmp_path), "det_x", [date(2024, 1, 2), date(2024, 1, 3), date(2024, 1, 5)])
    assert [r[1] for r in rows_of(spark, tmp_path, "det_x")] == [1, 20, 50]
    assert {f for f in (tmp_path / "det_x" / "date=2024-01-01").iterdir()} == before
    assert not [p for p in (tmp_path / "det_x").iterdir() if p.name.startswith("_old") or p.name.startswith("_new")]
    assert bag(tables.read_days(spark, str(tmp_path), "det_x", [date(2024, 1, 5)]).select("elasmo")) == [(50,)]


def test_rules_are_one_aggregate(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (None, " "), (3, None)], "elasmo bigint, location string")
    report = checks.rule_report(df, checks.DETECTION_RULES, {"elasmo": "bigint", "time": "timestamp"})
    assert [tuple(r) for r in report.collect()] == [
        ("elasmo is bigint", 0), ("time is timestamp", 1), ("a detection has a time", None), ("a detection has a tag", 1), ("a detection has a location", 2),
    ]
    assert report._jdf.queryExecution().optimizedPlan().toString().count("Aggregate") == 1
    paths = checks.path_report(spark, {"here": str(tmp_path), "gone": str(tmp_path / "x")})
    assert bag(paths) == [("gone exists", 1), ("here exists", 0)]
    write(tmp_path, "a.csv", "x")
    assert bag(checks.pattern_report(spark, str(tmp_path), ["*.csv", "*.gz"])) == [("a file matches *.csv", 0), ("a file matches *.gz", 1)]
