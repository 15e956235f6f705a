"""Text and date helpers, sheets, foreign files and file formats."""

from __future__ import annotations

import posixpath
import uuid

from pyspark.sql import functions as F

from registry.bindings import CONTACTS, TZ, det, det_years, instant, load, local, shown, with_tables
from trackspark.functions import text as tx
from trackspark.functions import times
from trackspark.operators.periods import assign_period
from trackspark.operators.quality import conversion_stats, convert_dates
from trackspark.operators.summary import detection_counts
from trackspark.plans import ingest
from trackspark.session import shared_dir
from trackspark.sources.csv_files import read_sheet, scan_csv_by_name
from trackspark.sources.tables import load_table, prune_days, read_table, save_period_csv, save_table, write_tables


def scratch(spark) -> str:
    """A new folder below the shared one."""
    return posixpath.join(shared_dir(spark), f"run-{uuid.uuid4().hex}")


def text_of(name: str):
    return F.col(name).cast("string")


# --- text and date helpers -------------------------------------------------------------------


def untidy(spark, d):
    name = F.concat(F.lit("  "), F.upper("p_name"), F.lit("\t  "), F.col("p_type"), F.lit(" "))
    return load(spark, d, "part").select("p_partkey", tx.norm_name(name).alias("name"))


def suffix(spark, d):
    key = F.col("p_partkey")
    code = F.when(key % 7 == 0, text_of("p_partkey")).when(key % 5 == 0, F.lit("A00-"))
    code = code.otherwise(F.concat(F.lit("A00-0000-"), text_of("p_partkey"), F.lit(".0")))
    return load(spark, d, "part").select(
        "p_partkey", tx.suffix_id(code).alias("suffix"), tx.tag_id(tx.suffix_id(code)).alias("tag")
    )


def first_t(spark, d):
    stamp = F.date_format("time", "yyyy-MM-dd'T'HH:mm:ss")
    stamp = F.concat(stamp, F.lit(" T"))
    return det(spark, d).select("event_id", tx.first_t_to_blank(stamp).alias("stamp"))


def replaced(spark, d):
    rules = [("small", "SMALL"), ("SMALL ring", "Ring small"), ("[aeiou]t", "_")]
    return load(spark, d, "part").select("p_partkey", tx.replace_in_order(F.col("p_name"), rules).alias("name"))


def clock(spark, d):
    t = F.col("time")
    second = F.hour(t) * 3600 + F.minute(t) * 60 + F.second(t)
    return det(spark, d).select("event_id", times.serial_to_clock(second / F.lit(86400.0)).alias("clock"))


def clock_day_later(spark, d):
    """A clock day added in the data zone; over a zone change it is 23 or 25 hours."""
    return shown(det_years(spark, d).select("event_id", times.add_clock_hours(F.col("time"), 24, TZ).alias("later")))


def relabelled(spark, d):
    t = F.col("time")
    return shown(
        det(spark, d).select(
            "event_id",
            times.relabel_zone(t, "UTC", TZ).alias("forced"),
            times.clock_seconds_as_utc(t, TZ).alias("clock_as_utc"),
        )
    )


def snake(spark, d):
    raw = load(spark, d, "part").toDF("Part Key", "Part Name", "BRAND", "typeOfPart", "Size (%)", "Retail.Price")
    return tx.clean_names(raw)


def mixed(spark, d):
    key = F.col("o_orderkey")
    t = F.col("o_orderdate") + F.make_dt_interval(
        hours=(key % 24).cast("int"), mins=(key % 60).cast("int"), secs=(key % 59).cast("decimal(18,6)")
    )
    text = (
        F.when(key % 4 == 0, F.date_format(t, "M/d/yy H:mm"))
        .when(key % 8 == 1, F.date_format(t, "M/d/yyyy H:mm:ss"))
        .when(key % 4 == 1, F.date_format(t, "M/d/yyyy H:mm"))
        .when(key % 8 == 2, F.date_format(t, "MM-dd-yyyy HH:mm:ss"))
        .when(key % 8 == 6, F.concat(F.date_format(t, "M/d/yyyy HH:mm"), F.lit(" PM")))
        .otherwise("not a date")
    )
    return load(spark, d, "orders").select("o_orderkey", text.alias("stamp"), text.alias("text"))


MIXED = """stamped AS (SELECT o_orderkey, CAST(o_orderdate AS TIMESTAMP) + to_hours(o_orderkey % 24)
        + to_minutes(o_orderkey % 60) + to_seconds((o_orderkey % 59)::DOUBLE) AS t FROM orders),
    texts AS (SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN strftime(t, '%-m/%-d/%y %-H:%M')
        WHEN o_orderkey % 8 = 1 THEN strftime(t, '%-m/%-d/%Y %-H:%M:%S')
        WHEN o_orderkey % 4 = 1 THEN strftime(t, '%-m/%-d/%Y %-H:%M')
        WHEN o_orderkey % 8 = 2 THEN strftime(t, '%m-%d-%Y %H:%M:%S')
        WHEN o_orderkey % 8 = 6 THEN strftime(t, '%-m/%-d/%Y %H:%M PM') ELSE 'not a date' END AS text FROM stamped),
    parsed AS (SELECT o_orderkey, text, try_strptime(text,
        ['%m/%d/%y %H:%M', '%m/%d/%Y %H:%M', '%m/%d/%Y %H:%M:%S', '%m-%d-%Y %H:%M:%S']) AS stamp FROM texts)"""


def converted(spark, d):
    return shown(convert_dates(mixed(spark, d), "stamp"))


def converted_stats(spark, d):
    return conversion_stats(convert_dates(mixed(spark, d), "stamp"), "stamp")


# --- sheets ----------------------------------------------------------------------------------

RULES = ingest.SheetRules(
    agency="AG0",
    tz=TZ,
    retired=(("Reef 3", "24.3"),),
    excluded=("Reef 5",),
    pending=(("Reef 1", "2024-01-02T00:00:00"),),
)


def deployment_sheet(spark, d):
    key = F.col("s_suppkey")
    start = F.lit("2024-01-01 00:00:00").cast("timestamp") + F.make_dt_interval(days=(key % 90).cast("int"))
    stamp = "yyyy-MM-dd'T'HH:mm:ss"
    return load(spark, d, "supplier").select(
        F.when(key % 17 != 0, F.concat(F.lit("Reef "), (key % 8).cast("string"))).alias("station_no"),
        F.when(key % 5 == 0, "VR2AR").otherwise("VR2W").alias("ins_model_no"),
        (key % 30 + 100000).cast("double").alias("ins_serial_no"),
        F.concat(F.lit("24."), (key % 4).cast("string")).alias("deploy_lat"),
        F.lit("-79.5").alias("deploy_long"),
        F.when(key % 3 == 0, "n/a").otherwise("12.5").alias("bottom_depth"),
        F.lit(None).cast("string").alias("riser_length"),
        (key % 10).cast("string").alias("instrument_depth"),
        F.when(key % 11 == 0, "2022-xxxxx").otherwise(F.date_format(start, stamp)).alias(ingest.DEPLOYED_AT),
        F.date_format(start + F.expr("INTERVAL 60 DAYS"), stamp).alias(ingest.RECOVERED_AT),
        F.when(key % 13 == 0, "N").otherwise("Y").alias("data_downloaded_y_n"),
        F.when(key % 2 == 0, "ok").alias("comments"),
        "s_suppkey",
    )


SHEET = """sheet AS (SELECT CASE WHEN s_suppkey % 17 <> 0 THEN 'Reef ' || CAST(s_suppkey % 8 AS VARCHAR) END AS station_no,
        '24.' || CAST(s_suppkey % 4 AS VARCHAR) AS lat, s_suppkey,
        TIMESTAMP '2024-01-01' + to_days(CAST(s_suppkey % 90 AS INTEGER)) AS put_out FROM supplier WHERE s_suppkey % 5 <> 0),
    usable AS (SELECT * FROM sheet WHERE NOT (station_no = 'Reef 3' AND lat = '24.3')
        AND (station_no IS NULL OR station_no <> 'Reef 5'))"""


def locations(spark, d):
    return ingest.receiver_locations(deployment_sheet(spark, d), RULES, ["s_suppkey"])


def deployments(spark, d):
    return shown(ingest.receiver_deployments(deployment_sheet(spark, d), RULES))


def catch_sheet(spark, d):
    key = F.col("c_custkey")
    return load(spark, d, "customer").select(
        F.when(key % 13 == 0, None).when(key % 11 == 0, " NA ").otherwise(F.concat(F.lit(" "), F.floor(key / 2).cast("string"))).alias("acoustic_tag_id"),
        F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), (key % 300).cast("int")), "yyyy-MM-dd").alias("event_dt"),
        F.when(key % 9 != 0, times.serial_to_clock((key % 86400) / F.lit(86400.0))).alias("event_ts"),
        F.col("c_mktsegment").alias("species"),
        F.lit("F").alias("sex"),
        F.col("c_acctbal").cast("string").alias("pcl"),
        F.lit("x").alias("fl"),
        F.lit(None).cast("string").alias("tl"),
        F.lit("1.5").alias("stl"),
        F.lit("owner").alias("tag_owner"),
        F.lit("25.1").alias("latitude"),
        F.lit("-79.1").alias("longitude"),
        F.col("c_name").alias("site"),
        "c_custkey",
    )


def tags(spark, d):
    return shown(ingest.tag_metadata(catch_sheet(spark, d), TZ, ["c_custkey"]))


# --- detection files -------------------------------------------------------------------------


def export_rows(spark, d):
    return load(spark, d, "events").select(
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("Date and Time (UTC)"),
        F.concat(F.lit("VR2W-"), (F.col("user_id") % 10 + 100000).cast("string")).alias("Receiver"),
        F.concat(F.lit("A00-0000-"), text_of("user_id")).alias("Transmitter"),
        F.when(F.col("event_id") % 3 == 0, F.col("event_type")).alias("Sensor Value"),
        F.lit("m").alias("Sensor Unit"),
        "event_id",
    )


def export_files(spark, d):
    """Half of the rows under one header order, half under another, in nested folders."""
    rows, folder = export_rows(spark, d), scratch(spark)
    first = ["Date and Time (UTC)", "Receiver", "Transmitter", "Sensor Value", "Sensor Unit"]
    second = ["Transmitter", "Sensor Unit", "Receiver", "Sensor Value", "Date and Time (UTC)", "event_id"]
    for i, names in enumerate((first, second)):
        part = rows.where(F.col("event_id") % 2 == i).select(*[F.col(f"`{n}`") for n in names])
        part.write.option("header", "true").csv(posixpath.join(folder, f"part{i}", "files"))
    return folder


def imported(layout):
    def run(spark, d):
        files = scan_csv_by_name(spark, export_files(spark, d), layout=layout, columns=list(ingest.EXPORT_COLUMNS.values()))
        return shown(ingest.raw_detections(files, "AG0"))

    return run


def raw(spark, d):
    return shown(ingest.raw_detections(export_rows(spark, d), "AG0"))


RAW_SQL = """SELECT date_trunc('second', CAST(ts AS TIMESTAMP)) AS time, CAST(user_id % 10 + 100000 AS VARCHAR) AS station,
    user_id AS elasmo, CASE WHEN event_id % 3 = 0 THEN event_type END AS sensor_value, 'm' AS sensor_unit,
    'AG0' AS agency FROM events"""


def by_name(spark, d):
    return scan_csv_by_name(spark, export_files(spark, d)).drop("_source_file").withColumnsRenamed(
        {v: k for k, v in ingest.EXPORT_COLUMNS.items()}
    )


FOREIGN_RULES = dict(contacts=CONTACTS, tz=TZ, excluded=("view",))


def matched_rows(spark, d):
    key = F.col("event_id")
    return load(spark, d, "events").select(
        F.date_format(F.date_trunc("hour", "ts"), "yyyy-MM-dd HH:mm:ss").alias("datecollected"),
        F.when(key % 9 == 0, "VR2W-release").otherwise(F.concat(F.lit("VR2W-"), (key % 3).cast("string"))).alias("receiver"),
        F.concat(F.lit("A00-0000-"), (F.col("user_id") % 20).cast("string")).alias("tagname"),
        F.lit("1").alias("sensorvalue"),
        F.lit(None).cast("string").alias("sensorunit"),
        F.when(key % 10 != 0, F.col("event_type")).alias("station"),
        F.lit("-79.1").alias("longitude"),
        F.lit("24.1").alias("latitude"),
        F.concat(F.lit("c"), (key % 6).cast("string")).alias("contact_poc"),
        F.concat(F.lit("f"), (key % 4).cast("string")).alias("_source_file"),
    )


def matched(**changes):
    def run(spark, d):
        rules = ingest.ForeignRules(**FOREIGN_RULES, location_rules=(("click", "CLICK"),), retired_locations=("error",), **changes)
        return shown(ingest.foreign_detections_matched(matched_rows(spark, d), rules))

    return run


def matched_sql(source: str) -> str:
    return with_tables(
        f"""SELECT time, station, elasmo, '1' AS sensor_value, CAST(NULL AS VARCHAR) AS sensor_unit, location,
        '24.1' AS deploy_lat, '-79.1' AS deploy_long, agency FROM (SELECT DISTINCT date_trunc('hour', CAST(ts AS TIMESTAMP)) AS time,
        CAST(event_id % 3 AS VARCHAR) AS station, CAST(user_id % 20 AS VARCHAR) AS elasmo,
        replace(event_type, 'click', 'CLICK') AS location, agency, {source} AS source
        FROM events JOIN contacts ON contact = 'c' || CAST(event_id % 6 AS VARCHAR)
        WHERE event_id % 9 <> 0 AND event_id % 10 <> 0 AND event_type NOT IN ('error', 'view'))""",
        "contacts",
    )


def private(spark, d):
    key = F.col("event_id")
    rows = load(spark, d, "events").select(
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("Date and Time (UTC)"),
        F.concat(F.lit("VR2W-"), (key % 3).cast("string")).alias("Receiver"),
        F.concat(F.lit("A00-0000-"), (F.col("user_id") % 20).cast("string")).alias("Transmitter"),
        F.when(key % 10 != 0, F.col("event_type")).alias("Station Name"),
        F.lit("24.1").alias("Latitude"),
        F.lit("-79.1").alias("Longitude"),
        F.concat(F.lit("c"), (key % 6).cast("string")).alias("contact_poc"),
        F.concat(F.lit("f"), (key % 4).cast("string")).alias("_source_file"),
    )
    return shown(ingest.foreign_detections_private(rows, ingest.ForeignRules(**FOREIGN_RULES)))


PRIVATE_SQL = with_tables(
    """SELECT time, station, elasmo, CAST(NULL AS VARCHAR) AS sensor_value, CAST(NULL AS VARCHAR) AS sensor_unit, location,
    '24.1' AS deploy_lat, '-79.1' AS deploy_long, agency FROM (SELECT DISTINCT date_trunc('minute', CAST(ts AS TIMESTAMP)) AS time,
    CAST(event_id % 3 AS VARCHAR) AS station, CAST(user_id % 20 AS VARCHAR) AS elasmo,
    CASE WHEN event_id % 10 <> 0 THEN event_type END AS location, coalesce(agency, '') AS agency, event_id % 4 AS source
    FROM events LEFT JOIN contacts ON contact = 'c' || CAST(event_id % 6 AS VARCHAR)
    WHERE event_id % 10 = 0 OR event_type <> 'view')""",
    "contacts",
)

# --- formats ---------------------------------------------------------------------------------


def sheet_file(spark, d):
    t = F.col("time")
    second = F.hour(t) * 3600 + F.minute(t) * 60 + F.second(t)
    rows = det(spark, d).select(
        F.concat((F.abs("elasmo") + 100000).cast("string"), F.lit(".0")).alias("INS_SERIAL_NO"),
        F.when(F.col("event_id") % 4 == 0, "NA").otherwise((second / F.lit(86400.0)).cast("string")).alias("event_ts"),
        F.when(F.col("event_id") % 5 == 0, "  ").otherwise(F.concat(F.lit(" "), "location", F.lit(" "))).alias("Site Name"),
        text_of("event_id").alias("event_id"),
    )
    folder = scratch(spark)
    rows.write.option("header", "true").csv(folder)
    sheet = read_sheet(spark, folder, with_order=False).drop("_source_file")
    return tx.clean_names(sheet.withColumn("INS_SERIAL_NO", tx.serial_text(F.col("INS_SERIAL_NO"))))


def period_csv(spark, d):
    """Counts per period written as CSV folders, read back with the period from the folder name."""
    rows = assign_period(det(spark, d), monthly=True, tz=TZ)
    counted = detection_counts(rows).withColumn("location", F.when(F.col("location") != "view", F.col("location")))
    folder = scratch(spark)
    save_period_csv(counted, folder, {"n": "Total detections"})
    back = spark.read.option("header", "true").schema("location string, elasmo bigint, `Total detections` bigint, interval_id int").csv(folder)
    return back.withColumnRenamed("Total detections", "n")


def switched(spark, d):
    """A table saved as csv (instants to the minute) and as parquet, both loaded by extension."""
    rows = det(spark, d).select("event_id", "time", "location")
    folder = scratch(spark)
    save_table(rows, f"{folder}/rows.csv", date_column="time", tz=TZ)
    save_table(rows, f"{folder}/rows.parquet")
    text = load_table(spark, f"{folder}/rows.csv").select(F.col("event_id").cast("bigint").alias("event_id"), F.col("time").alias("minute"))
    return shown(load_table(spark, f"{folder}/rows.parquet").join(text, "event_id"))


def quoted_cells(spark, d):
    """Cells with quotes, commas, line breaks and backslashes, written as CSV and read back by header name."""
    p = F.col("p_name")
    cells = load(spark, d, "part").select(
        "p_partkey",
        F.concat(F.lit('said "'), p, F.lit('", twice')).alias("quoted"),
        F.concat(p, F.lit("\n"), F.col("p_brand"), F.lit(",x")).alias("broken"),
        F.concat(F.lit("C:\\"), p, F.lit("\\")).alias("path"),
        F.lit("last").alias("last"),
    )
    folder = scratch(spark)
    save_table(cells, folder, "csv")
    back = scan_csv_by_name(spark, folder, multi_line=True).drop("_source_file")
    return back.withColumn("p_partkey", F.col("p_partkey").cast("bigint"))


def stored(spark, d):
    """A detection table written by local day, read back for a range of days."""
    rows = det(spark, d).select("time", "station", "elasmo", F.col("location").alias("sensor_value"), F.lit("m").alias("sensor_unit"), "agency")
    folder = scratch(spark)
    write_tables({"det": rows}, folder, TZ)
    return shown(prune_days(read_table(spark, folder, "det"), "2024-01-05", "2024-01-09"))


QUERIES = {
    "name_normalise": (
        untidy,
        r"""SELECT p_partkey, replace(trim(regexp_replace(lower('  ' || upper(p_name) || chr(9) || '  ' || p_type || ' '),
        '\s+', ' ', 'g')), ' ', '_') AS name FROM part""",
    ),
    "suffix_after_dash": (
        suffix,
        """SELECT p_partkey, CASE WHEN p_partkey % 7 = 0 THEN CAST(p_partkey AS VARCHAR)
        WHEN p_partkey % 5 <> 0 THEN CAST(p_partkey AS VARCHAR) || '.0' END AS suffix,
        CASE WHEN p_partkey % 7 = 0 OR p_partkey % 5 <> 0 THEN p_partkey END AS tag FROM part""",
    ),
    "first_t_replace": (
        first_t,
        """SELECT event_id, strftime(CAST(ts AS TIMESTAMP), '%Y-%m-%d %H:%M:%S') || ' T' AS stamp FROM events""",
    ),
    "multi_replace": (
        replaced,
        """SELECT p_partkey, regexp_replace(replace(replace(p_name, 'small', 'SMALL'), 'SMALL ring', 'Ring small'),
        '[aeiou]t', '_', 'g') AS name FROM part""",
    ),
    "serial_to_clock": (clock, "SELECT event_id, strftime(CAST(ts AS TIMESTAMP), '%H:%M:%S') AS clock FROM events"),
    "add_clock_hours": (
        clock_day_later,
        with_tables(f"SELECT event_id, {instant(local('time') + ' + INTERVAL 24 HOURS')} AS later FROM det", "det_years"),
    ),
    "zone_relabel": (
        relabelled,
        with_tables(
            f"SELECT event_id, {instant('time')} AS forced, date_trunc('second', {local('time')}) AS clock_as_utc FROM det", "det"
        ),
    ),
    "clean_names": (
        snake,
        """SELECT p_partkey AS part_key, p_name AS part_name, p_brand AS brand, p_type AS type_of_part, p_size AS size_percent,
        p_retailprice AS retail_price FROM part""",
    ),
    "mixed_date_conversion": (converted, with_tables("SELECT o_orderkey, stamp, text FROM parsed", MIXED)),
    "conversion_stats": (
        converted_stats,
        with_tables(
            """SELECT count(*) AS total, count(*) - count(stamp) AS failed,
            round_even(count(stamp)::DOUBLE / count(*)::DOUBLE * 100, 2) AS success_rate FROM parsed""",
            MIXED,
        ),
    ),
    "receiver_locations": (
        locations,
        with_tables(
            """SELECT lat::DOUBLE AS deploy_lat, -79.5::DOUBLE AS deploy_long, lower(replace(station_no, ' ', '_')) AS location,
            CASE WHEN s_suppkey % 3 <> 0 THEN 12.5::DOUBLE END AS bottom_depth, CAST(NULL AS DOUBLE) AS riser_length,
            (s_suppkey % 10)::DOUBLE AS instrument_depth, 'AG0' AS agency FROM usable
            QUALIFY row_number() OVER (PARTITION BY lat, station_no ORDER BY s_suppkey) = 1""",
            SHEET,
        ),
    ),
    "receiver_deployments": (
        deployments,
        with_tables(
            f"""SELECT DISTINCT CAST(s_suppkey % 30 + 100000 AS VARCHAR) AS station, {instant('put_out')} AS date_in,
            {instant('put_out + to_days(60)')} AS date_out, lower(replace(station_no, ' ', '_')) AS location,
            CASE WHEN s_suppkey % 2 = 0 THEN 'ok' END AS comments FROM usable
            WHERE s_suppkey % 11 <> 0 AND s_suppkey % 13 <> 0
            AND coalesce(NOT (station_no = 'Reef 1' AND put_out = TIMESTAMP '2024-01-02'), put_out <> TIMESTAMP '2024-01-02')""",
            SHEET,
        ),
    ),
    "tag_metadata": (
        tags,
        with_tables(
            f"""SELECT c_custkey // 2 AS acoustic_tag_id, CASE WHEN c_custkey % 9 <> 0 THEN
            {instant("TIMESTAMP '2024-01-01' + to_days(CAST(c_custkey % 300 AS INTEGER)) + to_seconds((c_custkey % 86400)::DOUBLE)")}
            END AS tagging_datetime, c_mktsegment AS species, 'F' AS sex, c_acctbal AS pcl, CAST(NULL AS DOUBLE) AS fl,
            CAST(NULL AS DOUBLE) AS tl, 1.5::DOUBLE AS stl, 'owner' AS tag_owner, '25.1' AS latitude, '-79.1' AS longitude,
            c_name AS site FROM kept QUALIFY row_number() OVER (PARTITION BY c_custkey // 2 ORDER BY c_custkey) = 1""",
            "kept AS (SELECT * FROM customer WHERE c_custkey % 13 <> 0 AND c_custkey % 11 <> 0)",
        ),
    ),
    "raw_detections": (raw, RAW_SQL),
    "csv_multi_header_scan": (
        by_name,
        """SELECT strftime(CAST(ts AS TIMESTAMP), '%Y-%m-%d %H:%M:%S') AS time, 'VR2W-' || CAST(user_id % 10 + 100000 AS VARCHAR) AS station,
        'A00-0000-' || CAST(user_id AS VARCHAR) AS elasmo, CASE WHEN event_id % 3 = 0 THEN event_type END AS sensor_value,
        'm' AS sensor_unit, CASE WHEN event_id % 2 = 1 THEN CAST(event_id AS VARCHAR) END AS event_id FROM events""",
    ),
    "import_detection_files": (imported("file"), RAW_SQL),
    "import_detection_directories": (imported("directory"), RAW_SQL),
    "foreign_detections_matched": (matched(), matched_sql("event_id % 4")),
    "foreign_detections_matched_all_files": (matched(dedupe_scope="all"), matched_sql("0")),
    "foreign_detections_private": (private, PRIVATE_SQL),
    "read_sheet": (
        sheet_file,
        """SELECT CAST(user_id + 100000 AS VARCHAR) AS ins_serial_no,
        CASE WHEN event_id % 4 <> 0 THEN strftime(CAST(ts AS TIMESTAMP), '%H:%M:%S') END AS event_ts,
        CASE WHEN event_id % 5 <> 0 THEN event_type END AS site_name, CAST(event_id AS VARCHAR) AS event_id FROM events""",
    ),
    "csv_period_sink": (
        period_csv,
        with_tables(
            f"""SELECT CASE WHEN location <> 'view' THEN location END AS location, elasmo, count(*) AS n,
            CASE WHEN {local('time')} < TIMESTAMP '2024-01-01' THEN 1 ELSE 2 END AS interval_id FROM det GROUP BY location, elasmo, 4""",
            "det",
        ),
    ),
    "csv_quoted_cells": (
        quoted_cells,
        r"""SELECT p_partkey, 'said "' || p_name || '", twice' AS quoted, p_name || chr(10) || p_brand || ',x' AS broken,
        'C:\' || p_name || '\' AS path, 'last' AS last FROM part""",
    ),
    "load_save_switch": (
        switched,
        with_tables(f"SELECT event_id, time, location, strftime({local('time')}, '%Y-%m-%d %H:%M') AS minute FROM det", "det"),
    ),
    "stored_detections_by_day": (
        stored,
        with_tables(
            f"""SELECT time, station, elasmo, location AS sensor_value, 'm' AS sensor_unit, agency,
            CAST({local('time')} AS DATE) AS date FROM det
            WHERE CAST({local('time')} AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-09'""",
            "det",
        ),
    ),
}
