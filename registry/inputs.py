"""Checks of inputs, ragged files, ids of two kinds and empty periods."""

from __future__ import annotations

import posixpath

from pyspark.sql import functions as F

from registry.bindings import TZ, det, ind, load, shown, vmov, with_tables
from registry.detections import AFTER_SQL, COMPILED_SQL
from registry.ingest import export_files, scratch
from trackspark.operators import summary
from trackspark.operators.periods import assign_period
from trackspark.plans.detections import compile_detections
from trackspark.sources import checks
from trackspark.sources.csv_files import scan_csv_by_name

NAMES = ["c1", "c2", "c3", "c4", "c5", "c6", "c7", "c8", "c9", "c10"]


def ragged(spark, d):
    """Files with ten headings and eight cells a row."""
    key = F.col("event_id")
    cells = [F.concat(F.lit(n), F.lit("_"), (key % (i + 2)).cast("string")).alias(n) for i, n in enumerate(NAMES[:7])]
    # The writer joins headings with commas: the last one stands for three.
    rows = load(spark, d, "events").select(*cells, key.cast("string").alias(",".join(NAMES[7:])))
    folder = scratch(spark)
    rows.write.option("header", "true").option("quote", "").csv(folder)
    return scan_csv_by_name(spark, folder).drop("_source_file")


def patterns(spark, d):
    return checks.pattern_report(spark, export_files(spark, d), ["*.csv", "*.xlsx"])


def inputs(spark, d):
    names = ["events", "supplier", "customer", "det_cleaned", "vloc"]
    return checks.path_report(spark, {n: posixpath.join(d, f"{n}.parquet") for n in names})


def detection_rules(spark, d):
    key = F.col("event_id")
    rows = det(spark, d).withColumns(
        {
            "time": F.when(key % 17 != 0, F.col("time")),
            "elasmo": F.when(key % 13 != 0, F.col("elasmo")),
            "location": F.when(key % 11 == 0, " ").when(key % 7 != 0, F.col("location")),
        }
    )
    required = {"time": "timestamp", "elasmo": "bigint", "location": "string", "station": "bigint", "sensor_unit": "string"}
    named = checks.Rule("a sensor value has a unit", ["sensor_value", "sensor_unit"], lambda v, u: v.isNotNull() & u.isNull())
    return checks.rule_report(rows, [*checks.DETECTION_RULES, named], required)


def parameter_rules(spark, d):
    """Parameters of reports, one set per order."""
    key = F.col("o_orderkey")
    rows = load(spark, d, "orders").select(
        (key % 5 - 1).cast("double").alias("time_window_hours"),
        F.when(key % 10 != 0, (key % 7) / F.lit(2.0)).alias("step_days"),
        F.when(key % 3 != 0, F.col("o_orderdate")).alias("start"),
        (F.col("o_orderdate") + F.make_dt_interval(days=(F.col("o_custkey") % 9 - 3).cast("int"))).alias("end"),
    )
    return checks.rule_report(rows, checks.PARAMETER_RULES)


def coerced(spark, d):
    """Ids as text in the detections and as numbers in the tag table; a text that is no number meets nothing."""
    key = F.col("event_id")
    rows = det(spark, d).drop("location")
    text = F.when(key % 6 == 0, F.concat(F.lit(" "), "elasmo", F.lit(".0"))).when(key % 6 == 1, F.lit("A7")).otherwise(F.col("elasmo").cast("string"))
    return shown(compile_detections(rows.withColumn("elasmo", text), vmov(spark, d), ind(spark, d), TZ).detections)


def empty_period(spark, d):
    """The columns and types of summary and matrix of a period without detections, and their rows."""
    rows = assign_period(det(spark, d), start="2031-01-01", end="2032-01-01")
    parts = []
    for name, out in (("summary", summary.individual_summary(rows, ind(spark, d), TZ)), ("matrix", summary.detection_matrix(rows, ids=[1, 2]))):
        columns = [F.struct(F.lit(name).alias("report"), F.lit(c).alias("name"), F.lit(t).alias("type")) for c, t in out.dtypes]
        parts.append(out.agg(F.count(F.lit(1)).alias("rows")).select(F.inline(F.array(*columns)), "rows"))
    return parts[0].unionAll(parts[1])


SUMMARY_TYPES = {
    "interval_id": "int", "id": "bigint", "species": "string", "date_tagged": "string", "sex": "string", "pcl": "double", "fl": "double",
    "tl": "double", "stl": "double", "total_detections": "bigint", "total_stations_detected": "bigint", "total_days_detected": "bigint",
    "first_appearance": "string", "last_appearance": "string", "days_at_liberty": "double", "residency_index": "double",
}
MATRIX_TYPES = {"interval_id": "int", "location": "string", "1": "bigint", "2": "bigint"}

QUERIES = {
    "csv_ragged_rows": (
        ragged,
        "SELECT "
        + ", ".join(f"'{n}_' || CAST(event_id % {i + 2} AS VARCHAR) AS {n}" for i, n in enumerate(NAMES[:7]))
        + ", CAST(event_id AS VARCHAR) AS c8, CAST(NULL AS VARCHAR) AS c9, CAST(NULL AS VARCHAR) AS c10 FROM events",
    ),
    "check_file_patterns": (
        patterns,
        """SELECT 'a file matches *.csv' AS rule, (count(*) = 0)::BIGINT AS broken FROM events
        UNION ALL SELECT 'a file matches *.xlsx', 1""",
    ),
    "check_required_inputs": (
        inputs,
        """SELECT name || ' exists' AS rule, (name NOT IN (SELECT table_name FROM information_schema.tables))::BIGINT AS broken
        FROM (VALUES ('events'), ('supplier'), ('customer'), ('det_cleaned'), ('vloc')) t(name)""",
    ),
    "check_detection_rules": (
        detection_rules,
        """SELECT unnest(['time is timestamp', 'elasmo is bigint', 'location is string', 'station is bigint', 'sensor_unit is string',
            'a detection has a time', 'a detection has a tag', 'a detection has a location', 'a sensor value has a unit']) AS rule,
        unnest([0, 0, 0, 1, 1, count_if(event_id % 17 = 0), count_if(event_id % 13 = 0), count_if(event_id % 11 = 0 OR event_id % 7 = 0), NULL]::BIGINT[])
            AS broken FROM events""",
    ),
    "check_parameters": (
        parameter_rules,
        """SELECT unnest(['time_window_hours is positive', 'step_days is a positive whole number', 'start is not after end']) AS rule,
        unnest([count_if(o_orderkey % 5 <= 1), count_if(o_orderkey % 10 = 0 OR o_orderkey % 7 = 0 OR o_orderkey % 7 % 2 = 1),
            count_if(o_orderkey % 3 <> 0 AND o_custkey % 9 < 3)]::BIGINT[]) AS broken FROM orders""",
    ),
    "coerced_ids_compiled": (
        coerced,
        with_tables(
            "SELECT * FROM compiled WHERE event_id % 6 <> 1", "det", "ind", "vmov", AFTER_SQL.format(hours=24), COMPILED_SQL
        ),
    ),
    "empty_period_summary": (
        empty_period,
        "SELECT report, name, type, rows FROM (VALUES "
        + ", ".join(f"('{r}', '{n}', '{t}')" for r, kinds in (("summary", SUMMARY_TYPES), ("matrix", MATRIX_TYPES)) for n, t in kinds.items())
        + ") t(report, name, type), (SELECT count(*) AS rows FROM events WHERE ts >= TIMESTAMP '2031-01-01')",
    ),
}
