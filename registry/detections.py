"""Attribution, merging and cleaning of detections."""

from __future__ import annotations

from pyspark.sql import functions as F

from registry.bindings import (
    CONTACTS,
    COUNTRIES,
    TZ,
    coordinates,
    det,
    det_years,
    ind,
    load,
    local,
    shown,
    vmov,
    with_tables,
)
from trackspark.functions import times
from trackspark.operators import joins
from trackspark.operators.combine import most_precise_coordinates, union_by_name, update_receiver_registry
from trackspark.operators.isolation import flag_single_detections, remove_single_detections, removal_stats
from trackspark.operators.rows import distinct_per_source, keep_first
from trackspark.operators.timeline import add_country
from trackspark.plans.detections import combine_detections, compile_detections

DET = "time, station, elasmo, agency, location, event_id"


def flagged_sql(hours: int, source: str = "det") -> str:
    return f"""gaps AS (SELECT *,
        (epoch_us(lead(time) OVER w) - epoch_us(time))::DOUBLE / 3600000000.0::DOUBLE AS time_diff_to_next,
        (epoch_us(time) - epoch_us(lag(time) OVER w))::DOUBLE / 3600000000.0::DOUBLE AS time_diff_to_prev
        FROM {source} WINDOW w AS (PARTITION BY elasmo, location ORDER BY time, event_id)),
    flagged AS (SELECT *, CAST((time_diff_to_next IS NULL OR time_diff_to_next > {hours})
        AND (time_diff_to_prev IS NULL OR time_diff_to_prev > {hours}) AS INTEGER) AS single_detection FROM gaps)"""


STATS_SQL = """SELECT count(*) AS original, CAST(sum(single_detection) AS BIGINT) AS removed,
    count(*) - CAST(sum(single_detection) AS BIGINT) AS remaining,
    sum(single_detection)::DOUBLE / count(*)::DOUBLE * 100 AS removal_pct FROM flagged"""

AFTER_SQL = """tagged AS (SELECT det.* FROM det JOIN ind ON elasmo = acoustic_tag_id
    WHERE time >= tagging_datetime + INTERVAL {hours} HOURS)"""

COMPILED_SQL = """compiled AS (SELECT time, tagged.station, elasmo, agency, event_id, vmov.location FROM tagged
    JOIN vmov ON tagged.station = vmov.station AND time BETWEEN date_in AND date_out WHERE vmov.location IS NOT NULL)"""


def flag(spark, d):
    return shown(flag_single_detections(det(spark, d), 1, tie_break=["event_id"]))


def remove(spark, d):
    return shown(remove_single_detections(flag_single_detections(det(spark, d), 24, tie_break=["event_id"])))


def stats(spark, d):
    return removal_stats(flag_single_detections(det(spark, d), 24))


def known(spark, d):
    return shown(joins.known_tags(det(spark, d), ind(spark, d)))


def unknown(spark, d):
    return joins.unknown_tags(det(spark, d), ind(spark, d))


def lost(spark, d):
    before = joins.known_tags(det(spark, d), ind(spark, d))
    late = ind(spark, d).withColumn("tagging_datetime", F.col("tagging_datetime") + F.expr("INTERVAL 28 DAYS"))
    return joins.tags_lost(before, joins.detections_after_tagging(det(spark, d), late, 24))


def after(hours):
    return lambda spark, d: shown(joins.detections_after_tagging(det(spark, d), ind(spark, d), hours, TZ))


def placed(**options):
    def run(spark, d):
        deployments = vmov(spark, d)
        return shown(joins.interval_join(det(spark, d).drop("location"), deployments, ["station"], "time", "date_in", "date_out", **options))

    return run


PLACED_SQL = with_tables(
    """SELECT time, det.station, elasmo, agency, event_id, date_in, date_out, vmov.location, s_suppkey FROM det
    JOIN vmov ON det.station = vmov.station AND time BETWEEN date_in AND date_out""",
    "det",
    "vmov",
)


def placed_mixed(spark, d):
    """Deployments of one second, one per odd order, next to deployments of centuries."""
    key = F.col("o_orderkey")
    at = F.col("o_orderdate") + F.make_dt_interval(secs=(key % 86400).cast("decimal(18,6)"))
    orders = load(spark, d, "orders").select(at.alias("time"), (F.col("o_custkey") % 10).cast("string").alias("station"), "o_orderkey")
    short = orders.where(key % 2 == 1).select(
        "station", F.col("time").alias("date_in"), (F.col("time") + F.expr("INTERVAL 1 SECOND")).alias("date_out"), F.col("o_orderkey").alias("place")
    )
    supplier = F.col("s_suppkey")
    long = load(spark, d, "supplier").where(supplier % 25 == 0).select(
        F.floor(supplier / 25).cast("string").alias("station"),
        (F.lit("1800-01-01 00:00:00").cast("timestamp") + F.make_dt_interval(days=supplier.cast("int"))).alias("date_in"),
        F.lit("2130-01-01 00:00:00").cast("timestamp").alias("date_out"),
        (-supplier).alias("place"),
    )
    return joins.interval_join(orders, short.unionByName(long), ["station"], "time", "date_in", "date_out").select("o_orderkey", "place")


PLACED_MIXED_SQL = """WITH ords AS (SELECT CAST(o_orderdate AS TIMESTAMP) + to_seconds((o_orderkey % 86400)::DOUBLE) AS time,
        CAST(o_custkey % 10 AS VARCHAR) AS station, o_orderkey FROM orders)
    SELECT a.o_orderkey, b.o_orderkey AS place FROM ords a JOIN ords b ON a.station = b.station AND b.o_orderkey % 2 = 1
        AND a.time IN (b.time, b.time + INTERVAL 1 SECOND)
    UNION ALL SELECT o_orderkey, -s_suppkey FROM ords JOIN supplier ON s_suppkey % 25 = 0 AND station = CAST(s_suppkey // 25 AS VARCHAR)
        AND time BETWEEN TIMESTAMP '1800-01-01' + to_days(CAST(s_suppkey AS INTEGER)) AND TIMESTAMP '2130-01-01'"""


def compiled(spark, d):
    out = compile_detections(det(spark, d).drop("location"), vmov(spark, d), ind(spark, d), TZ)
    return shown(out.detections)


def cleaned(spark, d):
    out = compile_detections(det(spark, d).drop("location"), vmov(spark, d), ind(spark, d), TZ)
    flagged = flag_single_detections(out.detections, 24, tie_break=["event_id"])
    return shown(remove_single_detections(flagged))


def asof_deployment(**options):
    def run(spark, d):
        right = vmov(spark, d).select("station", "date_in", F.col("location").alias("deployed_at"), "s_suppkey")
        return shown(joins.asof_join(det(spark, d), right, ["station"], "time", "date_in", **options))

    return run


ASOF_SQL = with_tables(
    """SELECT time, det.station, elasmo, agency, det.location, event_id, vmov.location AS deployed_at, s_suppkey
    FROM det ASOF LEFT JOIN vmov ON det.station = vmov.station AND time >= date_in""",
    "det",
    "vmov",
)


def local_day(spark, d):
    t = F.col("time")
    return det(spark, d).select("event_id", times.local_date(t, TZ).alias("day"), times.clock_text(t, TZ).alias("clock"))


def month_text(spark, d):
    t = F.col("time")
    ym = times.year_month(t, TZ)
    return det_years(spark, d).select(
        "event_id", ym.alias("ym"), times.first_of_month(ym).alias("month_start"), F.date_format(times.wall_clock(t, TZ), "MM").alias("m")
    )


def foreign(spark, d):
    return load(spark, d, "events").select(
        F.col("ts").alias("time"),
        F.col("user_id").alias("elasmo"),
        F.col("event_type").alias("location"),
        F.concat(F.lit("c"), (F.col("event_id") % 6).cast("string")).alias("contact_poc"),
        F.floor(F.col("event_id") / 8).alias("payload"),
        F.concat(F.lit("f"), (F.col("event_id") % 4).cast("string")).alias("_source_file"),
    )


FOREIGN = """forn AS (SELECT CAST(ts AS TIMESTAMP) AS time, user_id AS elasmo, event_type AS location,
    'c' || CAST(event_id % 6 AS VARCHAR) AS contact_poc, event_id // 8 AS payload,
    'f' || CAST(event_id % 4 AS VARCHAR) AS source_file FROM events)"""


def agencies(spark, d):
    return shown(joins.map_lookup(foreign(spark, d).drop("_source_file"), CONTACTS, "contact_poc", "agency", ""))


def union_foreign(spark, d):
    own = det(spark, d).select("time", "elasmo", "location", "station", "agency")
    sent = joins.map_lookup(foreign(spark, d), CONTACTS, "contact_poc", "agency", "")
    return shown(union_by_name(own, sent.select("time", "elasmo", "location", "agency", "payload")))


def per_file(source):
    return lambda spark, d: distinct_per_source(foreign(spark, d).select("payload", "_source_file"), source)


def distinct_rows(spark, d):
    return shown(det_years(spark, d).select("time", (F.col("elasmo") % 50).alias("elasmo")).distinct())


def first_rows(spark, d):
    return shown(keep_first(det_years(spark, d), ["elasmo"], ["event_id"]))


def precise(spark, d):
    return most_precise_coordinates(coordinates(spark, d), ["s_suppkey"])


PRECISE = """best AS (SELECT location, arg_max(deploy_lat, length(regexp_replace(deploy_lat, '[^0-9]', '', 'g'))) AS lat,
    arg_max(deploy_long, length(regexp_replace(deploy_long, '[^0-9]', '', 'g'))) AS long FROM coords GROUP BY location)"""


def registry_input(spark, d):
    rows = coordinates(spark, d)
    own = rows.where(F.col("location") == "loc_1").select(
        F.col("deploy_lat").cast("double").alias("deploy_lat"),
        F.col("deploy_long").cast("double").alias("deploy_long"),
        "location",
        F.when(F.col("s_suppkey") % 2 == 0, 7.5).alias("bottom_depth"),
        F.lit(None).cast("double").alias("riser_length"),
        F.lit(3.25).alias("instrument_depth"),
        "agency",
    )
    return own, rows


def registry(spark, d):
    own, rows = registry_input(spark, d)
    return update_receiver_registry(own, rows, {"loc_2": 37.0}, {"loc_1": 61.5, "loc_3": 52.25}, ["s_suppkey"])


OWN_VLOC = """own AS (SELECT deploy_lat::DOUBLE AS deploy_lat, deploy_long::DOUBLE AS deploy_long, location,
    CASE WHEN s_suppkey % 2 = 0 THEN 7.5::DOUBLE END AS bottom_depth, CAST(NULL AS DOUBLE) AS riser_length,
    3.25::DOUBLE AS instrument_depth, agency FROM coords WHERE location = 'loc_1')"""
REGISTRY_SQL = """, foreign_rows AS (SELECT deploy_lat::DOUBLE AS deploy_lat, deploy_long::DOUBLE AS deploy_long, location, agency
    FROM {source} QUALIFY row_number() OVER (PARTITION BY deploy_lat::DOUBLE, deploy_long::DOUBLE ORDER BY {order}) = 1),
both_rows AS (SELECT * FROM own UNION ALL BY NAME
    SELECT *, CASE WHEN location = 'loc_2' THEN 37.0::DOUBLE END AS instrument_depth FROM foreign_rows)
SELECT deploy_lat, deploy_long, location, coalesce(bottom_depth, CASE location WHEN 'loc_1' THEN 61.5::DOUBLE
    WHEN 'loc_3' THEN 52.25::DOUBLE END) AS bottom_depth, riser_length, instrument_depth, agency FROM both_rows"""


def combine(spark, d):
    """Own detections united with foreign ones carrying text coordinates and untidy names."""
    sent = load(spark, d, "events").select(
        F.col("ts").alias("time"),
        (F.col("user_id") % 10).cast("string").alias("station"),
        F.concat((F.col("user_id") + 1000).cast("string"), F.lit(".0")).alias("elasmo"),
        F.concat(F.lit("  Far "), F.col("event_type"), F.lit("  Reef ")).alias("location"),
        F.concat(F.lit("24."), F.substring(F.lit("4268437"), F.lit(1), (F.col("event_id") % 6 + 1).cast("int"))).alias("deploy_lat"),
        F.lit("-79.1").alias("deploy_long"),
        F.lit("AG9").alias("agency"),
    )
    own, _ = registry_input(spark, d)
    return shown(combine_detections(det(spark, d), own, [sent])[0])


def country(spark, d):
    return add_country(det(spark, d).select("event_id", "agency"), COUNTRIES)


QUERIES = {
    "flag_single_detections": (
        flag,
        with_tables(f"SELECT {DET}, time_diff_to_next, time_diff_to_prev, single_detection FROM flagged", "det", flagged_sql(1)),
    ),
    "remove_single_detections": (
        remove,
        with_tables(f"SELECT {DET} FROM flagged WHERE single_detection = 0", "det", flagged_sql(24)),
    ),
    "removal_stats": (stats, with_tables(STATS_SQL, "det", flagged_sql(24))),
    "semi_known_tags": (
        known,
        with_tables(f"SELECT {DET} FROM det WHERE elasmo IN (SELECT acoustic_tag_id FROM ind)", "det", "ind"),
    ),
    "unknown_tags": (
        unknown,
        with_tables("SELECT DISTINCT elasmo FROM det WHERE elasmo NOT IN (SELECT acoustic_tag_id FROM ind)", "det", "ind"),
    ),
    "tags_lost_to_time_filter": (
        lost,
        with_tables(
            """SELECT elasmo FROM det JOIN ind ON elasmo = acoustic_tag_id
            GROUP BY elasmo HAVING count_if(time >= tagging_datetime + INTERVAL 29 DAYS) = 0""",
            "det",
            "ind",
        ),
    ),
    "detections_after_tagging": (after(0), with_tables(f"SELECT {DET} FROM tagged", "det", "ind", AFTER_SQL.format(hours=0))),
    "detections_after_tagging_24h": (
        after(24),
        with_tables(f"SELECT {DET} FROM tagged", "det", "ind", AFTER_SQL.format(hours=24)),
    ),
    "interval_join_deployments": (placed(), PLACED_SQL),
    "interval_join_unhinted": (placed(broadcast_mb=0), PLACED_SQL),
    "interval_join_mixed_lengths": (placed_mixed, PLACED_MIXED_SQL),
    "compile_detections": (
        compiled,
        with_tables("SELECT * FROM compiled", "det", "ind", "vmov", AFTER_SQL.format(hours=24), COMPILED_SQL),
    ),
    "clean_compiled_detections": (
        cleaned,
        with_tables(
            f"SELECT {DET} FROM flagged WHERE single_detection = 0",
            "det",
            "ind",
            "vmov",
            AFTER_SQL.format(hours=24),
            COMPILED_SQL,
            flagged_sql(24, "compiled"),
        ),
    ),
    "asof_detection_deployment": (asof_deployment(), ASOF_SQL),
    "asof_detection_deployment_stacked": (asof_deployment(broadcast_mb=0), ASOF_SQL),
    "dates_to_local_day": (
        local_day,
        with_tables(
            f"SELECT event_id, CAST({local('time')} AS DATE) AS day, strftime({local('time')}, '%Y-%m-%d %H:%M') AS clock FROM det",
            "det",
        ),
    ),
    "month_text": (
        month_text,
        with_tables(
            f"""SELECT event_id, strftime({local('time')}, '%Y-%m') AS ym,
            CAST(date_trunc('month', {local('time')}) AS DATE) AS month_start, strftime({local('time')}, '%m') AS m FROM det""",
            "det_years",
        ),
    ),
    "agency_lookup_default": (
        agencies,
        with_tables(
            """SELECT time, elasmo, location, contact_poc, payload, coalesce(agency, '') AS agency
            FROM forn LEFT JOIN contacts ON contact_poc = contact""",
            FOREIGN,
            "contacts",
        ),
    ),
    "union_foreign_detections": (
        union_foreign,
        with_tables(
            """SELECT time, elasmo, location, station, agency, CAST(NULL AS BIGINT) AS payload FROM det UNION ALL
            SELECT time, elasmo, location, NULL, coalesce(agency, ''), payload FROM forn
            LEFT JOIN contacts ON contact_poc = contact""",
            "det",
            FOREIGN,
            "contacts",
        ),
    ),
    "combine_detections": (
        combine,
        with_tables(
            f"""SELECT {DET} FROM det UNION ALL SELECT CAST(ts AS TIMESTAMP), CAST(user_id % 10 AS VARCHAR), user_id + 1000,
            'AG9', 'far_' || lower(event_type) || '_reef', NULL FROM events""",
            "det",
        ),
    ),
    "country_classification": (
        country,
        with_tables("SELECT event_id, det.agency, country FROM det LEFT JOIN countries USING (agency)", "det", "countries"),
    ),
    "distinct_rows": (distinct_rows, with_tables("SELECT DISTINCT time, elasmo % 50 AS elasmo FROM det", "det_years")),
    "distinct_keep_first": (
        first_rows,
        with_tables(
            "SELECT * FROM det QUALIFY row_number() OVER (PARTITION BY elasmo ORDER BY event_id) = 1", "det_years"
        ),
    ),
    "per_file_distinct": (
        per_file("_source_file"),
        with_tables("SELECT payload FROM (SELECT DISTINCT payload, source_file FROM forn)", FOREIGN),
    ),
    "all_files_distinct": (per_file(None), with_tables("SELECT DISTINCT payload FROM forn", FOREIGN)),
    "most_precise_coordinate": (
        precise,
        with_tables(
            "SELECT location, lat AS deploy_lat, long AS deploy_long, agency, s_suppkey FROM coords JOIN best USING (location)",
            "coordinates",
            PRECISE,
        ),
    ),
    "receiver_registry_update": (
        registry,
        with_tables("", "coordinates", OWN_VLOC) + REGISTRY_SQL.format(source="coords", order="s_suppkey"),
    ),
}
