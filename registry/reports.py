"""Period summaries, receiver activity, timelines and residency."""

from __future__ import annotations

from pyspark.sql import functions as F

from registry.bindings import (
    COUNTRIES,
    TZ,
    det,
    det_sites,
    det_years,
    ind,
    ind_years,
    instant,
    local,
    shown,
    vloc_types,
    vmov,
    vmov_long,
    with_tables,
)
from trackspark.operators import activity, residency, rollup, summary, timeline
from trackspark.operators.periods import TimeGrid, assign_period, period_table, time_window
from trackspark.plans import reports

# --- periods ---------------------------------------------------------------------------------

PERIOD_ID = f"""CAST((year({local('time')}) - year({local('(SELECT min(time) FROM det)')})) * 12
    + month({local('time')}) - month({local('(SELECT min(time) FROM det)')}) + 1 AS INTEGER)"""
# The last time of the bound tables is never an exact month start, so every row lies in a period.


def periods_monthly(spark, d):
    return shown(period_table(det_years(spark, d), monthly=True, tz=TZ))


def periods_full(spark, d):
    return shown(period_table(det(spark, d)))


def assigned_monthly(spark, d):
    return assign_period(det_years(spark, d), monthly=True, tz=TZ).select("event_id", "elasmo", "interval_id")


def assigned_full(spark, d):
    rows = assign_period(det(spark, d), start="2024-01-05 00:00:00", end="2024-01-20 12:00:00")
    return rows.select("event_id", "elasmo", "interval_id")


def window(spark, d):
    return shown(time_window(det(spark, d), "2024-01-05", "2024-01-20 12:00:00", TZ))


# --- summary and matrix ----------------------------------------------------------------------


def summarised(min_days=None):
    def run(spark, d):
        rows = assign_period(det(spark, d), monthly=True, tz=TZ)
        return summary.individual_summary(rows, ind(spark, d), TZ, min_days)

    return run


def rolled_up(full):
    """Summaries read from the monthly roll-up: of each month, or of all time."""

    def run(spark, d):
        return reports.rollup_summaries(rollup.monthly_rollup(det(spark, d), TZ), ind(spark, d), TZ)[full]

    return run


def rolled_up_totals(spark, d):
    """Totals over the middle two of five years, merged from months."""
    rolled = rollup.monthly_rollup(det_years(spark, d).withColumn("location", (F.col("event_id") % 7).cast("string")), TZ)
    return shown(rollup.totals_of_rollup(rolled, ("1995-01", "1996-12")).drop("difd", "difh"))


def active_by_quarter(spark, d):
    rolled = rollup.monthly_rollup(det_years(spark, d).withColumn("location", F.lit("x")))
    quarter = F.concat(F.substring("ym", 1, 4), F.lit("Q"), F.quarter(F.to_date(F.concat("ym", F.lit("-01")))).cast("string"))
    return rollup.merged_tags(rollup.tag_bitmaps(rolled, ind_years(spark, d)), quarter)


def summary_sql(min_days: int = 0, period: str = PERIOD_ID) -> str:
    return with_tables(
        f"""SELECT interval_id, acoustic_tag_id AS id, species, strftime({local('tagging_datetime')}, '%Y-%m-%d %H:%M')
        AS date_tagged, sex, round_even(pcl, 2) AS pcl, round_even(fl, 2) AS fl, round_even(tl, 2) AS tl, stl,
        n AS total_detections, stations AS total_stations_detected, days AS total_days_detected,
        strftime({local('lo')}, '%Y-%m-%d %H:%M') AS first_appearance,
        strftime({local('hi')}, '%Y-%m-%d %H:%M') AS last_appearance,
        round_even(liberty, 2) AS days_at_liberty, round_even(days / liberty, 2) AS residency_index
        FROM (SELECT *, greatest(1.0::DOUBLE, (epoch_us(hi) - epoch_us(tagging_datetime))::DOUBLE / 86400000000.0::DOUBLE) AS liberty
              FROM ind JOIN totals ON acoustic_tag_id = elasmo) WHERE days >= {min_days}""",
        "det",
        "ind",
        f"""totals AS (SELECT {period} AS interval_id, elasmo, count(*) AS n, min(time) AS lo, max(time) AS hi,
        count(DISTINCT location) AS stations, count(DISTINCT CAST({local('time')} AS DATE)) AS days FROM det GROUP BY 1, 2)""",
    )


def kept_by_days(spark, d):
    return shown(summary.detections_with_min_days(det(spark, d), TZ, 27))


def spans(spark, d):
    return shown(summary.detection_totals(det(spark, d), TZ).select("elasmo", "mintime", "maxtime", "difd", "difh"))


def counts(spark, d):
    return summary.detection_counts(det(spark, d))


def tenths(spark, d):
    return det(spark, d).withColumn("elasmo", F.pmod("elasmo", F.lit(10)))


def matrix(by_agency):
    return lambda spark, d: summary.detection_matrix(tenths(spark, d), by_agency)


def lists(spark, d):
    rows = assign_period(det(spark, d), monthly=True, tz=TZ)
    counted = summary.count_lists(summary.detection_counts(rows))
    # A text per group, so that any engine shows it alike.
    cell = F.transform("counts", lambda x: F.concat_ws(":", x["elasmo"], x["n"]))
    return counted.select("interval_id", "location", F.array_join(cell, " ").alias("counts"))


LISTS = with_tables(
    f"""SELECT interval_id, location, string_agg(elasmo || ':' || n, ' ' ORDER BY elasmo) AS counts FROM (
        SELECT {PERIOD_ID} AS interval_id, location, elasmo, count(*) AS n FROM det GROUP BY 1, 2, 3) GROUP BY 1, 2""",
    "det",
)


def matrix_sql(group: str) -> str:
    cells = ", ".join(f'count_if((elasmo % 10 + 10) % 10 = {i}) AS "{i}"' for i in range(10))
    return with_tables(f"SELECT {group}, {cells} FROM det GROUP BY {group}", "det")


BLOCK = 7


def blocked(spark, d):
    """The matrices of both months over all tags, seven columns a block; a text per row, so that any engine shows it alike."""
    rows = assign_period(det(spark, d), monthly=True, tz=TZ)
    dense = summary.matrix_rows(summary.detection_counts(rows), width=BLOCK)
    return dense.select("interval_id", "block", "location", F.array_join("tags", ",").alias("tags"), F.array_join(F.col("counts").cast("array<string>"), ",").alias("counts"))


BLOCKED = with_tables(
    f"""SELECT interval_id, block, location, string_agg(CAST(elasmo AS VARCHAR), ',' ORDER BY elasmo) AS tags,
        string_agg(CAST(coalesce(n, 0) AS VARCHAR), ',' ORDER BY elasmo) AS counts
        FROM blocks JOIN (SELECT DISTINCT interval_id, location FROM counted) USING (interval_id)
        LEFT JOIN counted USING (interval_id, location, elasmo) GROUP BY ALL""",
    "det",
    f"counted AS (SELECT {PERIOD_ID} AS interval_id, location, elasmo, count(*) AS n FROM det GROUP BY 1, 2, 3)",
    f"""blocks AS (SELECT interval_id, elasmo, CAST((row_number() OVER (PARTITION BY interval_id ORDER BY elasmo) - 1) // {BLOCK} AS INTEGER) AS block
        FROM (SELECT DISTINCT interval_id, elasmo FROM counted))""",
)

# --- receiver activity -----------------------------------------------------------------------


def corrections(spark, d):
    moves = vmov(spark, d)
    failed = moves.where(F.col("s_suppkey") % 9 == 0).select("location", "date_in").distinct()
    moved = moves.where(F.col("s_suppkey") % 7 == 0).groupBy("location", "date_in")
    return failed, moved.agg((F.max("date_out") + F.expr("INTERVAL 1 DAY")).alias("date_out"))


def clean_moves(spark, d):
    failed, moved = corrections(spark, d)
    return shown(activity.clean_receiver_deployments(vmov(spark, d), failed, moved))


CLEAN_MOVES = """moved AS (SELECT location, date_in, max(date_out) + INTERVAL 1 DAY AS new_out FROM vmov
        WHERE s_suppkey % 7 = 0 GROUP BY 1, 2),
    usable AS (SELECT station, date_in, coalesce(new_out, date_out) AS date_out, location, s_suppkey
        FROM vmov LEFT JOIN moved USING (location, date_in)
        WHERE (location, date_in) NOT IN (SELECT (location, date_in) FROM vmov WHERE s_suppkey % 9 = 0))"""


def weeks_deployed(spark, d):
    return activity.weekly_deployments(vmov_long(spark, d), TZ)


def unusable(spark, d):
    """Corrected deployments with the ends of some swapped: those have no weeks."""
    moves = vmov(spark, d)
    swap = F.col("location") == "loc_3"
    swapped = moves.withColumn("date_out", F.when(swap, F.col("date_in") - F.expr("INTERVAL 3 DAYS")).otherwise(F.col("date_out")))
    return shown(activity.unusable_ranges(swapped, TZ))


def weeks_detected(spark, d):
    return shown(activity.weekly_detections(det_sites(spark, d), vmov_long(spark, d), "AG0", TZ))


DEPLOYED = f"""deployed AS (SELECT station, CAST({local('date_in')} AS DATE) AS date_in, CAST({local('date_out')} AS DATE) AS date_out,
    location, s_suppkey FROM vmov),
    deployed_weeks AS (SELECT *, CAST(unnest(generate_series(date_in, date_out, INTERVAL 7 DAYS)) AS DATE) AS weeks,
    'Rec. mov.' AS source FROM deployed WHERE date_in <= date_out)"""
DETECTED = f"""days AS (SELECT location, station, CAST({local('time')} AS DATE) AS date FROM det WHERE agency = 'AG0'),
    ranges AS (SELECT location, station, date_in, date_out, min(date) AS start_date, max(date) AS end_date
        FROM days JOIN vmov USING (location, station)
        WHERE date BETWEEN CAST({local('date_in')} AS DATE) AND CAST({local('date_out')} AS DATE) GROUP BY ALL),
    detected_weeks AS (SELECT *, min(start_date) OVER (PARTITION BY location) AS min_start_date,
        CAST(unnest(generate_series(start_date, end_date, INTERVAL 7 DAYS)) AS DATE) AS weeks, 'Det.' AS source FROM ranges)"""


def activity_offset(spark, d):
    return reports.receiver_activity(det_sites(spark, d), vmov_long(spark, d), "AG0", TZ)


ACTIVITY_SQL = """SELECT location, weeks, source, dense_rank() OVER (ORDER BY location)::DOUBLE
    + CASE WHEN source = 'Det.' THEN 0.4::DOUBLE ELSE 0.0::DOUBLE END AS y_position
    FROM (SELECT location, weeks, source FROM deployed_weeks UNION ALL SELECT location, weeks, source FROM detected_weeks)"""


# --- timeline --------------------------------------------------------------------------------

STEP, LEFT = 4, 2


def base(spark, d, **options):
    return timeline.timeline_base(det(spark, d), ind(spark, d), vloc_types(spark, d), ["site 1"], **options)


def timeline_base(spark, d):
    return shown(base(spark, d))


def timeline_species(spark, d):
    return shown(base(spark, d, species="MACHINERY", dedupe_right=True))


BASE = """base AS (SELECT time, station, elasmo, agency, det.location, tagging_datetime, species, sex, pcl, fl, tl, stl,
    latitude, longitude FROM det JOIN ind ON elasmo = acoustic_tag_id
    {vloc} WHERE coalesce(site <> 'site 1', true) {where})"""
BASE_ALL = BASE.format(vloc="LEFT JOIN vloc ON det.location = vloc.location", where="")


def grid_sql(source: str) -> str:
    return f"""extent AS (SELECT {instant(f"date_trunc('day', {local('min(time)')})")} - to_days({30 * LEFT}) AS lo,
        {instant(f"date_trunc('day', {local('max(time)')})")} AS hi FROM {source}),
    size AS (SELECT lo, ceil((epoch_us(hi) - epoch_us(lo))::DOUBLE / 86400000000.0::DOUBLE) / {STEP}.0::DOUBLE AS l FROM extent),
    grid AS (SELECT CAST(i + 1 AS INTEGER) AS bin, {instant(f"date_trunc('day', {local(f'lo + to_days(CAST({STEP} * i AS INTEGER))')})")} AS date
        FROM (SELECT lo, unnest(range(CAST(ceil(l + 0.4::DOUBLE * l) AS BIGINT))) AS i FROM size))"""


def time_grid(spark, d):
    return shown(TimeGrid(det_years(spark, d), STEP, LEFT, TZ).table())


def time_bins(spark, d):
    rows = det_years(spark, d)
    return shown(TimeGrid(rows, STEP, LEFT, TZ).add_bin(rows, date="date").select("event_id", "time", "bin", "date"))


def config():
    return reports.TimelineConfig(tz=TZ, step_days=STEP, months_left=LEFT, exclude_site=["site 1"], agency_country=COUNTRIES)


def tables(spark, d):
    return reports.timeline_tables(det(spark, d), ind(spark, d), vloc_types(spark, d), config())


def timeline_rows(spark, d):
    return shown(tables(spark, d).rows)


RANKED = """ranked AS (SELECT elasmo, CAST(row_number() OVER (ORDER BY species, elasmo) AS INTEGER) AS indice, species
    FROM (SELECT elasmo, min(species) AS species FROM base GROUP BY elasmo))"""
MARKERS = """markers AS (SELECT ind.acoustic_tag_id AS elasmo, ind.species, sex, stl, tagging_datetime, indice, grid.date
    FROM ind JOIN ranked ON ind.acoustic_tag_id = ranked.elasmo ASOF LEFT JOIN grid ON tagging_datetime >= grid.date)"""
BASE_TABLES = ("det", "ind", "vloc_types", BASE_ALL)


def ordinals(spark, d):
    return timeline.tag_ordinals(base(spark, d))


def markers(spark, d):
    return shown(tables(spark, d).markers)


def legend(spark, d):
    return tables(spark, d).legend


def label_positions(spark, d):
    return tables(spark, d).label_positions


# --- residency -------------------------------------------------------------------------------


def active(spark, d):
    return residency.active_tags(det_years(spark, d), ind_years(spark, d))


def deployed(scope):
    return lambda spark, d: residency.deployed_tags(ind_years(spark, d), det_years(spark, d), scope=scope)


def joined(spark, d, scope="species"):
    a, b = det_years(spark, d), ind_years(spark, d)
    return residency.join_activity_deployment(residency.active_tags(a, b), residency.deployed_tags(b, a, scope=scope))


def skeleton(spark, d):
    return residency.skeleton_grid(joined(spark, d), det_years(spark, d), ind_years(spark, d))


def monthly(spark, d):
    out = reports.monthly_residency(det_years(spark, d), ind_years(spark, d), "UTC")
    return out.withColumn("mean_active_prop", F.round("mean_active_prop", 6))


def monthly_nan(spark, d):
    """NaN and infinity are shown as a kind, so that both engines print them alike."""
    out = reports.monthly_residency(det_years(spark, d), ind_years(spark, d), "UTC", "global", "nan")
    p = F.col("mean_active_prop")
    kind = F.when(F.isnan(p), "nan").when(p == float("inf"), "inf").otherwise("finite")
    return out.select("species", "month", kind.alias("kind"), F.when(kind == "finite", F.round(p, 6)).alias("share"))


ACTIVE = """active AS (SELECT species, strftime(time, '%Y-%m') AS ym, count(DISTINCT elasmo) AS active_count
    FROM det JOIN ind ON elasmo = acoustic_tag_id GROUP BY 1, 2)"""


def deployed_sql(scope: str) -> str:
    over = "PARTITION BY species ORDER BY date_tagged" if scope == "species" else "ORDER BY species, date_tagged"
    return f"""deployed AS (SELECT species, date_tagged,
        CAST(sum(n) OVER ({over} ROWS UNBOUNDED PRECEDING) AS BIGINT) AS cs
        FROM (SELECT species, strftime(tagging_datetime, '%Y-%m') AS date_tagged, count(DISTINCT acoustic_tag_id) AS n
        FROM ind WHERE acoustic_tag_id IN (SELECT elasmo FROM det) GROUP BY 1, 2))"""


JOINED = """joined AS (SELECT a.species, a.roll_date, active_count, cs FROM
    (SELECT species, CAST(ym || '-01' AS DATE) AS roll_date, active_count FROM active) a ASOF LEFT JOIN
    (SELECT species, CAST(date_tagged || '-01' AS DATE) AS m, cs FROM deployed) b ON a.species = b.species AND a.roll_date >= b.m)"""
SKELETON = """skeleton AS (SELECT species, CAST(unnest(generate_series((SELECT min(roll_date) FROM joined),
    (SELECT max(roll_date) FROM joined), INTERVAL 1 MONTH)) AS DATE) AS roll_date
    FROM (SELECT DISTINCT species FROM ind WHERE acoustic_tag_id IN (SELECT elasmo FROM det)))"""


def share_sql(undefined: str) -> str:
    return f"""shares AS (SELECT species, strftime(roll_date, '%m') AS month, CASE WHEN coalesce(cs, 0) = 0 THEN {undefined}
        ELSE round_even(coalesce(active_count, 0) / cs, 1) END AS share, coalesce(active_count, 0) AS active, coalesce(cs, 0) AS cs
        FROM skeleton LEFT JOIN joined USING (species, roll_date))"""


YEARS = ("det_years", "ind_years", ACTIVE)

QUERIES = {
    "period_table": (
        periods_monthly,
        with_tables(
            f"""SELECT CAST(row_number() OVER (ORDER BY p) AS INTEGER) AS index, {instant('p')} AS period FROM (
            SELECT unnest(generate_series(date_trunc('month', {local('min(time)')}),
            date_trunc('month', {local('max(time)')}) + INTERVAL 1 MONTH, INTERVAL 1 MONTH)) AS p FROM det)""",
            "det_years",
        ),
    ),
    "period_table_full": (
        periods_full,
        with_tables(
            """SELECT CAST(1 AS INTEGER) AS index, min(time) AS period FROM det
            UNION ALL SELECT 2, max(time) + INTERVAL 1 MINUTE FROM det""",
            "det",
        ),
    ),
    "assign_period": (assigned_monthly, with_tables(f"SELECT event_id, elasmo, {PERIOD_ID} AS interval_id FROM det", "det_years")),
    "assign_period_bounded": (
        assigned_full,
        with_tables(
            """SELECT event_id, elasmo, CAST(1 AS INTEGER) AS interval_id FROM det
            WHERE time >= TIMESTAMP '2024-01-05' AND time < TIMESTAMP '2024-01-20 12:01:00'""",
            "det",
        ),
    ),
    "time_window": (
        window,
        with_tables(
            f"""SELECT * FROM det WHERE time BETWEEN {instant("TIMESTAMP '2024-01-05'")}
            AND {instant("TIMESTAMP '2024-01-20 12:00:00'")}""",
            "det",
        ),
    ),
    "individual_summary": (summarised(), summary_sql()),
    "individual_summary_min_days": (summarised(22), summary_sql(22)),
    "rollup_summary_monthly": (rolled_up(0), summary_sql()),
    "rollup_summary_full": (rolled_up(1), summary_sql(period="CAST(1 AS INTEGER)")),
    "rollup_totals": (
        rolled_up_totals,
        with_tables(
            f"""SELECT elasmo, count(*) AS total_detection, min(time) AS mintime, max(time) AS maxtime,
            count(DISTINCT event_id % 7) AS nbrstation, count(DISTINCT CAST({local('time')} AS DATE)) AS nbrday
            FROM det WHERE year({local('time')}) IN (1995, 1996) GROUP BY elasmo""",
            "det_years",
        ),
    ),
    "rollup_active_tags_quarterly": (
        active_by_quarter,
        with_tables(
            """SELECT species, year(time) || 'Q' || quarter(time) AS period, count(DISTINCT elasmo) AS active_count
            FROM det JOIN ind ON elasmo = acoustic_tag_id GROUP BY 1, 2""",
            "det_years",
            "ind_years",
        ),
    ),
    "detections_min_days": (
        kept_by_days,
        with_tables(
            f"""SELECT * FROM det WHERE elasmo IN (SELECT elasmo FROM det GROUP BY elasmo
            HAVING count(DISTINCT CAST({local('time')} AS DATE)) >= 27)""",
            "det",
        ),
    ),
    "detection_spans": (
        spans,
        with_tables(
            """SELECT elasmo, min(time) AS mintime, max(time) AS maxtime,
            (epoch_us(max(time)) - epoch_us(min(time)))::DOUBLE / 86400000000.0::DOUBLE AS difd,
            (epoch_us(max(time)) - epoch_us(min(time)))::DOUBLE / 3600000000.0::DOUBLE AS difh FROM det GROUP BY elasmo""",
            "det",
        ),
    ),
    "detection_counts_long": (counts, with_tables("SELECT location, elasmo, count(*) AS n FROM det GROUP BY 1, 2", "det")),
    "detection_count_lists": (lists, LISTS),
    "detection_matrix_blocks": (blocked, BLOCKED),
    "detection_matrix_by_location": (matrix(False), matrix_sql("location")),
    "detection_matrix_by_agency": (matrix(True), matrix_sql("agency")),
    "clean_receiver_deployments": (
        clean_moves,
        with_tables("SELECT station, date_in, date_out, location, s_suppkey FROM usable", "vmov", CLEAN_MOVES),
    ),
    "weekly_deployment_activity": (
        weeks_deployed,
        with_tables("SELECT station, date_in, date_out, location, s_suppkey, weeks, source FROM deployed_weeks", "vmov_long", DEPLOYED),
    ),
    "unusable_deployment_ranges": (
        unusable,
        with_tables(
            """SELECT station, date_in, date_in - INTERVAL 3 DAYS AS date_out, location, s_suppkey FROM vmov
            WHERE location = 'loc_3'""",
            "vmov",
        ),
    ),
    "weekly_detection_activity": (
        weeks_detected,
        with_tables("SELECT * FROM detected_weeks", "det_sites", "vmov_long", DETECTED),
    ),
    "receiver_activity_offset": (activity_offset, with_tables(ACTIVITY_SQL, "det_sites", "vmov_long", DEPLOYED, DETECTED)),
    "timeline_base": (timeline_base, with_tables("SELECT * FROM base", *BASE_TABLES)),
    "timeline_base_species": (
        timeline_species,
        with_tables("SELECT * FROM base", "det", "ind", BASE.format(vloc="", where="AND species = 'MACHINERY'")),
    ),
    "time_grid": (time_grid, with_tables("SELECT bin, date FROM grid", "det_years", grid_sql("det"))),
    "time_bins": (
        time_bins,
        with_tables(
            "SELECT event_id, time, coalesce(bin, 0) AS bin, date FROM det ASOF LEFT JOIN grid ON time >= date",
            "det_years",
            grid_sql("det"),
        ),
    ),
    "tag_ordinals": (ordinals, with_tables("SELECT elasmo, species, indice FROM ranked", *BASE_TABLES, RANKED)),
    "binned_timeline": (
        timeline_rows,
        with_tables(
            """SELECT base.*, coalesce(bin, 0) AS bin, date, country, indice FROM base LEFT JOIN countries USING (agency)
            JOIN ranked ON base.elasmo = ranked.elasmo ASOF LEFT JOIN grid ON time >= date""",
            *BASE_TABLES,
            RANKED,
            "countries",
            grid_sql("base"),
        ),
    ),
    "tagging_markers": (markers, with_tables("SELECT * FROM markers", *BASE_TABLES, RANKED, grid_sql("base"), MARKERS)),
    "legend_dimension": (
        legend,
        with_tables("SELECT DISTINCT agency, country FROM base LEFT JOIN countries USING (agency)", *BASE_TABLES, "countries"),
    ),
    "species_label_positions": (
        label_positions,
        with_tables("SELECT species, min(indice) AS position FROM ranked GROUP BY species", *BASE_TABLES, RANKED),
    ),
    "active_tags_monthly": (active, with_tables("SELECT * FROM active", *YEARS)),
    "deployed_tags_cumulative": (
        deployed("species"),
        with_tables("SELECT * FROM deployed", "det_years", "ind_years", deployed_sql("species")),
    ),
    "deployed_tags_cumulative_global": (
        deployed("global"),
        with_tables("SELECT * FROM deployed", "det_years", "ind_years", deployed_sql("global")),
    ),
    "asof_activity_deployment": (joined, with_tables("SELECT * FROM joined", *YEARS, deployed_sql("species"), JOINED)),
    "skeleton_grid": (skeleton, with_tables("SELECT * FROM skeleton", *YEARS, deployed_sql("species"), JOINED, SKELETON)),
    "monthly_residency": (
        monthly,
        with_tables(
            "SELECT species, month, round(avg(share), 6) AS mean_active_prop FROM shares GROUP BY 1, 2",
            *YEARS,
            deployed_sql("species"),
            JOINED,
            SKELETON,
            share_sql("0.0::DOUBLE"),
        ),
    ),
    "monthly_residency_nan": (
        monthly_nan,
        with_tables(
            """SELECT species, month, CASE WHEN bool_or(cs = 0 AND active = 0) THEN 'nan' WHEN bool_or(cs = 0) THEN 'inf'
            ELSE 'finite' END AS kind, CASE WHEN NOT bool_or(cs = 0) THEN round(avg(share), 6) END AS share
            FROM shares GROUP BY 1, 2""",
            *YEARS,
            deployed_sql("global"),
            JOINED,
            SKELETON,
            share_sql("NULL"),
        ),
    ),
}
