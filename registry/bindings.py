"""The given tables seen as detections, tags, deployments and sheets, in Spark and in SQL.

Both forms of a binding stand next to each other. Timestamps of the given tables carry no zone
and are read as UTC instants.
"""

from __future__ import annotations

import posixpath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trackspark.session import configure

TZ = "America/New_York"

COLUMNS = {
    "events": "event_id bigint, ts timestamp, user_id bigint, event_type string, value double",
    "customer": "c_custkey bigint, c_name string, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_acctbal double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
}


def load(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A given table with declared types: filters on instants reach the Parquet scan."""
    configure(spark)
    return spark.read.schema(COLUMNS[name]).parquet(posixpath.join(folder, f"{name}.parquet"))


def shown(df: DataFrame) -> DataFrame:
    """Instants as zone-free timestamps, so that collecting does not depend on the Python zone."""
    instants = [f.name for f in df.schema if isinstance(f.dataType, T.TimestampType)]
    return df.withColumns({c: F.col(f"`{c}`").cast("timestamp_ntz") for c in instants}) if instants else df


def local(x: str) -> str:
    """SQL: clock reading in the data zone of a UTC timestamp."""
    return f"(({x}) AT TIME ZONE 'UTC' AT TIME ZONE '{TZ}')"


def instant(x: str) -> str:
    """SQL: UTC timestamp of a clock reading in the data zone."""
    return f"(({x}) AT TIME ZONE '{TZ}' AT TIME ZONE 'UTC')"


def with_tables(body: str, *ctes: str) -> str:
    return "WITH " + ",\n".join(SQL[c] if c in SQL else c for c in ctes) + "\n" + body


def det(spark: SparkSession, folder: str) -> DataFrame:
    """Detections: events; every fifth tag has a number that no animal carries."""
    return load(spark, folder, "events").select(
        F.col("ts").alias("time"),
        (F.col("user_id") % 10).cast("string").alias("station"),
        F.when(F.col("user_id") % 5 == 0, -F.col("user_id")).otherwise(F.col("user_id")).alias("elasmo"),
        F.concat(F.lit("AG"), (F.col("event_id") % 4).cast("string")).alias("agency"),
        F.col("event_type").alias("location"),
        "event_id",
    )


def det_sites(spark: SparkSession, folder: str) -> DataFrame:
    """Detections whose location is the one their station is deployed at."""
    return det(spark, folder).withColumn("location", F.concat(F.lit("loc_"), (F.abs("elasmo") % 5).cast("string")))


def ind(spark: SparkSession, folder: str) -> DataFrame:
    """Tags: the customers."""
    start = F.lit("2023-12-25 12:00:00").cast("timestamp")
    return load(spark, folder, "customer").select(
        F.col("c_custkey").alias("acoustic_tag_id"),
        (start + F.make_dt_interval(days=(F.col("c_custkey") % 20).cast("int"))).alias("tagging_datetime"),
        F.col("c_mktsegment").alias("species"),
        (F.col("c_custkey") % 2).cast("string").alias("sex"),
        F.col("c_acctbal").alias("pcl"),
        (F.col("c_acctbal") + 1).alias("fl"),
        (F.col("c_acctbal") + 2).alias("tl"),
        F.lit(None).cast("double").alias("stl"),
        F.lit(25.5).alias("latitude"),
        F.lit(-79.25).alias("longitude"),
        F.when(F.col("c_custkey") % 5 != 0, F.concat(F.lit("site "), (F.col("c_custkey") % 3).cast("string"))).alias("site"),
    )


def vmov(spark: SparkSession, folder: str) -> DataFrame:
    """Deployments: suppliers, disjoint per station."""
    start = F.lit("2024-01-01 00:00:00").cast("timestamp")
    day = (F.floor(F.col("s_suppkey") / 10) * 3).cast("int")
    return load(spark, folder, "supplier").select(
        (F.col("s_suppkey") % 10).cast("string").alias("station"),
        (start + F.make_dt_interval(days=day)).alias("date_in"),
        (start + F.make_dt_interval(days=day, hours=F.lit(60))).alias("date_out"),
        F.concat(F.lit("loc_"), (F.col("s_suppkey") % 5).cast("string")).alias("location"),
        "s_suppkey",
    )


def vmov_long(spark: SparkSession, folder: str) -> DataFrame:
    """Deployments of up to 39 days that overlap."""
    days = (F.col("s_suppkey") % 40).cast("int")
    return vmov(spark, folder).withColumn("date_out", F.col("date_in") + F.make_dt_interval(days=days))


def det_years(spark: SparkSession, folder: str) -> DataFrame:
    """Detections over several years: orders."""
    return load(spark, folder, "orders").select(
        F.col("o_orderdate").alias("time"), F.col("o_custkey").alias("elasmo"), F.col("o_orderkey").alias("event_id")
    )


def ind_years(spark: SparkSession, folder: str) -> DataFrame:
    """Tags deployed over several years: customers."""
    start = F.lit("1995-03-01 00:00:00").cast("timestamp")
    return load(spark, folder, "customer").select(
        F.col("c_custkey").alias("acoustic_tag_id"),
        F.col("c_mktsegment").alias("species"),
        (start + F.make_dt_interval(days=(F.col("c_custkey") % 1200).cast("int"))).alias("tagging_datetime"),
    )


def vloc_types(spark: SparkSession, folder: str) -> DataFrame:
    """Registry listing some locations twice: the event types."""
    names = load(spark, folder, "events").select(F.col("event_type").alias("location")).distinct()
    return names.unionAll(names.where(F.col("location") < "e"))


def coordinates(spark: SparkSession, folder: str) -> DataFrame:
    """Text coordinates of differing precision: suppliers."""
    key = F.col("s_suppkey")
    return load(spark, folder, "supplier").select(
        F.concat(F.lit("loc_"), (key % 5).cast("string")).alias("location"),
        F.concat(F.lit("31."), F.substring(F.lit("1937524"), F.lit(1), (key % 6 + 1).cast("int"))).alias("deploy_lat"),
        F.concat(F.lit("-64."), F.substring(F.lit("8162075"), F.lit(1), (key % 4 + 1).cast("int"))).alias("deploy_long"),
        F.concat(F.lit("AG"), (key % 4).cast("string")).alias("agency"),
        "s_suppkey",
    )


CONTACTS = {"c0": "AG0", "c1": "AG1", "c2": "AG2", "c3": "AG3"}
COUNTRIES = {"AG0": "North", "AG1": "North", "AG2": "South"}

SQL = {
    "det": """det AS (SELECT CAST(ts AS TIMESTAMP) AS time, CAST(user_id % 10 AS VARCHAR) AS station,
        CASE WHEN user_id % 5 = 0 THEN -user_id ELSE user_id END AS elasmo,
        'AG' || CAST(event_id % 4 AS VARCHAR) AS agency, event_type AS location, event_id FROM events)""",
    "det_sites": """det AS (SELECT CAST(ts AS TIMESTAMP) AS time, CAST(user_id % 10 AS VARCHAR) AS station,
        CASE WHEN user_id % 5 = 0 THEN -user_id ELSE user_id END AS elasmo, 'AG' || CAST(event_id % 4 AS VARCHAR) AS agency,
        'loc_' || CAST(user_id % 5 AS VARCHAR) AS location, event_id FROM events)""",
    "ind": """ind AS (SELECT c_custkey AS acoustic_tag_id,
        TIMESTAMP '2023-12-25 12:00:00' + to_days(CAST(c_custkey % 20 AS INTEGER)) AS tagging_datetime,
        c_mktsegment AS species, CAST(c_custkey % 2 AS VARCHAR) AS sex, c_acctbal AS pcl, c_acctbal + 1 AS fl,
        c_acctbal + 2 AS tl, CAST(NULL AS DOUBLE) AS stl, 25.5::DOUBLE AS latitude, -79.25::DOUBLE AS longitude,
        CASE WHEN c_custkey % 5 <> 0 THEN 'site ' || CAST(c_custkey % 3 AS VARCHAR) END AS site
        FROM customer)""",
    "vmov": """vmov AS (SELECT CAST(s_suppkey % 10 AS VARCHAR) AS station,
        TIMESTAMP '2024-01-01 00:00:00' + to_days(CAST(s_suppkey // 10 * 3 AS INTEGER)) AS date_in,
        TIMESTAMP '2024-01-01 00:00:00' + to_days(CAST(s_suppkey // 10 * 3 AS INTEGER)) + INTERVAL 60 HOURS AS date_out,
        'loc_' || CAST(s_suppkey % 5 AS VARCHAR) AS location, s_suppkey FROM supplier)""",
    "vmov_long": """vmov AS (SELECT CAST(s_suppkey % 10 AS VARCHAR) AS station,
        TIMESTAMP '2024-01-01 00:00:00' + to_days(CAST(s_suppkey // 10 * 3 AS INTEGER)) AS date_in,
        TIMESTAMP '2024-01-01 00:00:00' + to_days(CAST(s_suppkey // 10 * 3 + s_suppkey % 40 AS INTEGER)) AS date_out,
        'loc_' || CAST(s_suppkey % 5 AS VARCHAR) AS location, s_suppkey FROM supplier)""",
    "det_years": """det AS (SELECT CAST(o_orderdate AS TIMESTAMP) AS time, o_custkey AS elasmo, o_orderkey AS event_id
        FROM orders)""",
    "ind_years": """ind AS (SELECT c_custkey AS acoustic_tag_id, c_mktsegment AS species,
        TIMESTAMP '1995-03-01 00:00:00' + to_days(CAST(c_custkey % 1200 AS INTEGER)) AS tagging_datetime FROM customer)""",
    "vloc_types": """names AS (SELECT DISTINCT event_type AS location FROM events),
        vloc AS (SELECT location FROM names UNION ALL SELECT location FROM names WHERE location < 'e')""",
    "coordinates": """coords AS (SELECT 'loc_' || CAST(s_suppkey % 5 AS VARCHAR) AS location,
        '31.' || substr('1937524', 1, CAST(1 + s_suppkey % 6 AS INTEGER)) AS deploy_lat,
        '-64.' || substr('8162075', 1, CAST(1 + s_suppkey % 4 AS INTEGER)) AS deploy_long,
        'AG' || CAST(s_suppkey % 4 AS VARCHAR) AS agency, s_suppkey FROM supplier)""",
    "contacts": """contacts(contact, agency) AS (VALUES ('c0', 'AG0'), ('c1', 'AG1'), ('c2', 'AG2'), ('c3', 'AG3'))""",
    "countries": """countries(agency, country) AS (VALUES ('AG0', 'North'), ('AG1', 'North'), ('AG2', 'South'))""",
}
