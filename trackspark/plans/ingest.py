"""From exported files to the tables ``vloc``, ``vmov``, ``ind``, ``det`` and foreign detections."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trackspark.functions import text as tx
from trackspark.functions.times import parse_instant
from trackspark.operators.joins import map_lookup
from trackspark.operators.rows import distinct_per_source, keep_first
from trackspark.sources.checks import require_columns, require_list
from trackspark.sources.csv_files import SOURCE_FILE, SOURCE_ORDER, read_sheet, scan_csv_by_name
from trackspark.sources.tables import write_tables

# Fixed values of the exports: formats, labels and the placeholder of an unknown day.
SECOND_FORMAT = "%Y-%m-%d %H:%M:%S"
MINUTE_FORMAT = "%Y-%m-%d %H:%M"
RECEIVER_MODEL = "VR2W"
PLACEHOLDER_DATE = "2022-xxxxx"
DOWNLOADED = "Y"
PSEUDO_STATION = "release"
DEPLOYED_AT = "deploy_date_time_yyyy_mm_dd_thh_mm_ss"
RECOVERED_AT = "recover_date_time_yyyy_mm_dd_thh_mm_ss"
EXPORT_COLUMNS = {
    "time": "Date and Time (UTC)",
    "station": "Receiver",
    "elasmo": "Transmitter",
    "sensor_value": "Sensor Value",
    "sensor_unit": "Sensor Unit",
}
MATCHED_COLUMNS = {
    "time": "datecollected",
    "station": "receiver",
    "elasmo": "tagname",
    "sensor_value": "sensorvalue",
    "sensor_unit": "sensorunit",
    "location": "station",
    "deploy_lat": "latitude",
    "deploy_long": "longitude",
}
PRIVATE_COLUMNS = {
    "time": "Date and Time (UTC)",
    "station": "Receiver",
    "elasmo": "Transmitter",
    "location": "Station Name",
    "deploy_lat": "Latitude",
    "deploy_long": "Longitude",
}
FOREIGN_ORDER = (
    "time", "station", "elasmo", "sensor_value", "sensor_unit", "location", "deploy_lat", "deploy_long", "agency",
)


@dataclass(frozen=True)
class SheetRules:
    """Site-specific rules for deployment sheets.

    ``retired`` lists (station, latitude text) pairs, ``pending`` (station, deployment text)
    pairs; both are left out.
    """

    agency: str
    tz: str = "US/Eastern"
    model: str = RECEIVER_MODEL
    retired: tuple[tuple[str, str], ...] = ()
    pending: tuple[tuple[str, str], ...] = ()
    excluded: tuple[str, ...] | None = None
    placeholder: str = PLACEHOLDER_DATE
    downloaded: str = DOWNLOADED


@dataclass(frozen=True)
class ForeignRules:
    """Rules for detections sent in by other arrays.

    ``drop_unmapped`` leaves out rows whose contact has no agency; ``dedupe_scope`` is ``"file"``
    (equal rows of two files both stay) or ``"all"``.
    """

    contacts: Mapping[str, str] = field(default_factory=dict)
    tz: str = "US/Eastern"
    excluded: tuple[str, ...] | None = None
    location_rules: tuple[tuple[str, str], ...] = ()
    retired_locations: tuple[str, ...] = ()
    drop_unmapped: bool = True
    dedupe_scope: str = "file"


def _rename(df: DataFrame, names: Mapping[str, str], keep: Sequence[str] = ()) -> DataFrame:
    require_columns(df, names.values())
    kept = [c for c in (*keep, SOURCE_FILE) if c in df.columns]
    return df.select(*[F.col(f"`{old}`").alias(new) for new, old in names.items()], *kept)


def _without_pairs(a: Column, b: Column, pairs: Sequence[tuple[str, str]]) -> Column:
    out = F.lit(True)
    for x, y in pairs:
        out = out & ~((a == x) & (b == y))
    return out


def _usable_sheet_rows(sheet: DataFrame, rules: SheetRules) -> DataFrame:
    require_list("excluded", rules.excluded)
    return sheet.where(
        _without_pairs(F.col("station_no"), F.col("deploy_lat").cast("string"), rules.retired)
        & (F.col("ins_model_no") == rules.model)
        & tx.not_in(F.col("station_no"), rules.excluded)
    )


def _sheet_order(df: DataFrame) -> list[str]:
    return [c for c in SOURCE_ORDER if c in df.columns]


def receiver_locations(sheet: DataFrame, rules: SheetRules, order: Sequence[str] | None = None) -> DataFrame:
    """``vloc``: receiver locations, first row per (latitude, longitude, location)."""
    order = list(order) if order is not None else _sheet_order(sheet)
    typed = _usable_sheet_rows(sheet, rules).select(
        F.col("deploy_lat").try_cast("double").alias("deploy_lat"),
        F.col("deploy_long").try_cast("double").alias("deploy_long"),
        tx.norm_name(F.col("station_no")).alias("location"),
        *[F.col(c).try_cast("double").alias(c) for c in ("bottom_depth", "riser_length", "instrument_depth")],
        F.lit(rules.agency).alias("agency"),
        *order,
    )
    return keep_first(typed, ["deploy_lat", "deploy_long", "location"], order).drop(*order)


def receiver_deployments(sheet: DataFrame, rules: SheetRules) -> DataFrame:
    """``vmov``: complete deployment cycles with local times turned into instants."""
    deployed = F.col(DEPLOYED_AT)
    usable = _usable_sheet_rows(sheet, rules).where(
        (deployed != rules.placeholder)
        & (F.col("data_downloaded_y_n") == rules.downloaded)
        & _without_pairs(F.col("station_no"), deployed, rules.pending)
    )

    def instant(c: str) -> Column:
        return parse_instant(tx.first_t_to_blank(F.col(c)), SECOND_FORMAT, rules.tz)

    return usable.select(
        tx.serial_text(F.col("ins_serial_no")).alias("station"),
        instant(DEPLOYED_AT).alias("date_in"),
        instant(RECOVERED_AT).alias("date_out"),
        tx.norm_name(F.col("station_no")).alias("location"),
        "comments",
    ).distinct()


def tag_metadata(catch: DataFrame, tz: str | None = "US/Eastern", order: Sequence[str] | None = None) -> DataFrame:
    """``ind``: one row per acoustic tag, the first capture in input order."""
    order = list(order) if order is not None else _sheet_order(catch)
    raw = F.col("acoustic_tag_id").cast("string")
    tagged = F.concat(F.col("event_dt"), F.lit(" "), F.col("event_ts"))
    typed = catch.where(raw.isNotNull() & (F.trim(raw) != "NA")).select(
        raw.alias("_raw"),
        tx.tag_id(raw).alias("acoustic_tag_id"),
        parse_instant(tagged, SECOND_FORMAT, tz).alias("tagging_datetime"),
        "species",
        "sex",
        *[F.col(c).try_cast("double").alias(c) for c in ("pcl", "fl", "tl", "stl")],
        "tag_owner",
        "latitude",
        "longitude",
        "site",
        *order,
    )
    # Ids are one per raw text; canonical ids compare "5001" and "5001.0" as equal.
    key = F.coalesce(F.col("acoustic_tag_id").cast("string"), F.col("_raw"))
    first = keep_first(typed.withColumn("_key", key), ["_key"], order)
    return first.drop("_raw", "_key", *order)


def raw_detections(exports: DataFrame, agency: str) -> DataFrame:
    """``det``: detections of the own receivers, times read as UTC."""
    named = _rename(exports, EXPORT_COLUMNS)
    return named.select(
        parse_instant(F.col("time"), SECOND_FORMAT, "UTC").alias("time"),
        tx.suffix_id(F.col("station")).alias("station"),
        tx.tag_id(tx.suffix_id(F.col("elasmo"))).alias("elasmo"),
        "sensor_value",
        "sensor_unit",
        F.lit(agency).alias("agency"),
    )


def _foreign(df: DataFrame, time_format: str, rules: ForeignRules) -> DataFrame:
    require_list("excluded", rules.excluded)
    if rules.dedupe_scope not in ("file", "all"):
        raise ValueError("dedupe_scope must be 'file' or 'all'")
    typed = df.withColumns(
        {
            "station": tx.suffix_id(F.col("station")),
            "elasmo": tx.suffix_id(F.col("elasmo")),
            "time": parse_instant(F.col("time"), time_format, "UTC"),
            "location": tx.replace_in_order(F.col("location"), rules.location_rules),
        }
    )
    return map_lookup(typed, rules.contacts, "contact_poc", "agency", default="")


def _foreign_result(df: DataFrame, rules: ForeignRules) -> DataFrame:
    kept = df.where(tx.not_in(F.col("location"), rules.excluded))
    source = SOURCE_FILE if SOURCE_FILE in df.columns and rules.dedupe_scope == "file" else None
    columns = [*FOREIGN_ORDER, *([SOURCE_FILE] if source else [])]
    return distinct_per_source(kept.select(*columns), source)


def foreign_detections_matched(files: DataFrame, rules: ForeignRules) -> DataFrame:
    """Foreign detections from matched-detection files.

    Pseudo-stations and retired locations are left out, and with them rows lacking a station or,
    where locations are retired, a location.
    """
    named = _rename(files, MATCHED_COLUMNS, ["contact_poc"])
    typed = _foreign(named, SECOND_FORMAT, rules).where(F.col("station") != PSEUDO_STATION)
    for name in rules.retired_locations:
        typed = typed.where(F.col("location") != name)
    if rules.drop_unmapped:
        typed = typed.where(F.col("agency") != "")
    return _foreign_result(typed, rules)


def foreign_detections_private(files: DataFrame, rules: ForeignRules) -> DataFrame:
    """Foreign detections from privately sent files: minute precision, unmapped contacts stay."""
    named = _rename(files, PRIVATE_COLUMNS, ["contact_poc"])
    empty = F.lit(None).cast("string")
    typed = _foreign(named, MINUTE_FORMAT, rules).withColumns({"sensor_value": empty, "sensor_unit": empty})
    return _foreign_result(typed, rules)


def run_import(
    spark: SparkSession,
    deployment_folder: str,
    catch_folder: str,
    detection_folder: str,
    out_folder: str,
    rules: SheetRules,
    layout: str = "file",
) -> None:
    """Files to the four tables."""
    sheet = tx.clean_names(read_sheet(spark, deployment_folder))
    sheet = sheet.withColumnsRenamed({c.strip("_"): c for c in SOURCE_ORDER})
    catch = read_sheet(spark, catch_folder)
    exports = scan_csv_by_name(spark, detection_folder, layout=layout, columns=list(EXPORT_COLUMNS.values()))
    write_tables(
        {
            "vloc": receiver_locations(sheet, rules),
            "vmov": receiver_deployments(sheet, rules),
            "ind": tag_metadata(catch, rules.tz),
            "det": raw_detections(exports, rules.agency),
        },
        out_folder,
        rules.tz,
    )
