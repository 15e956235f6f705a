"""Declared schemas of the logical tables, as DDL."""

DET = "time timestamp, station string, elasmo bigint, sensor_value string, sensor_unit string, agency string"
VLOC = (
    "deploy_lat double, deploy_long double, location string, bottom_depth double, "
    "riser_length double, instrument_depth double, agency string"
)
VMOV = "station string, date_in timestamp, date_out timestamp, location string, comments string"
IND = (
    "acoustic_tag_id bigint, tagging_datetime timestamp, species string, sex string, pcl double, fl double, "
    "tl double, stl double, tag_owner string, latitude string, longitude string, site string"
)
DET_PLACED = DET + ", location string"
ROLLUP = "elasmo bigint, location string, n bigint, mintime timestamp, maxtime timestamp, days int, ym string"

TABLES = {
    "det": DET,
    "vloc": VLOC,
    "vloc_extended": VLOC,
    "vmov": VMOV,
    "ind": IND,
    "det_compiled": DET_PLACED,
    "det_tot": DET_PLACED,
    "det_cleaned": DET_PLACED,
    "det_cleaned_season": DET_PLACED,
    "rollup_month": ROLLUP,
}
