"""Scans of exported CSV files, every column as text."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping

import pyarrow as pa
from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trackspark.functions.times import serial_to_clock
from trackspark.operators.combine import union_by_name
from trackspark.session import shared_dir

SOURCE_FILE = "_source_file"
SOURCE_ORDER = ("_source_file", "_source_block", "_source_row")
# Bytes up to which a file is read whole for its first line, together with others.
SMALL_FILE = 4 << 20
# More bytes than a file has: each file is a task.
WHOLE_FILES = 1 << 50

# A quote within a quoted cell is doubled, a backslash is a plain character; blanks around cells are
# dropped, both an empty cell and the text NA are missing.
CSV_DIALECT = {"quote": '"', "escape": '"'}
CSV_OPTIONS = {
    **CSV_DIALECT,
    "header": "true",
    "mode": "PERMISSIVE",
    "nullValue": "NA",
    "ignoreLeadingWhiteSpace": "true",
    "ignoreTrailingWhiteSpace": "true",
}


def _first_lines(alone: bool, quotes_closed: bool):
    """(path, line) of the first line of each file in a task; a task with one file (``alone``) stops after it.

    With ``quotes_closed`` lines are added until no quoted cell is open, for headers that hold line breaks.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, str] = {}
        for batch in batches:
            for path, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                line = found.get(path)
                if line is None:
                    found[path] = text
                elif quotes_closed and line.count('"') % 2:
                    found[path] = f"{line}\n{text}"
            if alone and not (quotes_closed and any(line.count('"') % 2 for line in found.values())):
                break
        yield pa.record_batch([pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.string())], names=["path", "line"])

    return run


def _glob(spark: SparkSession, pattern: str) -> DataFrameReader:
    return spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", pattern)


def header_catalogue(spark: SparkSession, places: str | list[str], pattern: str = "*.csv", multi_line: bool = False) -> DataFrame:
    """(path, line) of all files below, ``line`` the heading as it stands in the file; files without a line are left out.

    Small files are packed into common tasks and read whole; a big file is a task of its own that stops after its first
    lines. So there are two jobs, however many files.
    """
    shared_dir(spark)
    found = []
    # Spark packs files into a task up to the first size, each weighing the second at least.
    packing = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    size = F.col("_metadata.file_size")
    try:
        for alone, wanted in ((False, size <= SMALL_FILE), (True, size > SMALL_FILE)):
            for key, usual in packing.items():
                spark.conf.set(key, str(WHOLE_FILES) if alone else usual)
            # Filters on the metadata choose the files; only what begins a file can be its heading.
            first = _glob(spark, pattern).text(places).where(wanted & (F.col("_metadata.file_block_start") == 0))
            lines = first.select("_metadata.file_path", "value").mapInArrow(_first_lines(alone, multi_line), "path string, line string")
            found.append(lines.checkpoint())
    finally:
        for key, usual in packing.items():
            spark.conf.set(key, usual)
    # The metadata show paths as addresses.
    path = F.url_decode(F.replace("path", F.lit("+"), F.lit("%2B")))
    return found[0].unionAll(found[1]).select(path.alias("path"), "line")


def _header(spark: SparkSession, path: str, multi_line: bool) -> tuple[str, ...]:
    return tuple(spark.read.options(**CSV_OPTIONS).option("multiLine", multi_line).csv(path).columns)


def _folder(path: Column) -> Column:
    return F.regexp_replace(path, r"/[^/]*$", "")


def header_groups(
    spark: SparkSession, folder: str, pattern: str = "*.csv", layout: str = "file", multi_line: bool = False
) -> dict[tuple[str, ...], list[str]]:
    """Column names of each distinct header, with what to scan for it: files, directories, or the folder as a whole.

    The distinct headings come from one catalogue job; Spark's own reader then names the columns of one file of each. Where
    all files have one heading the folder is scanned as a whole, and no path of a file reaches the driver.
    """
    files = _glob(spark, pattern).format("binaryFile").load(folder).select("path")
    if files.isEmpty():
        raise FileNotFoundError(f"no file matches {pattern!r} in {folder}")
    places: str | list[str] = folder
    if layout == "directory":
        places = [r.path for r in files.groupBy(_folder(F.col("path")).alias("_folder")).agg(F.min("path").alias("path")).collect()]
    lines = header_catalogue(spark, places, pattern, multi_line)
    distinct = lines.groupBy("line").agg(F.min("path").alias("path")).orderBy("path").collect()
    headers = {r.line: _header(spark, r.path, multi_line) for r in distinct}
    names = set(headers.values())
    if len(names) <= 1:
        return {next(iter(names), ()): [folder]}
    place = _folder(F.col("path")) if layout == "directory" else F.col("path")
    groups: dict[tuple[str, ...], list[str]] = {}
    for row in lines.groupBy("line").agg(F.sort_array(F.collect_set(place)).alias("places")).orderBy("line").collect():
        groups.setdefault(headers[row.line], []).extend(row.places)
    return groups


def scan_csv_by_name(
    spark: SparkSession,
    folder: str,
    pattern: str = "*.csv",
    layout: str = "file",
    columns: list[str] | None = None,
    with_order: bool = False,
    multi_line: bool = False,
) -> DataFrame:
    """All matching CSV files below a folder as one table, columns bound by header name.

    Spark binds a multi-file CSV scan by position, so files are grouped by header (``header_groups``), each group is
    one scan, and the scans are united by name (a column missing in a file is null). Rows with
    fewer cells than the header are padded with nulls.

    ``layout="file"`` reads the first line of every file. ``"directory"`` reads one header per
    directory, for exports with many files per directory; the scan then checks each file's header
    and fails on one that differs.

    ``multi_line`` accepts line breaks within quoted cells; such files are not split, so big exports, which hold
    none, are better read without.

    Adds ``_source_file``; ``with_order`` also adds two columns that together with it give the
    input order (``SOURCE_ORDER``).
    """
    if layout not in ("file", "directory"):
        raise ValueError("layout must be 'file' or 'directory'")
    scans = []
    for header, places in header_groups(spark, folder, pattern, layout, multi_line).items():
        schema = T.StructType([T.StructField(name, T.StringType()) for name in header])
        reader = _glob(spark, pattern) if places == [folder] else spark.read.option("pathGlobFilter", pattern)
        reader = reader.options(**CSV_OPTIONS).option("multiLine", multi_line)
        scan = reader.option("enforceSchema", "true" if layout == "file" else "false").schema(schema).csv(places)
        wanted = [c for c in header if columns is None or c in columns]
        cells = [F.nullif(F.trim(F.col(f"`{c}`")), F.lit("")).alias(c) for c in wanted]
        place = [F.col("_metadata.file_path").alias(SOURCE_FILE)]
        if with_order:
            place.append(F.col("_metadata.file_block_start").alias("_source_block"))
            place.append(F.monotonically_increasing_id().alias("_source_row"))
        scans.append(scan.select(*cells, *place))
    return union_by_name(*scans)


def read_sheet(
    spark: SparkSession,
    folder: str,
    pattern: str = "*.csv",
    cast_overrides: Mapping[str, str] | None = None,
    clock_column: str | None = "event_ts",
    with_order: bool = True,
    multi_line: bool = True,
) -> DataFrame:
    """A sheet exported as CSV, text columns with chosen columns cast.

    Defaults cast the receiver serial and the event clock to double; the clock serial then
    becomes ``HH:MM:SS`` text. Cells that do not cast become null.
    """
    casts = {"INS_SERIAL_NO": "double", "event_ts": "double"} if cast_overrides is None else cast_overrides
    sheet = scan_csv_by_name(spark, folder, pattern, with_order=with_order, multi_line=multi_line)
    sheet = sheet.withColumns({c: F.col(f"`{c}`").try_cast(t) for c, t in casts.items() if c in sheet.columns})
    if clock_column in sheet.columns and clock_column in casts:
        sheet = sheet.withColumn(clock_column, serial_to_clock(F.col(clock_column)))
    return sheet
