"""Checks of inputs: those that raise look at schemas and paths only; those that report give a table of rules.

A report has one row per rule with the number of times it is broken. All rules over the rows of a table are evaluated in one
aggregate.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def require_columns(df: DataFrame, columns: Iterable[str]) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"required columns missing: {', '.join(missing)}")


def require_timestamp(df: DataFrame, column: str) -> None:
    require_columns(df, [column])
    if not isinstance(df.schema[column].dataType, T.TimestampType):
        raise TypeError(f"column {column!r} must be a timestamp")


def require_text(df: DataFrame, column: str) -> None:
    require_columns(df, [column])
    if not isinstance(df.schema[column].dataType, T.StringType):
        raise TypeError(f"column {column!r} must be text")


def require_positive(name: str, value: float) -> None:
    if isinstance(value, bool) or not isinstance(value, (int, float)) or not value > 0:
        raise ValueError(f"{name} must be a positive number")


def require_list(name: str, value) -> None:
    """A list of texts or ``None``."""
    if value is None:
        return
    if isinstance(value, str) or not all(isinstance(v, str) for v in value):
        raise ValueError(f"{name} must be a list of texts or None")


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether Spark finds anything under the path, on whatever file system it lives."""
    try:
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error):
            return False
        raise
    return True


def require_paths(spark: SparkSession, paths: Iterable[str]) -> None:
    """All paths are looked up before failing, so that the message names every missing one."""
    missing = [p for p in paths if not path_exists(spark, p)]
    if missing:
        raise FileNotFoundError(f"required inputs not found: {', '.join(missing)}")


class Rule(NamedTuple):
    """A rule over the rows of a table: its name, the columns it needs and the rows that break it."""

    name: str
    columns: Sequence[str]
    broken: Callable[..., Column]


def rule_report(df: DataFrame, rules: Sequence[Rule], required: Mapping[str, str] | None = None) -> DataFrame:
    """(rule, broken): each rule with the number of rows that break it, a null condition counting as broken.

    ``required`` maps columns to type names: a missing or differently typed column breaks its rule once, and rules that
    need a missing column have a null count.
    """
    kinds = dict(df.dtypes)
    cells = [
        F.struct(F.lit(f"{c} is {kind}").alias("rule"), F.lit(int(kinds.get(c) != kind)).cast("bigint").alias("broken"))
        for c, kind in (required or {}).items()
    ]
    for rule in rules:
        if all(c in kinds for c in rule.columns):
            count = F.count_if(F.coalesce(rule.broken(*[F.col(f"`{c}`") for c in rule.columns]), F.lit(True)))
        else:
            count = F.lit(None).cast("bigint")
        cells.append(F.struct(F.lit(rule.name).alias("rule"), count.alias("broken")))
    return df.agg(F.array(*cells).alias("_all")).select(F.inline("_all"))


# What a table of detections has to hold.
DETECTION_RULES = (
    Rule("a detection has a time", ["time"], lambda t: t.isNull()),
    Rule("a detection has a tag", ["elasmo"], lambda e: e.isNull()),
    Rule("a detection has a location", ["location"], lambda p: p.isNull() | (F.trim(p) == "")),
)
# What the parameters of a report have to be, where they come as rows of a table.
PARAMETER_RULES = (
    Rule("time_window_hours is positive", ["time_window_hours"], lambda h: ~(h > 0)),
    Rule("step_days is a positive whole number", ["step_days"], lambda d: ~((d > 0) & (d == F.floor(d)))),
    Rule("start is not after end", ["start", "end"], lambda a, b: a.isNotNull() & b.isNotNull() & (a > b)),
)


def path_report(spark: SparkSession, paths: Mapping[str, str]) -> DataFrame:
    """(rule, broken): whether each named input exists. All are looked up; no content is read."""
    rows = [(f"{name} exists", int(not path_exists(spark, path))) for name, path in paths.items()]
    return spark.createDataFrame(rows, "rule string, broken bigint")


def pattern_report(spark: SparkSession, folder: str, patterns: Iterable[str]) -> DataFrame:
    """(rule, broken): whether any file below a folder matches each pattern; only names are listed."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    parts = [
        reader.option("pathGlobFilter", p)
        .load(folder)
        .agg(F.lit(f"a file matches {p}").alias("rule"), (F.count(F.lit(1)) == 0).cast("bigint").alias("broken"))
        for p in patterns
    ]
    report = parts[0]
    for part in parts[1:]:
        report = report.unionAll(part)
    return report
