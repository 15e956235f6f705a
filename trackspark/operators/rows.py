"""Row-level operators: distinct forms, first per key, ordinals and row numbers."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trackspark.operators.sizes import settled
from trackspark.session import shared_dir

# Rows of one key that a task may number; more are numbered by a sort over all tasks.
KEY_ROWS = 1_000_000


def nulls_last(columns: Sequence[str]) -> list[Column]:
    return [F.col(c).asc_nulls_last() for c in columns]


def sortable(df: DataFrame, columns: Sequence[str]) -> list[str]:
    """Those of the columns that can be sorted by: maps cannot."""
    return [c for c in columns if "map<" not in df.schema[c].dataType.simpleString()]


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """First row per key combination by ``order``; nulls count as a key value.

    Without an order the whole row decides, so the result does not depend on the layout of the
    data. Spark keeps one candidate per key and task before the shuffle (window group limit), so
    a frequent key does not gather in one task.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    first = Window.partitionBy(*keys).orderBy(*nulls_last([*order, *rest] or list(keys)))
    return df.withColumn("_n", F.row_number().over(first)).where(F.col("_n") == 1).drop("_n")


def distinct_per_source(df: DataFrame, source: str | None = "_source_file") -> DataFrame:
    """Distinct rows within each source file; equal rows of two files both stay.

    ``source=None`` removes duplicates over all files.
    """
    if source is None:
        return df.drop("_source_file").distinct()
    return df.distinct().drop(source)


def top_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[str], k: int) -> DataFrame:
    """The first ``k`` rows per key by ``order`` (only ``k`` candidates per task are shuffled)."""
    first = Window.partitionBy(*keys).orderBy(*nulls_last(order))
    return df.withColumn("_n", F.row_number().over(first)).where(F.col("_n") <= k).drop("_n")


def ordinals(distinct_keys: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """Position (1, 2, …) of each distinct key in the given order, nulls last; range partitions share the work."""
    return global_row_number(distinct_keys, order, name).withColumn(name, F.col(name).cast("int"))


def _sorted_parts(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """The table sorted over all tasks and written once to the shared checkpoint folder.

    ``_part`` numbers the partitions in order, ``_within`` the rows of one from 0. Rows of equal order are placed by their
    other columns: places do not depend on the layout, and a value that many rows share is spread over tasks. What is
    written stays fixed when executors are lost.
    """
    shared_dir(df.sparkSession)
    return (
        df.orderBy(*nulls_last([*order, *sortable(df, [c for c in df.columns if c not in order])]))
        .withColumn("_place", F.monotonically_increasing_id())
        .checkpoint()
        .withColumn("_part", F.shiftright("_place", 33))
        .withColumn("_within", F.col("_place") - F.shiftleft("_part", 33))
        .drop("_place")
    )


def global_row_number(df: DataFrame, order: Sequence[str], name: str = "row_id") -> DataFrame:
    """Row number over the whole table in the given order, without gathering it in one task.

    Partition sizes give each partition of the sorted table its offset.
    """
    placed = _sorted_parts(df, order)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_part")
        .agg(F.count(F.lit(1)).alias("_size"))
        .select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    )
    # One row per partition of the sort, so its size is bounded by the shuffle partition count.
    return (
        placed.join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_within") + F.col("_offset") + 1)
        .drop("_part", "_within", "_offset")
    )


def running_total(df: DataFrame, order: Sequence[str], value: str, name: str) -> DataFrame:
    """Running total of a whole number over the whole table in the given order; nulls add nothing.

    A window runs within each partition of the sorted table, and the sums of the partitions before are added: no
    task sees the whole table.
    """
    placed = _sorted_parts(df, order)
    # One row per partition of the sort: bounded by the shuffle partition count.
    sums = sorted((r[0], r[1] or 0) for r in placed.groupBy("_part").agg(F.sum(value)).collect())
    before = pa.table({"_part": pa.array([p for p, _ in sums], pa.int64()), "_offset": pa.array([0, *accumulate(n for _, n in sums)][: len(sums)], pa.int64())})
    offsets = F.broadcast(placed.sparkSession.createDataFrame(before))
    upto = Window.partitionBy("_part").orderBy("_within").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    within = F.coalesce(F.sum(F.col(value)).over(upto), F.lit(0))
    return (
        placed.withColumn("_sum", within)
        .join(offsets, "_part")
        .withColumn(name, F.col("_sum") + F.col("_offset"))
        .drop("_part", "_within", "_offset", "_sum")
    )


def numbered_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str, key_rows: int = KEY_ROWS) -> DataFrame:
    """Number the rows of each key in an order; ``df`` is stored. No task numbers more than ``key_rows`` rows of a key.

    Keys with more rows are numbered by a sort over all tasks, less the first number of their key.
    """
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    if (per_key.agg(F.max("_n")).first()[0] or 0) <= key_rows:
        return df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*nulls_last(order or keys))).cast("bigint"))
    placed = global_row_number(df, [*keys, *order], "_row")
    first = placed.groupBy(*[F.col(k).alias(f"_f_{k}") for k in keys]).agg(F.min("_row").alias("_first"))
    same = [F.col(k).eqNullSafe(F.col(f"_f_{k}")) for k in keys]
    return placed.join(settled(first), same).select(*df.columns, (F.col("_row") - F.col("_first") + 1).alias(name))
