"""Measured sizes: what may be broadcast, and what does not fit."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trackspark.session import shared_dir

BROADCAST_MB = 64
CELL_BYTES = 16


def row_bytes(df: DataFrame) -> Column:
    """Upper estimate of the bytes of a row: a fixed part per column, the length of its texts and binaries, and the
    written length of its nested cells."""

    def content(f: T.StructField) -> Column | None:
        cell = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            return F.octet_length(cell)
        if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            # Every element takes a character at least in writing; in memory it takes up to CELL_BYTES.
            return F.octet_length(F.to_json(F.struct(cell.alias("c")))) * CELL_BYTES
        return None

    lengths = [F.coalesce(c, F.lit(0)) for c in map(content, df.schema) if c is not None]
    return reduce(lambda a, b: a + b, lengths, F.lit(CELL_BYTES * (len(df.columns) + 1)))


def broadcast_if_small(df: DataFrame, limit_mb: int = BROADCAST_MB) -> DataFrame:
    """Hint a broadcast when the measured size is below the limit, otherwise leave it to a shuffle.

    Measuring runs the plan of ``df``: use it on tables that are stored, or see ``settled``.
    """
    size = df.agg(F.coalesce(F.sum(row_bytes(df).cast("bigint")), F.lit(0))).first()[0]
    return F.broadcast(df) if size <= limit_mb * 1024 * 1024 else df


def settled(df: DataFrame, limit_mb: int = BROADCAST_MB) -> DataFrame:
    """A per-key result written once to the shared checkpoint folder and broadcast if measured small.

    Spark plans the size of an aggregate from its input, so without this a join to a table of a
    few keys would shuffle the detections.
    """
    shared_dir(df.sparkSession)
    return broadcast_if_small(df.checkpoint(), limit_mb)
