"""Helpers shared by the operators: tables, words, Arrow batches and the shared scratch folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from trackspark.session import shared_dir
from trackspark.sources.tables import remove_path

# A word, for Java's and DuckDB's regular expressions. bytes.split() cuts UTF-8 at the same six characters.
WORD = r"[^\x20\x09-\x0D]+"
# Texts decoded to Python at once; bounds memory where a batch holds very long texts.
SLICE_ROWS = 128


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Folders made by this driver that are not discarded yet, oldest first.
_MADE: list[str] = []


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder below the cluster's shared checkpoint folder."""
    _MADE.append(f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}")
    return _MADE[-1]


def made() -> int:
    """How many folders there are now: what ``discard`` keeps."""
    return len(_MADE)


def latest() -> str:
    return _MADE[-1]


def discard(spark: SparkSession, since: int, keep: Iterable[str] = ()) -> None:
    """Remove the folders made after the first ``since``, once what was computed from them is written elsewhere."""
    keep = set(keep)
    for folder in [f for f in _MADE[since:] if f not in keep]:
        remove_path(spark, folder)
        _MADE.remove(folder)


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and go on from there."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def stored(df: DataFrame) -> DataFrame:
    """Like ``cut`` for larger tables: written as compressed Parquet, which checkpoint files are not."""
    folder = scratch(df.sparkSession, "table")
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def slices(batches: Iterable[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every input bit (the finaliser of MurmurHash3)."""
    values = values ^ (values >> np.uint64(33))
    values = values * np.uint64(0xFF51AFD7ED558CCD)
    values = values ^ (values >> np.uint64(33))
    values = values * np.uint64(0xC4CEB9FE1A85EC53)
    return values ^ (values >> np.uint64(33))


SPACES = np.isin(np.arange(256), np.frombuffer(b" \t\n\r\x0b\x0c", dtype=np.uint8))
BYTE_WORTH = mixed(np.arange(1, 257, dtype=np.uint64))
POWER = 0xD1342543DE82EF95
# Bytes hashed at once; longer texts are cut at a space.
PIECE = 1 << 20
_POWERS = [np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)]


def powers(count: int) -> list[np.ndarray]:
    """The first powers of POWER and of its inverse modulo 2^64."""
    if len(_POWERS[0]) < count:
        for i, base in enumerate((POWER, pow(POWER, -1, 1 << 64))):
            steps = np.full(max(count, 1 << 16), base, dtype=np.uint64)
            steps[0] = 1
            _POWERS[i] = np.cumprod(steps)
    return _POWERS


def word_hashes(text: bytes) -> np.ndarray:
    """64-bit content hash of each word of a UTF-8 text, in order; the words are those of ``bytes.split``.

    A word's hash is the sum of its bytes' worths times the powers of its positions: running sums over the text give
    all words at once. It depends on the word alone, so it is the word's name on every executor, without a dictionary.
    """
    if len(text) > 2 * PIECE:
        parts, start = [], 0
        while start < len(text):
            spaces = np.flatnonzero(SPACES[np.frombuffer(text, dtype=np.uint8, offset=start)[PIECE:]])
            end = start + PIECE + int(spaces[0]) if len(spaces) else len(text)
            parts.append(_hashed(text[start:end]))
            start = end
        return np.concatenate(parts)
    return _hashed(text)


def _hashed(text: bytes) -> np.ndarray:
    codes = np.frombuffer(text, dtype=np.uint8)
    space = np.ones(len(codes) + 2, dtype=bool)
    space[1:-1] = SPACES[codes]
    edges = np.flatnonzero(space[1:] != space[:-1])
    starts, ends = edges[::2], edges[1::2]
    forward, back = powers(len(codes) + 1)
    sums = np.zeros(len(codes) + 1, dtype=np.uint64)
    np.cumsum(BYTE_WORTH[codes] * forward[: len(codes)], out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * back[starts])


def rolled(hashes: np.ndarray, width: int, base: int = 0x9E3779B97F4A7C15) -> np.ndarray:
    """Hash of every run of ``width`` consecutive hashes; shorter inputs give an empty array."""
    count = len(hashes) - width + 1
    if count < 1:
        return np.empty(0, dtype=np.uint64)
    out = hashes[:count].copy()
    for step in range(1, width):
        out = out * np.uint64(base) + hashes[step : step + count]
    return mixed(out)

