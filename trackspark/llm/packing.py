"""Best-fit packing into bins of several permitted sequence lengths.

Documents become pieces: a document longer than the largest permitted length is cut into pieces of that length and a
rest. Pieces are dealt by a hash into groups of a bounded number of pieces; a task packs a group on its own, pieces in
descending order of length. A piece goes to the open bin it fills best. Where none has room, the bin size to open is
chosen over all permitted lengths together: the one of least cost per token that the group can still put into it,
with the cost of a sequence ``length + length^2 / QUADRATIC`` (linear work and attention). At the end each bin shrinks
to the smallest permitted length that holds its contents.

In order. ``pack_in_order`` packs mixed documents along their training order, which ``pack_documents`` has no use for. The
order is derived from the rows themselves (``mixing.order_of_copies``), so neither file names nor the order in which
files are read matter. Pieces are numbered through in it, a group is a range of the numbers, and ``bin_order``, the least
number in a bin, orders the bins. Groups are smaller there, at most 1 / ``ORDERED_GROUPS`` of all pieces but at least
``ORDERED_LEAST``, because within a group length decides.

Defined results. A null or empty text has no words and makes no piece. Texts are packed whole. Repeated rows are
packed as often as they occur. Pieces of one length are taken in the order of document, copy and piece, so reruns
agree. Ids may be null. An empty table gives no bins. Other columns are not read.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trackspark.llm.common import WORD, cut, table
from trackspark.llm.mixing import order_of_copies
from trackspark.operators.rows import global_row_number, numbered_by_key

LENGTHS = (512, 1024, 2048, 4096, 8192)
# Tokens at which a sequence's quadratic cost equals its linear cost.
QUADRATIC = 16_384
GROUP_PIECES = 10_000
ORDERED_GROUPS = 100
ORDERED_LEAST = 200
PACKED = "doc_id long, copy int, piece int, length int, bin_id string, position int, bin_length int, bin_used int"


def cost(length: int) -> float:
    return length + length * length / QUADRATIC


def pack(pieces: Sequence[int], lengths: Sequence[int] = LENGTHS) -> tuple[list[tuple[int, int]], list[list[int]]]:
    """Pack pieces, given in descending order: (bin, position) of each, and [length, used] of each bin.

    ``room`` holds (free, bin) of the open bins in ascending order: the first entry with enough room is the best fit.
    """
    lengths = sorted(lengths)
    remaining = np.concatenate([np.cumsum(np.asarray(pieces[::-1], dtype=np.int64))[::-1], [0]]).tolist()
    room: list[tuple[int, int]] = []
    bins: list[list[int]] = []
    placed = []
    ascending = list(pieces[::-1])
    count = len(pieces)
    for n, size in enumerate(pieces):
        at = bisect_left(room, (size, -1))
        if at < len(room):
            free, which = room.pop(at)
        else:
            which, best = len(bins), None
            for length in lengths:
                if length < size:
                    continue
                # What can still come into the rest of such a bin: later pieces that are short enough.
                short = bisect_left(ascending, length - size + 1, 0, count - n - 1)
                usable = min(length, size + (remaining[count - short] if short else 0))
                rate = cost(length) / usable
                if best is None or rate < best[0]:
                    best = (rate, length)
            free = best[1]
            bins.append([free, 0])
        placed.append((which, bins[which][1]))
        bins[which][1] += size
        if free > size:
            insort(room, (free - size, which))
    for one in bins:
        one[0] = lengths[bisect_left(lengths, one[1])]
    return placed, bins


def pieces_of(docs: DataFrame, largest: int) -> DataFrame:
    """(doc_id, copy, piece, length); copies of one id are numbered from 0."""
    size = F.coalesce(F.regexp_count(F.col("text"), F.lit(WORD)), F.lit(0)).cast("long")
    sized = docs.select(F.col("doc_id").cast("long").alias("doc_id"), size.alias("size")).filter("size > 0")
    # Equal rows are counted first: a much repeated id is one row here.
    counted = sized.groupBy("doc_id", "size").agg(F.count("*").alias("rows"))
    before = Window.partitionBy("doc_id").orderBy("size").rowsBetween(Window.unboundedPreceding, -1)
    first = counted.withColumn("first", F.coalesce(F.sum("rows").over(before), F.lit(0)))
    copies = first.withColumn("copy", F.explode(F.sequence(F.col("first"), F.col("first") + F.col("rows") - 1)))
    count = F.ceil(F.col("size") / largest)
    each = copies.withColumn("piece", F.explode(F.sequence(F.lit(0), (count - 1).cast("int"))))
    length = F.least(F.lit(largest), F.col("size") - F.col("piece") * largest).cast("int")
    return each.select("doc_id", F.col("copy").cast("int").alias("copy"), "piece", length.alias("length"))


def pack_documents(docs: DataFrame, lengths: Sequence[int] = LENGTHS, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """One row per piece: doc_id, copy, piece, length, bin_id, position, bin_length, bin_used."""
    pieces = cut(pieces_of(docs, max(lengths)))
    groups = max(1, -(-pieces.count() // group_pieces))
    spread = pieces.withColumn("group", F.pmod(F.xxhash64("doc_id", "copy", "piece"), F.lit(groups)))

    return packed(spread, lengths, ("doc_id", "copy", "piece"))


def packed(spread: DataFrame, lengths: Sequence[int], ties: Sequence[str]) -> DataFrame:
    """Pack each group; ``ties`` order pieces of one length. With a ``number`` of the pieces, bins get their order."""
    numbered = "number" in spread.columns

    def run(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = [("length", "descending"), *((t, "ascending") for t in ties)]
        every = pa.Table.from_batches(list(batches)).sort_by(keys)
        rows = every.select(["doc_id", "copy", "piece", "length"])
        placed, bins = pack(rows.column("length").to_pylist(), lengths)
        group = key[0].as_py()
        more = {
            "bin_id": pa.array([f"{group}-{b}" for b, _ in placed], pa.string()),
            "position": pa.array([p for _, p in placed], pa.int32()),
            "bin_length": pa.array([bins[b][0] for b, _ in placed], pa.int32()),
            "bin_used": pa.array([bins[b][1] for b, _ in placed], pa.int32()),
        }
        if numbered:
            which, number = np.array([b for b, _ in placed]), every.column("number").to_numpy()
            least = np.full(len(bins), np.iinfo(np.int64).max)
            np.minimum.at(least, which, number)
            more["bin_order"] = pa.array(least[which], pa.int64())
        for name, column in more.items():
            rows = rows.append_column(name, column)
        yield from rows.to_batches(max_chunksize=10_000)

    return spread.groupBy("group").applyInArrow(run, PACKED + ", bin_order long" * numbered)


def numbered_pieces(docs: DataFrame, largest: int) -> tuple[DataFrame, int]:
    """(doc_id, copy, piece, length, number) of the pieces, numbered from 0 in training order, and their count.

    Copies of an id are numbered in that order. Both numberings go over all tasks where a key or the table is large.
    """
    order = ["position", "place", "size", "pass"]
    copies = numbered_by_key(cut(order_of_copies(docs)), ["doc_id"], order, "nth")
    count = F.ceil(F.col("size") / largest)
    each = copies.withColumn("piece", F.explode(F.sequence(F.lit(0), (count - 1).cast("int"))))
    length = F.least(F.lit(largest), F.col("size") - F.col("piece") * largest).cast("int")
    pieces = each.select("doc_id", (F.col("nth") - 1).cast("int").alias("copy"), "piece", length.alias("length"), "position", "place")
    numbered = cut(global_row_number(pieces, ["position", "place", "doc_id", "copy", "piece"], "number"))
    out = numbered.select("doc_id", "copy", "piece", "length", (F.col("number") - 1).alias("number"))
    return out, out.count()


def pack_in_order(docs: DataFrame, lengths: Sequence[int] = LENGTHS, group_pieces: int | None = None) -> DataFrame:
    """The rows of ``pack_documents`` with ``bin_order``: groups are ranges of the training order of mixed documents."""
    pieces, total = numbered_pieces(docs, max(lengths))
    size = group_pieces or min(GROUP_PIECES, max(ORDERED_LEAST, -(-total // ORDERED_GROUPS)))
    return packed(pieces.withColumn("group", F.floor(F.col("number") / size)), lengths, ("number",))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))
