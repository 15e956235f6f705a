"""Mixing sources to target weights along a curriculum.

Sizes. A document's size is its number of words. Sources, by code point with null last, weigh 5, 2, 1, repeating; they
share ``SHARE_PERCENT`` of all words by weight. A target stops at ``MOST_PASSES`` times its source's words, and the
excess is shared again by weight until no target is above. That fixed point is found in one pass over the sources:
they fill up in the order of words per weight, so a source is full exactly if its ratio is not above the level that
all sources from it on would share.

Curriculum. A source's weight changes over training time: its schedule is piecewise linear (``SCHEDULES``), its
integral is the source's demand up to a time. A source is consumed in a fixed pseudo-random order of its documents,
pass after pass; a copy that starts after c of t target words gets the time at which the integral reaches c / t.
Sorting by that position (range partitions) gives the training order. The query writes this order of all copies and
derives its rows from it: a document's taken words are summed over its copies, and the rows come in the order of first
positions, part by part, with documents never taken last.

Taken. A document is taken once per whole pass, and once more, or a part of it, where the last pass ends: the last
document of a source is cut at the target. So a source's taken words are its target to within one word.

Scale. The text is read once; narrow rows (id, source, size) are written to the shared checkpoint folder. Running
sums of a source go through hash buckets of a bounded number of documents, so a source with a third of all rows is
spread over tasks. Only rows per source (count and words) and per bucket are brought together.

Defined results. A null text has size 0 and takes nothing. Null sources are one source. Repeated rows are documents of
their own. Without words nothing is taken and targets are 0. An empty table gives an empty result. Other columns are
not read by the mix; ``mixed_documents`` keeps them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trackspark.llm.common import WORD, cut, stored, table
from trackspark.operators.sizes import settled

WEIGHTS = (5, 2, 1)
SHARE_PERCENT = 150
MOST_PASSES = 2
BUCKET_ROWS = 4_000
# Weight over training time, at even knots, of the sources in order, repeating: early, even, late. Only ratios count.
SCHEDULES = ((3, 2, 1, 1, 1), (1, 1, 1, 1, 1), (1, 1, 1, 2, 3))


def measures(doc_id: Column, text: Column) -> dict[str, Column]:
    """size: words of the text; spread: orders a source's documents at random, the same each time."""
    return {
        "size": F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long"),
        "spread": F.md5(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")),
    }


def sized(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size, spread)"""
    found = measures(F.col("doc_id"), F.col("text"))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", *(c.alias(n) for n, c in found.items()))


def targets(sizes: DataFrame) -> DataFrame:
    """(source, place, source_rows, source_size, target) of each source."""
    per_source = sizes.groupBy("source").agg(F.count("*").alias("source_rows"), F.sum("size").alias("source_size"))
    placed = per_source.withColumn("place", F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))) - 1)
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), F.col("place") % len(WEIGHTS) + 1).cast("long")
    # In the order of words per weight: what is full before a source, and what all sources from it on weigh.
    order = Window.orderBy(F.col("source_size") / F.col("weight"), "place")
    every = Window.partitionBy()
    sums = placed.withColumn("weight", weight).select(
        "*",
        F.row_number().over(order).alias("rank"),
        F.coalesce(F.sum("source_size").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("size_before"),
        F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing)).alias("weight_after"),
        F.sum("source_size").over(every).alias("size_all"),
    )
    # Hundredths of words keep the demand whole; decimals keep the comparison exact.
    rest = F.col("size_all") * SHARE_PERCENT - F.col("size_before") * (MOST_PASSES * 100)
    exact = lambda c: c.cast("decimal(18,0)")
    most = exact(F.col("source_size") * (MOST_PASSES * 100)) * exact(F.col("weight_after"))
    judged = sums.withColumn("rest", rest).withColumn("full", most <= exact(F.col("rest")) * exact(F.col("weight")))
    # The first source that is not full fixes the level of all from it on.
    first = F.min_by(F.struct("rest", "weight_after"), F.when(~F.col("full"), F.col("rank"))).over(every)
    known = judged.withColumn("open", first)
    share = F.col("weight") * F.col("open.rest") / (F.col("open.weight_after") * 100)
    whole = (F.col("source_size") * MOST_PASSES).cast("double")
    target = F.when(F.col("full") | F.col("open").isNull(), whole).otherwise(share)
    return known.select("source", "place", "source_rows", "source_size", target.alias("target"))


def dealt(rows: DataFrame, goals: DataFrame) -> DataFrame:
    """Rows with their source's goal and bucket: the leading 28 bits of the order, scaled to the number of buckets."""
    own = goals.withColumnRenamed("source", "goal_source")
    joined = rows.join(own, F.col("source").eqNullSafe(F.col("goal_source"))).drop("goal_source")
    buckets = F.greatest(F.lit(1), F.ceil(F.col("source_rows") / BUCKET_ROWS)).cast("long")
    lead = F.conv(F.substring("spread", 1, 7), 16, 10).cast("long")
    return joined.withColumn("bucket", F.floor(lead * buckets / F.lit(1 << 28)))


def planned(rows: DataFrame, goals: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Goals of the sources and, per source and bucket, the words before the bucket; broadcast if measured small."""
    goals = settled(targets(rows) if goals is None else goals)
    per_bucket = dealt(rows, goals).groupBy("place", "bucket").agg(F.sum("size").alias("bucket_size"))
    so_far = Window.partitionBy("place").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = per_bucket.select(
        F.col("place").alias("b_place"),
        F.col("bucket").alias("b_bucket"),
        F.coalesce(F.sum("bucket_size").over(so_far), F.lit(0)).alias("bucket_start"),
    )
    return goals, settled(starts)


def taken_from(rows: DataFrame, goals: DataFrame, starts: DataFrame) -> DataFrame:
    """Add place, source_size, target, offset (words of the source before the row) and taken; other columns stay."""
    placed = dealt(rows, goals).join(starts, (F.col("place") == F.col("b_place")) & (F.col("bucket") == F.col("b_bucket")))
    within = Window.partitionBy("place", "bucket").orderBy("spread", "doc_id", "size")
    inside = within.rowsBetween(Window.unboundedPreceding, -1)
    found = placed.withColumn("offset", F.col("bucket_start") + F.coalesce(F.sum("size").over(inside), F.lit(0)))
    # Whole words of the target, and what is left of it when this row's turn comes in the last pass.
    goal = F.round("target").cast("long")
    passes = F.when(F.col("source_size") > 0, F.floor(goal / F.col("source_size"))).otherwise(0)
    left = goal - passes * F.col("source_size") - F.col("offset")
    taken = passes * F.col("size") + F.greatest(F.lit(0), F.least(F.col("size"), left))
    return found.withColumn("taken", taken.cast("long")).drop("b_place", "b_bucket", "bucket_start", "bucket", "source_rows", "spread")


def mix(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, source, size, place, source_size, target, offset, taken."""
    rows = cut(sized(docs))
    return taken_from(rows, *planned(rows))


def time_of(share: Column, place: Column) -> Column:
    """The training time, 0 to 1, at which a source's schedule has used the given share of its demand."""

    def inverse(knots: tuple[int, ...]) -> Column:
        steps = len(knots) - 1
        areas = [(a + b) / 2 for a, b in zip(knots, knots[1:], strict=False)]
        total, begin, pieces = sum(areas), 0.0, []
        for i, area in enumerate(areas):
            a, b = knots[i], knots[i + 1]
            used = F.greatest(share * F.lit(total) - F.lit(begin), F.lit(0.0))
            # a x + (b - a) x^2 / 2 = used, for x in 0 .. 1
            x = used / F.lit(float(a)) if a == b else (F.sqrt(F.lit(float(a * a)) + used * (2.0 * (b - a))) - a) / (b - a)
            begin += area
            pieces.append((begin / total, (F.lit(float(i)) + x) / steps))
        out = pieces[-1][1]
        for bound, value in reversed(pieces[:-1]):
            out = F.when(share < bound, value).otherwise(out)
        return out

    kinds = [inverse(k) for k in SCHEDULES]
    chosen = [F.when(place % len(kinds) == i, k) for i, k in enumerate(kinds)]
    return F.least(F.lit(1.0), reduce(lambda a, b: F.coalesce(a, b), chosen))


def training_order(mixed: DataFrame) -> DataFrame:
    """One row per copy taken, sorted by position over range partitions: the columns of ``mix``, pass, words, position.

    Copies at one position are ordered by source place, document and pass.
    """
    passes = F.floor(F.col("taken") / F.greatest(F.col("size"), F.lit(1))).cast("int")
    part = F.col("taken") - passes * F.col("size")
    copies = mixed.filter("taken > 0").select(
        "*", F.explode(F.sequence(F.lit(0), F.when(part > 0, passes).otherwise(passes - 1))).alias("pass")
    )
    words = F.when(F.col("pass") < passes, F.col("size")).otherwise(part)
    begin = F.col("pass") * F.col("source_size") + F.col("offset")
    share = F.least(F.lit(1.0), begin / F.col("target"))
    timed = copies.withColumns({"words": words, "position": time_of(share, F.col("place"))})
    order = ("position", "place", "doc_id", "pass")
    return timed.repartitionByRange(*order).sortWithinPartitions(*order)


def ordered_mix(docs: DataFrame) -> DataFrame:
    """The rows of ``mix``, derived from the training order and sorted as it is, with the position of the first copy.

    The order of all copies is written once. Rows never taken have no position and come last. A row with words is
    known by its source and offset, so repeated rows stay apart.
    """
    mixed = stored(mix(docs))
    copies = stored(training_order(mixed))
    row = ("doc_id", "source", "size", "place", "source_size", "target", "offset")
    used = copies.groupBy(*row).agg(F.sum("words").alias("taken"), F.min("position").alias("position"))
    never = mixed.filter("taken = 0").select(*row, "taken", F.lit(None).cast("double").alias("position"))
    order = (F.asc_nulls_last("position"), F.col("place"), F.col("doc_id"), F.col("offset"))
    return used.union(never).repartitionByRange(*order).sortWithinPartitions(*order)


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The documents in training order, one row per pass, with their columns as they were.

    Documents are whole here: the document in which a source's demand ends comes once more if at least half of it is
    taken in that pass. Texts are shuffled twice, by bucket and by position.
    """
    names = docs.columns
    plain = docs.select(*(F.col(f"`{n}`").alias(f"c{i}") for i, n in enumerate(names)))
    column = {n: F.col(f"c{i}") for i, n in enumerate(names)}
    keys = {"doc_id": column["doc_id"].cast("long"), "source": column["source"]}
    wide = plain.withColumns({**keys, **measures(column["doc_id"], column["text"])})
    order = training_order(taken_from(wide, *planned(cut(sized(docs)))))
    return order.filter(F.col("words") * 2 >= F.col("size")).select(*(c.alias(n) for n, c in column.items()))


def order_of_copies(docs: DataFrame) -> DataFrame:
    """(doc_id, size, position, place, pass) of each row of mixed documents that has words.

    The order is that of ``mixed_documents``, derived from the rows alone: a source's demand is the words its rows hold,
    equal rows are its passes. So it depends neither on files nor on partitions.
    """
    rows = sized(docs if "source" in docs.columns else docs.withColumn("source", F.lit(None).cast("string")))
    once = cut(rows.filter("size > 0").groupBy("doc_id", "source", "size", "spread").agg(F.count("*").alias("copies")))
    per_source = once.groupBy("source").agg(
        F.count("*").alias("source_rows"), F.sum("size").alias("source_size"), F.sum(F.col("size") * F.col("copies")).cast("double").alias("target")
    )
    goals = per_source.withColumn("place", F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))) - 1)
    placed = taken_from(once, *planned(once, goals))
    each = placed.withColumn("pass", F.explode(F.sequence(F.lit(0), (F.col("copies") - 1).cast("int"))))
    share = F.least(F.lit(1.0), (F.col("pass") * F.col("source_size") + F.col("offset")) / F.col("target"))
    return each.select("doc_id", "size", time_of(share, F.col("place")).alias("position"), "place", "pass")


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ordered_mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


OP6_SQL = rf"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
    md5(coalesce(doc_id::VARCHAR, '')) AS spread
  FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place FROM d GROUP BY source
), w AS (
  SELECT *, ([{", ".join(map(str, WEIGHTS))}])[place % {len(WEIGHTS)} + 1]::BIGINT AS weight FROM s
), o AS (
  SELECT *, row_number() OVER r AS rank, sum(source_size) OVER () AS size_all,
    coalesce(sum(source_size) OVER (r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS size_before,
    sum(weight) OVER (r ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weight_after
  FROM w WINDOW r AS (ORDER BY source_size / weight, place)
), f AS (
  SELECT *, size_all * {SHARE_PERCENT} - size_before * {MOST_PASSES * 100} AS rest FROM o
), g AS (
  SELECT *, source_size * {MOST_PASSES * 100} * weight_after <= rest * weight AS is_full FROM f
), h AS (
  SELECT *, min(CASE WHEN NOT is_full THEN rank END) OVER () AS first_open FROM g
), t AS (
  SELECT h.source, h.place, h.source_size, CASE WHEN h.is_full OR x.rank IS NULL THEN (h.source_size * {MOST_PASSES})::DOUBLE
    ELSE (h.weight * x.rest)::DOUBLE / (x.weight_after * 100)::DOUBLE END AS target
  FROM h LEFT JOIN h x ON x.rank = h.first_open
), r AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, round(t.target)::BIGINT AS goal,
    coalesce(sum(d.size) OVER (PARTITION BY t.place ORDER BY d.spread, d.doc_id, d.size
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS begin_at
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target, (CASE WHEN source_size > 0 THEN goal // source_size ELSE 0 END * size
  + greatest(0, least(size, CASE WHEN source_size > 0 THEN goal % source_size ELSE 0 END - begin_at)))::BIGINT AS taken
FROM r
"""
