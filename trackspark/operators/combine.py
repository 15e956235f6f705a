"""Merging detections contributed by other arrays."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackspark.functions.text import digit_count, norm_name, normalised
from trackspark.operators.joins import lookup_table
from trackspark.operators.rows import keep_first
from trackspark.operators.sizes import settled


def union_by_name(*frames: DataFrame) -> DataFrame:
    """Union all by column name; a column missing on one side is null there."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out


def most_precise_coordinates(df: DataFrame, order: Sequence[str] = ()) -> DataFrame:
    """Give every row of a location the longitude and latitude texts with most digits.

    The two columns are chosen separately; of equally long texts the first by ``order`` wins
    (without an order, the smallest text). Rows without a location form one group.

    The choice is an aggregate with map-side combine joined back, so that a busy location is not
    gathered in one task. Its result, one row per location, is written to the shared checkpoint
    folder once; measured small it is broadcast, which spares the rows a shuffle by location.
    """

    # A location has few distinct texts: reduce to those first, each with its first position.
    first = [F.min(F.struct(*[F.struct(F.isnull(o), F.col(o)) for o in order])).alias("_at")] if len(order) > 1 else []
    first = [F.min(order[0]).alias("_at")] if len(order) == 1 else first
    grouped = df.groupBy(F.col("location").alias("_location"), "deploy_long", "deploy_lat")
    texts = grouped.agg(*(first or [F.lit(0).alias("_at")]))

    def best(c: str) -> Column:
        rank = F.struct(-digit_count(F.col(c)), F.isnull("_at"), F.col("_at"), F.col(c))
        return F.min_by(F.col(c), F.when(F.col(c).isNotNull(), rank)).alias(f"_{c}")

    chosen = texts.groupBy("_location").agg(best("deploy_long"), best("deploy_lat"))
    return (
        df.join(settled(chosen), F.col("location").eqNullSafe(F.col("_location")), "inner")
        .withColumns({"deploy_long": F.col("_deploy_long"), "deploy_lat": F.col("_deploy_lat")})
        .select(*df.columns)
    )


def update_receiver_registry(
    vloc: DataFrame,
    orph: DataFrame,
    instrument_depths: Mapping[str, float] | None = None,
    bottom_depths: Mapping[str, float] | None = None,
    order: Sequence[str] = (),
) -> DataFrame:
    """Receiver locations extended by the foreign ones, unique on coordinates among those.

    The depth tables map location names to metres; they are matched on normalised names.
    ``instrument_depths`` applies to the foreign rows, ``bottom_depths`` fills missing bottom
    depths of all rows.
    """
    foreign = orph.select("deploy_long", "deploy_lat", "location", "agency", *order).withColumns(
        {c: F.col(c).try_cast("double") for c in ("deploy_long", "deploy_lat")}
    )
    # Few places come from many detections: reduce to places and their first occurrence before sorting.
    places = ["deploy_long", "deploy_lat", "location", "agency"]
    at = [x for c in order for x in (F.isnull(c).alias(f"no_{c}"), F.col(c))]
    first = foreign.groupBy(*places).agg(F.min(F.struct(*at) if at else F.lit(0)).alias("_at"))
    foreign = keep_first(first, ["deploy_long", "deploy_lat"], ["_at"]).select(*places)
    foreign = _depth(foreign, instrument_depths, "instrument_depth")
    return _depth(union_by_name(vloc, foreign), bottom_depths, "bottom_depth")


def _depth(df: DataFrame, depths: Mapping[str, float] | None, column: str) -> DataFrame:
    known = F.col(column) if column in df.columns else F.lit(None).cast("double")
    if not depths:
        return df.withColumn(column, known)
    texts: dict[str, str] = {}
    for name, depth in depths.items():  # the first entry of a normalised name counts
        texts.setdefault(normalised(name), str(float(depth)))
    table = lookup_table(df.sparkSession, texts, "_name", "_depth")
    found = df.join(table, norm_name(F.col("location")) == F.col("_name"), "left")
    return found.withColumn(column, F.coalesce(known, F.col("_depth").cast("double"))).drop("_name", "_depth")
