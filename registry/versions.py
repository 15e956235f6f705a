"""Comparison of two versions of a table."""

from __future__ import annotations

from pyspark.sql import functions as F

from registry.bindings import load, with_tables
from trackspark.operators import diff, joins
from trackspark.operators.rows import global_row_number
from trackspark.plans.maintenance import compare_tables, diagnose_tables

COLUMNS = ("p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice")


def old(spark, d):
    return load(spark, d, "part")


def new(spark, d):
    key = F.col("p_partkey")
    return load(spark, d, "part").where(F.col("p_size") != 13).select(
        "p_partkey",
        F.when(key % 70 != 0, F.col("p_name")).alias("p_name"),
        F.when(key % 30 == 0, "NA").otherwise(F.col("p_brand")).alias("p_brand"),
        "p_type",
        "p_size",
        F.when(key % 50 == 0, F.col("p_retailprice") + 1).otherwise(F.col("p_retailprice")).alias("p_retailprice"),
    )


VERSIONS = """old AS (SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part),
    new AS (SELECT p_partkey, CASE WHEN p_partkey % 70 <> 0 THEN p_name END AS p_name,
        CASE WHEN p_partkey % 30 = 0 THEN NULL ELSE p_brand END AS p_brand, p_type, p_size,
        CASE WHEN p_partkey % 50 = 0 THEN p_retailprice + 1 ELSE p_retailprice END AS p_retailprice
        FROM part WHERE p_size <> 13)"""
SAME = " AND ".join(f"a.{c} IS NOT DISTINCT FROM b.{c}" for c in COLUMNS)


def anti_sql(left: str, right: str) -> str:
    return with_tables(f"SELECT a.* FROM {left} a WHERE NOT EXISTS (SELECT 1 FROM {right} b WHERE {SAME})", VERSIONS)


def differs_sql(c: str) -> str:
    if c in ("p_retailprice", "p_size"):
        return f"coalesce(abs(n.{c} - o.{c}) > 1.490116119384766e-08, (n.{c} IS NULL) <> (o.{c} IS NULL))"
    return f"n.{c} IS DISTINCT FROM o.{c}"


def standard(spark, d):
    """Brand numbers and sizes as text next to names: only all-numeric columns become double."""
    rows = new(spark, d).select(
        "p_partkey",
        "p_name",
        F.when(F.col("p_brand") == "NA", "<NA>").otherwise(F.regexp_replace("p_brand", "Brand#", " +")).alias("brand_no"),
        F.when(F.col("p_size") % 2 == 0, "").otherwise(F.col("p_size").cast("string")).alias("odd_size"),
        F.lit("NA").alias("nothing"),
        F.concat(F.col("p_size").cast("string"), F.lit("a")).alias("mixed"),
    )
    return diff.standardise_types(rows)


def compared(spark, d):
    return compare_tables(new(spark, d), old(spark, d), keys=["p_partkey"])


def diagnosed(spark, d):
    return diagnose_tables(new(spark, d), old(spark, d), keys=["p_partkey"])


def identical(other, **options):
    def run(spark, d):
        left = diff.standardise_types(new(spark, d))
        right = diff.standardise_types(other(spark, d))
        return diff.tables_identical(left, right, **options)

    return run


def by_position(spark, d):
    """Rows aligned by their position in key order instead of by key."""
    return compare_tables(new(spark, d), old(spark, d), order_by=["p_partkey"]).by_variable


def by_brand(spark, d):
    """A repeated key that may be null: equal rows pair first, the rest of a brand in the order of the other columns."""
    standard_new, standard_old = (diff.standardise_types(t(spark, d)) for t in (new, old))
    return diff.Alignment(standard_new, standard_old, keys=["p_brand"]).by_variable()


def branded(spark, d):
    key = F.col("p_partkey")
    return load(spark, d, "part").select("p_partkey", "p_name", F.when(key % 30 != 0, F.col("p_brand")).alias("p_brand"), "p_size", "p_retailprice")


def inserted(spark, d):
    """Every second brand, null as one of them, has a new first row; in the others one price is changed."""
    rows = branded(spark, d)
    first = rows.groupBy(F.col("p_brand").alias("brand")).agg(F.min("p_partkey").alias("first"))
    marked = rows.join(F.broadcast(first), F.col("p_brand").eqNullSafe(F.col("brand")))
    dearer = (F.col("p_partkey") == F.col("first")) & (F.col("first") % 2 == 0)
    changed = marked.withColumn("p_retailprice", F.when(dearer, F.col("p_retailprice") + 1).otherwise(F.col("p_retailprice")))
    front = first.where(F.col("first") % 2 == 1).select(
        (-F.col("first")).alias("p_partkey"), F.lit("in front").alias("p_name"), F.col("brand").alias("p_brand"), F.lit(0).alias("p_size"), F.lit(0.0).alias("p_retailprice")
    )
    return changed.select(*rows.columns).unionByName(front)


def inserted_pairs(spark, d):
    return diff.Alignment(inserted(spark, d), branded(spark, d), keys=["p_brand"])


BRANDED = """branded AS (SELECT p_partkey, p_name, CASE WHEN p_partkey % 30 <> 0 THEN p_brand END AS p_brand, p_size, p_retailprice FROM part)"""
INSERTED = """firsts AS (SELECT p_brand, min(p_partkey) AS f FROM branded GROUP BY 1),
    inserted AS (SELECT p_partkey, p_name, b.p_brand, p_size, CASE WHEN p_partkey = f AND f % 2 = 0 THEN p_retailprice + 1 ELSE p_retailprice END
        AS p_retailprice FROM branded b JOIN firsts ON b.p_brand IS NOT DISTINCT FROM firsts.p_brand
        UNION ALL SELECT -f, 'in front', p_brand, 0, 0.0::DOUBLE FROM firsts WHERE f % 2 = 1),
    come AS (SELECT * FROM inserted EXCEPT ALL SELECT * FROM branded), gone AS (SELECT * FROM branded EXCEPT ALL SELECT * FROM inserted)"""
# What is left of a brand is one row on each side or one new row, so nothing has to be ranked.
LEFT_PAIRS = "come n JOIN gone o ON n.p_brand IS NOT DISTINCT FROM o.p_brand"


def exact(spark, d):
    """Whole numbers beyond the precision of doubles, one apart for every seventh key."""
    big = load(spark, d, "part").select("p_partkey", (F.col("p_partkey") + 9007199254740992).alias("big"))
    other = big.withColumn("big", F.col("big") + F.when(F.col("p_partkey") % 7 == 0, 1).otherwise(0))
    return diff.Alignment(other, big, keys=["p_partkey"]).by_variable()


def slightly_off(spark, d):
    """Prices that differ in the 7th decimal only: unequal plainly, equal after rounding."""
    off = old(spark, d).withColumn("p_retailprice", F.bround("p_retailprice", 2) + F.lit(0.0000001))
    plain = old(spark, d).withColumn("p_retailprice", F.bround("p_retailprice", 2))
    return diff.diagnostics(off, plain).select("identical", "identical_after_rounding", "row_counts_match")


def only_order(spark, d):
    """The same rows as bags; numbered by a column in which the other version runs backwards, they differ."""
    rows = old(spark, d).select("p_partkey", "p_brand")
    turned = rows.select((F.lit(-1) * F.col("p_partkey")).alias("p_partkey"), "p_brand")
    bag, placed = (diff.tables_identical(rows, turned, **o) for o in ({}, {"order_by": ["p_brand"]}))
    same = diff.tables_identical(rows, rows.repartition(7), order_by=["p_brand"])
    return bag.select(F.col("identical").alias("bag")).select("bag", placed.scalar().alias("placed"), same.scalar().alias("shuffled"))


def numbered(spark, d):
    rows = old(spark, d).select("p_partkey", "p_brand")
    return global_row_number(rows, ["p_brand", "p_partkey"])


def by_variable_sql(pairing: str, keys: tuple[str, ...] = ("p_partkey",)) -> str:
    return with_tables(
        " UNION ALL ".join(
            f"""SELECT '{c}' AS variable, count_if({differs_sql(c)}) AS n_diff,
            count_if((n.{c} IS NULL) <> (o.{c} IS NULL)) AS n_one_null FROM {pairing}"""
            for c in COLUMNS
            if c not in keys or "pos" in pairing
        ),
        VERSIONS,
        """new_pos AS (SELECT *, row_number() OVER (ORDER BY p_partkey) AS pos FROM new)""",
        """old_pos AS (SELECT *, row_number() OVER (ORDER BY p_partkey) AS pos FROM old)""",
        """new_brand AS (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) AS nth
            FROM (SELECT * FROM new EXCEPT ALL SELECT * FROM old))""",
        """old_brand AS (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) AS nth
            FROM (SELECT * FROM old EXCEPT ALL SELECT * FROM new))""",
    )


CELLS = "cells AS (" + " UNION ALL ".join(
    f"""SELECT n.p_partkey, '{c}' AS variable, CAST(n.{c} AS VARCHAR) AS new_value, CAST(o.{c} AS VARCHAR) AS old_value,
    (n.{c} IS NULL) <> (o.{c} IS NULL) AS one_null FROM new n JOIN old o USING (p_partkey) WHERE {differs_sql(c)}"""
    for c in COLUMNS[1:]
) + ")"

QUERIES = {
    "anti_new_vs_old": (lambda spark, d: compared(spark, d).rows_only_new, anti_sql("new", "old")),
    "anti_old_vs_new": (lambda spark, d: compared(spark, d).rows_only_old, anti_sql("old", "new")),
    "anti_keeps_duplicates": (
        lambda spark, d: joins.anti_join_null_safe(new(spark, d).select("p_brand", "p_size"), old(spark, d).select("p_brand", "p_size")),
        with_tables(
            """SELECT coalesce(p_brand, 'NA') AS p_brand, p_size FROM new WHERE (coalesce(p_brand, 'NA'), p_size)
            NOT IN (SELECT (p_brand, p_size) FROM old)""",
            VERSIONS,
        ),
    ),
    "diff_row_counts": (
        lambda spark, d: compared(spark, d).row_counts,
        with_tables(
            """SELECT count(n.p_partkey) FILTER (o.p_partkey IS NOT NULL) AS rows_shared, count_if(o.p_partkey IS NULL) AS rows_only_new,
            count_if(n.p_partkey IS NULL) AS rows_only_old FROM new n FULL JOIN old o ON n.p_partkey = o.p_partkey""",
            VERSIONS,
        ),
    ),
    "diff_by_variable": (lambda spark, d: compared(spark, d).by_variable, by_variable_sql("new n JOIN old o USING (p_partkey)")),
    "diff_by_position": (by_position, by_variable_sql("new_pos n JOIN old_pos o USING (pos)")),
    "diff_repeated_keys": (
        lambda spark, d: inserted_pairs(spark, d).by_variable(),
        with_tables(
            " UNION ALL ".join(
                f"SELECT '{c}' AS variable, count_if({differs_sql(c)}) AS n_diff, count_if((n.{c} IS NULL) <> (o.{c} IS NULL)) AS n_one_null FROM {LEFT_PAIRS}"
                for c in ("p_partkey", "p_name", "p_size", "p_retailprice")
            ),
            BRANDED,
            INSERTED,
        ),
    ),
    "diff_inserted_rows": (
        lambda spark, d: inserted_pairs(spark, d).counts(),
        with_tables(
            """SELECT (SELECT count(*) FROM branded) AS rows_shared, (SELECT count(*) FROM inserted) - (SELECT count(*) FROM branded) AS rows_only_new,
            0::BIGINT AS rows_only_old""",
            BRANDED,
            INSERTED,
        ),
    ),
    "diff_changed_keys": (
        by_brand,
        by_variable_sql("new_brand n JOIN old_brand o ON n.p_brand IS NOT DISTINCT FROM o.p_brand AND n.nth = o.nth", ("p_brand",)),
    ),
    "diff_exact_integers": (
        exact,
        "SELECT 'big' AS variable, count_if(p_partkey % 7 = 0) AS n_diff, 0::BIGINT AS n_one_null FROM part",
    ),
    "diff_flags_rounding": (
        slightly_off,
        """SELECT NOT EXISTS (SELECT p_partkey, round_even(p_retailprice, 2) + 0.0000001::DOUBLE FROM part
            EXCEPT ALL SELECT p_partkey, round_even(p_retailprice, 2) FROM part) AS identical,
        NOT EXISTS (SELECT p_partkey, round_even(round_even(p_retailprice, 2) + 0.0000001::DOUBLE, 6) FROM part
            EXCEPT ALL SELECT p_partkey, round_even(round_even(p_retailprice, 2), 6) FROM part) AS identical_after_rounding,
        true AS row_counts_match""",
    ),
    "tables_identical_order_only": (
        only_order,
        """WITH a AS (SELECT p_partkey, p_brand FROM part), b AS (SELECT -p_partkey AS p_partkey, p_brand FROM part),
        x AS (SELECT *, row_number() OVER (ORDER BY p_brand, p_partkey) AS i FROM a),
        y AS (SELECT *, row_number() OVER (ORDER BY p_brand, p_partkey) AS i FROM b)
        SELECT NOT EXISTS (SELECT * FROM a EXCEPT ALL SELECT * FROM b) AS bag,
        NOT EXISTS (SELECT * FROM x EXCEPT ALL SELECT * FROM y) AS placed, true AS shuffled""",
    ),
    "diff_cells": (lambda spark, d: diagnosed(spark, d).differing_cells, with_tables("SELECT * FROM cells", VERSIONS, CELLS)),
    "diff_samples": (
        lambda spark, d: diagnosed(spark, d).samples,
        with_tables(
            "SELECT * FROM cells QUALIFY row_number() OVER (PARTITION BY variable ORDER BY p_partkey) <= 5", VERSIONS, CELLS
        ),
    ),
    "diff_diagnostics": (
        lambda spark, d: diagnosed(spark, d).diagnostics,
        with_tables(
            """SELECT true AS column_names_match, true AS column_types_match,
            (SELECT count(*) FROM new) = (SELECT count(*) FROM old) AS row_counts_match, true AS column_counts_match,
            true AS attributes_equal, same AS identical, same AS identical_after_rounding, same AS identical_after_encoding
            FROM (SELECT NOT EXISTS (SELECT * FROM new EXCEPT ALL SELECT * FROM old)
            AND NOT EXISTS (SELECT * FROM old EXCEPT ALL SELECT * FROM new) AS same)""",
            VERSIONS,
        ),
    ),
    "standardise_types": (
        standard,
        with_tables(
            """SELECT p_partkey, p_name, CAST(replace(p_brand, 'Brand#', '') AS DOUBLE) AS brand_no,
            CASE WHEN p_size % 2 <> 0 THEN p_size::DOUBLE END AS odd_size, CAST(NULL AS DOUBLE) AS nothing,
            CAST(p_size AS VARCHAR) || 'a' AS mixed FROM new""",
            VERSIONS,
        ),
    ),
    "tables_identical": (
        identical(old),
        with_tables(
            """SELECT NOT EXISTS (SELECT * FROM new EXCEPT ALL SELECT * FROM old)
            AND NOT EXISTS (SELECT * FROM old EXCEPT ALL SELECT * FROM new) AS identical""",
            VERSIONS,
        ),
    ),
    "tables_identical_ordered": (
        identical(new, order_by=["p_partkey"]),
        with_tables("SELECT count(*) = count(DISTINCT p_partkey) AS identical FROM new", VERSIONS),
    ),
    "global_row_number": (
        numbered,
        "SELECT p_partkey, p_brand, row_number() OVER (ORDER BY p_brand, p_partkey) AS row_id FROM part",
    ),
}
