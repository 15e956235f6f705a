import pytest
from conftest import bag
from pyspark.sql import functions as F

from trackspark.operators import diff, quality
from trackspark.plans.maintenance import compare_tables, diagnose_tables

SCHEMA = "k int, name string, x double, t timestamp"


@pytest.fixture
def versions(spark, ts):
    old = [(1, "a", 1.0, ts("2024-01-01")), (2, "b", 2.0, None), (3, None, None, ts("2024-01-03")), (4, "d", 4.0, None)]
    new = [(1, "a", 1.0 + 1e-9, ts("2024-01-01")), (2, "B", 2.1, None), (3, "c", None, None), (5, "e", 5.0, None)]
    return spark.createDataFrame(new, SCHEMA), spark.createDataFrame(old, SCHEMA)


def test_standardise_types(spark):
    df = spark.createDataFrame(
        [("NA", " 1 ", "1a", None, "<NA>", "1e5"), ("x", "-.5", "2", None, "", "2"), (None, "+3.", "NA", None, "NA", None)],
        "a string, b string, c string, d string, e string, f string",
    )
    out = diff.standardise_types(df)
    # "+3." has no digit after the point, so b stays text; d and e hold nothing and count as numbers.
    assert dict(out.dtypes) == {"a": "string", "b": "string", "c": "string", "d": "double", "e": "double", "f": "string"}
    numbers = diff.standardise_types(spark.createDataFrame([(" 1 ",), ("-.5",), ("NA",)], "b string"))
    assert bag(numbers) == [(-0.5,), (1.0,), (None,)]


def test_instants_are_relabelled_on_request(spark, ts):
    df = spark.createDataFrame([(ts("2024-07-01 12:00:00"),)], "t timestamp")
    assert bag(diff.standardise_types(df, "UTC", force_zone="US/Eastern")) == [("2024-07-01 16:00:00",)]
    assert bag(diff.standardise_types(df, cut_zone="US/Eastern")) == [("2024-07-01 08:00:00",)]
    assert bag(diff.standardise_types(df)) == [("2024-07-01 12:00:00",)]


def test_compare_by_key(versions):
    out = compare_tables(*versions, keys=["k"])
    assert out.identical.first()[0] is False
    assert bag(out.row_counts) == [(3, 1, 1)]
    # The tiny change of x is within the tolerance; null against value counts as different.
    assert bag(out.by_variable) == [("name", 2, 1), ("t", 1, 1), ("x", 1, 0)]
    assert sorted(r.k for r in out.rows_only_new.collect()) == [1, 2, 3, 5]
    assert sorted(r.k for r in out.rows_only_old.collect()) == [1, 2, 3, 4]


def test_tolerance_is_a_parameter(versions):
    assert ("x", 2, 0) in bag(compare_tables(*versions, keys=["k"], tolerance=0.0).by_variable)


def test_compare_by_position(versions):
    new, old = versions
    assert ("k", 1, 0) in bag(compare_tables(new, old, order_by=["k"]).by_variable)
    with pytest.raises(ValueError):
        compare_tables(new, old)
    with pytest.raises(ValueError):
        compare_tables(new, old, keys=["k"], order_by=["k"])


def test_a_table_equals_itself(versions):
    new, _ = versions
    out = compare_tables(new, new, keys=["k"])
    assert out.identical.first()[0] is True
    assert out.rows_only_new.count() == out.rows_only_old.count() == 0
    assert {r.n_diff for r in out.by_variable.collect()} == {0}


def test_identity_is_bag_equality_unless_ordered(spark):
    a = spark.createDataFrame([(1,), (1,), (2,)], "v int")
    b = spark.createDataFrame([(2,), (1,), (1,)], "v int")
    c = spark.createDataFrame([(1,), (2,), (2,)], "v int")
    assert diff.tables_identical(a, b).first()[0] is True
    assert diff.tables_identical(a, c).first()[0] is False
    assert diff.tables_identical(a, a.toDF("w")).first()[0] is False
    assert diff.tables_identical(a, a.select(F.col("v").cast("bigint").alias("v"))).first()[0] is False
    assert diff.tables_identical(a, b, order_by=["v"]).first()[0] is True


def test_columns_of_two_kinds_and_of_one_side(spark):
    new = spark.createDataFrame([(1, 5, "z")], "k int, v int, n string")
    old = spark.createDataFrame([(1, "5", 1.0)], "k int, v string, o double")
    pairs = diff.Alignment(new, old, ["k"])
    assert (pairs.only_new, pairs.only_old) == (["n"], ["o"])
    assert bag(pairs.by_variable()) == [("v", 0, 0)]


def test_diagnosis(versions):
    out = diagnose_tables(*versions, keys=["k"], samples=1)
    d = out.diagnostics.first().asDict()
    assert d["column_names_match"] and d["column_types_match"] and d["row_counts_match"] and d["column_counts_match"]
    assert not d["identical"] and not d["identical_after_rounding"] and not d["identical_after_encoding"]
    assert bag(out.samples) == [(2, "name", "B", "b", False), (2, "x", "2.1", "2.0", False), (3, "t", None, "2024-01-03 00:00:00", True)]
    assert ("3", "name") in {(str(r.k), r.variable) for r in out.differing_cells.collect()}


def test_rounding_hides_small_changes(spark):
    a = spark.createDataFrame([(1.0,)], "x double")
    b = spark.createDataFrame([(1.0 + 1e-9,)], "x double")
    d = diff.diagnostics(a, b).first()
    assert not d.identical and d.identical_after_rounding
    other = diff.diagnostics(a, b.toDF("y")).first()
    assert not other.column_names_match and not other.identical_after_rounding


def test_conversion_stats(spark):
    df = spark.createDataFrame([("4/8/25 9:05", "a"), ("no", "b"), (None, "c")], "`Date and Time (UTC)` string, other string")
    out = quality.convert_dates(df)
    assert out.columns == df.columns and sorted(r.other for r in out.collect()) == ["a", "b", "c"]
    assert bag(quality.conversion_stats(out)) == [(3, 2, 33.33)]
    with pytest.raises(TypeError):
        quality.convert_dates(out)
    with pytest.raises(ValueError):
        quality.convert_dates(df, "missing")


def test_repeated_and_null_keys_pair_one_to_one(spark):
    rows = [(None, 1), (None, 2), (None, 3), (5, 1), (5, 2)]
    df = spark.createDataFrame(rows, "k int, v int")
    same = diff.Alignment(df, df.repartition(3), keys=["k"])
    assert bag(same.counts()) == [(5, 0, 0)] and bag(same.by_variable()) == [("v", 0, 0)]
    more = diff.Alignment(df.union(df.limit(1)), df, keys=["k"])
    assert bag(more.counts()) == [(5, 1, 0)]


def test_whole_numbers_are_compared_exactly(spark):
    a = spark.createDataFrame([(1, 9007199254740993)], "k int, v bigint")
    b = spark.createDataFrame([(1, 9007199254740992)], "k int, v bigint")
    assert bag(diff.Alignment(a, b, keys=["k"]).by_variable()) == [("v", 1, 0)]
    c = a.withColumn("v", a.v.cast("double"))
    assert bag(diff.Alignment(c, b, keys=["k"]).by_variable()) == [("v", 0, 0)]


def test_order_is_compared_whatever_the_layout(spark):
    df = spark.createDataFrame([(i % 3, i) for i in range(200)], "k int, v int")
    assert diff.tables_identical(df, df.repartition(7), order_by=["k"]).first()[0]


def test_a_row_inserted_in_front_differs_from_nothing(spark):
    old = spark.createDataFrame([(1, i, f"n{i}", i / 7) for i in range(10)], "k int, a int, b string, x double")
    new = old.unionAll(spark.createDataFrame([(1, -1, "front", 0.0)], old.schema))
    pairs = diff.Alignment(new, old, keys=["k"])
    assert bag(pairs.by_variable()) == [("a", 0, 0), ("b", 0, 0), ("x", 0, 0)]
    assert bag(pairs.counts()) == [(10, 1, 0)] and pairs.equal == 10


@pytest.mark.parametrize("key_rows", [1, 1000])
def test_the_rest_of_a_key_pairs_in_order(spark, key_rows):
    rows = [(k, v) for k in (1, 2, None) for v in (1, 1, 2, 3, 3, 3)]
    old = spark.createDataFrame(rows, "k int, v int")
    new = spark.createDataFrame([r for r in rows if r != (1, 3)] + [(1, 7), (2, 8), (None, 9), (None, 3)], "k int, v int")
    pairs = diff.Alignment(new, old, keys=["k"], key_rows=key_rows)
    # Left over: key 1 has 7 against 3, 3, 3; key 2 has one row more, the null key two.
    assert bag(pairs.counts()) == [(16, 3, 2)]
    assert bag(pairs.by_variable()) == [("v", 1, 0)]
    assert bag(pairs.differing_cells()) == [(1, "v", "7", "3", False)]


def test_copies_are_counted_not_sorted(spark):
    one = spark.createDataFrame([(1, "x")], "k int, v string")
    many = spark.range(200_000).select(F.lit(1).alias("k"), F.lit("x").alias("v"))
    pairs = diff.Alignment(many, one, keys=["k"])
    assert pairs.equal == 1 and bag(pairs.counts()) == [(1, 199_999, 0)]
    assert bag(diff.Alignment(many, many.unionAll(one), keys=["k"]).counts()) == [(200_000, 0, 1)]


def test_hashes_tell_nulls_apart_and_signed_zeros_not(spark):
    rows = [(None, "a", 0.0, [1, None]), ("a", None, -0.0, [None, 1])]
    df = spark.createDataFrame(rows, "a string, b string, x double, l array<int>")
    hashes = [tuple(r) for r in df.select(*diff.row_hashes(df)).collect()]
    assert len(set(hashes)) == 2
    zeros = df.select("x")
    assert len({tuple(r) for r in zeros.select(*diff.row_hashes(zeros)).collect()}) == 1
    swapped = spark.createDataFrame([(r[1], r[0], *r[2:]) for r in rows], df.schema)
    assert bag(diff.Alignment(df, swapped, keys=["x"]).counts()) == [(2, 0, 0)]


def test_keys_of_two_kinds_match(spark):
    a = spark.createDataFrame([(1, 5), (3_000_000_000, 6)], "k bigint, v bigint")
    b = spark.createDataFrame([(1, 5), (2, 6)], "k int, v int")
    assert bag(diff.Alignment(b, a, keys=["k"]).counts()) == [(1, 1, 1)]
    c = spark.createDataFrame([(1, "5.00")], "k int, v string").withColumn("v", F.col("v").cast("decimal(5,2)"))
    assert bag(diff.Alignment(a, c, keys=["k"]).by_variable()) == [("v", 0, 0)]


def test_equal_rows_are_never_sorted_or_joined(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    pairs = diff.Alignment(df, df.where("v <> 5"), keys=["k"])
    assert bag(pairs.counts()) == [(999, 1, 0)] and pairs.pairs.count() == 1
