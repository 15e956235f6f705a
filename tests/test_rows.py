import random

from conftest import bag
from pyspark.sql import functions as F

from trackspark.operators import combine, rows, sizes


def test_keep_first_follows_the_order_and_groups_nulls(spark):
    df = spark.createDataFrame([("a", 3, "x"), ("a", 1, "y"), (None, 2, "z"), (None, None, "w")], "k string, o int, v string")
    assert bag(rows.keep_first(df, ["k"], ["o"])) == [("a", 1, "y"), (None, 2, "z")]


def test_keep_first_without_order_ignores_the_layout(spark):
    data = [(i % 5, str(i * 37 % 101)) for i in range(100)]
    one = spark.createDataFrame(data, "k int, v string")
    two = spark.createDataFrame(data[::-1], "k int, v string").repartition(7)
    assert bag(rows.keep_first(one, ["k"])) == bag(rows.keep_first(two, ["k"]))


def test_first_rows_are_limited_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    for out in (rows.keep_first(df, ["k"], ["v"]), rows.top_per_group(df, ["k"], ["v"], 5)):
        plan = out._jdf.queryExecution().executedPlan().toString()
        exchange = plan.index("Exchange")
        assert "WindowGroupLimit" in plan[exchange:] and "Partial" in plan[exchange:]


def test_distinct_per_source(spark):
    df = spark.createDataFrame([(1, "f1"), (1, "f1"), (1, "f2")], "a int, _source_file string")
    assert bag(rows.distinct_per_source(df)) == [(1,), (1,)]
    assert bag(rows.distinct_per_source(df, None)) == [(1,)]


def test_ordinals_of_sparse_ids_and_common_prefixes(spark):
    keys = [(s, e) for s in ("loc_b", "loc_a", None) for e in (5, 250_000_000_000, 100_001, 7)]
    random.Random(1).shuffle(keys)
    df = spark.createDataFrame(keys, "species string, elasmo bigint")
    out = rows.ordinals(df, ["species", "elasmo"], "n")
    expected = sorted(keys, key=lambda k: (k[0] is None, k[0] or "", k[1]))
    assert {(r.species, r.elasmo): r.n for r in out.collect()} == {k: i + 1 for i, k in enumerate(expected)}


def test_global_row_number(spark):
    values = [i * 7919 % 1000 for i in range(1000)]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v int").repartition(5)
    out = rows.global_row_number(df, ["v"])
    assert {r.v: r.row_id for r in out.collect()} == {**{v: v + 1 for v in values}, None: 1001}


COORDS = "location string, deploy_long string, deploy_lat string, n int"


def test_most_precise_coordinates(spark):
    df = spark.createDataFrame(
        [
            ("a", "-79.1", "24.42", 1), ("a", "-79.123", None, 2), ("a", "-79.124", "24.41", 3), ("a", None, "24.4", 4),
            (None, "-1.25", "2", 5), (None, "-1.2", "2.5", 6), ("b", None, "1", 7),
        ],
        COORDS,
    )
    out = {r.n: (r.deploy_long, r.deploy_lat) for r in combine.most_precise_coordinates(df, ["n"]).collect()}
    # Longest text per column, the first of equals, from different rows if need be.
    assert out[1] == out[2] == out[3] == out[4] == ("-79.123", "24.42")
    assert out[5] == out[6] == ("-1.25", "2.5") and out[7] == (None, "1")
    two = {r.n: (r.deploy_long, r.deploy_lat) for r in combine.most_precise_coordinates(df, ["location", "n"]).collect()}
    assert two == out


def test_registry_update(spark):
    vloc = spark.createDataFrame(
        [(1.0, 2.0, "a", None, None, 5.0, "AG0"), (1.0, 2.0, "b", 9.0, None, None, "AG0")],
        "deploy_lat double, deploy_long double, location string, bottom_depth double, riser_length double, instrument_depth double, agency string",
    )
    orph = spark.createDataFrame(
        [("2.50", "1.0", "c", "AG1", 1), ("2.5", "1", "later", "AG1", 2), ("x", None, "d", "AG2", 3), ("7", "8", "a", "AG2", 4)],
        "deploy_long string, deploy_lat string, location string, agency string, n int",
    )
    out = combine.update_receiver_registry(vloc, orph, {"C": 37, "a": 1}, {"A": 61.5, "b": 3.0}, ["n"])
    got = {(r.location, r.deploy_lat): (r.deploy_long, r.bottom_depth, r.instrument_depth) for r in out.collect()}
    assert got == {
        ("a", 1.0): (2.0, 61.5, 5.0),
        ("b", 1.0): (2.0, 9.0, None),
        ("c", 1.0): (2.5, None, 37.0),
        ("d", None): (None, None, None),
        ("a", 8.0): (7.0, 61.5, 1.0),
    }


def test_union_by_name(spark):
    a = spark.createDataFrame([(1, "x")], "a int, b string")
    b = spark.createDataFrame([("y", 2)], "b string, c int")
    assert bag(combine.union_by_name(a, b)) == [(1, "x", None), (None, "y", 2)]


def test_nested_and_binary_cells_count_in_full(spark):
    df = spark.range(1).selectExpr("array_repeat(1.5D, 100000) as a", "cast(repeat('x', 5000) as binary) as b", "id")
    assert df.select(sizes.row_bytes(df)).first()[0] > 800_000


def test_running_total_over_all_rows(spark):
    import itertools
    import random

    from trackspark.operators import rows

    rng = random.Random(4)
    data = [(rng.choice("abc"), rng.randrange(20), rng.choice([None, 1, 5, -2])) for _ in range(500)]
    df = spark.createDataFrame(data, "k string, t int, n bigint").repartition(7)
    out = rows.running_total(df, ["k", "t"], "n", "cs")
    order = sorted(data, key=lambda r: (r[0], r[1], r[2] is None, r[2] or 0))
    sums = list(itertools.accumulate(n or 0 for *_, n in order))
    assert sorted((r.k, r.t, r.n is None, r.n or 0, r.cs) for r in out.collect()) == sorted(
        (k, t, n is None, n or 0, cs) for (k, t, n), cs in zip(order, sums, strict=True)
    )
    # Every window is within a partition of the sort.
    assert "SinglePartition" not in out._jdf.queryExecution().executedPlan().toString()
    assert rows.running_total(df.limit(0), ["k"], "n", "cs").count() == 0


def test_rows_of_a_key_are_numbered_alike_either_way(spark):
    from trackspark.operators import rows

    df = spark.range(300).select((F.col("id") % 4).alias("k"), F.xxhash64("id").alias("v")).unionByName(spark.sql("SELECT NULL AS k, id AS v FROM range(9)"))
    few, many = (sorted(map(str, rows.numbered_by_key(df, ["k"], ["v"], "n", most).collect())) for most in (1, 1000))
    assert few == many
