"""Comparison of two versions of a table."""

from __future__ import annotations

from collections.abc import Sequence
from functools import cached_property

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trackspark.functions.text import NUMERIC_TEXT, missing_to_null
from trackspark.functions.times import clock_seconds_as_utc, relabel_zone
from trackspark.operators.rows import KEY_ROWS, global_row_number, numbered_by_key, sortable, top_per_group
from trackspark.operators.sizes import broadcast_if_small
from trackspark.session import shared_dir

# Fixed value: numbers closer than this are equal (square root of the double epsilon).
NUMBER_TOLERANCE = 1.490116119384766e-08
# Copies of a row listed by one array.
COPIES = 1 << 16


def standardise_types(
    df: DataFrame, zone: str | None = None, force_zone: str | None = None, cut_zone: str | None = None
) -> DataFrame:
    """Missing-cell texts become null, and text columns holding only numbers become double.

    All text columns are tested in one aggregate; a column of nulls only counts as numeric.
    Instants are left alone, or re-labelled: ``force_zone`` keeps the clock reading shown in
    ``zone`` and moves it there, ``cut_zone`` reads the clock there to whole seconds as UTC.
    """
    texts = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    cleaned = df.withColumns({c: missing_to_null(F.col(c)) for c in texts}) if texts else df
    if texts:
        tests = [F.coalesce(F.bool_and(F.col(c).isNull() | F.col(c).rlike(NUMERIC_TEXT)), F.lit(True)) for c in texts]
        numeric = cleaned.agg(*[t.alias(f"_{i}") for i, t in enumerate(tests)]).first()
        casts = {c: F.trim(F.col(c)).cast("double") for i, c in enumerate(texts) if numeric[i]}
        cleaned = cleaned.withColumns(casts) if casts else cleaned
    instants = [f.name for f in df.schema if isinstance(f.dataType, T.TimestampType)]
    if force_zone:
        cleaned = cleaned.withColumns({c: relabel_zone(F.col(c), zone or "UTC", force_zone) for c in instants})
    elif cut_zone:
        cleaned = cleaned.withColumns({c: clock_seconds_as_utc(F.col(c), cut_zone) for c in instants})
    return cleaned


def row_hashes(df: DataFrame) -> list[Column]:
    """Two 64-bit hashes (``_h1``, ``_h2``) of a whole row: equal rows, nulls and signed zeros included, have equal hashes."""
    cells = []
    for f in df.schema:
        cell = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cell = cell + F.lit(0.0)
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            cell = F.to_json(F.struct(cell.alias("c")), {"ignoreNullFields": "false"})
        cells.append(cell)
    # A null leaves a hash as it is; where the nulls are is hashed as well.
    cells.append(F.array(*[F.isnull(F.col(f"`{c}`")) for c in df.columns]))
    return [F.xxhash64(*cells).alias("_h1"), F.xxhash64(F.lit(1), *cells).alias("_h2")]


def signed_counts(new: DataFrame, old: DataFrame) -> DataFrame:
    """(_h1, _h2, _new, _old): how often each distinct row occurs in either table. Only hashes are shuffled."""
    one, none = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    both = new.select(*row_hashes(new), one.alias("_new"), none.alias("_old")).unionAll(
        old.select(*row_hashes(old), none.alias("_new"), one.alias("_old"))
    )
    return both.groupBy("_h1", "_h2").agg(F.sum("_new").alias("_new"), F.sum("_old").alias("_old"))


def _unequal_rows(new: DataFrame, old: DataFrame) -> DataFrame:
    """One row: number of distinct rows whose multiplicity differs between the tables."""
    return signed_counts(new, old.select(*new.columns)).agg(F.count_if(F.col("_new") != F.col("_old")).alias("n"))


def _plain_types(df: DataFrame) -> list[tuple[str, str]]:
    return [(f.name, f.dataType.simpleString()) for f in df.schema]


def tables_identical(new: DataFrame, old: DataFrame, order_by: Sequence[str] | None = None) -> DataFrame:
    """One row (``identical``): same columns and types and the same rows, as bags.

    With ``order_by`` both tables are numbered in that order first, which also compares order.
    """
    spark = new.sparkSession
    if _plain_types(new) != _plain_types(old):
        return spark.range(1).select(F.lit(False).alias("identical"))
    if order_by:
        new, old = (global_row_number(t, order_by, "_row") for t in (new, old))
    return _unequal_rows(new, old).select((F.col("n") == 0).alias("identical"))


def _differs(a: Column, b: Column, dtype: T.DataType, tolerance: float) -> Column:
    """Floating numbers differ beyond the tolerance; whole and decimal numbers are compared exactly."""
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        x, y = a.cast("double"), b.cast("double")
        same = (x == y) | (F.abs(x - y) <= tolerance)
        return F.coalesce(~same, a.isNull() != b.isNull())
    return ~a.eqNullSafe(b)


def cancelled(new: DataFrame, old: DataFrame) -> tuple[int, DataFrame]:
    """(pairs of equal rows, the rows that are left) of two tables with the same columns, as bags.

    Every row of one table cancels one equal row of the other. What is left of a row is listed as often as it is left;
    ``_side`` is 1 for the new table and 0 for the old one. The tables are shuffled as hashes only; their rows
    meet the few hashes that are left over.
    """
    shared_dir(new.sparkSession)
    seen = Observation()
    counts = signed_counts(new, old).observe(seen, F.coalesce(F.sum(F.least("_new", "_old")), F.lit(0)).alias("equal"))
    more = counts.select("_h1", "_h2", (F.col("_new") - F.col("_old")).alias("_more")).where(F.col("_more") != 0).checkpoint()

    def left_over(df: DataFrame, side: int) -> DataFrame:
        surplus = more.where(F.col("_more") > 0) if side else more.where(F.col("_more") < 0).withColumn("_more", -F.col("_more"))
        rows = df.select("*", *row_hashes(df)).join(broadcast_if_small(surplus), ["_h1", "_h2"])
        once = rows.dropDuplicates(["_h1", "_h2"])
        # Copies are listed in two steps, so that no array holds them all.
        many = once.withColumn("_part", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("_more") - 1) / COPIES))))
        size = F.least(F.lit(COPIES), F.col("_more") - F.col("_part") * COPIES).cast("int")
        return many.select(*df.columns, F.explode(F.array_repeat(F.lit(side), size)).alias("_side"))

    left = left_over(new, 1).unionAll(left_over(old, 0)).checkpoint()
    return seen.get["equal"], left


class Alignment:
    """Rows of two tables brought side by side, by key columns or by position in a given order.

    By key, rows that are equal in all shared columns are paired first: they cancel as signed counts of row hashes and
    are never sorted or joined. What is left of a key is numbered in the order of the shared columns and paired by
    number, so repeated and null keys pair one to one. Keys match null-safely. The comparison keeps one row per pair
    that is left; differences are counted in wide form, so rows are not multiplied by the number of columns.

    Pairing runs when a result is first asked for, and what is left is written once to the shared checkpoint folder.
    """

    def __init__(
        self,
        new: DataFrame,
        old: DataFrame,
        keys: Sequence[str] | None = None,
        order_by: Sequence[str] | None = None,
        tolerance: float = NUMBER_TOLERANCE,
        key_rows: int = KEY_ROWS,
    ):
        if bool(keys) == bool(order_by):
            raise ValueError("give either keys or order_by")
        self.order_by = list(order_by or ())
        self.keys = list(keys) if keys else ["row_id"]
        self.shared = [c for c in new.columns if c in old.columns and c not in self.keys]
        self.only_new = [c for c in new.columns if c not in old.columns]
        self.only_old = [c for c in old.columns if c not in new.columns]
        # Numbers of two kinds are compared as a type that holds both, other columns of two kinds as texts.
        self.types = {
            c: _common(new.schema[c].dataType, old.schema[c].dataType)
            for c in [*self.shared, *self.keys]
            if c in new.columns
        }
        self.new, self.old, self.tolerance, self.key_rows = new, old, tolerance, key_rows
        self.both = F.col("n_here").isNotNull() & F.col("o_here").isNotNull()

    def _side(self, df: DataFrame) -> DataFrame:
        keys = [(F.col(k).cast(self.types[k]) if k in self.types else F.col(k)).alias(f"k{i}") for i, k in enumerate(self.keys)]
        cells = [F.col(c).cast(self.types[c]).alias(f"c{i}") for i, c in enumerate(self.shared)]
        return df.select(*keys, *cells)

    @cached_property
    def _paired(self) -> tuple[int, DataFrame]:
        new, old = self.new, self.old
        if self.order_by:
            # Positions are unique: nothing to cancel or to number.
            new, old = (global_row_number(t, self.order_by, "row_id") for t in (new, old))
            equal, sides = 0, [self._side(t).withColumn("_nth", F.lit(1)) for t in (new, old)]
        else:
            equal, left = cancelled(self._side(new), self._side(old))
            keys = [f"k{i}" for i in range(len(self.keys))]
            order = sortable(left, [f"c{i}" for i in range(len(self.shared))])
            numbered = numbered_by_key(left, ["_side", *keys], order, "_nth", self.key_rows)
            sides = [numbered.where(F.col("_side") == s) for s in (1, 0)]
        left, right = (
            side.select(
                *[F.col(f"k{i}").alias(f"{p}_k{i}") for i in range(len(self.keys))],
                *[F.col(f"c{i}").alias(f"{p}_{i}") for i in range(len(self.shared))],
                F.col("_nth").alias(f"{p}_nth"),
                F.lit(1).alias(f"{p}_here"),
            )
            for p, side in zip("no", sides, strict=True)
        )
        same = [F.col(f"n_k{i}").eqNullSafe(F.col(f"o_k{i}")) for i in range(len(self.keys))]
        return equal, left.join(right, [*same, F.col("n_nth") == F.col("o_nth")], "full")

    @property
    def equal(self) -> int:
        """Pairs that are equal in all columns and were cancelled."""
        return self._paired[0]

    @property
    def pairs(self) -> DataFrame:
        """The pairs that were not cancelled, and the rows without a partner."""
        return self._paired[1]

    def _difference(self, i: int) -> Column:
        return _differs(F.col(f"n_{i}"), F.col(f"o_{i}"), self.types[self.shared[i]], self.tolerance)

    def counts(self) -> DataFrame:
        """One row: rows on both sides and on one side only."""
        return self.pairs.agg(
            (F.count_if(self.both) + F.lit(self.equal)).alias("rows_shared"),
            F.count_if(F.col("o_here").isNull()).alias("rows_only_new"),
            F.count_if(F.col("n_here").isNull()).alias("rows_only_old"),
        )

    def by_variable(self) -> DataFrame:
        """Number of differing rows and of null-versus-value rows for every shared column."""
        cells = []
        for i, name in enumerate(self.shared):
            differs = self.both & self._difference(i)
            one_null = self.both & (F.col(f"n_{i}").isNull() != F.col(f"o_{i}").isNull())
            cells.append(
                F.struct(
                    F.lit(name).alias("variable"),
                    F.count_if(differs).alias("n_diff"),
                    F.count_if(one_null).alias("n_one_null"),
                )
            )
        wide = self.pairs.agg(F.array(*cells).alias("_all"))
        return wide.select(F.inline("_all"))

    def differing_cells(self) -> DataFrame:
        """Long form, differing cells only: key columns, variable, both values as text, null flag."""
        cells = [
            F.struct(
                F.lit(name).alias("variable"),
                F.col(f"n_{i}").cast("string").alias("new_value"),
                F.col(f"o_{i}").cast("string").alias("old_value"),
                (F.col(f"n_{i}").isNull() != F.col(f"o_{i}").isNull()).alias("one_null"),
                self._difference(i).alias("_differs"),
            )
            for i, name in enumerate(self.shared)
        ]
        listed = F.filter(F.array(*cells), lambda s: s["_differs"])
        keys = [F.col(f"n_k{i}").alias(k) for i, k in enumerate(self.keys)]
        return self.pairs.where(self.both).select(*keys, F.inline(listed)).drop("_differs")

    def samples(self, k: int = 5) -> DataFrame:
        """The first ``k`` differing cells of every variable in key order."""
        return top_per_group(self.differing_cells(), ["variable"], self.keys, k)


# Digits before the point of whole numbers.
DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}


def _common(a: T.DataType, b: T.DataType) -> T.DataType:
    """Type two columns are compared as: a number that holds both, one type, or else texts."""
    if a == b:
        return a
    if not (isinstance(a, T.NumericType) and isinstance(b, T.NumericType)):
        return T.StringType()
    if isinstance(a, (T.DoubleType, T.FloatType)) or isinstance(b, (T.DoubleType, T.FloatType)):
        return T.DoubleType()
    if type(a) in DIGITS and type(b) in DIGITS:
        return T.LongType()
    whole = max(DIGITS[type(t)] if type(t) in DIGITS else t.precision - t.scale for t in (a, b))
    scale = max(getattr(t, "scale", 0) for t in (a, b))
    return T.DecimalType(min(38, whole + scale), min(scale, 38 - min(38, whole)))


def _rounded(df: DataFrame, digits: int) -> DataFrame:
    numbers = [f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType, T.DecimalType))]
    return df.withColumns({c: F.bround(c, digits) for c in numbers}) if numbers else df


def _valid_utf8(df: DataFrame) -> DataFrame:
    texts = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: F.make_valid_utf8(c) for c in texts}) if texts else df


def _attributes(df: DataFrame) -> list:
    return [(f.name, f.nullable, f.metadata) for f in df.schema]


def diagnostics(new: DataFrame, old: DataFrame, digits: int = 6) -> DataFrame:
    """One row of comparisons: names, types, counts, attributes, and equality as bags plain,
    after rounding, and after making texts valid UTF-8."""
    names = new.columns == old.columns
    types = [t for _, t in _plain_types(new)] == [t for _, t in _plain_types(old)]

    kinds = {type(f.dataType) for f in new.schema}
    plain = _unequal_rows(new, old).scalar() == 0 if names and types else F.lit(False)

    def identical(change, *changed: type) -> Column:
        """Equality after a change; without a column that it changes, plain equality."""
        if not (names and types) or kinds.isdisjoint(changed):
            return plain
        return _unequal_rows(change(new), change(old)).scalar() == 0

    def rows(df: DataFrame) -> Column:
        return df.agg(F.count(F.lit(1))).scalar()

    return new.sparkSession.range(1).select(
        F.lit(names).alias("column_names_match"),
        F.lit(types).alias("column_types_match"),
        (rows(new) == rows(old)).alias("row_counts_match"),
        F.lit(len(new.columns) == len(old.columns)).alias("column_counts_match"),
        F.lit(_attributes(new) == _attributes(old)).alias("attributes_equal"),
        plain.alias("identical"),
        identical(lambda t: _rounded(t, digits), T.DoubleType, T.FloatType, T.DecimalType).alias("identical_after_rounding"),
        identical(_valid_utf8, T.StringType).alias("identical_after_encoding"),
    )

