"""Text helpers as Column expressions."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Texts that stand for a missing cell, and the shape of a numeric text.
MISSING_TOKENS = ("NA", "<NA>", "")
NUMERIC_TEXT = r"^\s*[-+]?[0-9]*\.?[0-9]+\s*$"


def norm_name(c: Column) -> Column:
    """Lower case, outer blanks removed, inner runs of blanks replaced by one underscore."""
    squeezed = F.trim(F.regexp_replace(F.lower(c), r"[\s\p{Z}]+", " "))
    return F.translate(squeezed, " ", "_")


def normalised(name: str) -> str:
    """``norm_name`` of a text of the driver."""
    return "_".join(name.lower().split())


def suffix_id(c: Column) -> Column:
    """Text after the last hyphen; null when there is none (``"A-"``)."""
    return F.nullif(F.substring_index(c, "-", -1), F.lit(""))


def tag_id(c: Column) -> Column:
    """Canonical bigint id from text; text that is not a whole number becomes null."""
    return F.regexp_replace(F.trim(c.cast("string")), r"\.0+$", "").try_cast("bigint")


def first_t_to_blank(c: Column) -> Column:
    """Replace only the first ``T``, as in ``2024-01-01T08:00:00``."""
    return F.regexp_replace(c, "^([^T]*)T", "$1 ")


def replace_in_order(c: Column, rules: Iterable[tuple[str, str]]) -> Column:
    """Apply (pattern, replacement) rules one after the other; later rules see earlier results."""
    for pattern, replacement in rules:
        c = F.regexp_replace(c, pattern, replacement)
    return c


def serial_text(c: Column) -> Column:
    """Serial number as text without a trailing ``.0``, from a number or from text."""
    number = c.try_cast("double")
    whole = number.try_cast("bigint")
    return F.when(number == whole, whole.cast("string")).otherwise(c.cast("string"))


def not_in(c: Column, values: Sequence | None) -> Column:
    """Exclusion test that keeps null cells; ``None`` switches it off."""
    if not values:
        return F.lit(True)
    return F.coalesce(~c.isin(*values), F.lit(True))


def missing_to_null(c: Column) -> Column:
    """Texts that stand for a missing cell become null."""
    return F.when(~c.isin(*MISSING_TOKENS), c)


def digit_count(c: Column) -> Column:
    return F.regexp_count(c, F.lit("[0-9]"))


def snake_names(names: Sequence[str]) -> list[str]:
    """Snake-case column names; repeated names get ``_2``, ``_3``, …"""
    seen: dict[str, int] = {}
    out = []
    for name in names:
        text = re.sub(r"['\"]", "", name).replace("%", "_percent_").replace("#", "_number_")
        text = re.sub(r"([a-z0-9])([A-Z])", r"\1_\2", text)
        text = re.sub(r"[^0-9a-z]+", "_", text.lower()).strip("_") or "x"
        if text[0].isdigit():
            text = "x" + text
        seen[text] = seen.get(text, 0) + 1
        out.append(text if seen[text] == 1 else f"{text}_{seen[text]}")
    return out


def clean_names(df: DataFrame) -> DataFrame:
    """Rename every column to snake case."""
    return df.toDF(*snake_names(df.columns))
