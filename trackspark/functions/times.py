"""Time helpers as Column expressions.

Instants are ``TimestampType`` under a session pinned to UTC; a data zone is always an argument.
Inside a daylight-saving gap the clock reading is moved forward, in the repeated hour the first
pass is taken, as Spark's zone functions do.
"""

from __future__ import annotations

import re
from itertools import pairwise

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS_PER_HOUR = 3_600_000_000
MICROS_PER_DAY = 24 * MICROS_PER_HOUR

# Date-time directives with the text they accept, the matching Spark pattern and
# its zero-padded form.
DIRECTIVES = {
    "%Y": (r"\d{1,4}", "y", "yyyy"),
    "%y": (r"\d{2}", "yy", "yy"),
    "%m": (r"\d{1,2}", "M", "MM"),
    "%d": (r"\d{1,2}", "d", "dd"),
    "%H": (r"\d{1,2}", "H", "HH"),
    "%M": (r"\d{1,2}", "m", "mm"),
    "%S": (r"\d{1,2}", "s", "ss"),
}
# Layouts a plain cast reads; it takes the same digits and ignores nothing in between.
CASTABLE = ("yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd HH:mm")
# Month abbreviations; two-digit years 69-99 belong to the 1900s.
MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")
LAST_YEAR_OF_2000S = 2068
# A sheet's day serial counts from 1900-01-01 two days late; seconds from there to 1970.
SERIAL_SHIFT_DAYS = 2
SECONDS_1900_TO_1970 = 2_208_988_800


def is_utc(tz: str | None) -> bool:
    return tz is None or tz.upper() in ("UTC", "ETC/UTC", "GMT", "Z")


def wall_clock(ts: Column, tz: str | None) -> Column:
    """Clock reading in ``tz`` of an instant."""
    return ts if is_utc(tz) else F.from_utc_timestamp(ts, tz)


def from_wall_clock(clock: Column, tz: str | None) -> Column:
    """Instant of a clock reading in ``tz``."""
    return clock if is_utc(tz) else F.to_utc_timestamp(clock, tz)


def relabel_zone(ts: Column, src: str, dst: str) -> Column:
    """Keep the clock reading shown in ``src``, move it to ``dst`` (a forced zone)."""
    return from_wall_clock(wall_clock(ts, src), dst)


def clock_seconds_as_utc(ts: Column, src: str) -> Column:
    """Clock reading in ``src`` cut to seconds and labelled UTC."""
    return F.date_trunc("second", wall_clock(ts, src))


def local_date(ts: Column, tz: str | None) -> Column:
    return F.to_date(wall_clock(ts, tz))


def local_midnight(ts: Column, tz: str | None) -> Column:
    """Instant at which the local day of ``ts`` starts."""
    return from_wall_clock(F.date_trunc("day", wall_clock(ts, tz)), tz)


def year_month(ts: Column, tz: str | None) -> Column:
    return F.date_format(wall_clock(ts, tz), "yyyy-MM")


def first_of_month(ym: Column) -> Column:
    """``yyyy-MM`` text to the first day of that month."""
    return F.to_date(F.concat(ym, F.lit("-01")))


def clock_text(ts: Column, tz: str | None, pattern: str = "yyyy-MM-dd HH:mm") -> Column:
    return F.date_format(wall_clock(ts, tz), pattern)


def micros_between(start: Column, end: Column) -> Column:
    return F.unix_micros(end) - F.unix_micros(start)


def hours_between(start: Column, end: Column) -> Column:
    """Elapsed hours with fractions."""
    return micros_between(start, end) / F.lit(float(MICROS_PER_HOUR))


def days_between(start: Column, end: Column) -> Column:
    """Elapsed days with fractions."""
    return micros_between(start, end) / F.lit(float(MICROS_PER_DAY))


def add_clock_hours(ts: Column, hours: int, tz: str | None) -> Column:
    """Move the local clock reading; differs from elapsed hours only across a zone change."""
    return from_wall_clock(wall_clock(ts, tz) + F.make_dt_interval(hours=F.lit(hours)), tz)


def parse_clock(c: Column, fmt: str, whole: bool = False) -> Column:
    """Clock reading from text by a date-time format.

    Text after the part the format covers is ignored (``whole``: must be blank), fields may be unpadded, and a text
    that does not match gives null. Texts laid out like the zero-padded year-first form are cast
    directly, which spares the usual export the pattern matching.
    """
    prefix, pattern, padded, rest = r"^\s*", "", "", fmt
    while rest:
        token = rest[:2]
        if token in DIRECTIVES:
            shape, letters, full = DIRECTIVES[token]
            prefix, pattern, padded, rest = prefix + shape, pattern + letters, padded + full, rest[2:]
        elif rest[0].isspace():
            prefix, pattern, padded, rest = prefix + r"\s+", pattern + " ", padded + " ", rest.lstrip()
        elif rest[0] == "%" or rest[0].isalpha():
            raise ValueError(f"unsupported date format: {fmt!r}")
        else:
            prefix, pattern, padded, rest = prefix + re.escape(rest[0]), pattern + rest[0], padded + rest[0], rest[1:]
    accepted = F.regexp_substr(c, F.lit(prefix + r"\s*$" if whole else prefix))
    text = F.trim(F.regexp_replace(accepted, r"\s+", " "))
    general = F.try_to_timestamp(text, F.lit(pattern))
    if "%y" in fmt:
        return _century(general)
    if padded not in CASTABLE:
        return general
    head = F.substring(c, 1, len(padded))
    laid_out = F.length(F.rtrim(c) if whole else head) == len(padded)
    for at, mark in enumerate(padded):
        if not mark.isalpha():
            laid_out = laid_out & (F.substring(c, at + 1, 1) == mark)
    return F.coalesce(F.when(laid_out, head.try_cast("timestamp")), general)


def _century(clock: Column) -> Column:
    late = F.year(clock) > LAST_YEAR_OF_2000S
    return F.when(late, clock - F.make_ym_interval(F.lit(100))).otherwise(clock)


def parse_instant(c: Column, fmt: str, tz: str | None) -> Column:
    """Instant from text by a date-time format read in ``tz``."""
    return from_wall_clock(parse_clock(c, fmt), tz)


def text_parts(c: Column) -> Column:
    """A text cut into numbers, ASCII words, runs of blanks and single other signs, by one regular expression."""
    return F.regexp_extract_all(c, F.lit(r"(\d+|[A-Za-z]+|\s+|[^\dA-Za-z\s])"), F.lit(1))


def _is_number(part: Column) -> Column:
    return F.ascii(part).between(ord("0"), ord("9"))


def _is_word(part: Column) -> Column:
    return F.ascii(part).between(ord("A"), ord("Z")) | F.ascii(part).between(ord("a"), ord("z"))


def _is_blank(part: Column) -> Column:
    return F.ascii(part).isin(9, 10, 11, 12, 13, 32)


def _format_items(fmt: str) -> list[str] | None:
    """Directives, blanks (as one) and signs of a format, or None where parts of a text cannot tell them apart."""
    items = re.findall(r"%.|\s+|.", fmt)
    fields = [i for i in items if i in DIRECTIVES]
    plain = all(i in DIRECTIVES or not (i[0] == "%" or i[0].isalnum()) for i in items)
    apart = not any(a in DIRECTIVES and b in DIRECTIVES for a, b in pairwise(items))
    year = "%y" in fields or "%Y" in fields
    return items if plain and apart and year and {"%m", "%d"} <= set(fields) and len(fields) == len(set(fields)) else None


def _full_year(year: Column) -> Column:
    """Year of two digits."""
    return year + F.when(year + 2000 > LAST_YEAR_OF_2000S, 1900).otherwise(2000)


def _by_format(body: Column, items: list[str]) -> Column:
    """Clock reading of the parts of a text, blanks at its ends removed, that a format reads as a whole."""
    fits, fields = F.size(body) == len(items), {}
    for at, item in enumerate(items):
        part = F.get(body, F.lit(at))
        if item in DIRECTIVES:
            longest = 4 if item == "%Y" else 2
            fits = fits & _is_number(part) & (F.length(part).between(2 if item == "%y" else 1, longest))
            fields[item] = part.try_cast("int")
        else:
            fits = fits & (_is_blank(part) if item.isspace() else part == F.lit(item))
    year = fields["%Y"] if "%Y" in fields else _full_year(fields["%y"])
    zero = F.lit(0)
    clock = [fields.get(d, zero) for d in ("%H", "%M")]
    second = fields.get("%S", zero).cast("decimal(8,6)")
    return F.when(fits, F.try_make_timestamp(year, fields["%m"], fields["%d"], *clock, second, F.lit("UTC")))


def _month_day_year(c: Column, parts: Column) -> Column:
    """Clock reading from month-day-year text with any separators and optional seconds; the month may be a name."""
    solid = F.filter(parts, lambda p: _is_number(p) | _is_word(p))
    n, first, last = F.size(solid), F.get(solid, F.lit(0)), F.try_element_at(solid, F.lit(-1))
    third = F.get(solid, F.lit(2))
    # What stands before the first solid part is separators only, so it is found at its first occurrence.
    starts = F.call_function("instr", c, first)
    underscore = F.instr(c, "_")
    fits = (
        n.isin(5, 6)
        & F.when(_is_word(first), F.length(first).between(3, 9)).otherwise(F.length(first) <= 2)
        # A name is followed by a separator, and no underscore stands at either end.
        & ~_is_number(F.substring(c, starts + F.length(first), F.lit(1)))
        & ((underscore == 0) | (underscore > starts))
        & (F.call_function("instr", F.substring_index(c, "_", -1), last) > 0)
        & F.forall(F.slice(solid, 2, 5), _is_number)
        & F.length(third).isin(2, 4)
    )
    for at in (1, 3, 4, 5):
        fits = fits & ((n <= at) | (F.length(F.get(solid, F.lit(at))) <= 2))
    names = F.array(*[F.lit(m) for m in MONTHS])
    by_name = F.array_position(names, F.lower(F.substring(first, 1, 3))).cast("int")
    month = F.coalesce(first.try_cast("int"), F.nullif(by_name, F.lit(0)))
    year = third.try_cast("int")
    second = F.coalesce(F.get(solid, F.lit(5)).try_cast("decimal(8,6)"), F.lit(0).cast("decimal(8,6)"))
    whole = [F.get(solid, F.lit(i)).try_cast("int") for i in (1, 3, 4)]
    read = F.try_make_timestamp(
        F.when(F.length(third) == 4, year).otherwise(_full_year(year)), month, *whole, second, F.lit("UTC")
    )
    return F.when(fits, read)


def mixed_date_of_parts(
    c: Column, parts: Column, formats: tuple[str, ...] = ("%m/%d/%y %H:%M", "%m/%d/%Y %H:%M"), tz: str | None = "UTC"
) -> Column:
    """``mixed_date`` of a text that is cut into ``text_parts`` already: formats are decided on the parts."""
    lead, tail = (F.coalesce(_is_blank(F.try_element_at(parts, F.lit(i))), F.lit(False)).cast("int") for i in (1, -1))
    body = F.slice(parts, lead + 1, F.greatest(F.size(parts) - lead - tail, F.lit(0)))
    attempts = []
    for fmt in formats:
        items = _format_items(fmt)
        attempts.append(parse_clock(c, fmt, whole=True) if items is None else _by_format(body, items))
    return from_wall_clock(F.coalesce(*attempts, _month_day_year(c, parts)), tz)


def mixed_date(
    c: Column,
    formats: tuple[str, ...] = ("%m/%d/%y %H:%M", "%m/%d/%Y %H:%M"),
    tz: str | None = "UTC",
) -> Column:
    """Instant from a column mixing several date formats: the first format that reads the whole text wins.

    Texts that no format reads as a whole fall back to month-day-year with any separators and optional seconds, so
    seconds are kept. Texts with anything else behind the date give null. The text is cut into parts once.
    """
    return F.element_at(F.transform(F.array(text_parts(c)), lambda parts: mixed_date_of_parts(c, parts, formats, tz)), 1)


def serial_to_clock(x: Column) -> Column:
    """Day-fraction serial of a sheet to ``HH:MM:SS``.

    The shift to 1970 is added before flooring: it absorbs the representation error of the
    fraction, so that every second of the day comes back unchanged.
    """
    since_1970 = (x - F.lit(float(SERIAL_SHIFT_DAYS))) * F.lit(86400.0) - F.lit(float(SECONDS_1900_TO_1970))
    second = F.pmod(F.floor(since_1970), F.lit(86400))
    hours, minutes = F.floor(second / 3600), F.floor(F.pmod(second, F.lit(3600)) / 60)
    text = F.format_string("%02d:%02d:%02d", hours, minutes, F.pmod(second, F.lit(60)))
    return F.when(x.isNotNull(), text)
