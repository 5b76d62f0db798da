"""Parsing and standardizing raw text as built-in Column expressions."""

from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from cleargrain.functions import fixed

# ISO dates: calendar and week forms, each extended or basic.
_DATE = r"\d{4}-\d{2}-\d{2}|\d{8}|\d{4}-W\d{2}(?:-\d)?|\d{4}W\d{2}\d?"
# One separator, a clock time, and the offset of its zone.
_CLOCK = r"(\d{2})(?::?(\d{2})(?::?(\d{2})(?:[.,](\d+))?)?)?"
_OFFSET = r"Z|[+-]\d{2}(?::?\d{2}(?::?\d{2})?)?"
_DATETIME = rf"^({_DATE})(?:[\s\S]{_CLOCK}({_OFFSET})?)?$"
# Text of a number, and the largest that DECIMAL(38,18) holds.
_NUMBER = r"^\s*[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?\s*$"
_LARGEST = Decimal("99999999999999999999.99")


def is_blank(value: Column) -> Column:
    """Raw text is missing when it is NULL or empty; white space is not missing."""
    return value.isNull() | (value == "")


def null_if_blank(value: Column) -> Column:
    return F.nullif(value, F.lit(""))


def strip(value: Column) -> Column:
    """Trim every kind of white space (plain ``trim`` removes spaces only)."""
    return F.btrim(value, F.lit(fixed.WHITESPACE))


def token(value: Column) -> Column:
    """Upper-case words joined by ``_``; hyphens and white space both separate."""
    separators = fixed.WHITESPACE + "-"
    spaced = F.translate(F.upper(value), separators, " " * len(separators))
    return F.regexp_replace(F.trim(spaced), " +", "_")


def standardize(value: Column, domain: tuple[str, ...], aliases: dict[str, str]) -> Column:
    """Governed value of raw text, or its token when no alias covers it.

    Text that is governed already is returned first, so the token work runs
    only on the rows that need it.
    """
    raw = F.coalesce(value, F.lit(""))
    word = token(raw)
    mapping = F.create_map(*[F.lit(part) for pair in aliases.items() for part in pair])
    return F.when(raw.isin(*domain), raw).otherwise(
        F.coalesce(F.try_element_at(mapping, word), word)
    )


def customer_segment(value: Column) -> Column:
    return standardize(value, fixed.SEGMENTS, fixed.SEGMENT_ALIASES)


def product_category(value: Column) -> Column:
    return standardize(value, fixed.CATEGORIES, fixed.CATEGORY_ALIASES)


def order_status(value: Column) -> Column:
    return standardize(value, fixed.ORDER_STATUSES, fixed.ORDER_STATUS_ALIASES)


def priority(value: Column) -> Column:
    return standardize(value, fixed.PRIORITIES, fixed.PRIORITY_ALIASES)


def finance_type(value: Column) -> Column:
    return standardize(value, fixed.FINANCE_TYPES, fixed.FINANCE_TYPE_ALIASES)


def to_decimal(value: Column) -> Column:
    """Number in the text, or NULL; digit-grouping underscores are allowed.

    A number too wide for the type reads as the largest that fits, so rules judge
    it as the large number it is; its cents are NULL (see ``cents``).
    """
    digits = F.when(value.contains("_"), F.translate(value, "_", "")).otherwise(value)
    wide = F.when(digits.rlike(_NUMBER), digits.try_cast("double"))
    largest = F.lit(_LARGEST).cast("decimal(38,18)")
    return F.coalesce(digits.try_cast("decimal(38,18)"), F.when(wide >= 1e19, largest).when(wide <= -1e19, -largest))


def is_beyond(amount: Column) -> Column:
    """Whether ``to_decimal`` read a number too wide for the type."""
    return F.abs(amount) >= F.lit(_LARGEST).cast("decimal(38,18)")


def cents(amount: Column) -> Column:
    """Whole cents of a decimal amount, halves away from zero.

    NULL stays NULL, and so do amounts beyond 64-bit cents, which no control
    can balance: they stop the publication.
    """
    return (F.round(amount, 2) * 100).try_cast("bigint")


def basis_points(rate: Column) -> Column:
    return (F.round(rate, 4) * 10000).try_cast("bigint")


def iso_date(value: Column) -> Column:
    """The date of ISO text, else NULL: ``YYYY-MM-DD``, ``YYYYMMDD`` or a week date.

    A parse that prints back as the same text rules out the looser forms a
    cast accepts; only other text is matched against the other forms.
    """
    parsed = value.try_cast("date")
    return F.when(_is_exact(value, parsed), parsed).otherwise(_apart(value, _other_date))


def _is_exact(value: Column, parsed: Column) -> Column:
    return (parsed.cast("string") == value) & ~value.startswith("0000")


def _apart(value: Column, parse: Callable[[Column], Column]) -> Column:
    """A long expression for few rows, kept out of the generated code of the many."""
    return F.transform(F.array(value), parse)[0]


def _other_date(value: Column) -> Column:
    joined = F.concat_ws("-", F.substring(value, 1, 4), F.substring(value, 5, 2), F.substring(value, 7, 2))
    basic = F.when(value.rlike(r"^\d{8}$") & ~value.startswith("0000"), joined.try_cast("date"))
    return F.coalesce(basic, _week_date(value))


def _any_date(value: Column) -> Column:
    parsed = value.try_cast("date")
    return F.when(_is_exact(value, parsed), parsed).otherwise(_other_date(value))


def _week_date(value: Column) -> Column:
    """The day of an ISO week date, Monday where none is named, else NULL."""
    digits = F.translate(value, "-W", "")
    year, week = F.substring(digits, 1, 4).try_cast("int"), F.substring(digits, 5, 2).try_cast("int")
    day = F.coalesce(F.nullif(F.substring(digits, 7, 1), F.lit("")).try_cast("int"), F.lit(1))
    fourth = F.concat(F.substring(digits, 1, 4), F.lit("-01-04")).try_cast("date")  # always in week 1
    monday = F.date_sub(fourth, F.weekday(fourth))
    found = F.date_add(monday, (week - 1) * 7 + day - 1)
    fits = (year > 0) & day.between(1, 7) & (week >= 1) & (F.weekofyear(F.date_add(monday, (week - 1) * 7)) == week)
    return F.when(value.rlike(r"^(\d{4}-W\d{2}(-\d)?|\d{4}W\d{2}\d?)$") & fits, found)


def iso_datetime(value: Column) -> Column:
    """The instant of ISO text as UTC, else NULL; text without an offset counts as UTC.

    Text like ``2025-01-31T09:30`` is known by printing back as the same text;
    only other text is matched against every form.
    """
    parsed = value.try_cast("timestamp_ntz")
    printed = parsed.cast("string")
    same = F.concat(F.substring(printed, 1, 10), F.lit("T"), F.substring(printed, 12, 5)) == value
    return F.when(same & ~value.startswith("0000"), parsed).otherwise(_apart(value, _any_iso_datetime))


def _any_iso_datetime(value: Column) -> Column:
    def part(n: int) -> Column:
        return F.regexp_extract(value, _DATETIME, n)

    def two(text: Column) -> Column:
        return F.when(text == "", "00").otherwise(text)

    day = _any_date(part(1)).cast("string")
    fraction = F.rpad(F.substring(part(5), 1, 6), 6, "0")
    clock = F.concat_ws(":", two(part(2)), two(part(3)), two(part(4)))
    local = F.concat(day, F.lit("T"), clock, F.lit("."), fraction).try_cast("timestamp_ntz")
    zone = F.translate(part(6), ":", "")
    seconds = (
        F.substring(zone, 2, 2).try_cast("int") * 3600
        + F.coalesce(F.substring(zone, 4, 2).try_cast("int"), F.lit(0)) * 60
        + F.coalesce(F.substring(zone, 6, 2).try_cast("int"), F.lit(0))
    )
    shift = F.when(zone.startswith("-"), -seconds).otherwise(seconds)
    instant = F.when(zone.isin("", "Z"), local).when(seconds < 86400, local - F.make_dt_interval(secs=shift))
    return F.when(value.rlike(_DATETIME), instant)


def month(value: Column) -> Column:
    return F.substring(value, 1, 7)


def elapsed_hours(start: Column, end: Column) -> Column:
    """Hours to two decimals, rounded as their binary value: a half of the last
    place goes to the side on which the binary number lies, or to even."""
    micros = F.timestamp_diff("MICROSECOND", start, end)
    hours = micros / F.lit(1e6) / F.lit(3600.0)
    halves = F.call_function("div", micros, F.lit(18_000_000).cast("bigint"))  # of a hundredth of an hour
    # 200 * hours - halves without rounding: the high half of the digits, then the low.
    spread = hours * 134217729.0
    high = spread - (spread - hours)
    beyond = (high * 200.0 - halves) + (hours - high) * 200.0
    down, up = (halves - 1) / F.lit(2), (halves + 1) / F.lit(2)
    even = F.when(F.pmod(down.cast("bigint"), F.lit(2)) == 0, down).otherwise(up)
    nearest = F.when(beyond > 0, up).when(beyond < 0, down).otherwise(even)
    is_half = (F.pmod(micros, F.lit(18_000_000)) == 0) & (F.pmod(halves, F.lit(2)) == 1)
    return F.when(is_half, nearest / F.lit(100.0)).otherwise(F.round(hours, 2))
