"""Exact money and rate arithmetic on aggregated integers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cleargrain.functions import fixed


def dollars(amount_cents: Column) -> Column:
    """Cents as dollars; a missing sum reads as zero."""
    return F.coalesce(amount_cents, F.lit(0)) / F.lit(100.0)


def half_up(numerator: Column, denominator: Column) -> Column:
    """``numerator / denominator`` to the nearest integer, halves away from zero.

    Stays in integers, so the result does not depend on summation order or on
    the binary form of the quotient. NULL when the denominator is zero.
    """
    size = F.abs(numerator.cast("decimal(38,0)"))
    base = F.nullif(denominator, F.lit(0)).cast("decimal(38,0)")
    whole = F.call_function("div", size, base)
    rounded = whole + F.when((size % base) * 2 >= base, 1).otherwise(0)
    return F.when(numerator < 0, -rounded).otherwise(rounded).cast("bigint")


def percent(part: Column, whole: Column) -> Column:
    """``100 * part / whole`` to two decimals; NULL when the whole is zero."""
    return half_up(part.cast("decimal(34,0)") * 10000, whole) / F.lit(100.0)


def percent_or_zero(part: Column, whole: Column) -> Column:
    return F.coalesce(percent(part, whole), F.lit(0.0))


def growth(current: Column, prior: Column) -> Column:
    """Percent change on the size of the prior value; NULL without one."""
    return percent(current - prior, F.abs(prior))


def mean_hundredths(total_hundredths: Column, count: Column) -> Column:
    """Mean of values held in hundredths, to two decimals, zero when empty."""
    return F.coalesce(half_up(total_hundredths, count), F.lit(0)) / F.lit(100.0)


def count_if(condition: Column) -> Column:
    """Number of rows meeting the condition; zero, not NULL, on no rows."""
    return F.count(F.when(condition, 1))


def sum_if(condition: Column, value: Column) -> Column:
    return F.coalesce(F.sum(F.when(condition, value)), F.lit(0)).cast("bigint")


def fulfilled() -> Column:
    return F.col("order_status").isin(*fixed.FULFILLED)


def cancelled() -> Column:
    return F.col("order_status") == "CANCELLED"


def within_sla() -> Column:
    """Ticket resolved within the hours its priority allows."""
    *urgent, last = fixed.SLA_HOURS.items()
    allowed = F
    for name, hours in urgent:
        allowed = allowed.when(F.col("priority") == name, hours)
    return F.col("resolution_hours") <= allowed.otherwise(last[1])


def hours_hundredths() -> Column:
    return F.round(F.col("resolution_hours") * 100).cast("bigint")


def decimal_text(value: Column) -> Column:
    return F.format_string("%.2f", value)


def title_text(value: Column) -> Column:
    return F.initcap(F.replace(value, F.lit("_"), F.lit(" ")))
