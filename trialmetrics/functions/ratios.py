"""Column helpers shared by the reports."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def half_up(value: Column | str, digits: int) -> Column:
    """Round a double as the decimal number it stands for.

    149.03445 / 3 is 49.678149999999995 as a double, but has to round up to 49.6782.
    """
    return F.round(_column(value).cast("decimal(38,12)"), digits).cast("double")


def ratio(numerator: Column | str, denominator: Column | str, digits: int | None = None) -> Column:
    """Quotient as a double, NULL where the denominator is 0 or NULL."""
    value = F.try_divide(_column(numerator).cast("double"), _column(denominator).cast("double"))
    return value if digits is None else half_up(value, digits)


def ratio_or_zero(numerator: Column | str, denominator: Column | str, digits: int | None = None) -> Column:
    """Quotient as a double, 0 where the denominator is 0."""
    return F.when(_column(denominator) == 0, F.lit(0.0)).otherwise(ratio(numerator, denominator, digits))


def money(value: Column | str) -> Column:
    """Sum of amounts, to six digits.

    The last bits of a sum of doubles depend on the order of addition, that is on how the
    rows happen to be partitioned, and can tip the rounding of a ratio made from it.
    """
    return F.round(F.sum(_column(value)), 6)


def money_of(flag: Column | str, value: Column | str) -> Column:
    """:func:`money` over the rows that satisfy ``flag``, 0 where there are none."""
    return F.round(total_of(flag, value), 6)


def total(flag: Column | str) -> Column:
    """How many rows satisfy ``flag``."""
    return F.count(F.when(_column(flag), 1))


def total_of(flag: Column | str, value: Column | str) -> Column:
    """Sum of ``value`` over the rows that satisfy ``flag``, 0 where there are none."""
    return F.sum(F.when(_column(flag), _column(value)).otherwise(0))
