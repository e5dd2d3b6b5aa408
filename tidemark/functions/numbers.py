"""Numeric and display expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def observed(value: Column) -> Column:
    """The value as double, with NaN read as missing."""
    number = value.cast("double")
    return F.when(~F.isnan(number), number)


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient; null when the denominator is 0 or missing."""
    return F.try_divide(numerator, denominator)


def clip(value: Column, low: float, high: float) -> Column:
    """The value held to [low, high]; missing stays missing."""
    return F.when(value.isNotNull(), F.greatest(F.lit(low), F.least(F.lit(high), value)))


def min_max(value: Column, low: Column, high: Column) -> Column:
    """Position of the value between low and high; null for a constant column."""
    return F.try_divide(value - low, high - low)


def z_score(value: Column, mean: Column, deviation: Column) -> Column:
    """Standardised value; a constant column is only centred."""
    return (value - mean) / F.coalesce(F.nullif(deviation, F.lit(0.0)), F.lit(1.0))


def fixed_point(value: Column, digits: int) -> Column:
    """Text with ``digits`` decimals, rounded half to even on the exact binary value.

    Java's formatter rounds the shortest decimal text instead, which turns 0.125
    into 0.13. Here the scaled value is kept as product plus exact rounding error,
    so that ties are seen as ties only when they are. From 2^53 / 10^digits on, where that has no room,
    the formatter is used; NaN and infinities have their own text.
    """
    scale = float(10**digits)
    special = F.when(F.isnan(value), "nan").when(value == float("inf"), "inf").when(value == float("-inf"), "-inf")
    large = F.abs(value) >= 2.0**53 / scale
    formatted = F.format_string(f"%.{digits}f", value.cast("double"))
    plain = F.when(~(large | F.isnan(value)), value)
    return F.coalesce(special, F.when(large, formatted), _half_even(plain, digits, scale))


def _half_even(value: Column, digits: int, scale: float) -> Column:
    size = F.abs(value)
    product = size * scale
    high = size.cast("float").cast("double")
    error = (high * scale - product) + (size - high) * scale
    whole = F.floor(product)
    past_half = (product - whole) - F.lit(0.5) + error
    up = (past_half > 0) | ((past_half == 0) & (whole % 2 == 1))
    units = whole + F.when(up, 1).otherwise(0)
    sign = F.when(value < 0, "-").otherwise("")
    if digits == 0:
        return F.concat(sign, units.cast("string"))
    step = F.lit(10**digits).cast("bigint")
    decimals = F.lpad((units % step).cast("string"), digits, "0")
    return F.concat(sign, F.floor(units / step).cast("string"), F.lit("."), decimals)


def percent(share: Column, digits: int) -> Column:
    """A share of 1 as text in percent."""
    return F.concat(fixed_point(share * 100.0, digits), F.lit("%"))


def utc(moment: Column) -> Column:
    """Wall-clock time in UTC, whatever the session time zone; counted from 1970, so that no local hour repeats."""
    start = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_add("MICROSECOND", F.unix_micros(moment), start)
