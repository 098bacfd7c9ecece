"""Casts that give null instead of failing, and money casts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trip_marts.schemas import MONEY, TIMESTAMP, find_field

# Text of a decimal or whole number; blanks around it are allowed.
NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
DIGITS = r"^\s*[+-]?\d+\s*$"
# Amounts have at most fifteen digits before the point.
MONEY_LIMIT = 1e15


def safe_int(df: DataFrame, name: str) -> Column:
    """``name`` as an integer, null where it is not one.

    Fractions round to the nearest integer rather than being cut off: floating
    values half to even, decimals and text half away from zero.
    """
    field = find_field(df, name)
    if field is None:
        raise ValueError(f"no column {name!r} to cast to integer")
    value = F.col(field.name)
    if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
        return F.rint(value).try_cast("int")
    if isinstance(field.dataType, T.DecimalType):
        return F.round(value).try_cast("int")
    if isinstance(field.dataType, T.StringType):
        # Plain digits are the usual case and need no decimal.
        digits = text_like(value, DIGITS).try_cast("int")
        fraction = F.round(text_like(value, NUMBER).try_cast("decimal(38,10)"))
        return F.coalesce(digits, fraction.try_cast("int"))
    return value.try_cast("int")


def safe_timestamp(value: Column) -> Column:
    """Timestamp without zone, null where the value is not one."""
    return value.try_cast(TIMESTAMP)


def money(value: Column) -> Column:
    """Decimal, integer or text amount with three decimals; bad input is an error."""
    return value.cast(MONEY)


def text_like(value: Column, pattern: str) -> Column:
    """Text of the given form, else null.

    A cast finds out by an exception for every row that a text is no number,
    which is many times slower than a look at its form.
    """
    return F.when(value.rlike(pattern), value)


def money_from_double(value: Column) -> Column:
    """Floating amount with three decimals; not a number or too large is an error.

    Halves of the scaled value round away from zero. Going through an integer
    avoids printing and parsing every value, which is how a plain cast from
    double to decimal works and most of what it costs.
    """
    scaled = F.abs(value * 1000)
    whole = scaled.cast("bigint")
    thousandths = whole + F.when(scaled - whole >= 0.5, 1).otherwise(0)
    signed = F.when(value < 0, -thousandths).otherwise(thousandths)
    exact = (signed.cast("decimal(18,0)") * F.lit("0.001").cast("decimal(3,3)")).cast(MONEY)
    # Strict sessions fail in the casts; elsewhere they give nulls or wrong numbers,
    # so the range is checked too. NaN counts as larger than any number.
    bad = value.isNotNull() & (exact.isNull() | (F.abs(value) >= MONEY_LIMIT))
    error = F.raise_error(F.concat(F.lit("not an amount: "), value.cast("string")))
    return F.when(bad, error.cast(MONEY)).otherwise(exact)


def amount(df: DataFrame, name: str) -> Column:
    """Column ``name`` as money, by the conversion that fits its type."""
    field = find_field(df, name)
    if field is None:
        raise ValueError(f"no column {name!r} to use as an amount")
    value = F.col(field.name)
    if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
        return money_from_double(value.cast("double"))
    return money(value)


def safe_amount(df: DataFrame, name: str) -> Column:
    """Column ``name`` as money, null where it is not a number or too large."""
    field = find_field(df, name)
    if field is None:
        raise ValueError(f"no column {name!r} to use as an amount")
    value = F.col(field.name)
    if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
        return F.when(F.abs(value) < MONEY_LIMIT, amount(df, name))
    if isinstance(field.dataType, T.StringType):
        value = text_like(value, NUMBER)
    return value.try_cast(MONEY)


def or_zero(value: Column) -> Column:
    return F.coalesce(value, F.lit(0))
