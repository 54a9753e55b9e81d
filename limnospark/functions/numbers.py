"""Numeric column expressions. Every one is a built-in Spark expression."""

from __future__ import annotations

import re
from functools import lru_cache

from pyspark.sql import Column, DataFrame, functions as F, types as T

from limnospark.functions.text import WHITESPACE, strip

# Spellings of cubic metres per second.
CUBIC_METRE_UNITS = ("m3/s", "m^3/s", "m3s", "cms")
LITRES_PER_CUBIC_METRE = 1000.0


def finite(value: Column) -> Column:
    """Null in place of NaN."""
    return F.nanvl(value, F.lit(None).cast("double"))


def to_number(column: Column, decimal_comma: bool = False) -> Column:
    """Text to double; anything that is not a number becomes null."""
    text = strip(column.cast("string"))
    if decimal_comma:
        text = F.replace(text, F.lit(","), F.lit("."))
    # Java accepts a trailing type letter ("1f", "2d"); such text is not a number here.
    # It is spoilt in place and NaN replaced by one function, so that the text is worked out once and not four times.
    text = F.regexp_replace(text, "[dDfF]$", "x")
    return finite(text.try_cast("double"))


def number_of(df: DataFrame, name: str) -> Column:
    """Column of a table as double: a cast where it is numeric already, else parsed from text."""
    column = F.col("`" + name.replace("`", "``") + "`")
    if isinstance(df.schema[name].dataType, T.NumericType):
        return finite(column.cast("double"))
    return to_number(column)


def cell_number(column: Column) -> Column:
    """Spreadsheet cell to double: decimal comma allowed, a dash means missing."""
    return to_number(F.nullif(strip(column), F.lit("-")), decimal_comma=True)


_DECIMAL = re.compile(r"[\0- ]*[-+]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][-+]?[0-9]+)?[\0- ]*")
_HEXADECIMAL = re.compile(r"[-+]?0[xX](?:[0-9a-fA-F]+\.?|[0-9a-fA-F]*\.[0-9a-fA-F]+)[pP][-+]?[0-9]+")
_CONTROLS = "".join(map(chr, range(33)))


@lru_cache(1 << 16)
def cell_number_of(text: str | None) -> float | None:
    """As `cell_number`, for a text at hand: what Java reads as a number, without a type letter."""
    if text is None:
        return None
    text = text.strip(WHITESPACE).replace(",", ".")
    if _DECIMAL.fullmatch(text):
        return float(text.strip(_CONTROLS))
    text = text.strip(_CONTROLS)
    if _HEXADECIMAL.fullmatch(text):
        try:
            return float.fromhex(text)
        except OverflowError:
            return float("-inf" if text[0] == "-" else "inf")
    return {"infinity": float("inf"), "+infinity": float("inf"), "-infinity": float("-inf")}.get(text.lower())


def cell_integer(column: Column) -> Column:
    return F.bround(cell_number(column), 0).cast("bigint")


def whole_number(value: Column) -> Column:
    """Double to bigint only where it is whole; other values are null (see `is_fractional`)."""
    return F.when(value == F.floor(value), value.cast("bigint"))


def is_fractional(value: Column) -> Column:
    return F.coalesce(value != F.floor(value), F.lit(False))


def to_litres(value: Column, unit: str | Column) -> Column:
    number = to_number(value)
    if isinstance(unit, str):
        scale = LITRES_PER_CUBIC_METRE if unit.strip().lower().replace(" ", "") in CUBIC_METRE_UNITS else 1.0
        return number * F.lit(scale)
    cleaned = F.replace(F.lower(strip(unit)), F.lit(" "), F.lit(""))
    return F.when(cleaned.isin(*CUBIC_METRE_UNITS), number * LITRES_PER_CUBIC_METRE).otherwise(number)


def relative_difference_floor(observed: Column, expected: Column, floor: float | Column) -> Column:
    """Percent difference; the denominator never falls below `floor`."""
    bound = floor if isinstance(floor, Column) else F.lit(float(floor))
    return F.abs(observed - expected) / F.greatest(F.abs(expected), bound) * 100.0


def relative_difference(base: Column, other: Column) -> Column:
    """Percent difference from `base`, or the absolute one when `base` is practically zero."""
    gap = F.abs(other - base)
    return F.when(F.abs(base) < 1e-12, gap).otherwise(F.try_divide(gap, F.abs(base)) * 100.0)


def markup_value(column: Column) -> Column:
    """Canonical text of an attribute value: whole numbers, decimals, or the text itself."""
    text = strip(column)
    whole = F.when(text.rlike(r"^[+-]?\d+$"), text.try_cast("bigint").cast("string"))
    decimal = F.when(text.rlike(r"[.eE]"), to_number(text).cast("string"))
    return F.coalesce(whole, decimal, text, F.lit(""))


def predict(model: Column, x: Column, a: Column, b: Column, c: Column) -> Column:
    """Value of a fitted curve; the power law is defined for positive x only."""
    return (
        F.when(model == "poly1", a * x + b)
        .when(model == "poly2", a * x * x + b * x + c)
        .when((model == "power") & (x > 0), a * F.pow(x, b))
    )


def coefficients_json(a: Column, b: Column, c: Column) -> Column:
    return F.to_json(F.struct(a.alias("a"), b.alias("b"), c.alias("c")))


def coefficients_struct(text: Column) -> Column:
    return F.from_json(text, "a double, b double, c double")
