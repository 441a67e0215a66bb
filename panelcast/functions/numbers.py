"""Rounding, log targets, residuals and number display."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def half_even(value: Column | str, places: int = 0) -> Column:
    """Round half to even, scaling by a power of ten first."""
    value = F.col(value) if isinstance(value, str) else value
    if places == 0:
        return F.rint(value)
    scale = float(10**places)
    return F.rint(value * F.lit(scale)) / F.lit(scale)


def log_target(value: Column | str) -> Column:
    return F.log1p(value)


def from_log_target(value: Column | str) -> Column:
    return F.expm1(value)


def residual(actual: Column | str, predicted: Column | str) -> Column:
    actual = F.col(actual) if isinstance(actual, str) else actual
    predicted = F.col(predicted) if isinstance(predicted, str) else predicted
    return actual - predicted


def direction(value: Column | str) -> Column:
    """``raises`` for a value above zero, else ``lowers``."""
    value = F.col(value) if isinstance(value, str) else value
    return F.when(value > 0, "raises").when(value <= 0, "lowers")


def direction_colour(value: Column | str) -> Column:
    value = F.col(value) if isinstance(value, str) else value
    # Display colours (fixed values).
    return F.when(value > 0, "#e74c3c").when(value <= 0, "#2ecc71")


def whole_text(value: Column | str) -> Column:
    """The value with no decimals; ties go to the even number."""
    return F.format_string("%.0f", F.rint(value))


def tenths_text(value: Column | str) -> Column:
    """The value with one decimal, rounded from its exact binary value.

    Spark rounds the shortest decimal spelling (12.35 would tie, and go up)
    although the double behind it lies below the tie. The fraction is therefore
    scaled by 2**58, which is exact, and rounded in whole numbers.
    """
    value = F.col(value) if isinstance(value, str) else value
    unit = F.lit(2**58)
    size = F.abs(value)
    whole = F.floor(size)
    tenths = ((size - whole) * F.lit(float(2**58))).cast("bigint") * F.lit(10)
    digit = F.floor(tenths / unit).cast("bigint")
    # Double division may land on the next digit; the remainder shows it.
    digit = F.when(digit * unit > tenths, digit - 1).otherwise(digit)
    twice_rest = (tenths - digit * unit) * F.lit(2)
    up = (twice_rest > unit) | ((twice_rest == unit) & (digit % 2 == 1))
    total = whole.cast("bigint") * F.lit(10) + digit + up.cast("bigint")
    sign = F.when(value < 0, "-").otherwise("")
    text = F.concat(
        sign, F.floor(total / F.lit(10)).cast("string"), F.lit("."), (total % 10).cast("string")
    )
    return F.when(value.isNotNull(), text)
