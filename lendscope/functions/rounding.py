"""Rounding and division with the results a binary-scaling engine gives."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# From here on every double is a whole number, so there is nothing to round.
_WHOLE = float(2**53)


def round_half_away(value: Column, digits: int) -> Column:
    """Round to ``digits`` places on the scaled double, ties away from zero.

    ``F.round`` rounds the decimal text instead and gives 0.0002 for 0.00015.
    NaN, infinities and values too large to carry a fraction pass unchanged.
    """
    scale = float(10**digits)
    scaled = F.abs(value) * scale
    below = F.floor(scaled)
    nearest = below + F.when(scaled - below >= 0.5, 1.0).otherwise(0.0)
    return F.when(scaled < _WHOLE, F.signum(value) * nearest / scale).otherwise(value)


def round_half_even(value: Column, digits: int) -> Column:
    """Round the scaled double, ties to the even neighbour, as model metrics do."""
    scale = float(10**digits)
    return F.rint(value * scale) / scale


def to_int_half_even(value: Column) -> Column:
    """Double to int, ties to the even neighbour; a bare cast would truncate."""
    return F.rint(value).cast("int")


def guarded_ratio(numerator: Column, denominator: Column, digits: int = 4) -> Column:
    """Rounded quotient where the divisor is positive, NULL elsewhere."""
    return F.when(denominator > 0, round_half_away(numerator / denominator, digits))
