"""Rounding of doubles by their exact binary value, ties to even."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _halves(x: Column) -> tuple[Column, Column]:
    """A double as the exact sum of two with 26 significant bits each."""
    c = x * F.lit(134217729.0)  # 2 ** 27 + 1
    high = c - (c - x)
    return high, x - high


def round_exact(x: Column, digits: int) -> Column:
    """``x`` rounded to ``digits`` decimals, as its exact binary value demands, ties to even.

    Spark's ``round`` and ``bround`` round the shortest decimal that prints like the double: 0.55555, whose value lies below
    the tie, would become 0.5556. Here the product with the power of ten is kept as a double and its exact error
    (of magnitudes that scores and percentages have), and both decide on which side of the tie it lies. Values that have no
    such decimals (beyond 2^53 once scaled) and those that are not finite are returned as they are.
    """
    scale = 10.0 ** digits
    b = F.lit(scale)
    p = x * b
    xh, xl = _halves(x)
    bh, bl = _halves(b)
    error = ((xh * bh - p) + xh * bl + xl * bh) + xl * bl
    low = F.floor(p).cast("double")
    beyond = ((p - low) - F.lit(0.5)) + error
    up = (beyond > 0) | ((beyond == 0) & (low % 2 != 0))
    return F.when(F.abs(p) < F.lit(2.0 ** 53), (low + F.when(up, 1.0).otherwise(0.0)) / b).otherwise(x)
