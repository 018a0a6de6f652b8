"""Rounding as Python does it, in column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Splits a double into two halves of 26 bits.
_HALVES = float((1 << 27) + 1)
#: From a product of this size on, neighbouring doubles lie further apart than the multiples: each is its own nearest.
_WHOLE = float(1 << 53)


def python_round(c: Column, digits: int) -> Column:
    """The multiple of 10 ** -digits nearest to the exact binary value; of two equally near ones the even one.

    The product with 10 ** digits is rounded itself, so what it lost is worked out without error (halves of few
    bits multiply exactly) and decides where the product looks like a tie.
    """
    scale = float(10**digits)
    x = c.cast("double")
    near = x * F.lit(scale)
    high = x * F.lit(_HALVES) - (x * F.lit(_HALVES) - x)
    lost = (high * F.lit(scale) - near) + (x - high) * F.lit(scale)
    below = F.floor(near).cast("double")
    tie = near - below == F.lit(0.5)
    whole = F.when(tie & (lost > 0), below + 1).when(tie & (lost < 0), below).otherwise(F.rint(near))
    return F.when(F.abs(near) < F.lit(_WHOLE), whole / F.lit(scale)).otherwise(x)
