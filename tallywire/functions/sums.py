"""Sums of doubles that depend neither on the order of their terms nor on the partitioning.

Doubles are added as whole numbers. Up to `ORDINARY` a value counts with nine decimal places, in one decimal sum. Beyond
that it is a whole number times 2 ** (WIDTH * band), `band` following from its exponent; each band has a decimal sum of its
own, so that a value of any size is added without rounding. Sums of a band merge by adding; `combined` makes one double
of them at the very end.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A whole number of a band is below 2 ** (WIDTH + 55), so a decimal(38,0) takes 10 ** 12 of them.
WIDTH = 32
ORDINARY = 1e12


def band(value: Column) -> Column:
    """The band a value is added in; null for ordinary values, for null and for what is no number at all."""
    size = F.abs(value)
    far = (size >= ORDINARY) & (size < float("inf"))
    # One less than the logarithm says, as it may be rounded up: the last bit of the value must not be lost.
    return F.when(far, F.floor((F.floor(F.log2(size)) - 53) / WIDTH).cast("int"))


def ordinary(value: Column) -> Column:
    """The value with nine places where it has no band, else null."""
    return F.when(F.abs(value) < ORDINARY, value.try_cast("decimal(30,9)"))


def whole(value: Column, in_band: Column) -> Column:
    """The value in units of its band."""
    return (value / F.pow(F.lit(2.0), in_band * WIDTH)).cast("decimal(28,0)")


def combined(ordinary_sum: Column, bands: Column) -> Column:
    """One double from the sum of ordinary values and an array of (band, whole number), each band once.

    Terms are added from the greatest band down: what cancels out within a band has done so exactly before.
    """
    units = F.transform(
        F.reverse(F.array_sort(bands)), lambda b: b["whole"].cast("double") * F.pow(F.lit(2.0), b["band"] * WIDTH)
    )
    far = F.aggregate(units, F.lit(0.0), lambda a, b: a + b)
    return far + F.coalesce(ordinary_sum.cast("double"), F.lit(0.0))
