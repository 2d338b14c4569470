"""Rounding and number text with the semantics of IEEE doubles in JSON producers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_finite(x: Column) -> Column:
    return ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))


def round_half_up(x: Column, decimals: int) -> Column:
    """Round a double half towards plus infinity; null when the value is null or not finite.

    Spark's own `round` goes through decimals and rounds half away from zero, which differs on negative ties and on
    values such as 1.005.
    """
    factor = float(10**decimals)
    scaled = x * F.lit(factor)
    # Beyond 2**52 a double has no fraction, and the long that `floor` returns would overflow later on.
    whole = F.floor(scaled).cast("double")
    rounded = F.when(F.abs(scaled) >= F.lit(float(2**52)), scaled).otherwise(
        whole + F.when(scaled - whole >= 0.5, 1.0).otherwise(0.0)
    )
    return F.when(is_finite(x), rounded / F.lit(factor))


def number_text(x: Column) -> Column:
    """Text of a double as JSON writes it: 120, 91.2, 12345678, 0.0001, 1e+21, 1e-7."""
    text = x.cast("string")
    size = F.abs(x)
    plain = F.regexp_replace(text, r"\.0$", "")
    # Spark switches to an exponent at 1e7 and below 1e-3; JSON does at 1e21 and below 1e-6.
    large = F.regexp_replace(text.try_cast("decimal(38,16)").cast("string"), r"\.?0+$", "")
    small = F.regexp_replace(text.try_cast("decimal(38,23)").cast("string"), r"0+$", "")
    exponent = F.regexp_replace(
        F.regexp_replace(F.regexp_replace(text, r"\.0E", "E"), r"E(\d)", "e+$1"), "E-", "e-"
    )
    return (
        F.when(F.isnan(x), "NaN")
        .when(size == F.lit(float("inf")), text)
        .when(size == 0, "0")
        .when((size >= 1e-3) & (size < 1e7), plain)
        .when((size >= 1e7) & (size < 1e21), large)
        .when((size >= 1e-6) & (size < 1e-3), small)
        .otherwise(exponent)
    )


def json_number(x: Column) -> Column:
    """A double as a JSON value, so that `to_json` writes 3 and not 3.0; null when missing or not finite."""
    return F.try_parse_json(F.when(is_finite(x), number_text(x)))
