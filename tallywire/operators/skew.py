"""Cutting the rows of a hot key into slices of bounded size, under any order."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SLICE_ROWS = 1_000_000

# How many rows of a hot key are drawn for each of its slices to find where it begins.
DRAWN = 32

# Bounds that go to every task; beyond that they meet the rows in a join that Spark splits.
MOST_BOUNDS = 500_000


def as_long(df: DataFrame, column: str) -> Column | None:
    """An order column as a whole number that grows with it; none for other kinds of columns."""
    kind = df.schema[column].dataType.typeName()
    if kind in ("timestamp", "timestamp_ntz"):
        return F.unix_micros(F.col(column).cast("timestamp"))
    if kind in ("byte", "short", "integer", "long"):
        return F.col(column).cast("long")
    return None


def hot_keys(df: DataFrame, key: str, rows: int) -> DataFrame:
    """Keys with more than `rows` rows, and how many they have. There are fewer than the rows of `df` / `rows`."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("_rows")).where(F.col("_rows") > rows)


def splitters(df: DataFrame, hot: DataFrame, key: str, order_by: Sequence[str], rows: int, seed: int = 17) -> DataFrame:
    """For every hot key the places in the order at which its slices begin, ascending: (key, `_bounds`).

    They are quantiles of a sample, and whole places: all order columns as one value, compared one column after the
    other. So text cuts as well as time and numbers, and where one value of the first column is hot, the next cuts it.
    """
    share = min(1.0, DRAWN / rows)
    drawn = df.select(key, F.struct(*order_by).alias("_place")).sample(share, seed)
    drawn = drawn.join(hot.select(key), key, "left_semi")
    place = Window.partitionBy(key).orderBy("_place")
    every = max(1, round(rows * share))
    picked = drawn.withColumn("_number", F.row_number().over(place)).where(F.col("_number") % every == 0)
    return picked.groupBy(key).agg(F.array_sort(F.collect_set("_place")).alias("_bounds"))


def slice_number(bounds: Column, place: Column) -> Column:
    """How many of the ascending bounds are not behind the place, by binary search; 0 without bounds."""
    # Between low and high lies the answer: bound number low is not behind, number high + 1 is.
    halving = F.sequence(F.lit(1), F.ceil(F.log2(F.size(bounds) + 1.0)).cast("int") + 1)

    def step(range_: Column, _: Column) -> Column:
        low, high = range_["low"], range_["high"]
        middle = F.call_function("div", low + high + 1, F.lit(2)).cast("int")
        reached = F.get(bounds, middle - 1) <= place
        return (
            F.when(low >= high, range_)
            .when(reached, F.struct(middle.alias("low"), high.alias("high")))
            .otherwise(F.struct(low.alias("low"), (middle - 1).alias("high")))
        )

    whole = F.struct(F.lit(0).alias("low"), F.size(bounds).alias("high"))
    return F.when(bounds.isNull(), F.lit(0)).otherwise(F.aggregate(halving, whole, step, lambda r: r["low"]))


def with_slices(
    df: DataFrame, hot: DataFrame, key: str, order_by: Sequence[str], rows: int, store: Callable[[DataFrame, str], DataFrame], out: str = "_slice"
) -> DataFrame:
    """Add `out`: the number of the slice a row of a hot key lies in, which never decreases along the order; else null.

    The bounds are stored, so that whoever reads them again finds the same.
    """
    bounds = store(hot.join(splitters(df, hot, key, order_by, rows), key, "left").drop("_rows"), "bounds")
    # Hot keys are few, and how many bounds they have follows from their rows.
    slices = hot.agg(F.sum("_rows")).first()[0] / rows
    bounds = bounds.withColumn("_hot", F.lit(True))
    joined = df.join(F.broadcast(bounds) if slices <= MOST_BOUNDS else bounds, key, "left")
    number = F.when(F.col("_hot"), slice_number(F.col("_bounds"), F.struct(*order_by)))
    return joined.withColumn(out, number).drop("_hot", "_bounds")
