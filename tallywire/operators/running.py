"""Running aggregates over the earlier rows of a key, for keys of any size."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallywire.operators.skew import SLICE_ROWS, hot_keys, with_slices
from tallywire.session import stage

_COMBINE: dict[str, tuple[Callable[[str], Column], Callable[[Column, Column], Column]]] = {
    "max": (F.max, lambda a, b: F.greatest(a, b)),
    "sum": (F.sum, lambda a, b: F.coalesce(a, b) + F.when(a.isNull(), F.lit(0)).otherwise(F.coalesce(b, F.lit(0)))),
}

# The key as one value that is never null, so that rows without a key are a key like any other.
_KEY = "_key"


def key_columns(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def running(
    df: DataFrame,
    out: str,
    how: str,
    value: Column,
    key: str | Sequence[str],
    order_by: Sequence[str],
    start: DataFrame | None = None,
    slice_rows: int = SLICE_ROWS,
    store: Callable[[DataFrame, str], DataFrame] = stage,
    stored: bool = False,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Add `out`: the `how` ("max" or "sum") of `value` over the rows of `key` that come earlier in `order_by`.

    A key of up to `slice_rows` rows is one window partition. The rows of a larger one are cut along the order, whatever
    its columns are, into slices of about that many rows: each runs by itself, and starts from what the slices before it
    add up to, of which there is one row for each slice. Both aggregates are associative, so the answer does not depend
    on where the cuts are. `start` is an optional table (key columns, `_start`) of values from before this table; it takes
    part as rows that come first. `df` is read several times and therefore stored first by `store`, unless it is
    `stored` already. Who knows the large keys hands them in as `hot` (see `large_keys`); without any, `df` is read once.
    """
    keys = key_columns(key)
    columns = df.columns
    plain = hot is not None and hot.isEmpty()
    if not stored and not plain:
        df = store(df, "running")
    df = df.withColumn("_value", value).withColumn(_KEY, F.struct(*keys))
    if start is not None:
        # Nulls sort before all places in the order.
        before = start.select(*keys, F.struct(*keys).alias(_KEY), F.col("_start").alias("_value"))
        df = df.withColumn("_own", F.lit(True)).unionByName(before, allowMissingColumns=True)
    if hot is None:
        hot = hot_keys(df, _KEY, slice_rows)
        plain = hot.isEmpty()
    if plain:
        # By the key's own columns, so that an aggregate by key that follows finds the rows dealt out and sorted already.
        placed = _within(df, out, how, keys, order_by)
    else:
        df = with_slices(df, store(hot, "hot-keys"), _KEY, order_by, slice_rows, store)
        tops = df.where(F.col("_slice").isNotNull()).groupBy(_KEY, "_slice").agg(_COMBINE[how][0]("_value").alias("_value"))
        begins = store(_within(tops, "_begin", how, [_KEY], ["_slice"]).drop("_value"), "begins")
        placed = _within(df, out, how, [_KEY, "_slice"], order_by).join(begins, [_KEY, "_slice"], "left")
        placed = placed.withColumn(out, _COMBINE[how][1](F.col(out), F.col("_begin")))
    if start is not None:
        placed = placed.where("_own")
    return placed.select(*columns, out)


def large_keys(df: DataFrame, key: str | Sequence[str], slice_rows: int = SLICE_ROWS) -> DataFrame:
    """The keys of a log, or of one with more rows, that `running` has to cut."""
    return hot_keys(df.withColumn(_KEY, F.struct(*key_columns(key))), _KEY, slice_rows)


def _within(df: DataFrame, out: str, how: str, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    earlier = Window.partitionBy(*keys).orderBy(*order_by).rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumn(out, _COMBINE[how][0]("_value").over(earlier))
