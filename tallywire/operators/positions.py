"""The place of every row in an order over a whole table."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallywire.session import stage


def with_positions(
    df: DataFrame, order_by: Sequence[str], out: str = "position", store: Callable[[DataFrame, str], DataFrame] = stage
) -> DataFrame:
    """Add `out`: the number of the row in the order of `order_by`, from 1. Rows that are equal there follow in any order.

    The rows are dealt out by ranges of the order and sorted in each, which numbers them within their range; how many rows
    the ranges before hold is added. Numbers within a range are stored with the rows, since ranges come from a sample.
    Nothing but one count for each range meets in one place.
    """
    columns = df.columns
    ranged = df.repartitionByRange(*order_by).sortWithinPartitions(*order_by)
    # The upper bits of this number are the partition's, the lower ones count its rows.
    placed = store(ranged.select(*columns, F.spark_partition_id().alias("_range"), F.monotonically_increasing_id().alias("_number")), "placed")
    counts = placed.groupBy("_range").agg(F.count(F.lit(1)).alias("_rows"), F.min("_number").alias("_first"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_range", "_first", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    numbered = placed.join(F.broadcast(offsets), "_range")
    return numbered.select(*columns, (F.col("_before") + F.col("_number") - F.col("_first") + 1).alias(out))
