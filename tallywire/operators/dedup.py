"""Labelling re-delivered records."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywire.schema import LOG_ORDER
from tallywire.session import stage


def arrival(order_by: Sequence[str]) -> Column:
    """Arrival as one comparable value."""
    return F.col(order_by[0]) if len(order_by) == 1 else F.struct(*order_by)


def mark_duplicates(
    df: DataFrame,
    order_by: Sequence[str] = LOG_ORDER,
    id_col: str = "event_id",
    seen: Callable[[DataFrame], DataFrame] | None = None,
    store: Callable[[DataFrame, str], DataFrame] = stage,
    stored: bool = False,
) -> DataFrame:
    """Add `is_duplicate`: true for every record whose id arrived before. A record without an id is never one.

    `seen` tells which of the ids of a table (of the column `id_col`) were there before this log; all their records are
    duplicates.

    Ids that arrived more than once are found by partial minima of arrival, however many records one of them has, and
    are stored; few as they are, the records then meet them in a join whose hot keys Spark splits. `df` is read twice
    and therefore stored first by `store`, unless it is `stored` already.
    """
    if not stored:
        df = store(df, "unmarked")
    columns = df.columns
    first = F.min(arrival(order_by)).alias("_first")
    again = df.where(F.col(id_col).isNotNull()).groupBy(id_col).agg(first, F.count(F.lit(1)).alias("_count"))
    if seen is None:
        again = again.where("_count > 1").select(id_col, "_first")
        later = arrival(order_by) > F.col("_first")
    else:
        # Only ids of this log are looked for: what is moved of the ids seen before is what matches.
        known = seen(again.select(id_col)).select(id_col, F.lit(True).alias("_seen"))
        again = again.join(known, id_col, "left").where("_count > 1 OR _seen").select(id_col, "_first", "_seen")
        later = F.col("_seen") | (arrival(order_by) > F.col("_first"))
    marked = df.join(store(again, "repeated-ids"), id_col, "left")
    return marked.withColumn("is_duplicate", F.coalesce(later, F.lit(False))).select(*columns, "is_duplicate")
