"""Sequence continuity per sensor: gaps, late arrivals and what they mean for a choice of record key."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywire.operators.running import key_columns, running
from tallywire.schema import ACCEPTED, DUPLICATE, GAP, LOG_ORDER, OUT_OF_ORDER
from tallywire.session import stage


def with_previous_sequence(
    df: DataFrame,
    order_by: Sequence[str] = LOG_ORDER,
    key: str | Sequence[str] = "sensor_id",
    sequence: str = "sequence",
    last: DataFrame | None = None,
    **options,
) -> DataFrame:
    """Add `previous_sequence`: the highest sequence of the sensor that arrived earlier, 0 when there is none.

    Duplicates (`is_duplicate`, when present) do not count. `key` may be several columns. `last` is an optional table
    `(key, last_sequence)` of what arrived before this log. `options` are those of `running`: `slice_rows`, `store`, and
    `stored` for a log that is a stored table already.
    """
    counted = F.col(sequence)
    if "is_duplicate" in df.columns:
        counted = F.when(~F.col("is_duplicate"), counted)
    start = None if last is None else last.select(*key_columns(key), F.col("last_sequence").alias("_start"))
    df = running(df, "_before", "max", counted, key, order_by, start, **options)
    previous = F.greatest(F.lit(0.0), F.coalesce("_before", F.lit(0.0)))
    return df.withColumn("previous_sequence", previous).drop("_before")


def classify_continuity(
    df: DataFrame,
    order_by: Sequence[str] = LOG_ORDER,
    key: str | Sequence[str] = "sensor_id",
    sequence: str = "sequence",
    last: DataFrame | None = None,
    **options,
) -> DataFrame:
    """Add `previous_sequence`, `status` and `missing` (readings skipped by a gap, else 0)."""
    df = with_previous_sequence(df, order_by, key, sequence, last, **options)
    seq, previous = F.col(sequence), F.col("previous_sequence")
    status = (
        F.when((previous != 0) & (seq < previous), OUT_OF_ORDER)
        .when((previous != 0) & (seq > previous + 1), GAP)
        .otherwise(ACCEPTED)
    )
    if "is_duplicate" in df.columns:
        status = F.when(F.col("is_duplicate"), DUPLICATE).otherwise(status)
    df = df.withColumn("status", status)
    return df.withColumn("missing", F.when(F.col("status") == GAP, seq - previous - 1).otherwise(0.0))


def ordering_report(
    df: DataFrame,
    orders: Mapping[str, Sequence[str]],
    key: str | Sequence[str] = "sensor_id",
    store: Callable[[DataFrame, str], DataFrame] = stage,
    stored: bool = False,
    **options,
) -> DataFrame:
    """Continuity of one log under several arrival orders, one row per order.

    Shows what a record key that does not keep a sensor in one partition costs. The log is stored once for all orders,
    unless it is `stored` already.
    """
    if not stored:
        df = store(df, "ordering")
    report = None
    for name, order_by in orders.items():
        row = classify_continuity(df, order_by, key, store=store, stored=True, **options).agg(
            F.lit(name).alias("arrival_order"),
            F.count_if(F.col("status") != DUPLICATE).alias("readings"),
            F.count_if(F.col("status") == OUT_OF_ORDER).alias("out_of_order"),
            F.count_if(F.col("status") == GAP).alias("gaps"),
            F.coalesce(F.sum("missing"), F.lit(0.0)).alias("missing"),
        )
        report = row if report is None else report.unionByName(row)
    if report is None:
        raise ValueError("name at least one arrival order")
    return report


def partition_spread(df: DataFrame, key: str = "sensor_id", partition: str = "partition") -> DataFrame:
    """Sensors whose records sit in more than one partition, so that no order between them is guaranteed."""
    return df.groupBy(key).agg(F.count_distinct(partition).alias("partitions")).where(F.col("partitions") > 1)
