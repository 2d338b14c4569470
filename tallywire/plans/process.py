"""From a log to its labelled records, and from raw records to the audit table."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywire.operators.anomaly import DEFAULT_THRESHOLDS, Thresholds, flag_anomalies
from tallywire.operators.continuity import classify_continuity
from tallywire.operators.dedup import mark_duplicates
from tallywire.operators.running import large_keys
from tallywire.operators.skew import SLICE_ROWS
from tallywire.operators.validation import validate
from tallywire.schema import FIELD_COLUMNS, LOG_ORDER
from tallywire.session import stage

READING_COLUMNS = list(FIELD_COLUMNS.values())


def label_log(
    readings: DataFrame,
    order_by: Sequence[str] = LOG_ORDER,
    limits: Thresholds = DEFAULT_THRESHOLDS,
    seen: Callable[[DataFrame], DataFrame] | None = None,
    last: DataFrame | None = None,
    key: str | Sequence[str] = "sensor_id",
    store: Callable[[DataFrame, str], DataFrame] = stage,
    stored: bool = False,
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """Valid readings with `is_duplicate`, `previous_sequence`, `status`, `missing`, `is_anomaly`
    and `anomaly`.

    Two shuffles of the whole log: by event id for the duplicates, by sensor (hot ones by slice of arrival) for
    continuity. The readings are stored first, unless they are `stored` already, since they are looked through for
    repeated ids and for hot sensors before. `seen` and `last` carry what earlier batches left behind; `key` is what a
    sequence counts by.
    """
    if not stored:
        readings = store(readings, "readings")
    hot = large_keys(readings, key, slice_rows)
    marked = mark_duplicates(readings, order_by, "event_id", seen, store, stored=True)
    placed = classify_continuity(marked, order_by, key, last=last, slice_rows=slice_rows, store=store, hot=hot)
    return flag_anomalies(placed, limits)


def check_log(raw: DataFrame, keep_payload: bool = True) -> DataFrame:
    """Raw records parsed and validated, without key and headers. Those that failed carry their whole payload as `raw`
    and the time of the check, which is now or that of the column `checked_at`; the payload of good ones is kept for the
    audit log, or dropped."""
    checked = validate(raw)
    kept = [c for c in raw.columns if c not in ("key", "value", "headers", "payload", "checked_at")]
    failed = F.col("reason").isNotNull()
    time = F.col("checked_at") if "checked_at" in raw.columns else F.current_timestamp()
    failure = [F.when(failed, F.col("payload")).alias("raw"), F.when(failed, time).alias("dead_lettered_at")]
    payload = [F.when(F.col("reason").isNull(), F.col("payload")).alias("payload")] if keep_payload else []
    return checked.select(*kept, *READING_COLUMNS, "event_time", "reason", "errors", *failure, *payload)


def process_log(
    raw: DataFrame,
    order_by: Sequence[str] = LOG_ORDER,
    limits: Thresholds = DEFAULT_THRESHOLDS,
    keep_payload: bool = True,
    **label_options,
) -> DataFrame:
    """The audit table of a raw log: one row per record, with its status, whatever became of it.

    The parsed records are staged first. Parsing is the expensive step and then happens once; looking for hot keys,
    labelling and quarantining each read just their columns of the staged table.
    """
    return label_checked(stage(check_log(raw, keep_payload), "checked"), order_by, limits, **label_options)


def label_checked(
    checked: DataFrame,
    order_by: Sequence[str] = LOG_ORDER,
    limits: Thresholds = DEFAULT_THRESHOLDS,
    **label_options,
) -> DataFrame:
    """The audit table from stored checked records: good ones labelled, bad ones with their reason as status."""
    good = checked.where(F.col("reason").isNull())
    bad = checked.where(F.col("reason").isNotNull())
    labelled = label_log(good, order_by, limits, stored=True, **label_options)
    return labelled.unionByName(bad.withColumn("status", F.col("reason")), allowMissingColumns=True)
