"""Threshold anomalies."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywire.functions.numbers import number_text
from tallywire.schema import DUPLICATE


@dataclass(frozen=True)
class Thresholds:
    high_c: float = 80.0
    low_c: float = -10.0
    vibration_mm_s: float = 5.0


DEFAULT_THRESHOLDS = Thresholds()

ANOMALY_COLUMNS = (
    "event_id", "sensor_id", "rack_id", "ts", "sequence", "temperature_c", "vibration_mm_s",
)


def is_anomalous(limits: Thresholds = DEFAULT_THRESHOLDS) -> Column:
    """Whether a reading breaks any threshold; a missing vibration counts as 0."""
    hot, cold, shaking = _breaches(limits)
    return F.coalesce(hot | cold | shaking, F.lit(False))


def anomaly_reason(limits: Thresholds = DEFAULT_THRESHOLDS) -> Column:
    """Every threshold a reading breaks, joined by '; '; null when it breaks none."""
    hot, cold, shaking = _breaches(limits)

    def text(column: str, name: str, sign: str, limit: float) -> Column:
        value = F.coalesce(number_text(F.col(column)), F.lit("null"))
        return F.concat(F.lit(f"{name} "), value, F.lit(f" {sign} "), number_text(F.lit(float(limit))))

    reasons = F.concat_ws(
        "; ",
        F.when(hot, text("temperature_c", "temperatureC", ">", limits.high_c)),
        F.when(cold, text("temperature_c", "temperatureC", "<", limits.low_c)),
        F.when(shaking, text("vibration_mm_s", "vibrationMmS", ">", limits.vibration_mm_s)),
    )
    # Most readings break nothing; only those that do get a text.
    return F.when(is_anomalous(limits), reasons)


def flag_anomalies(readings: DataFrame, limits: Thresholds = DEFAULT_THRESHOLDS) -> DataFrame:
    """Add `is_anomaly` and `anomaly` (the reason, or null) to any table of readings. Counting needs only the first."""
    return readings.withColumns({"is_anomaly": is_anomalous(limits), "anomaly": anomaly_reason(limits)})


def detect_anomalies(readings: DataFrame, limits: Thresholds = DEFAULT_THRESHOLDS) -> DataFrame:
    """The anomalous readings of any table, with the reason of each. Labelled duplicates raise none."""
    if "status" in readings.columns:
        readings = readings.where(F.col("status") != DUPLICATE)
    elif "is_duplicate" in readings.columns:
        readings = readings.where(~F.col("is_duplicate"))
    found = readings.where(is_anomalous(limits))
    return found.select(*ANOMALY_COLUMNS, anomaly_reason(limits).alias("reason"))


def _breaches(limits: Thresholds) -> tuple[Column, Column, Column]:
    temperature = F.col("temperature_c")
    vibration = F.coalesce("vibration_mm_s", F.lit(0.0))
    return temperature > limits.high_c, temperature < limits.low_c, vibration > limits.vibration_mm_s
