"""Ids, keys and the records handed to sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywire.functions.clock import iso_text
from tallywire.functions.numbers import json_number, number_text, round_half_up
from tallywire.functions.text import pad_left, utf16_char
from tallywire.schema import FIELD_COLUMNS

KEY_MODES = ("sensor", "roundrobin", "random")
WITH_NULLS = {"ignoreNullFields": "false"}


def sensor_id(index: Column) -> Column:
    """sensor-01, sensor-02, … for index 0, 1, …"""
    return F.concat(F.lit("sensor-"), pad_left((index + 1).cast("string"), 2, "0"))


def rack_id(index: Column) -> Column:
    """rack-A, rack-B, … for index 0, 1, …"""
    return F.concat(F.lit("rack-"), utf16_char(index + 65))


def event_id(run: Column, sensor: Column, sequence: Column) -> Column:
    """<run>-<sensor>-<sequence padded to 6 digits>; longer numbers stay whole."""
    return F.concat_ws("-", run, sensor, pad_left(number_text(sequence.cast("double")), 6, "0"))


def make_readings(df: DataFrame) -> DataFrame:
    """Readings from raw measurements: `run_id, sensor_id, rack_id, sequence, time, temperature_c, humidity_pct,
    vibration_mm_s`, rounded to 2, 2 and 3 decimals."""
    return df.select(
        F.lit(1.0).alias("schema_version"),
        event_id(F.col("run_id"), F.col("sensor_id"), F.col("sequence")).alias("event_id"),
        "sensor_id",
        "rack_id",
        F.col("sequence").cast("double").alias("sequence"),
        iso_text(F.col("time")).alias("ts"),
        round_half_up(F.col("temperature_c"), 2).alias("temperature_c"),
        round_half_up(F.col("humidity_pct"), 2).alias("humidity_pct"),
        round_half_up(F.col("vibration_mm_s"), 3).alias("vibration_mm_s"),
    )


def with_message_key(readings: DataFrame, mode: str = "sensor", seed: int = 0) -> DataFrame:
    """Add `key`: the sensor, nothing, or text that looks random.

    The random text is a hash of the event id, so a retried task publishes the same key again.
    """
    if mode not in KEY_MODES:
        raise ValueError(f"unknown key mode: {mode}")
    if mode == "sensor":
        key = F.col("sensor_id")
    elif mode == "roundrobin":
        key = F.lit(None).cast("string")
    else:
        mixed = F.md5(F.concat_ws("-", F.lit(seed).cast("string"), F.col("event_id")).cast("binary"))
        key = F.substring(mixed, 1, 12)
    return readings.withColumn("key", key)


def reading_json() -> Column:
    """A reading as the JSON text that is published. Missing optional fields are left out."""
    numbers = {"schemaVersion", "sequence", "temperatureC", "humidityPct", "vibrationMmS"}
    order = (
        "schemaVersion", "eventId", "sensorId", "rackId", "sequence", "ts", "temperatureC", "humidityPct",
        "vibrationMmS",
    )
    parts = [
        (json_number(F.col(FIELD_COLUMNS[n])) if n in numbers else F.col(FIELD_COLUMNS[n])).alias(n) for n in order
    ]
    return F.to_json(F.struct(*parts))


def to_log_records(readings: DataFrame, key_mode: str = "sensor", source: str = "tallywire", seed: int = 0) -> DataFrame:
    """Readings as `(key, value, headers)` records, ready for a Kafka or table sink."""
    keyed = with_message_key(readings, key_mode, seed)
    return keyed.select(
        "key",
        reading_json().alias("value"),
        _headers(
            ("event-type", F.lit("sensor.reading")),
            ("schema-version", number_text(F.col("schema_version"))),
            ("source", F.lit(source)),
        ),
    )


def anomaly_records(anomalies: DataFrame) -> DataFrame:
    """Anomalies as `(key, value, headers)` records. `runId` repeats the event id."""
    body = F.struct(
        F.lit("anomaly").alias("type"),
        F.col("event_id").alias("eventId"),
        F.col("sensor_id").alias("sensorId"),
        F.col("rack_id").alias("rackId"),
        "ts",
        json_number(F.col("sequence")).alias("sequence"),
        json_number(F.col("temperature_c")).alias("temperatureC"),
        json_number(F.col("vibration_mm_s")).alias("vibrationMmS"),
        "reason",
        F.col("event_id").alias("runId"),
    )
    return anomalies.select(
        F.col("sensor_id").alias("key"),
        F.to_json(body, WITH_NULLS).alias("value"),
        _headers(("event-type", F.lit("sensor.anomaly"))),
    )


def dead_letters(quarantine: DataFrame) -> DataFrame:
    """Quarantined records in the dead-letter layout, with their whole payload.

    The time is that of the check when the records carry one, so that all copies of a failure agree.
    """
    raw = F.col("raw") if "raw" in quarantine.columns else F.col("payload")
    time = F.col("dead_lettered_at") if "dead_lettered_at" in quarantine.columns else F.current_timestamp()
    return quarantine.select(
        F.lit("dead-letter").alias("type"),
        "reason",
        "errors",
        time.alias("dead_lettered_at"),
        "topic",
        "partition",
        "offset",
        raw.alias("raw"),
    )


def dead_letter_records(letters: DataFrame) -> DataFrame:
    """Dead letters as `(key, value, headers)` records, keyed by the partition they came from."""
    body = F.struct(
        "type",
        "reason",
        "errors",
        iso_text(F.col("dead_lettered_at")).alias("deadLetteredAt"),
        source_struct().alias("source"),
        "raw",
    )
    return letters.select(
        F.concat(F.lit("p"), F.col("partition")).alias("key"),
        F.to_json(body, WITH_NULLS).alias("value"),
        _headers(("event-type", F.lit("sensor.reading.dlt")), ("reason", F.col("reason"))),
    )


def source_struct() -> Column:
    """Where a record came from; the offset is text, as in the log protocol."""
    return F.struct("topic", "partition", F.col("offset").cast("string").alias("offset"))


def _headers(*pairs: tuple[str, Column]) -> Column:
    entries = [F.struct(F.lit(k).alias("key"), v.cast("binary").alias("value")) for k, v in pairs]
    return F.array(*entries).alias("headers")
