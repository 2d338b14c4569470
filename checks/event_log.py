"""A record log made from the `events` table: lost readings, late arrivals, re-deliveries and bad payloads included."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywire.operators.running import running

TOPIC = "sensor-readings"
ARRIVAL = ("arrival",)


def numbered_events(events: DataFrame) -> DataFrame:
    """Events with `sequence`, their number within the user by time."""
    columns = ["event_id", "ts", "user_id", "event_type", "value"]
    numbered = running(events.select(*columns), "_before", "sum", F.lit(1), "user_id", ("ts", "event_id"), stored=True)
    return numbered.select(*columns, (F.coalesce("_before", F.lit(0)) + 1).cast("double").alias("sequence"))


def record_log(events: DataFrame, lossless: bool = False) -> DataFrame:
    """Typed readings in the order of `arrival`, which is unique; some are lost on the way, unless `lossless`."""
    return _readings(_deliveries(numbered_events(events), lossless))


def raw_records(events: DataFrame, spread: str = "user_id") -> DataFrame:
    """The log of all events as raw records with JSON payloads, plus broken, incomplete and non-object payloads."""
    numbered = numbered_events(events)
    good = _deliveries(numbered, lossless=True).withColumn("_kind", F.lit("good"))
    kinds = F.array(
        *[
            F.when(F.col("event_id") % step == 0, F.struct(F.lit(kind).alias("_kind"), F.lit(at).alias("_at")))
            for kind, step, at in (("cut", 41, 7), ("incomplete", 43, 8), ("array", 47, 9))
        ]
    )
    bad = numbered.select("*", F.inline(F.array_compact(kinds)))
    bad = bad.withColumn("arrival", F.col("event_id") * 10 + F.col("_at")).drop("_at")
    both = good.unionByName(bad)
    readings = _readings(both, "_kind", "user_id", F.col("event_id").alias("_number"))
    text = _json(F.col("sequence").cast("string"), F.concat(F.lit(',"temperatureC":'), F.col("temperature_c").cast("string")))
    incomplete = _json(F.concat(F.lit('"'), F.col("sequence").cast("string"), F.lit('"')), F.lit(""))
    value = (
        F.when(F.col("_kind") == "good", text)
        .when(F.col("_kind") == "cut", F.substring(text, 1, 20))
        .when(F.col("_kind") == "incomplete", incomplete)
        .otherwise("[1,2]")
    )
    placed = F.col("user_id") if spread == "user_id" else F.col("_number")
    return readings.select(
        F.col("sensor_id").cast("binary").alias("key"),
        value.cast("binary").alias("value"),
        F.lit(TOPIC).alias("topic"),
        (placed % 3).cast("int").alias("partition"),
        F.col("arrival").alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
    )


def _deliveries(numbered: DataFrame, lossless: bool = False) -> DataFrame:
    """Every reading that was not lost, on time or late, and again when it is re-delivered."""
    number = F.col("event_id")
    on_time = number * 10 + F.when(number % 31 == 0, 4001).otherwise(0)
    again = F.when(number % 37 == 0, number * 10 + 5005)
    kept = numbered if lossless else numbered.where(number % 29 != 0)
    return kept.select("*", F.explode(F.array_compact(F.array(on_time, again))).alias("arrival"))


def _readings(deliveries: DataFrame, *extra: str | Column) -> DataFrame:
    number = F.col("event_id")
    rack = F.when(number % 11 != 0, F.concat(F.lit("rack-"), F.col("event_type")))
    return deliveries.select(
        F.concat(F.lit("evt-"), number.cast("string")).alias("event_id"),
        F.concat(F.lit("sensor-"), F.col("user_id").cast("string")).alias("sensor_id"),
        rack.alias("rack_id"),
        "sequence",
        "ts",
        (F.col("value") - 20).alias("temperature_c"),
        F.when(number % 7 != 0, (number % 100).cast("double")).alias("humidity_pct"),
        ((number % 53).cast("double") / 10).alias("vibration_mm_s"),
        "arrival",
        *extra,
    )


def _json(sequence: Column, temperature: Column) -> Column:
    """The payload text, spelled out so that other engines can build the same."""

    def optional(name: str, text: Column, quote: str = "") -> Column:
        return F.coalesce(F.concat(F.lit(f',"{name}":{quote}'), text, F.lit(quote)), F.lit(""))

    return F.concat(
        F.lit('{"schemaVersion":1,"eventId":"'), F.col("event_id"),
        F.lit('","sensorId":"'), F.col("sensor_id"), F.lit('"'),
        optional("rackId", F.col("rack_id"), '"'),
        F.lit(',"sequence":'), sequence,
        F.lit(',"ts":"'), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit('Z"'),
        temperature,
        optional("humidityPct", F.col("humidity_pct").cast("string")),
        optional("vibrationMmS", F.col("vibration_mm_s").cast("string")),
        F.lit("}"),
    )
