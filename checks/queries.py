"""Registered queries: each takes (spark, folder of the tables) and returns a DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.event_log import ARRIVAL, raw_records, record_log
from tallywire.functions.clock import iso_text, run_id
from tallywire.operators.anomaly import Thresholds, detect_anomalies, flag_anomalies
from tallywire.operators.continuity import classify_continuity, ordering_report, partition_spread, with_previous_sequence
from tallywire.operators.dedup import mark_duplicates
from tallywire.operators.records import (
    anomaly_records,
    dead_letter_records,
    dead_letters,
    event_id,
    make_readings,
    rack_id,
    sensor_id,
    to_log_records,
    with_message_key,
)
from tallywire.operators.running import large_keys
from tallywire.operators.summary import (
    batch_outcomes,
    format_summary,
    log_totals,
    offset_ranges,
    run_stats,
    sensor_state,
    sensor_summary,
    state_totals,
    summarize,
    summary_positions,
    summary_sections,
)
from tallywire.operators.validation import decode_payload, parse_payload, split_valid, validate
from tallywire.plans.process import check_log, label_log, process_log
from tallywire.plans.sinks import audit_log
from tallywire.schema import DUPLICATE
from tallywire.session import prepare, stage, stage_by_key, work_dir
from tallywire.sources.log import log_from_table, read_log_files
from tallywire.sources.offsets import LogIndex
from tallywire.streaming.drop import drop_duplicates_stream
from tallywire.streaming.microbatch import LogStream
from tallywire.streaming.revised import RevisedLog

BATCH_OFFSETS = 10_000
SEED = 20260930

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return record_log(table(spark, sf_dir, "events"))


def whole_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log of all events, none lost, with its re-deliveries."""
    return record_log(table(spark, sf_dir, "events"), lossless=True)


def raw(spark: SparkSession, sf_dir: str, spread: str = "user_id") -> DataFrame:
    return raw_records(table(spark, sf_dir, "events"), spread=spread)


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return label_log(log(spark, sf_dir).withColumn("ts", iso_text(F.col("ts"))), ARRIVAL)


def audit(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    return process_log(raw(spark, sf_dir), **options)


def dedup_exact(spark, sf_dir):
    return mark_duplicates(whole_log(spark, sf_dir), ARRIVAL).select("event_id", "arrival", "is_duplicate")


def previous_sequence(spark, sf_dir):
    placed = with_previous_sequence(mark_duplicates(log(spark, sf_dir), ARRIVAL), ARRIVAL)
    return placed.where(~F.col("is_duplicate")).select("sensor_id", "arrival", "sequence", "previous_sequence")


def continuity_status(spark, sf_dir):
    placed = classify_continuity(mark_duplicates(log(spark, sf_dir), ARRIVAL), ARRIVAL)
    return placed.select("event_id", "sensor_id", "arrival", "status", "missing")


def missing_by_sensor(spark, sf_dir):
    placed = classify_continuity(mark_duplicates(log(spark, sf_dir), ARRIVAL), ARRIVAL)
    return placed.groupBy("sensor_id").agg(
        F.sum("missing").alias("missing"),
        F.count_if(F.col("status") == "gap").alias("gaps"),
        F.count_if(F.col("status") == "out_of_order").alias("out_of_order"),
    )


def continuity_by_rack(spark, sf_dir):
    """Continuity with another key and without de-duplication; records without a rack are a key like any other."""
    placed = classify_continuity(log(spark, sf_dir), ARRIVAL, key="rack_id")
    return placed.groupBy("rack_id", "status").agg(F.count(F.lit(1)).alias("records"), F.sum("missing").alias("missing"))


def continuity_by_sensor_and_type(spark, sf_dir):
    """Continuity with a key of two columns: each sensor counts by itself on each rack."""
    marked = mark_duplicates(log(spark, sf_dir), ARRIVAL)
    placed = classify_continuity(marked, ARRIVAL, key=("sensor_id", "rack_id"))
    return placed.select("event_id", "sensor_id", "rack_id", "arrival", "previous_sequence", "status", "missing")


def _skewed(spark, sf_dir):
    """A log in which one sensor holds a third of all rows and one id a ninth."""
    number = F.col("event_id")
    return table(spark, sf_dir, "events").select(
        F.when(number % 3 == 0, F.lit("hot")).otherwise(F.col("user_id").cast("string")).alias("sensor_id"),
        F.when(number % 9 == 0, F.lit("again")).otherwise(F.concat(F.lit("e"), (number - number % 5).cast("string"))).alias("id"),
        (number + (number * 7) % 11).cast("double").alias("sequence"),
        number.alias("arrival"),
        F.concat(F.lit("line-"), (number * 7919 % 1_000_003).cast("string")).alias("place"),
        F.date_trunc("hour", "ts").alias("hour"),
    )


def continuity_skewed(spark, sf_dir):
    """A hot sensor and a hot id; sensors of more than 500 records are cut."""
    marked = mark_duplicates(_skewed(spark, sf_dir), ARRIVAL, "id", stored=True)
    placed = classify_continuity(marked, ARRIVAL, slice_rows=500)
    return placed.select("arrival", "sensor_id", "is_duplicate", "previous_sequence", "status", "missing")


def continuity_text_order(spark, sf_dir):
    """The same under orders that numbers do not lead: by text, and by hours in which many records fall."""
    log = _skewed(spark, sf_dir)
    both = None
    for name, order in (("place", ("place", "arrival")), ("hour", ("hour", "place", "arrival"))):
        placed = classify_continuity(log, order, slice_rows=300, stored=True)
        one = placed.select(F.lit(name).alias("led_by"), "arrival", "previous_sequence", "status", "missing")
        both = one if both is None else both.unionByName(one)
    return both


def ordering(spark, sf_dir):
    # Ordered by partition, a sensor whose records are spread over partitions is read one partition after the other.
    spread = log(spark, sf_dir).withColumn("partition", F.substring("event_id", 5, 20).cast("long") % 3)
    return ordering_report(mark_duplicates(spread, ARRIVAL), {"arrival": ARRIVAL, "partition": ("partition", "arrival"), "time": ("ts", "arrival")})


def sensor_spread(spark, sf_dir):
    return partition_spread(
        raw(spark, sf_dir, spread="event_id").select(F.col("key").cast("string").alias("sensor_id"), "partition")
    )


def anomalies(spark, sf_dir):
    return detect_anomalies(mark_duplicates(whole_log(spark, sf_dir), ARRIVAL)).withColumn("ts", iso_text(F.col("ts")))


def anomalies_standalone(spark, sf_dir):
    """Detection on a table that is no log at all: order lines, with other thresholds."""
    lines = table(spark, sf_dir, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("event_id"),
        F.col("l_suppkey").cast("string").alias("sensor_id"),
        F.col("l_returnflag").alias("rack_id"),
        F.col("l_shipdate").cast("string").alias("ts"),
        F.col("l_linenumber").cast("double").alias("sequence"),
        F.col("l_quantity").cast("double").alias("temperature_c"),
        F.when(F.col("l_discount") > 0.03, F.col("l_discount").cast("double")).alias("vibration_mm_s"),
    )
    return detect_anomalies(lines, Thresholds(high_c=48.0, low_c=2.0, vibration_mm_s=0.095))


def anomaly_messages(spark, sf_dir):
    records = anomaly_records(anomalies(spark, sf_dir))
    return records.select("key", "value", _header("event-type", "event_type"))


def sensors(spark, sf_dir):
    return sensor_summary(labelled(spark, sf_dir), ARRIVAL)


def sensors_by_run(spark, sf_dir):
    """Every sensor counts anew in each run: sequences, last values and sums by sensor and run."""
    runs = log(spark, sf_dir).withColumns(
        {"ts": iso_text(F.col("ts")), "run": F.call_function("div", F.substring("event_id", 5, 20).cast("long"), F.lit(2500))}
    )
    key = ("sensor_id", "run")
    return sensor_summary(label_log(runs, ARRIVAL, key=key), ARRIVAL, key)


def sensors_bucketed(spark, sf_dir):
    """Two passes by sensor over a log that is stored by sensor: neither moves it."""
    readings = log(spark, sf_dir).withColumn("ts", iso_text(F.col("ts")))
    marked = stage_by_key(mark_duplicates(readings, ARRIVAL), "by-sensor", ("sensor_id",), ARRIVAL)
    hot = large_keys(marked, "sensor_id")
    return sensor_summary(flag_anomalies(classify_continuity(marked, ARRIVAL, stored=True, hot=hot)), ARRIVAL)


def totals(spark, sf_dir):
    return log_totals(labelled(spark, sf_dir), ARRIVAL)


def stats(spark, sf_dir):
    return run_stats(audit(spark, sf_dir, keep_payload=False))


def outcomes(spark, sf_dir):
    batch = F.floor(F.col("offset") / BATCH_OFFSETS).alias("batch_id")
    return batch_outcomes(audit(spark, sf_dir, keep_payload=False).select("*", batch))


def ranges(spark, sf_dir):
    return offset_ranges(raw(spark, sf_dir))


def decoded(spark, sf_dir):
    """Payloads with bytes that are no UTF-8, and payloads that are missing."""
    number = F.col("event_id")
    text = F.concat(F.lit("é"), F.col("event_type"), F.lit("-"), number.cast("string")).cast("binary")
    payload = (
        F.when(number % 53 == 0, F.lit(None))
        .when(number % 5 == 0, F.concat(text, F.lit(b"\xff"), F.lit("x").cast("binary")))
        .otherwise(text)
    )
    records = table(spark, sf_dir, "events").select("event_id", payload.alias("value"))
    return decode_payload(records).select("event_id", "payload")


def json_parse_split(spark, sf_dir):
    parsed = parse_payload(raw(spark, sf_dir))
    return parsed.select(
        "partition", "offset", F.col("event").isNotNull().alias("parsed"), F.length("payload").alias("length")
    )


def validation_errors(spark, sf_dir):
    checked = validate(raw(spark, sf_dir))
    return checked.select("partition", "offset", "reason", F.array_join("errors", "; ").alias("errors"))


def validation_kinds(spark, sf_dir):
    """Every kind of problem, and some that are none."""
    number = F.col("event_id")
    text, user = number.cast("string"), F.col("user_id").cast("string")
    body = F.concat(
        F.lit('"eventId":"e'), text, F.lit('","sensorId":"s'), user, F.lit('","sequence":'), text,
        F.lit(',"ts":"2026-09-30T10:00:00Z"'),
    )
    full = F.concat(F.lit('{"schemaVersion":1,'), body, F.lit(',"temperatureC":20.5'))
    kinds = [
        F.concat(full, F.lit("}")),
        F.concat(full, F.lit("} x")),
        F.concat(F.lit(" \n"), full, F.lit(',"tags":["a","b"],"extra":{"k":[1]}} ')),
        F.concat(full, F.lit(',"tags":[1]}]')),
        F.concat(F.lit("{"), body, F.lit("}")),
        F.concat(F.lit('{"schemaVersion":"1","eventId":'), text, F.lit(',"sensorId":true,"sequence":{},"ts":[],"temperatureC":null}')),
        F.concat(full, F.lit(',"eventId":"'), F.repeat(F.lit("x"), 201), F.lit('"}')),
        F.concat(full, F.lit(',"eventId":"'), F.repeat(F.lit("x"), 200), F.lit('"}')),
        F.concat(full, F.lit(',"ts":"yesterday"}')),
        F.concat(full, F.lit(',"ts":"2026-02-30"}')),
        F.concat(full, F.lit(',"ts":"2026-09-30T10:00:00+0200"}')),
        F.concat(full, F.lit(',"ts":"2026-13-01T10:00:00Z"}')),
        F.concat(full, F.lit(',"rackId":7,"humidityPct":"50","vibrationMmS":null}')),
        F.concat(F.lit('"'), text, F.lit('"')),
        text,
        F.lit("null"),
        F.lit(""),
        F.concat(F.lit("["), full, F.lit("}]")),
        F.concat(F.lit('{"schemaVersion":1,'), body, F.lit(',"temperatureC":1e999}')),
    ]
    # The kind is picked by position, so every event gives one record.
    payload = F.element_at(F.array(*kinds), (number % len(kinds) + 1).cast("int"))
    records = table(spark, sf_dir, "events").select(number, payload.cast("binary").alias("value"))
    checked = validate(records.withColumnRenamed("event_id", "number"))
    return checked.select(
        "number", "reason", F.array_join("errors", "; ").alias("errors"), "sensor_id", "sequence", "temperature_c", "rack_id"
    )


def readings_parsed(spark, sf_dir):
    good, _ = split_valid(validate(raw(spark, sf_dir)))
    return good.select(
        "partition", "offset", "schema_version", "event_id", "sensor_id", "rack_id", "sequence", "ts", "temperature_c",
        "humidity_pct", "vibration_mm_s",
    )


def quarantine(spark, sf_dir):
    _, bad = split_valid(validate(raw(spark, sf_dir)))
    letters = dead_letters(bad)
    return letters.select(
        "type", "reason", F.array_join("errors", "; ").alias("errors"), "topic", "partition", "offset", "raw"
    )


def dead_letter_messages(spark, sf_dir):
    _, bad = split_valid(validate(raw(spark, sf_dir)))
    fixed = dead_letters(bad).withColumn("dead_lettered_at", F.lit("2026-09-30 10:00:00").cast("timestamp"))
    records = dead_letter_records(fixed)
    return records.select("key", "value", _header("event-type", "event_type"), _header("reason", "reason"))


def raw_prefix(spark, sf_dir):
    """Dead letters of long payloads: whole documents are no JSON, and are kept whole."""
    documents = table(spark, sf_dir, "documents")
    records = documents.select("doc_id", F.col("text").cast("binary").alias("value"), F.lit(0).alias("partition"), F.lit(0).alias("offset"))
    _, bad = split_valid(validate(log_from_table(records, "documents")))
    letters = dead_letters(bad)
    return letters.select("reason", F.md5(F.col("raw").cast("binary")).alias("digest"), F.length("raw").alias("length"))


def audit_table(spark, sf_dir):
    lines = audit_log(audit(spark, sf_dir))
    return lines.select(
        "type",
        "topic",
        "partition",
        "offset",
        "status",
        F.get_json_object("event", "$.eventId").alias("event_id"),
        F.get_json_object("event", "$.temperatureC").cast("double").alias("temperature_c"),
        "reason",
        F.array_join("errors", "; ").alias("errors"),
        F.col("source.partition").alias("source_partition"),
        F.col("source.offset").alias("source_offset"),
        "raw",
    )


def message_keys(spark, sf_dir):
    readings = whole_log(spark, sf_dir).select("event_id", "sensor_id", "arrival")
    by_sensor = with_message_key(readings, "sensor").withColumn("mode", F.lit("sensor"))
    keyless = with_message_key(readings, "roundrobin").withColumn("mode", F.lit("roundrobin"))
    return by_sensor.unionByName(keyless).select("mode", "arrival", "key")


def random_keys(spark, sf_dir):
    return with_message_key(whole_log(spark, sf_dir).select("event_id", "sensor_id", "arrival"), "random", SEED)


def reading_messages(spark, sf_dir):
    readings = whole_log(spark, sf_dir).withColumns({"schema_version": F.lit(1.0), "ts": iso_text(F.col("ts"))})
    records = to_log_records(readings, "sensor", "telemetry")
    return records.select(
        "key",
        "value",
        _header("event-type", "event_type"),
        _header("schema-version", "schema_version"),
        _header("source", "source"),
    )


def event_ids(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    index = F.col("user_id")
    return events.select(
        F.col("event_id").alias("number"),
        event_id(run_id(F.col("ts").cast("timestamp")), sensor_id(index), F.col("event_id") * 97).alias("event_id"),
        sensor_id(index).alias("sensor_id"),
        rack_id(index % 26).alias("rack_id"),
    )


def readings_rounded(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    measured = events.select(
        F.lit("run1").alias("run_id"),
        sensor_id(F.col("user_id")).alias("sensor_id"),
        F.concat(F.lit("rack-"), F.col("event_type")).alias("rack_id"),
        F.col("event_id").alias("sequence"),
        F.col("ts").cast("timestamp").alias("time"),
        (F.col("value") / 7 - 20).alias("temperature_c"),
        (F.col("value") / 8 - 10).alias("humidity_pct"),
        (F.col("value") / 160).alias("vibration_mm_s"),
    )
    return make_readings(measured)


def report(spark, sf_dir):
    # Lines and totals come from one state per sensor, worked out once.
    states = stage(sensor_state(labelled(spark, sf_dir), ARRIVAL), "states")
    return format_summary(summarize(states), state_totals(states))


def sections(spark, sf_dir):
    marked = stage(labelled(spark, sf_dir), "labelled")
    return summary_sections(marked, order_by=ARRIVAL).select(
        "section", "sensor_id", F.element_at("arrival", 1).alias("arrival"), "body"
    )


def positions(spark, sf_dir):
    """Every row of the summary document with its place in it."""
    marked = stage(labelled(spark, sf_dir), "labelled")
    placed = summary_positions(summary_sections(marked, order_by=ARRIVAL))
    return placed.select("section", "sensor_id", F.element_at("arrival", 1).alias("arrival"), "position")


def offset_range_scan(spark, sf_dir):
    """The second quarter of the offsets of a log kept as files, of which the index names those to open."""
    root = work_dir(spark, "indexed")
    log_from_table(raw(spark, sf_dir)).repartitionByRange(16, "offset").write.parquet(f"{root}/log")
    index = LogIndex(spark, f"{root}/log", f"{root}/index")
    index.refresh()
    low, high = index.entries().agg(F.min("first_offset"), F.max("last_offset")).first()
    found = index.read(low + (high - low) // 4, low + (high - low) // 2)
    return found.select("partition", "offset", F.md5("value").alias("digest"))


def _slice_of(low: int, high: int, slices: int):
    """Which of so many slices of a log a record is in, by its offset."""
    return F.least(F.lit(slices - 1), F.floor((F.col("offset") - low) * slices / (high - low + 1)))


def _streamed(spark: SparkSession, sf_dir: str, slices: int = 3) -> LogStream:
    """The raw log worked off as a stream: written slice by slice in the shared folder, each slice a micro-batch.

    Every slice is a run of its own, so each but the first continues from the checkpoint and the state on disk.
    """
    log = stage(raw(spark, sf_dir), "log")
    low, high = log.agg(F.min("offset"), F.max("offset")).first()
    root = work_dir(spark, "stream")
    stream = LogStream(spark, f"{root}/out")
    for i in range(slices):
        # Headers are part of a log; these records have none.
        log_from_table(log.where(_slice_of(low, high, slices) == i)).write.mode("append").parquet(f"{root}/log")
        stream.start(read_log_files(spark, f"{root}/log")).awaitTermination()
    return stream


def stream_summary(spark, sf_dir):
    return _streamed(spark, sf_dir).summary()


def stream_audit(spark, sf_dir):
    return _streamed(spark, sf_dir).audit().select("partition", "offset", "event_id", "status", "missing", "anomaly")


def stream_stats(spark, sf_dir):
    return _streamed(spark, sf_dir).stats()


def stream_outcomes(spark, sf_dir):
    """The outcome of every micro-batch, from the counters taken while its audit table was written."""
    return _streamed(spark, sf_dir).outcomes()


def stream_drop(spark, sf_dir):
    """Ids of good readings that a stream lets through, each once, over three runs of the stream."""
    log = stage(raw(spark, sf_dir), "log")
    low, high = log.agg(F.min("offset"), F.max("offset")).first()
    root = work_dir(spark, "drop")
    for i in range(3):
        log_from_table(log.where(_slice_of(low, high, 3) == i)).write.mode("append").parquet(f"{root}/log")
        good, _ = split_valid(validate(read_log_files(spark, f"{root}/log")))
        kept = drop_duplicates_stream(good).select("event_id")
        writer = kept.writeStream.format("parquet").option("checkpointLocation", f"{root}/checkpoint")
        writer.trigger(availableNow=True).start(f"{root}/out").awaitTermination()
    return spark.read.schema("event_id string").parquet(f"{root}/out")


def stream_revised(spark, sf_dir):
    """Labels of a stream whose batches are dealt by number, so that sensors and ids are spread over all of them."""
    good, _ = split_valid(stage(check_log(raw(spark, sf_dir, spread="event_id"), keep_payload=False), "checked"))
    revised = RevisedLog(spark, work_dir(spark, "revised"), good.schema, ("offset", "partition"))
    for i in range(3):
        revised.process(good.where(F.col("offset") % 3 == i), i)
    return revised.labels().select("partition", "offset", "event_id", "previous_sequence", "status", "missing")


def average_any_size(spark, sf_dir):
    """Averages of temperatures between 1e-300 and 1e300 in size, the greatest of which cancel out."""
    number = F.col("event_id")
    size = F.pow(F.lit(2.0), ((number * 37) % 1981 - 990).cast("double"))
    # Every value beyond comparison has its opposite under the next number of the sensor.
    far = F.when(number % 2 == 0, 1.0).otherwise(-1.0) * F.pow(F.lit(2.0), (F.call_function("div", number, F.lit(2)) * 7 % 960).cast("double"))
    readings = table(spark, sf_dir, "events").select(
        F.concat(F.lit("s"), (F.call_function("div", number, F.lit(2)) % 50).cast("string")).alias("sensor_id"),
        F.when(number % 3 == 0, F.col("value")).when(number % 3 == 1, F.col("value") / size).otherwise(F.col("value")).alias("small"),
        far.alias("far"),
        number.alias("arrival"),
    )
    both = readings.select("sensor_id", "arrival", F.col("small").alias("temperature_c"), F.lit(0).alias("part")).unionByName(
        readings.select("sensor_id", "arrival", F.col("far").alias("temperature_c"), F.lit(1).alias("part"))
    )
    log = both.select(
        F.lit("accepted").alias("status"), "sensor_id", "arrival", "part", "temperature_c", F.lit(0.0).alias("missing"), F.lit(False).alias("is_anomaly"),
        F.lit(None).cast("string").alias("rack_id"), F.lit(1.0).alias("sequence"), F.lit("").alias("ts"),
        (F.col("temperature_c") * 3).alias("humidity_pct"), F.lit(0.0).alias("vibration_mm_s"),
    )
    found = sensor_summary(log.repartition(7), ("arrival", "part"))
    return found.select("sensor_id", "readings", "avg_temperature_c", "avg_humidity_pct")


def stream_dedup(spark, sf_dir):
    """Ids that come through the stream, each once."""
    audit = _streamed(spark, sf_dir).audit()
    return audit.where(F.col("reason").isNull() & (F.col("status") != DUPLICATE)).select("event_id")


def stream_sections(spark, sf_dir):
    """The summary that the end of a run leaves behind, all sections of it."""
    written = _streamed(spark, sf_dir).sections()
    return written.select("section", "sensor_id", F.element_at("arrival", 2).alias("arrival"), "body")


def _header(name: str, alias: str):
    value = F.filter("headers", lambda h: h["key"] == name)[0]["value"]
    return value.cast("string").alias(alias)


QUERIES: dict[str, Query] = {
    "dedup_exact": dedup_exact,
    "previous_sequence": previous_sequence,
    "continuity_status": continuity_status,
    "missing_by_sensor": missing_by_sensor,
    "continuity_by_rack": continuity_by_rack,
    "continuity_by_sensor_and_type": continuity_by_sensor_and_type,
    "continuity_skewed": continuity_skewed,
    "continuity_text_order": continuity_text_order,
    "ordering_report": ordering,
    "partition_spread": sensor_spread,
    "anomalies": anomalies,
    "anomalies_standalone": anomalies_standalone,
    "anomaly_records": anomaly_messages,
    "sensor_summary": sensors,
    "sensor_summary_by_run": sensors_by_run,
    "sensor_summary_bucketed": sensors_bucketed,
    "log_totals": totals,
    "run_stats": stats,
    "batch_outcomes": outcomes,
    "offset_ranges": ranges,
    "offset_range_scan": offset_range_scan,
    "decode_payload": decoded,
    "json_parse_split": json_parse_split,
    "validation_errors": validation_errors,
    "validation_kinds": validation_kinds,
    "readings_parsed": readings_parsed,
    "dead_letters": quarantine,
    "dead_letter_records": dead_letter_messages,
    "dead_letter_raw": raw_prefix,
    "audit_log": audit_table,
    "message_keys": message_keys,
    "message_keys_random": random_keys,
    "reading_records": reading_messages,
    "event_ids": event_ids,
    "readings_rounded": readings_rounded,
    "summary_report": report,
    "summary_document": sections,
    "summary_positions": positions,
    "stream_summary": stream_summary,
    "stream_audit": stream_audit,
    "stream_stats": stream_stats,
    "stream_outcomes": stream_outcomes,
    "stream_dedup": stream_dedup,
    "stream_drop": stream_drop,
    "stream_revised": stream_revised,
    "average_any_size": average_any_size,
    "stream_sections": stream_sections,
}
