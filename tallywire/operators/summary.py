"""Per-sensor aggregates, totals, run statistics and the sections of the summary."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywire.functions.numbers import json_number, number_text, round_half_up
from tallywire.functions.sums import band, combined, ordinary, whole
from tallywire.functions.text import pad_left, pad_right
from tallywire.operators.anomaly import ANOMALY_COLUMNS, DEFAULT_THRESHOLDS, Thresholds
from tallywire.operators.positions import with_positions
from tallywire.operators.running import key_columns
from tallywire.operators.skew import as_long
from tallywire.schema import ACCEPTED, DUPLICATE, GAP, LOG_ORDER, OUT_OF_ORDER
from tallywire.session import stage

WITH_NULLS = {"ignoreNullFields": "false"}

BANDS = ("temperature_band", "humidity_band")


def sensor_state(labelled: DataFrame, order_by: Sequence[str] = LOG_ORDER, key: str | Sequence[str] = "sensor_id") -> DataFrame:
    """What is known of each sensor, in a form that merges: sums, extremes, counts and latest values.

    `labelled` carries `status`, `missing` and `is_anomaly` (see `label_log`). `key` may be several columns, such as sensor
    and run, here and in all that follows. A sensor has one row, and one more for each
    pair of bands (see `functions/sums.py`) its measures beyond the ordinary fall in.
    """
    applied = F.col("status") != DUPLICATE
    humidity = F.coalesce("humidity_pct", F.lit(0.0))
    vibration = F.coalesce("vibration_mm_s", F.lit(0.0))
    has_rack = F.col("rack_id") != ""

    def when_applied(value: Column) -> Column:
        return F.when(applied, value)

    measures = {"temperature": when_applied(F.col("temperature_c")), "humidity": when_applied(humidity)}
    banded = labelled.withColumns({f"{name}_band": band(value) for name, value in measures.items()})
    return banded.groupBy(*key_columns(key), *BANDS).agg(
        F.count_if(applied).alias("readings"),
        *[part for name, value in measures.items() for part in _sums(value, name)],
        F.min(when_applied(F.col("temperature_c"))).alias("min_temperature_c"),
        F.max(when_applied(F.col("temperature_c"))).alias("max_temperature_c"),
        F.max(when_applied(vibration)).alias("max_vibration_mm_s"),
        F.max(when_applied(F.col("sequence"))).alias("last_sequence"),
        F.max(when_applied(F.struct(*order_by, "ts", "temperature_c"))).alias("last"),
        F.max(F.when(applied & has_rack, F.struct(*order_by, "rack_id"))).alias("last_rack"),
        F.count_if(F.col("status") == GAP).alias("gaps"),
        F.count_if(F.col("status") == OUT_OF_ORDER).alias("out_of_order"),
        F.coalesce(F.sum("missing"), F.lit(0.0)).alias("missing"),
        F.count_if(~applied).alias("duplicates"),
        F.count_if(applied & F.col("is_anomaly")).alias("anomalies"),
    )


def merge_states(states: DataFrame, key: str | Sequence[str] = "sensor_id") -> DataFrame:
    """One state per sensor (and bands) from any number of partial ones."""
    return states.groupBy(*key_columns(key), *BANDS).agg(*_merged(states, [*key_columns(key), *BANDS]))


def one_state_each(states: DataFrame, key: str | Sequence[str] = "sensor_id") -> DataFrame:
    """One row per sensor, the sums of its bands as arrays `temperature_far` and `humidity_far`."""
    # A sensor has at most some sixty bands of each measure, whatever it measured.
    far = []
    for name in ("temperature", "humidity"):
        sums = F.collect_list(F.when(F.col(f"{name}_band").isNotNull(), F.struct(F.col(f"{name}_band").alias("band"), F.col(f"{name}_whole").alias("whole"))))
        far.append(_by_band(sums).alias(f"{name}_far"))
    keys = key_columns(key)
    return states.groupBy(*keys).agg(*_merged(states, [*keys, *BANDS, "temperature_whole", "humidity_whole"]), *far)


def _merged(states: DataFrame, keys: Sequence[str]) -> list[Column]:
    greatest = ("max_temperature_c", "max_vibration_mm_s", "last_sequence", "last", "last_rack")
    least = ("min_temperature_c",)
    return [
        (F.max(c) if c in greatest else F.min(c) if c in least else F.sum(c).cast(states.schema[c].dataType)).alias(c)
        for c in states.columns
        if c not in keys
    ]


def summarize(states: DataFrame, key: str | Sequence[str] = "sensor_id") -> DataFrame:
    """The summary of every sensor with at least one reading, from its state, which may come in parts."""
    readings = F.col("readings")
    return one_state_each(states, key).where(readings > 0).select(
        *key_columns(key),
        F.col("last_rack.rack_id").alias("rack_id"),
        "readings",
        round_half_up(_sum("temperature") / readings, 2).alias("avg_temperature_c"),
        round_half_up(F.col("min_temperature_c"), 2).alias("min_temperature_c"),
        round_half_up(F.col("max_temperature_c"), 2).alias("max_temperature_c"),
        round_half_up(_sum("humidity") / readings, 2).alias("avg_humidity_pct"),
        round_half_up(F.greatest(F.lit(0.0), "max_vibration_mm_s"), 3).alias("max_vibration_mm_s"),
        F.greatest(F.lit(0.0), "last_sequence").alias("last_sequence"),
        F.col("last.ts").alias("last_event_ts"),
        F.col("last.temperature_c").alias("last_temperature_c"),
        (F.col("gaps") + F.col("out_of_order")).alias("sequence_gaps"),
        "duplicates",
        "anomalies",
    )


def state_totals(states: DataFrame, key: str | Sequence[str] = "sensor_id") -> DataFrame:
    """Totals over all sensors, one row, from their states, which may come in parts. Gaps here do not include late arrivals."""

    def total(column: str) -> Column:
        return F.coalesce(F.sum(column), F.lit(0))

    return states.agg(
        F.count_distinct(F.when(F.col("readings") > 0, F.struct(*key_columns(key)))).alias("sensors"),
        total("readings").alias("readings"),
        total("duplicates").alias("duplicates"),
        total("out_of_order").alias("out_of_order"),
        total("gaps").alias("sequence_gaps"),
        total("missing").cast("double").alias("missing_readings"),
        total("anomalies").alias("anomalies"),
    )


def sensor_summary(labelled: DataFrame, order_by: Sequence[str] = LOG_ORDER, key: str | Sequence[str] = "sensor_id") -> DataFrame:
    """One row per sensor with at least one reading."""
    return summarize(sensor_state(labelled, order_by, key), key)


def log_totals(labelled: DataFrame, order_by: Sequence[str] = LOG_ORDER, key: str | Sequence[str] = "sensor_id") -> DataFrame:
    """One row of totals over all sensors."""
    return state_totals(sensor_state(labelled, order_by, key), key)


def run_stats(audit: DataFrame) -> DataFrame:
    """Counters of a whole run from its audit table; `batches` counts distinct `batch_id`s (one for a batch job)."""
    batches = F.count_distinct("batch_id") if "batch_id" in audit.columns else F.lit(1).cast("long")
    return audit.agg(*run_counters(), batches.alias("batches"))


def run_counters() -> list[Column]:
    """The counters of a run as aggregates, for an audit table or for metrics taken while one is written."""
    return [
        F.count(F.lit(1)).alias("consumed"),
        F.count_if(_processed()).alias("processed"),
        F.count_if(F.col("status") == DUPLICATE).alias("duplicates"),
        F.count_if(F.col("status") == OUT_OF_ORDER).alias("out_of_order"),
        F.count_if(F.col("status") == GAP).alias("gaps"),
        F.count_if(~_processed()).alias("dead_lettered"),
        F.count_if(_anomalous()).alias("anomalies_published"),
    ]


def added_counters(counters: DataFrame) -> DataFrame:
    """The counters of a run from those of its batches, a row for each `batch_id`."""
    names = [c for c in counters.columns if c != "batch_id"]
    return counters.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in names], F.count(F.lit(1)).alias("batches"))


def batch_outcomes(audit: DataFrame, batch: str = "batch_id") -> DataFrame:
    """What became of the records of each batch."""
    return outcomes(audit.groupBy(batch).agg(*run_counters()), batch)


def outcomes(counters: DataFrame, batch: str = "batch_id") -> DataFrame:
    """What became of the records of each batch, from its counters."""
    return counters.select(batch, "processed", "dead_lettered", F.col("anomalies_published").alias("anomalies"), "duplicates")


def offset_ranges(log: DataFrame) -> DataFrame:
    """Records and first and last offset per partition of a log or batch."""
    return log.groupBy("topic", "partition").agg(
        F.count(F.lit(1)).alias("records"),
        F.min("offset").alias("first_offset"),
        F.max("offset").alias("last_offset"),
    )


def sorted_by_sensor(df: DataFrame, key: str = "sensor_id") -> DataFrame:
    """Rows in the order people read ids in: a, A, b, B."""
    return df.orderBy(F.collate(F.col(key), "UNICODE"))


def format_summary(summary: DataFrame, totals: DataFrame) -> DataFrame:
    """The summary as text: `(part, sensor_id, line)` with a header (0), a line per sensor (1) and the totals (2)."""
    cells = [
        pad_right(F.col("sensor_id"), 11),
        _cell("readings", 8),
        _cell("avg_temperature_c", 7),
        _cell("min_temperature_c", 8),
        _cell("max_temperature_c", 8),
        _cell("max_vibration_mm_s", 7),
        _cell("sequence_gaps", 5),
        _cell("anomalies", 10),
    ]
    # Fixed value: the column heads, spaced like the cells below them.
    head = "sensor      readings  avgT(C)  minT(C)  maxT(C)  maxVib  gaps  anomalies"
    lines = summary.select(F.lit(1).alias("part"), "sensor_id", F.concat_ws(" ", *cells).alias("line"))
    # Fixed value: the words of the last line.
    closing = F.concat(
        F.lit("total: "), _number("readings"), F.lit(" readings, "), _number("anomalies"), F.lit(" anomalies, "),
        _number("duplicates"), F.lit(" duplicates, "), _number("out_of_order"), F.lit(" out-of-order, "),
        _number("missing_readings"), F.lit(" missing"),
    )
    nobody = F.lit(None).cast("string").alias("sensor_id")
    ends = totals.select(
        F.inline(
            F.array(
                F.struct(F.lit(0).alias("part"), nobody, F.lit(head).alias("line")),
                F.struct(F.lit(2).alias("part"), nobody, closing.alias("line")),
            )
        )
    )
    return ends.unionByName(lines)


def report_lines(report: DataFrame) -> DataFrame:
    """The lines of a report in reading order."""
    return report.orderBy("part", F.collate(F.coalesce("sensor_id", F.lit("")), "UNICODE")).select("line")


def summary_sections(
    labelled: DataFrame,
    stats: DataFrame | None = None,
    order_by: Sequence[str] = LOG_ORDER,
    limits: Thresholds = DEFAULT_THRESHOLDS,
    states: DataFrame | None = None,
) -> DataFrame:
    """The summary document cut into rows `(section, sensor_id, arrival, body)`, whole at any size.

    Sections are totals, thresholds, consumer (when `stats` is given), one `sensors` row per sensor and one
    `anomalies` row per anomaly. `body` is the JSON of that part. `labelled` is read twice: pass a stored table. `states` are the sensors' states when
    they are known already.
    """
    # One row per sensor, read by two sections: written once rather than worked out twice.
    states = stage(sensor_state(labelled, order_by) if states is None else states, "states")
    nobody = F.lit(None).cast("string").alias("sensor_id")
    nowhen = F.lit(None).cast("array<bigint>").alias("arrival")

    def body(content: Column) -> Column:
        return F.to_json(content, WITH_NULLS).alias("body")

    def section(name: str, content: Column) -> Column:
        return F.struct(F.lit(name).alias("section"), nobody, nowhen, body(content))

    single = [section("totals", totals_struct()), section("thresholds", thresholds_struct(limits))]
    document = state_totals(states).select(F.inline(F.array(*single)))
    if stats is not None:
        document = document.unionByName(stats.select(F.inline(F.array(section("consumer", stats_struct())))))
    sensors = summarize(states).select(F.lit("sensors").alias("section"), "sensor_id", nowhen, body(sensor_struct()))
    places = [as_long(labelled, c) for c in order_by]
    if any(p is None for p in places):
        raise ValueError("anomalies are listed by whole numbers or times; order_by has other columns")
    arrival = F.array(*places).alias("arrival")
    anomalies = _with_arrival(labelled, order_by).select(
        F.lit("anomalies").alias("section"), "sensor_id", arrival, body(anomaly_struct())
    )
    return document.unionByName(sensors).unionByName(anomalies)


def document_order(sections: DataFrame) -> DataFrame:
    """The rows of a summary with the columns `part`, `sensor` and `arrival`, by which the document is sorted: its
    sections one after the other, sensors in the order people read ids in, anomalies by arrival."""
    names = F.array(*map(F.lit, ("totals", "thresholds", "consumer", "sensors", "anomalies")))
    sensor = F.when(F.col("section") == "sensors", F.col("sensor_id"))
    return sections.withColumns({"part": F.array_position(names, F.col("section")), "sensor": F.collate(F.coalesce(sensor, F.lit("")), "UNICODE")})


def summary_positions(sections: DataFrame) -> DataFrame:
    """The rows of a summary with their place in the document, counted from 1."""
    return with_positions(document_order(sections), ("part", "sensor", "arrival")).drop("part", "sensor")


def _with_arrival(labelled: DataFrame, order_by: Sequence[str]) -> DataFrame:
    """Anomalies of a labelled log together with their arrival."""
    extra = [c for c in order_by if c not in ANOMALY_COLUMNS]
    found = labelled.where((F.col("status") != DUPLICATE) & F.col("is_anomaly"))
    return found.select(*ANOMALY_COLUMNS, F.col("anomaly").alias("reason"), *extra)


def totals_struct() -> Column:
    return F.struct(
        "sensors",
        "readings",
        "duplicates",
        F.col("out_of_order").alias("outOfOrder"),
        F.col("sequence_gaps").alias("sequenceGaps"),
        json_number(F.col("missing_readings")).alias("missingReadings"),
        "anomalies",
    )


def thresholds_struct(limits: Thresholds) -> Column:
    return F.struct(
        json_number(F.lit(float(limits.high_c))).alias("anomalyHighC"),
        json_number(F.lit(float(limits.low_c))).alias("anomalyLowC"),
        json_number(F.lit(float(limits.vibration_mm_s))).alias("vibrationThresholdMmS"),
    )


def sensor_struct() -> Column:
    return F.struct(
        F.col("sensor_id").alias("sensorId"),
        F.col("rack_id").alias("rackId"),
        "readings",
        json_number(F.col("avg_temperature_c")).alias("avgTemperatureC"),
        json_number(F.col("min_temperature_c")).alias("minTemperatureC"),
        json_number(F.col("max_temperature_c")).alias("maxTemperatureC"),
        json_number(F.col("avg_humidity_pct")).alias("avgHumidityPct"),
        json_number(F.col("max_vibration_mm_s")).alias("maxVibrationMmS"),
        json_number(F.col("last_sequence")).alias("lastSequence"),
        F.col("last_event_ts").alias("lastEventTs"),
        F.col("sequence_gaps").alias("sequenceGaps"),
        "duplicates",
        "anomalies",
    )


def anomaly_struct() -> Column:
    return F.struct(
        F.col("event_id").alias("eventId"),
        F.col("sensor_id").alias("sensorId"),
        F.col("rack_id").alias("rackId"),
        "ts",
        json_number(F.col("sequence")).alias("sequence"),
        json_number(F.col("temperature_c")).alias("temperatureC"),
        json_number(F.col("vibration_mm_s")).alias("vibrationMmS"),
        "reason",
    )


def stats_struct() -> Column:
    return F.struct(
        "consumed",
        "processed",
        "duplicates",
        F.col("out_of_order").alias("outOfOrder"),
        "gaps",
        F.col("dead_lettered").alias("deadLettered"),
        F.col("anomalies_published").alias("anomaliesPublished"),
        "batches",
    )


def _sums(value: Column, name: str) -> list[Column]:
    """Sums that do not depend on the order of their terms: of ordinary values, of a band's, and of infinite ones."""
    return [
        F.sum(ordinary(value)).alias(f"{name}_sum"),
        F.sum(whole(value, F.col(f"{name}_band"))).alias(f"{name}_whole"),
        F.sum(F.when(~(F.abs(value) < float("inf")), value)).alias(f"{name}_infinite"),
    ]


def _by_band(sums: Column) -> Column:
    """The sum of each band from an array of (band, whole)."""

    def total(number: Column) -> Column:
        own = F.filter(sums, lambda s: s["band"] == number)
        return F.aggregate(own, F.lit(0).cast("decimal(38,0)"), lambda a, s: (a + s["whole"]).cast("decimal(38,0)"))

    numbers = F.array_distinct(F.transform(sums, lambda s: s["band"]))
    return F.transform(numbers, lambda n: F.struct(n.alias("band"), total(n).alias("whole")))


def _sum(name: str) -> Column:
    return combined(F.col(f"{name}_sum"), F.col(f"{name}_far")) + F.coalesce(f"{name}_infinite", F.lit(0.0))


def _processed() -> Column:
    return F.col("status").isin(ACCEPTED, DUPLICATE, GAP, OUT_OF_ORDER)


def _anomalous() -> Column:
    return F.col("status").isin(ACCEPTED, GAP, OUT_OF_ORDER) & F.col("is_anomaly")


def _number(column: str) -> Column:
    return F.coalesce(number_text(F.col(column).cast("double")), F.lit("null"))


def _cell(column: str, width: int) -> Column:
    return pad_left(_number(column), width)
