"""Anomalies, summaries, reports and records."""

import json
import math
import random
from fractions import Fraction

import pytest
from conftest import raw_log, reading, typed_log
from pyspark.sql import functions as F

from tallywire.functions.sums import band, combined, ordinary, whole
from tallywire.operators.anomaly import Thresholds, detect_anomalies, flag_anomalies
from tallywire.operators.continuity import classify_continuity
from tallywire.operators.dedup import mark_duplicates
from tallywire.operators.positions import with_positions
from tallywire.operators.records import (
    anomaly_records,
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
    merge_states,
    offset_ranges,
    report_lines,
    run_stats,
    sensor_state,
    sensor_summary,
    sorted_by_sensor,
    summarize,
    summary_positions,
    summary_sections,
)
from tallywire.plans.process import label_log, process_log
from tallywire.plans.sinks import write_audit, write_records, write_report, write_summary
from tallywire.session import stage_by_key


def headers(row):
    return {h.key: bytes(h.value).decode() for h in row.headers}


def test_aggregates_of_one_sensor(spark):
    log = typed_log(
        spark,
        [
            reading(sequence=11, temperatureC=-3.25, humidityPct=71.5, vibrationMmS=2.0625),
            reading(sequence=12, temperatureC=8.5, humidityPct=..., vibrationMmS=..., rackId="rack-Q"),
            reading(sequence=13, temperatureC=1.125, humidityPct=12, vibrationMmS=4.1875, rackId=""),
            reading(sequence=14, temperatureC=0.625, humidityPct=33.25, vibrationMmS=0),
        ],
    )
    # By the rules: 7 / 4 and 116.75 / 4, halves upwards; the vibration with three places; the last rack that is named.
    row = sensor_summary(label_log(log)).first().asDict()
    assert row == {
        "sensor_id": "sensor-01", "rack_id": "rack-A", "readings": 4, "avg_temperature_c": 1.75,
        "min_temperature_c": -3.25, "max_temperature_c": 8.5, "avg_humidity_pct": 29.19, "max_vibration_mm_s": 4.188,
        "last_sequence": 14.0, "last_event_ts": "2026-09-30T10:00:14.000Z", "last_temperature_c": 0.625,
        "sequence_gaps": 0, "duplicates": 0, "anomalies": 0,
    }


def test_missing_values_count_as_zero(spark):
    log = typed_log(spark, [reading(sequence=1, humidityPct=..., vibrationMmS=..., rackId="r1"), reading(sequence=2, rackId="")])
    row = sensor_summary(label_log(log)).first()
    assert (row.avg_humidity_pct, row.max_vibration_mm_s, row.rack_id) == (25.0, 0.1, "r1")


def test_sensors_stay_apart_and_sort(spark):
    names = {"pump-7": 4.5, "Valve": -1, "pump-12": 61, "valve": 17.25, "élan": 3, "zeta": 2, "_9": 0}
    log = typed_log(spark, [reading(s, temperatureC=t) for s, t in names.items()])
    rows = sorted_by_sensor(sensor_summary(label_log(log))).collect()
    assert [r.sensor_id for r in rows] == ["_9", "élan", "pump-12", "pump-7", "valve", "Valve", "zeta"]
    assert {r.sensor_id: r.avg_temperature_c for r in rows} == names


def test_replayed_event_changes_nothing(spark):
    labelled = label_log(typed_log(spark, [reading()] * 3))
    assert [r.status for r in labelled.orderBy("offset").collect()] == ["accepted", "duplicate", "duplicate"]
    row, totals = sensor_summary(labelled).first(), log_totals(labelled).first()
    assert (row.readings, row.duplicates, totals.readings, totals.duplicates) == (1, 2, 1, 2)


def test_duplicate_of_a_sensor_without_readings(spark):
    labelled = label_log(typed_log(spark, [reading("s1", eventId="e"), reading("s2", eventId="e")]))
    assert [(r.sensor_id, r.duplicates) for r in sensor_summary(labelled).collect()] == [("s1", 0)]
    totals = log_totals(labelled).first()
    assert (totals.sensors, totals.duplicates) == (1, 1)


def test_anomalies(spark):
    log = typed_log(
        spark,
        [
            reading(sequence=1, temperatureC=-10, vibrationMmS=5.0),
            reading(sequence=2, temperatureC=-10.5, vibrationMmS=5.25),
            reading(sequence=3, temperatureC=200, rackId=..., vibrationMmS=...),
            reading(sequence=4, temperatureC=78.125, vibrationMmS=5),
            reading(sequence=5, temperatureC=80, vibrationMmS=12),
        ],
    )
    found = {r.sequence: r for r in detect_anomalies(log).collect()}
    assert {s: r.reason for s, r in found.items()} == {
        2.0: "temperatureC -10.5 < -10; vibrationMmS 5.25 > 5",
        3.0: "temperatureC 200 > 80",
        5.0: "vibrationMmS 12 > 5",
    }
    assert (found[3.0].rack_id, found[3.0].vibration_mm_s) == (None, None)
    stricter = detect_anomalies(log, Thresholds(high_c=70.5, low_c=-40, vibration_mm_s=100))
    assert sorted(r.reason for r in stricter.collect()) == [
        "temperatureC 200 > 70.5", "temperatureC 78.125 > 70.5", "temperatureC 80 > 70.5",
    ]


def test_anomaly_record(spark):
    log = typed_log(spark, [reading(eventId="cold-8", temperatureC=-41.5, vibrationMmS=5.75)])
    (record,) = anomaly_records(detect_anomalies(label_log(log))).collect()
    assert (record.key, headers(record)) == ("sensor-01", {"event-type": "sensor.anomaly"})
    assert record.value == (
        '{"type":"anomaly","eventId":"cold-8","sensorId":"sensor-01","rackId":"rack-A",'
        '"ts":"2026-09-30T10:00:01.000Z","sequence":1,"temperatureC":-41.5,"vibrationMmS":5.75,'
        '"reason":"temperatureC -41.5 < -10; vibrationMmS 5.75 > 5","runId":"cold-8"}'
    )


def test_gap_and_late_totals(spark):
    # 30 comes after nothing; 37 skips six, 38 none, 45 six again; 31 and 44 come late, another 45 is no step at all.
    steps = [30, 37, 31, 38, 45, 44, 45]
    labelled = label_log(typed_log(spark, [reading(sequence=n, eventId=f"e{k}") for k, n in enumerate(steps)]))
    totals, row = log_totals(labelled).first(), sensor_summary(labelled).first()
    assert (totals.sequence_gaps, totals.missing_readings, totals.out_of_order) == (2, 12.0, 2)
    assert (row.sequence_gaps, row.last_sequence, row.readings) == (4, 45.0, 7)


def test_report(spark, tmp_path):
    labelled = label_log(typed_log(spark, [reading(temperatureC=20.5)]))
    report = format_summary(sensor_summary(labelled), log_totals(labelled))
    lines = [r.line for r in report_lines(report).collect()]
    assert lines == [
        "sensor      readings  avgT(C)  minT(C)  maxT(C)  maxVib  gaps  anomalies",
        "sensor-01          1    20.5     20.5     20.5     0.1     0          0",
        "total: 1 readings, 0 anomalies, 0 duplicates, 0 out-of-order, 0 missing",
    ]
    write_report(report, str(tmp_path / "report"))
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "report")).collect()) == sorted(lines)


def test_states_merge(spark):
    readings = [reading(f"s{i % 3}", i, eventId=f"e{i % 17}", temperatureC=i * 7.77, rackId=f"r{i % 5}") for i in range(1, 21)]
    labelled = label_log(typed_log(spark, readings))
    order = ("partition", "offset")
    parts = sensor_state(labelled.where("offset < 7"), order).unionByName(sensor_state(labelled.where("offset >= 7"), order))
    merged = summarize(merge_states(parts))
    assert sorted(merged.collect()) == sorted(sensor_summary(labelled).collect())
    assert merge_states(parts).schema.simpleString() == parts.schema.simpleString()


def test_averages_do_not_depend_on_the_partitioning(spark):
    """Values from 1e-300 to 1e300 that mostly cancel out, in any order and number of partitions, merged or not."""
    draw = random.Random(12)
    values = []
    for _ in range(150):
        x = draw.choice([-1, 1]) * draw.random() * 10.0 ** draw.randrange(13, 300)
        values += [x, -x]
    small = [draw.uniform(-500, 500) for _ in range(60)] + [1e-300, -1e-300, 1e12, -1e12, 2.5e11]
    values += small
    exact = sum(Fraction(round(x * 10**9), 10**9) if abs(x) < 1e12 else Fraction(x) for x in values)
    wanted = math.floor(float(exact) / len(values) * 100 + 0.5) / 100
    order = ("partition", "offset")
    seen = set()
    for turn in (1, 3, 8):
        draw.shuffle(values)
        log = typed_log(spark, [reading(sequence=k + 1, eventId=f"e{k}", temperatureC=x, humidityPct=-x) for k, x in enumerate(values)])
        labelled = label_log(log).repartition(turn)
        whole = sensor_summary(labelled).first()
        parts = sensor_state(labelled.where("offset % 3 = 0"), order).unionByName(sensor_state(labelled.where("offset % 3 > 0"), order))
        merged = summarize(merge_states(parts)).first()
        assert whole == merged
        seen.add((whole.avg_temperature_c, whole.avg_humidity_pct))
    assert len(seen) == 1 and seen.pop()[0] == wanted


def test_sums_of_one_size(spark):
    """A great value that stays is rounded once, infinite ones win, and a band holds more than its digits at once."""
    rows = [("a", 1e300), ("a", 3.0), ("b", 5e-324), ("b", 2.0**960), ("b", -(2.0**960)), ("b", 4.0), ("c", float("inf")), ("c", 1.0), ("d", 1e25), ("d", 1e25 + 2**33)]
    df = spark.createDataFrame(rows, "k string, x double").withColumn("band", band(F.col("x")))
    parts = df.groupBy("k", "band").agg(F.sum(ordinary(F.col("x"))).alias("near"), F.sum(whole(F.col("x"), F.col("band"))).alias("whole"))
    far = F.collect_list(F.when(F.col("band").isNotNull(), F.struct("band", "whole")))
    sums = parts.groupBy("k").agg(combined(F.sum("near"), far).alias("sum"))
    assert {r.k: r.sum for r in sums.collect()} == {"a": 1e300, "b": 4.0, "c": 1.0, "d": 2e25 + 2**33}


def test_states_by_sensor_and_run(spark):
    readings = [reading("s1", n, eventId=f"{run}-{n}", temperatureC=t) for run, n, t in (("x", 1, 4), ("x", 2, 6), ("y", 1, 9), ("y", 5, 11))]
    log = typed_log(spark, readings).withColumn("run", F.substring_index("event_id", "-", 1))
    key = ("sensor_id", "run")
    labelled = label_log(log, key=key)
    rows = {r.run: (r.readings, r.avg_temperature_c, r.last_sequence, r.sequence_gaps) for r in sensor_summary(labelled, key=key).collect()}
    assert rows == {"x": (2, 5.0, 2.0, 0), "y": (2, 10.0, 5.0, 1)}
    totals = log_totals(labelled, key=key).first()
    assert (totals.sensors, totals.readings, totals.missing_readings) == (2, 4, 3.0)


def test_positions(spark):
    """Places in an order with repeated values, over many ranges, and of nothing."""
    draw = random.Random(6)
    rows = [(draw.choice("abc"), draw.randrange(40), k) for k in range(3000)]
    df = spark.createDataFrame(rows, "name string, number int, k int").repartition(5)
    placed = with_positions(df, ("name", "number", "k"), "at")
    assert {r.k: r.at for r in placed.collect()} == {k: at for at, (_, _, k) in enumerate(sorted(rows), 1)}
    assert with_positions(df.where("false"), ("name",)).count() == 0
    plan = placed._jdf.queryExecution().optimizedPlan().toString()
    assert "Sort [name" not in plan


def test_positions_of_a_summary(spark):
    audit = process_log(raw_log(spark, [reading("b"), reading("A", temperatureC=99), reading("a"), reading("b", 5, temperatureC=-11.5)]))
    found = summary_positions(summary_sections(audit.where("reason IS NULL"), run_stats(audit))).orderBy("position").collect()
    assert [(r.position, r.section, r.sensor_id) for r in found] == [
        (1, "totals", None), (2, "thresholds", None), (3, "consumer", None), (4, "sensors", "a"), (5, "sensors", "A"), (6, "sensors", "b"),
        (7, "anomalies", "A"), (8, "anomalies", "b"),
    ]


def test_tables_by_key_are_not_moved_again(spark):
    readings = [reading(f"s{k % 5}", k // 5 + 1, eventId=f"e{k}", temperatureC=k) for k in range(60)]
    marked = mark_duplicates(typed_log(spark, readings))
    stored = stage_by_key(marked, "by-sensor", ("sensor_id",), ("partition", "offset"))
    none = large_keys(stored, "sensor_id")
    summary = sensor_summary(flag_anomalies(classify_continuity(stored, stored=True, hot=none)))
    rows = sorted(summary.collect())
    assert "Exchange" not in summary._jdf.queryExecution().executedPlan().toString()
    assert rows == sorted(sensor_summary(label_log(typed_log(spark, readings))).collect())


def test_empty_log(spark):
    labelled = label_log(typed_log(spark, [reading()]).where("false"))
    assert sensor_summary(labelled).count() == 0
    assert set(log_totals(labelled).first()) == {0}
    audit = process_log(raw_log(spark, [reading()]).where("false"))
    assert list(run_stats(audit).first()) == [0, 0, 0, 0, 0, 0, 0, 1]
    assert batch_outcomes(audit.withColumn("batch_id", F.lit(0))).count() == 0


def test_stats_and_outcomes(spark):
    hot = reading(sequence=2, temperatureC=120)
    raw = raw_log(spark, [reading(), reading(), "", hot, hot, reading(sequence=9), {"eventId": "x"}, reading(eventId="late")])
    audit = process_log(raw).withColumn("batch_id", F.floor(F.col("offset") / 4))
    assert run_stats(audit).first().asDict() == {
        "consumed": 8, "processed": 6, "duplicates": 2, "out_of_order": 1, "gaps": 1, "dead_lettered": 2,
        "anomalies_published": 1, "batches": 2,
    }
    rows = {r.batch_id: tuple(r)[1:] for r in batch_outcomes(audit).collect()}
    assert rows == {0: (3, 1, 1, 1), 1: (3, 1, 0, 1)}
    assert [tuple(r) for r in offset_ranges(raw).collect()] == [("t", 0, 8, 0, 7)]


def test_audit_file(spark, tmp_path):
    raw = raw_log(spark, [reading(site={"hall": 3}), "{", reading(sequence=5)])
    for keep in (True, False):
        path = str(tmp_path / f"audit{keep}")
        write_audit(process_log(raw, keep_payload=keep), path)
        lines = sorted((json.loads(r.value) for r in spark.read.text(path).collect()), key=lambda r: r.get("offset", "1"))
        good, bad, gap = lines
        assert list(good) == ["type", "topic", "partition", "offset", "status", "event"]
        assert (good["type"], good["partition"], good["offset"], good["status"]) == ("reading", 0, "0", "accepted")
        assert good["event"] == reading(site={"hall": 3}) if keep else good["event"] == reading()
        assert gap["status"] == "gap"
        assert list(bad) == ["type", "reason", "errors", "deadLetteredAt", "source", "raw"]
        assert bad["source"] == {"topic": "t", "partition": 0, "offset": "1"} and bad["raw"] == "{"


def test_summary_sections(spark, tmp_path):
    readings = [reading("b"), reading("a", temperatureC=99), reading("b", 5, temperatureC=-11.5, rackId=...)]
    audit = process_log(raw_log(spark, readings))
    labelled, stats = audit.where("reason IS NULL"), run_stats(audit)
    write_summary(summary_sections(labelled, stats), str(tmp_path / "sections"))
    parts = {}
    for row in spark.read.text(str(tmp_path / "sections")).collect():
        part = json.loads(row.value)
        parts.setdefault(part["section"], []).append(part["body"])
    # Sensors by their ids, anomalies by arrival.
    assert [p["sensorId"] for p in parts["sensors"]] == ["a", "b"]
    assert [p["eventId"] for p in parts["anomalies"]] == ["a-1", "b-5"]
    assert parts["thresholds"] == [{"anomalyHighC": 80, "anomalyLowC": -10, "vibrationThresholdMmS": 5}]
    assert parts["totals"][0]["missingReadings"] == 3 and parts["consumer"][0]["consumed"] == 3
    assert parts["anomalies"][1] == {
        "eventId": "b-5", "sensorId": "b", "rackId": None, "ts": "2026-09-30T10:00:05.000Z", "sequence": 5,
        "temperatureC": -11.5, "vibrationMmS": 0.1, "reason": "temperatureC -11.5 < -10",
    }


def test_ids(spark):
    df = spark.createDataFrame([(0, 12), (8, 1234567), (99, 1)], "i int, n bigint")
    rows = df.select(
        sensor_id(F.col("i")), rack_id(F.col("i")), event_id(F.lit("run1"), sensor_id(F.col("i")), F.col("n"))
    ).collect()
    assert [tuple(r) for r in rows] == [
        ("sensor-01", "rack-A", "run1-sensor-01-000012"),
        ("sensor-09", "rack-I", "run1-sensor-09-1234567"),
        ("sensor-100", "rack-¤", "run1-sensor-100-000001"),
    ]


def test_make_readings(spark):
    df = spark.sql(
        "SELECT 'run1' run_id, 'sensor-07' sensor_id, 'rack-B' rack_id, 12 sequence, "
        "timestamp_millis(1790762400000) time, 21.4567D temperature_c, 45.4321D humidity_pct, 0.12345D vibration_mm_s"
    )
    assert make_readings(df).first().asDict() == {
        "schema_version": 1.0, "event_id": "run1-sensor-07-000012", "sensor_id": "sensor-07", "rack_id": "rack-B",
        "sequence": 12.0, "ts": "2026-09-30T10:00:00.000Z", "temperature_c": 21.46, "humidity_pct": 45.43,
        "vibration_mm_s": 0.123,
    }


def test_message_keys(spark):
    log = typed_log(spark, [reading("s1"), reading("s2")])
    assert [r.key for r in with_message_key(log, "sensor").orderBy("offset").collect()] == ["s1", "s2"]
    assert [r.key for r in with_message_key(log, "roundrobin").collect()] == [None, None]
    keys = [r.key for r in with_message_key(log, "random", 7).orderBy("offset").collect()]
    assert keys == [r.key for r in with_message_key(log, "random", 7).orderBy("offset").collect()]
    assert len(set(keys)) == 2 and all(len(k) == 12 and k.isalnum() for k in keys)
    with pytest.raises(ValueError, match="unknown key mode: other"):
        with_message_key(log, "other")


def test_published_readings(spark, tmp_path):
    original = [reading("sensor-01"), reading("sensor-02", 2, rackId=..., temperatureC=-1.25)]
    records = to_log_records(typed_log(spark, original), source="plant")
    rows = sorted(records.collect())
    assert [json.loads(r.value) for r in rows] == original
    assert headers(rows[0]) == {"event-type": "sensor.reading", "schema-version": "1", "source": "plant"}
    write_records(records, str(tmp_path / "records"))
    assert sorted(r.key for r in spark.read.parquet(str(tmp_path / "records")).collect()) == ["sensor-01", "sensor-02"]
