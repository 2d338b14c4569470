from datetime import datetime, timedelta, timezone

import pytest
from conftest import SMALLEST, raw_log, reading
from pyspark.sql import functions as F

from tallywire.operators.summary import log_totals, run_stats, sensor_summary
from tallywire.plans.process import label_log, process_log
from tallywire.schema import ENVELOPE
from checks.event_log import ARRIVAL, raw_records, record_log
from tallywire.sources.log import kafka_options, log_from_table, read_log_files
from tallywire.sources.offsets import LogIndex
from tallywire.session import CHECKPOINT_DIR, work_dir


TOTALS = {
    "sensors": 15, "readings": 965, "duplicates": 27, "out_of_order": 30, "sequence_gaps": 59, "missing_readings": 63.0,
    "anomalies": 317,
}


def test_record_log_totals(events):
    assert log_totals(label_log(record_log(events), ARRIVAL), ARRIVAL).first().asDict() == TOTALS


def test_record_log_in_short_slices(events):
    """The same answers when every sensor is cut into short slices of arrival."""
    sliced = label_log(record_log(events), ARRIVAL, slice_rows=20)
    assert log_totals(sliced, ARRIVAL).first().asDict() == TOTALS


def test_raw_log_counts(events):
    audit = process_log(raw_records(events))
    reasons = {r[0]: r[1] for r in audit.groupBy(F.coalesce(F.array_join("errors", ";"), F.lit(""))).count().collect()}
    assert reasons.pop("") == 1028
    assert reasons == {
        "payload is not valid JSON": 25,
        "event must be a JSON object": 22,
        "sequence must be a number, received string;temperatureC is required": 24,
    }
    stats = run_stats(audit).first()
    assert (stats.consumed, stats.processed, stats.dead_lettered) == (1099, 1028, 71)
    labelled = audit.where("reason IS NULL")
    totals = log_totals(labelled).first()
    # The raw log loses nothing, unlike the typed one above.
    assert totals == log_totals(label_log(record_log(events, lossless=True), ARRIVAL), ARRIVAL).first()
    assert (totals.readings, totals.duplicates) == (1000, 28)
    # What must hold for any log.
    assert stats.consumed == stats.processed + stats.dead_lettered
    assert stats.processed == totals.readings + totals.duplicates
    sensors = sensor_summary(labelled).agg(F.sum("readings"), F.sum("sequence_gaps"), F.sum("anomalies"), F.sum("duplicates")).first()
    assert sensors[0] == totals.readings and sensors[2] == totals.anomalies
    assert sensors[1] == totals.sequence_gaps + totals.out_of_order and sensors[3] <= totals.duplicates


def test_replaying_a_prefix_changes_no_aggregate(events):
    log = record_log(events)
    again = log.where("arrival < 3000").withColumn("arrival", F.col("arrival") + 1_000_000)
    once = sensor_summary(label_log(log, ARRIVAL), ARRIVAL).drop("duplicates")
    twice = sensor_summary(label_log(log.unionByName(again), ARRIVAL), ARRIVAL).drop("duplicates")
    assert sorted(once.collect()) == sorted(twice.collect())


def test_log_from_table(spark, tmp_path):
    log = log_from_table(raw_log(spark, [reading()]).drop("topic").withColumn("extra", F.lit(1)), topic="made")
    assert log.columns == [*ENVELOPE.fieldNames(), "extra"]
    assert log.first().topic == "made" and log.first().headers is None
    with pytest.raises(ValueError, match="offset, partition"):
        log_from_table(spark.range(1).withColumn("value", F.lit(b"")))
    log.drop("extra").write.parquet(str(tmp_path / "log"))
    assert read_log_files(spark, str(tmp_path / "log"), stream=False).count() == 1
    assert read_log_files(spark, str(tmp_path / "log"), max_files_per_trigger=1).isStreaming


def test_a_bounded_scan_opens_only_the_files_that_hold_it(spark, tmp_path):
    path, start = str(tmp_path / "log"), datetime(2026, 9, 30, tzinfo=timezone.utc)

    def arrive(offsets, partition, files):
        rows = [("t", partition, n, bytearray(str(n).encode()), start + timedelta(minutes=n)) for n in offsets]
        df = spark.createDataFrame(rows, "topic string, partition int, offset bigint, value binary, timestamp timestamp")
        log_from_table(df).repartitionByRange(files, "offset").write.mode("append").parquet(path)

    def read(**bounds):
        found = index.read(**bounds)
        return sorted((r.partition, r.offset) for r in found.collect()), len(found.inputFiles())

    arrive(range(1000), 0, 10)
    arrive(range(1000), 1, 10)
    index = LogIndex(spark, path, str(tmp_path / "index"))
    assert read() == ([], 0)
    index.refresh()
    index.refresh()
    assert index.entries().count() == 20
    rows, files = read(first=150, last=180, partitions=[1])
    assert rows == [(1, n) for n in range(150, 181)] and files <= 2
    rows, files = read(first=990)
    assert rows == [(p, n) for p in (0, 1) for n in range(990, 1000)] and files == 2
    rows, files = read(since=start + timedelta(minutes=500), until=start + timedelta(minutes=500))
    assert rows == [(0, 500), (1, 500)] and files <= 4
    assert read(first=5000) == ([], 0) and read(topics=["other"]) == ([], 0)
    # Files that come later are looked at by the next call, and those alone.
    arrive(range(1000, 1010), 0, 1)
    assert read(first=1000) == ([], 0)
    index.refresh()
    assert read(first=1000) == ([(0, n) for n in range(1000, 1010)], 1)
    assert index.entries().count() == 21 and read(last=2)[0] == [(p, n) for p in (0, 1) for n in range(3)]


def test_kafka_options():
    assert kafka_options("h:1", "t", {"startingOffsets": "latest", "minPartitions": "9"}) == {
        "kafka.bootstrap.servers": "h:1", "subscribe": "t", "startingOffsets": "latest", "includeHeaders": "true",
        "minPartitions": "9",
    }


def test_work_dir_is_the_shared_one(spark):
    first, second = work_dir(spark, "x"), work_dir(spark, "x")
    assert first != second and first.startswith(spark.conf.get(CHECKPOINT_DIR))


def test_tables_exist():
    from pathlib import Path

    assert (Path(SMALLEST) / "events.parquet").exists()
