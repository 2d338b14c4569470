"""The stream gives the answers of the batch job, whatever is repeated, restarted or merged on the way."""

import random

import pytest
from conftest import raw_log, reading, typed_log
from pyspark.sql import functions as F
from test_order import random_log

from checks.event_log import raw_records
from tallywire.operators.continuity import classify_continuity
from tallywire.operators.dedup import mark_duplicates
from tallywire.operators.summary import batch_outcomes, log_totals, run_stats, sensor_summary
from tallywire.operators.validation import split_valid, validate
from tallywire.plans.process import process_log
from tallywire.sources.log import log_from_table, read_log_files
from tallywire.session import stage
from tallywire.streaming.drop import drop_duplicates_stream
from tallywire.streaming.microbatch import LogStream
from tallywire.streaming.revised import RevisedLog
from tallywire.streaming.state import HASHES, LogState, runs_before

LABELS = ("partition", "offset", "event_id", "status", "missing", "anomaly", "raw")


@pytest.fixture(scope="module")
def log(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("raw"))
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    log_from_table(raw_records(events)).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def batch(log):
    return process_log(log)


def slices(log, count):
    top = log.agg(F.max("offset")).first()[0] + 1
    return [log.where(F.floor(F.col("offset") * count / top) == i) for i in range(count)]


def labels(audit):
    return sorted(tuple(str(v) for v in r) for r in audit.select(*LABELS).collect())


def test_batches_equal_one_batch(spark, log, batch, tmp_path):
    """Batches are handed over directly; one is repeated, states are merged every second batch."""
    published = []
    stream = LogStream(
        spark, str(tmp_path), publish=lambda df, kind, batch: published.append((kind, batch, df.count())), factor=2
    )
    for batch_id, part in enumerate(slices(log, 5)):
        stream.process(part, batch_id)
        if batch_id in (1, 2):
            stream.process(part, batch_id)
    assert labels(stream.audit()) == labels(batch)
    good = batch.where("reason IS NULL")
    assert sorted(stream.summary().collect()) == sorted(sensor_summary(good).collect())
    assert stream.totals().first() == log_totals(good).first()
    stats = run_stats(stream.audit()).first()
    assert stats.asDict() == {**run_stats(batch).first().asDict(), "batches": 5}
    # The counters taken while the audit table was written are those of the table, whatever was repeated.
    assert stream.stats().first().asDict() == stats.asDict()
    assert sorted(stream.outcomes().collect()) == sorted(batch_outcomes(stream.audit()).collect())
    assert spark.read.parquet(f"{tmp_path}/anomalies").count() == stats.anomalies_published
    assert spark.read.parquet(f"{tmp_path}/dead_letters").count() == stats.dead_lettered
    # A batch that is repeated is not published again.
    assert sorted((kind, n) for kind, n, _ in published) == [(kind, n) for kind in ("anomalies", "dead_letters") for n in range(5)]
    assert sum(n for kind, _, n in published if kind == "anomalies") == stats.anomalies_published
    # Earlier points in time can be asked for as well.
    first = process_log(slices(log, 5)[0])
    assert sorted(stream.summary(0).collect()) == sorted(sensor_summary(first.where("reason IS NULL")).collect())


def test_restart_after_a_crash(spark, log, batch, tmp_path):
    source, out = f"{tmp_path}/log", f"{tmp_path}/out"
    parts = slices(log, 3)

    def arrive(part):
        part.write.mode("append").parquet(source)

    def run(stream):
        stream.start(read_log_files(spark, source)).awaitTermination()

    class Crashing(LogStream):
        def _emit(self, kind, records, batch_id):
            super()._emit(kind, records, batch_id)
            if batch_id == 1 and kind == "anomalies":
                # In the middle of a batch, all answers are those of the batches before it.
                assert answers(self) == first
                raise RuntimeError("lost")

    def answers(stream):
        return stream.audit().count(), stream.totals().first(), stream.summary().count(), stream.states().count(), stream.sections().count()

    arrive(parts[0])
    run(Crashing(spark, out))
    first = answers(LogStream(spark, out))
    arrive(parts[1])
    with pytest.raises(Exception, match="lost"):
        run(Crashing(spark, out))
    assert answers(LogStream(spark, out)) == first
    run(LogStream(spark, out))
    arrive(parts[2])
    run(LogStream(spark, out))
    stream = LogStream(spark, out)
    assert labels(stream.audit()) == labels(batch)
    assert stream.totals().first() == log_totals(batch.where("reason IS NULL")).first()
    assert run_stats(stream.audit()).first().batches == 3


def test_empty_batches_and_ids_for_ever(spark, tmp_path):
    stream = LogStream(spark, str(tmp_path), audit_json=True, factor=2)
    assert (stream.audit().count(), stream.summary().count(), stream.sections().count()) == (0, 0, 3)
    one = log_from_table(raw_log(spark, [reading(), "{"]))
    stream.process(one, 0)
    for batch_id in range(1, 5):
        stream.process(one.where("false"), batch_id)
    stream.process(one, 5)
    assert {(r.batch_id, r.status) for r in stream.audit().collect()} == {
        (0, "accepted"), (0, "invalid-json"), (5, "duplicate"), (5, "invalid-json"),
    }
    assert spark.read.json(f"{tmp_path}/audit_json").count() == 4


def test_one_time_for_each_dead_letter(spark, tmp_path):
    stream = LogStream(spark, str(tmp_path), audit_json=True)
    stream.process(log_from_table(raw_log(spark, ["{", "x" * 2000, reading()])), 0)
    lines = {r.source.offset: (r.deadLetteredAt, r.raw) for r in spark.read.json(f"{tmp_path}/audit_json").where("reason IS NOT NULL").collect()}
    bodies = spark.read.json(spark.read.parquet(f"{tmp_path}/dead_letters").select("value").rdd.map(lambda r: r.value))
    assert {r.source.offset: (r.deadLetteredAt, r.raw) for r in bodies.collect()} == lines
    assert lines["1"][1] == "x" * 2000


def test_summary_at_the_end_of_a_run(spark, log, batch, tmp_path):
    log.write.parquet(f"{tmp_path}/log")
    stream = LogStream(spark, f"{tmp_path}/out")
    stream.run(read_log_files(spark, f"{tmp_path}/log"))
    kinds = {r.section: r["count"] for r in spark.read.json(f"{tmp_path}/out/summary").groupBy("section").count().collect()}
    found = batch.where("is_anomaly AND status <> 'duplicate'").count()
    assert kinds == {"totals": 1, "thresholds": 1, "consumer": 1, "sensors": 15, "anomalies": found}


def test_a_crash_between_publishing_and_commit(spark, log, tmp_path):
    """A publisher that remembers kind and batch is sent the same records again, and nothing twice that was noted."""
    source, out = f"{tmp_path}/log", f"{tmp_path}/out"
    sent, taken = [], {}

    def publish(records, kind, batch):
        rows = sorted((r.key or "", r.value) for r in records.collect())
        sent.append((kind, batch))
        assert taken.setdefault((kind, batch), rows) == rows

    class Crashing(LogStream):
        def _mark(self, kind, batch_id, schema, row):
            if kind == self.at:
                raise RuntimeError("lost")
            super()._mark(kind, batch_id, schema, row)

    log.write.parquet(source)
    for at in ("published/kind=anomalies", "finished"):
        stream = Crashing(spark, out, publish=publish)
        stream.at = at
        with pytest.raises(Exception, match="lost"):
            stream.start(read_log_files(spark, source)).awaitTermination()
    LogStream(spark, out, publish=publish).start(read_log_files(spark, source)).awaitTermination()
    # Dead letters were noted at once; the note on anomalies was lost, so they were sent again.
    assert sorted(sent) == [("anomalies", 0), ("anomalies", 0), ("dead_letters", 0)]
    stats = LogStream(spark, out).stats().first()
    assert (len(taken["anomalies", 0]), len(taken["dead_letters", 0])) == (stats.anomalies_published, stats.dead_lettered)


def test_levels_follow_the_number_of_the_batch():
    for factor in (2, 3, 8):
        for batch in range(200):
            covered = [b for level, n in runs_before(batch, factor) for b in range(n * factor**level, (n + 1) * factor**level)]
            assert covered == list(range(batch))
    assert len(runs_before(10**9, 8)) <= 7 * 11
    assert runs_before(200, 8) == [(2, 0), (2, 1), (2, 2), (1, 24)]


def test_a_batch_opens_only_files_its_ids_may_be_in(spark, tmp_path):
    """New ids open next to no file, however long the stream has run; ids seen before open the files that hold them."""
    state = LogState(spark, str(tmp_path), None, factor=8, buckets=4)

    def ids(first, count):
        return spark.range(first, first + count).select(F.concat(F.lit("run-"), F.col("id").cast("string")).alias("event_id"))

    # What 200 batches of 50 ids leave behind.
    for level, number in runs_before(200, 8):
        state.write_ids(level, number, ids(number * 8**level * 50, 8**level * 50))
    state.write_ids(0, 0, ids(0, 50))
    opened = {}
    for batch in (1, 200):
        fresh = ids(1_000_000, 50)
        maybe, paths = state.files_for(batch, fresh, stage)
        opened[batch] = len(paths)
        assert state.seen_among(batch, fresh, stage).count() == 0
    assert opened[1] == opened[200] == 0
    mixed = ids(9_990, 30)
    maybe, paths = state.files_for(200, mixed, stage)
    assert paths and all("level=1/number=24" in p for p in paths)
    found = sorted(r.event_id for r in state.seen_among(200, mixed, stage).collect())
    assert found == sorted(f"run-{n}" for n in range(9_990, 10_000))
    # All of what was seen passes its filter, and few others do.
    every = ids(0, 10_000)
    assert state.seen_among(200, every, stage).count() == 10_000
    passed = state.files_for(200, ids(10**7, 20_000), stage)[0].select("event_id").distinct().count()
    assert HASHES == 8 and passed < 100


def test_drop_keeps_each_id_once_for_ever(spark, log, batch, tmp_path):
    """Over restarts, with ids that come again much later, a late new reading and records without an id."""
    parts = [*slices(log, 3), log.where("offset % 5 = 0")]
    late = log_from_table(raw_log(spark, [reading("s", 1, eventId="late", ts="2001-01-01"), reading("s", 2, eventId="late", ts="2001-01-01")]))
    parts.append(late)
    for part in parts:
        part.write.mode("append").parquet(f"{tmp_path}/log")
        good, _ = split_valid(validate(read_log_files(spark, f"{tmp_path}/log")))
        nameless = good.withColumn("event_id", F.when(F.col("event_id") != "evt-2", F.col("event_id")))
        kept = drop_duplicates_stream(nameless).select("event_id", "partition", "offset")
        query = kept.writeStream.format("parquet").option("checkpointLocation", f"{tmp_path}/checkpoint").trigger(availableNow=True)
        query.start(f"{tmp_path}/out").awaitTermination()
    found = [r.event_id for r in spark.read.parquet(f"{tmp_path}/out").collect()]
    wanted = {r.event_id for r in batch.where("reason IS NULL").select("event_id").collect()} - {"evt-2"} | {"late"}
    named = [f for f in found if f is not None]
    assert len(named) == len(set(named)) and set(named) == wanted
    # A record without an id stays, one for each place in the log.
    assert found.count(None) == batch.where("event_id = 'evt-2'").count()


def test_revised_labels_are_those_of_one_batch(spark, tmp_path):
    """Records in any order over batches, a third of them of one sensor and a third of one id; a batch is repeated."""
    draw = random.Random(2)
    readings = random_log(2, 160)
    log = typed_log(spark, readings).withColumn("event_id", F.when(F.col("event_id") != "e5", F.col("event_id"))).cache()
    batch_of = {n: draw.randrange(3) for n in range(len(readings))}
    dealt = log.withColumn("batch", F.element_at(F.create_map(*[F.lit(x) for p in batch_of.items() for x in p]), F.col("offset").cast("int")))
    revised = RevisedLog(spark, str(tmp_path), log.schema, ("offset", "partition"), factor=2, buckets=2)
    for batch in range(3):
        for _ in range(2 if batch == 1 else 1):
            revised.process(dealt.where(F.col("batch") == batch).drop("batch"), batch)
        if not batch:
            continue
        sofar = dealt.where(F.col("batch") <= batch)
        wanted = classify_continuity(mark_duplicates(sofar, ("offset",)), ("offset",))
        columns = ("offset", "event_id", "sensor_id", "is_duplicate", "previous_sequence", "status", "missing")
        assert sorted(map(str, revised.labels().select(*columns).collect())) == sorted(map(str, wanted.select(*columns).collect()))
    assert revised.revisions(2).count() > 0


def test_records_in_order_revise_nothing(spark, tmp_path):
    log = typed_log(spark, [reading(f"s{k % 3}", k // 3 + 1, eventId=f"e{k}") for k in range(60)])
    revised = RevisedLog(spark, str(tmp_path), log.schema, ("offset", "partition"))
    for batch in range(2):
        revised.process(log.where(F.floor(F.col("offset") / 30) == batch), batch)
    assert revised.revisions(1).count() == 0 and revised.labels().where("status = 'accepted'").count() == 60
    # One late record that jumps ahead makes the next of its sensor late, until a higher one comes.
    jump = typed_log(spark, [reading("s0", 8, eventId="jump")]).withColumn("offset", F.lit(7).cast("long")).withColumn("partition", F.lit(9))
    revised.process(jump, 2)
    changed = {r.sequence: (r.previous_sequence, r.status) for r in revised.revisions(2).collect()}
    assert changed == {n: (8.0, "accepted" if n == 8 else "out_of_order") for n in range(4, 9)}
