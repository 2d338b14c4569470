"""The stream job: one pass over each micro-batch feeds the audit table, all sinks and the state."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tallywire.operators.anomaly import ANOMALY_COLUMNS, DEFAULT_THRESHOLDS, Thresholds
from tallywire.operators.records import anomaly_records, dead_letter_records, dead_letters
from tallywire.operators.summary import (
    added_counters,
    outcomes,
    run_counters,
    sensor_state,
    state_totals,
    summarize,
    summary_sections,
)
from tallywire.plans.process import check_log, label_checked
from tallywire.plans.sinks import write_audit, write_summary
from tallywire.schema import AUDIT, DUPLICATE, ENVELOPE, LOG_ORDER
from tallywire.session import prepare, stage_below
from tallywire.streaming.state import LogState, read_batches

# A publisher gets `(key, value, headers)` records, the kind of record ("anomalies" or "dead_letters") and the batch. The
# same kind and batch always comes with the same records, so one that remembers both can tell a repetition.
Publisher = Callable[[DataFrame, str, int], None]


# The counters of a batch, in the row that says that all its tables are written.
FINISHED = T.StructType(
    [
        T.StructField("finished_at", T.TimestampType()),
        *[
            T.StructField(name, T.LongType())
            for name in ("consumed", "processed", "duplicates", "out_of_order", "gaps", "dead_lettered", "anomalies_published")
        ],
    ]
)

AT = T.StructType([T.StructField("at", T.TimestampType())])


class LogStream:
    """A record log worked off in micro-batches below one folder.

    audit/         every record with its status, the table all else is derived from
    anomalies/     records ready to publish
    dead_letters/  records ready to publish
    published/     a row for each kind and batch that the publisher has taken
    state/         seen ids and sensor states
    finished/      a row for each batch all of whose tables are written, with its counters
    summary/       the sections of the summary as JSON lines, at the end of each run
    audit_json/    the audit log as JSON lines, when asked for
    work/          tables of the batch at hand

    Everything but the summary is written to a folder per batch, replacing what a failed attempt left there, before
    Spark records the batch as done. A batch that fails anywhere is therefore repeated as a whole: tables hold each
    record once. What the publisher took is not handed to it again; only when the attempt failed between its taking a
    batch and the row that says so, it gets the same records of the same batch a second time. `audit`, `summary`,
    `totals`, `states`, `sections`, `stats` and `outcomes` answer at any time, from the batches that are finished. Counters
    are taken while the audit table is written, so no answer about them reads it.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        order_by: Sequence[str] = LOG_ORDER,
        limits: Thresholds = DEFAULT_THRESHOLDS,
        publish: Publisher | None = None,
        keep_payload: bool = False,
        audit_json: bool = False,
        factor: int = 8,
        buckets: int = 16,
    ):
        self.spark = prepare(spark)
        self.root = root.rstrip("/")
        self.order_by = tuple(order_by)
        self.limits = limits
        self.publish = publish
        self.keep_payload = keep_payload or audit_json
        self.audit_json = audit_json
        good = spark.createDataFrame([], AUDIT).withColumn("batch_id", F.lit(0).cast("long"))
        state_schema = sensor_state(good, ("batch_id", *self.order_by)).schema
        self.state = LogState(spark, f"{self.root}/state", state_schema, factor, buckets)

    def start(self, log: DataFrame, **trigger) -> StreamingQuery:
        """Run over a streaming log; `trigger` is Spark's, by default everything there is and then stop."""
        # In a stream this is the time Spark noted for the batch, the same whenever the batch is repeated.
        log = log.withColumn("checked_at", F.current_timestamp())
        writer = log.writeStream.foreachBatch(self.process).option("checkpointLocation", f"{self.root}/checkpoint")
        return writer.trigger(**(trigger or {"availableNow": True})).start()

    def run(self, log: DataFrame, **trigger) -> None:
        """Work off what there is, and leave the summary of everything so far behind."""
        self.start(log, **trigger).awaitTermination()
        write_summary(self.sections(), f"{self.root}/summary")

    def process(self, batch: DataFrame, batch_id: int) -> None:
        """One micro-batch, complete and repeatable."""
        columns = [*ENVELOPE.fieldNames(), *(["checked_at"] if "checked_at" in batch.columns else [])]
        checked = self._store(check_log(batch.select(*columns), self.keep_payload), "checked")
        path = f"{self.root}/audit/batch_id={batch_id}"
        counted = Observation()
        self._labelled(checked, batch_id).observe(counted, *run_counters()).write.mode("overwrite").parquet(path)

        # From here on everything reads its columns of what was just written, side by side.
        stored = self.spark.read.schema(AUDIT).parquet(path).withColumn("batch_id", F.lit(batch_id).cast("long"))
        failed = dead_letter_records(dead_letters(stored.where(F.col("reason").isNotNull())))
        found = stored.where((F.col("status") != DUPLICATE) & F.col("is_anomaly"))
        found = anomaly_records(found.select(*ANOMALY_COLUMNS, F.col("anomaly").alias("reason")))
        writes = [
            lambda: self._emit("dead_letters", failed, batch_id),
            lambda: self._emit("anomalies", found, batch_id),
            *self.state.writes(batch_id, stored, self.order_by),
        ]
        if self.audit_json:
            writes.append(lambda: write_audit(stored, f"{self.root}/audit_json/batch_id={batch_id}", "overwrite"))
        with ThreadPoolExecutor(len(writes)) as pool:
            for job in [pool.submit(write) for write in writes]:
                job.result()
        self.state.merge(batch_id)
        self._publish("dead_letters", failed, batch_id)
        self._publish("anomalies", found, batch_id)
        # Of an empty batch Spark may have nothing to observe.
        counters = [counted.get.get(name, 0) for name in FINISHED.fieldNames()[1:]]
        self._mark("finished", batch_id, FINISHED, (datetime.now(timezone.utc), *counters))

    def last_batch(self) -> int:
        """The last finished batch, -1 when there is none."""
        done = read_batches(self.spark, f"{self.root}/finished", FINISHED).agg(F.max("batch_id")).first()[0]
        return -1 if done is None else done

    def counters(self) -> DataFrame:
        """The counters of each finished batch, with `batch_id`."""
        return read_batches(self.spark, f"{self.root}/finished", FINISHED).drop("finished_at")

    def stats(self) -> DataFrame:
        """The counters of the whole run, one row."""
        return added_counters(self.counters())

    def outcomes(self) -> DataFrame:
        """What became of the records of each batch."""
        return outcomes(self.counters())

    def audit(self) -> DataFrame:
        """The audit table of the finished batches, with `batch_id`."""
        return read_batches(self.spark, f"{self.root}/audit", AUDIT).where(F.col("batch_id") <= self.last_batch())

    def summary(self, through: int | None = None) -> DataFrame:
        """Per-sensor summary of all batches, or of those through the given one."""
        return summarize(self.states(through))

    def totals(self, through: int | None = None) -> DataFrame:
        return state_totals(self.states(through))

    def states(self, through: int | None = None) -> DataFrame:
        return self.state.sensors_before((self.last_batch() if through is None else through) + 1)

    def sections(self) -> DataFrame:
        """Totals, thresholds, sensors, anomalies and the counters of the run, of the finished batches."""
        good = self.audit().where(F.col("reason").isNull())
        order = ("batch_id", *self.order_by)
        sections = summary_sections(good, self.stats(), order, self.limits, self.states())
        # Arrival as the log has it, without the batch.
        return sections.withColumn("arrival", F.slice("arrival", 2, len(self.order_by)))

    def _store(self, df: DataFrame, label: str) -> DataFrame:
        return stage_below(f"{self.root}/work")(df, label)

    def _labelled(self, checked: DataFrame, batch_id: int) -> DataFrame:
        last = self.state.sensors_before(batch_id).groupBy("sensor_id").agg(F.max("last_sequence").alias("last_sequence"))

        def seen(ids: DataFrame) -> DataFrame:
            return self.state.seen_among(batch_id, ids, self._store)

        # Before the first batch there is nothing to look for.
        known = {"seen": seen, "last": last} if batch_id else {}
        return label_checked(checked, self.order_by, self.limits, store=self._store, **known)

    def _emit(self, kind: str, records: DataFrame, batch_id: int) -> None:
        records.write.mode("overwrite").parquet(f"{self.root}/{kind}/batch_id={batch_id}")

    def _publish(self, kind: str, records: DataFrame, batch_id: int) -> None:
        if self.publish is None or self._marked(f"published/kind={kind}", batch_id) is not None:
            return
        self.publish(self.spark.read.schema(records.schema).parquet(f"{self.root}/{kind}/batch_id={batch_id}"), kind, batch_id)
        self._mark(f"published/kind={kind}", batch_id, AT, (datetime.now(timezone.utc),))

    def _mark(self, kind: str, batch_id: int, schema: T.StructType, row: tuple) -> None:
        """One row in a folder of the batch's own."""
        one = self.spark.createDataFrame([row], schema).coalesce(1)
        one.write.mode("overwrite").parquet(f"{self.root}/{kind}/batch_id={batch_id}")

    def _marked(self, kind: str, batch_id: int) -> datetime | None:
        """The time in such a row, if it was written whole."""
        try:
            row = self.spark.read.schema(AT).parquet(f"{self.root}/{kind}/batch_id={batch_id}").first()
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return None
        return row and row["at"].replace(tzinfo=timezone.utc)
