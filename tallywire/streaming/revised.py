"""Labels of a stream whose records do not come in order: answers that late records change are given again."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywire.operators.continuity import classify_continuity
from tallywire.session import stage_below
from tallywire.streaming.state import LogState, read_batches

LABELS = ("is_duplicate", "previous_sequence", "status", "missing")


class RevisedLog:
    """Duplicates and continuity of readings under an order of their own, whatever batches they come in.

    rows/     for each batch its records with their labels, and the records of earlier batches whose labels it changed
    sensors/  for each batch the last place and the highest sequence of every sensor so far
    state/    the ids seen, in buckets with Bloom filters

    A record of a later batch may sort before records that have their labels already. Then the record of its id that was
    first may have become a duplicate, and records of its sensor after it, up to the next that follows a higher
    sequence, may follow another one now. Such records are written again with the new labels (`revisions`); the labels of a
    record are those of the last batch that wrote it (`labels`). They are what one batch over everything would say.

    A batch whose sensors are all in order and whose ids are all new reads nothing of earlier rows; else it reads rows
    from the earliest late place on, of the late sensors, and the rows of the ids that came again. `place` tells records
    apart. Batches count up from 0, and one can be repeated, as in `LogStream`.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        schema: T.StructType,
        order_by: Sequence[str],
        place: Sequence[str] = ("partition", "offset"),
        factor: int = 8,
        buckets: int = 16,
    ):
        self.spark = spark
        self.root = root.rstrip("/")
        self.order_by = list(order_by)
        self.place = list(place)
        self.columns = list(dict.fromkeys([*self.place, *self.order_by, "event_id", "sensor_id", "sequence"]))
        marks = [T.StructField(c, t) for c, t in zip(LABELS, (T.BooleanType(), T.DoubleType(), T.StringType(), T.DoubleType()))]
        self.schema = T.StructType([*(schema[c] for c in self.columns), *marks])
        self.ids = LogState(spark, f"{self.root}/state", T.StructType(), factor, buckets)
        self._store = stage_below(f"{self.root}/work")

    def process(self, readings: DataFrame, batch_id: int) -> None:
        """Valid readings of one batch."""
        new = self._store(readings.select(*self.columns), "new")
        fresh = new.select("event_id").where("event_id IS NOT NULL").distinct()
        known = self._known(fresh, batch_id)

        # Who is first of its id now, among the new records and the known ones of these ids.
        both = new.withColumn("was", F.lit(None).cast("boolean")).unionByName(known.select(*self.columns, F.col("is_duplicate").alias("was")))
        first = both.where("event_id IS NOT NULL").groupBy("event_id").agg(F.min(self._at()).alias("_first"))
        marked = both.join(self._store(first, "first"), "event_id", "left")
        marked = marked.withColumn("is_duplicate", F.coalesce(self._at() > F.col("_first"), F.lit(False))).drop("_first")
        # New records, and records of earlier batches that are a duplicate now, or are none any more.
        marked = self._store(marked.where("was IS NULL OR was <> is_duplicate"), "marked")

        starts = marked.groupBy(F.struct("sensor_id").alias("_key")).agg(F.min(self._at()).alias("_start"))
        before = self.sensors(batch_id).select(F.struct("sensor_id").alias("_key"), "last_place", "last_sequence")
        starts = self._store(starts.join(before, "_key", "left"), "starts")
        late = starts.where(F.col("_start") <= F.col("last_place")).select("_key", "_start")
        after = self._after(late, batch_id)

        # All records from the earliest change of their sensor on, under their marks of now.
        changed = marked.select(*[F.col(c).alias(f"_{c}") for c in self.place], F.col("is_duplicate").alias("_now"))
        after = after.join(changed, [F.col(c) == F.col(f"_{c}") for c in self.place], "left").drop(*[f"_{c}" for c in self.place])
        old = [F.col(c).alias(f"old_{c}") for c in LABELS]
        rows = after.select(*self.columns, F.coalesce("_now", "is_duplicate").alias("is_duplicate"), *old)
        rows = self._store(rows.unionByName(marked.where("was IS NULL").drop("was"), allowMissingColumns=True), "rows")
        # What the sensor had reached before: all before the start is as it was.
        reached = after.groupBy(F.struct("sensor_id").alias("_key")).agg(F.min("previous_sequence").alias("_reached"))
        reached = self._store(starts.join(reached, "_key", "left"), "reached")
        last = reached.select("_key.sensor_id", F.coalesce("_reached", "last_sequence").alias("last_sequence"))
        placed = classify_continuity(rows, self.order_by, last=last, store=self._store, stored=True)
        same = [F.col(c).eqNullSafe(F.col(f"old_{c}")) for c in LABELS]
        unchanged = F.col("old_status").isNotNull() & same[0] & same[1] & same[2] & same[3]
        placed.where(~unchanged).select(*self.schema.fieldNames()).write.mode("overwrite").parquet(f"{self.root}/rows/batch_id={batch_id}")

        tops = rows.groupBy(F.struct("sensor_id").alias("_key")).agg(
            F.max(self._at()).alias("_last"), F.max(F.when(~F.col("is_duplicate"), F.col("sequence"))).alias("_top")
        )
        base = reached.select("_key", "last_place", F.coalesce("_reached", "last_sequence").alias("_base"), F.lit(True).alias("_touched"))
        every = before.join(tops, "_key", "full").join(base.drop("last_place"), "_key", "left")
        highest = F.when(F.col("_touched"), F.greatest("_base", "_top")).otherwise(F.col("last_sequence"))
        every = every.select("_key.sensor_id", F.greatest("last_place", "_last").alias("last_place"), highest.alias("last_sequence"))
        every.write.mode("overwrite").parquet(f"{self.root}/sensors/batch_id={batch_id}")
        unseen = fresh.join(known.select("event_id").distinct(), "event_id", "left_anti")
        self.ids.write_ids(0, batch_id, unseen)
        self.ids.merge_ids(batch_id)

    def sensors(self, batch_id: int) -> DataFrame:
        """The last place and the highest sequence of every sensor before the batch."""
        place = T.StructType([self.schema[c] for c in self.order_by])
        schema = T.StructType(
            [self.schema["sensor_id"], T.StructField("last_place", place), T.StructField("last_sequence", T.DoubleType())]
        )
        if not batch_id:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.root}/sensors/batch_id={batch_id - 1}")

    def labels(self) -> DataFrame:
        """Every record with its labels as of now."""
        return self._latest(read_batches(self.spark, f"{self.root}/rows", self.schema)).drop("batch_id")

    def revisions(self, batch_id: int) -> DataFrame:
        """Records of earlier batches to which the batch gave other labels."""
        rows = read_batches(self.spark, f"{self.root}/rows", self.schema)
        earlier = rows.where(F.col("batch_id") < batch_id).select(*self.place).distinct()
        return rows.where(F.col("batch_id") == batch_id).join(earlier, self.place, "left_semi").drop("batch_id")

    def _at(self):
        return F.struct(*self.order_by)

    def _latest(self, rows: DataFrame) -> DataFrame:
        version = Window.partitionBy(*self.place).orderBy(F.desc("batch_id"))
        return rows.withColumn("_version", F.row_number().over(version)).where("_version = 1").drop("_version")

    def _history(self, batch_id: int) -> DataFrame:
        return read_batches(self.spark, f"{self.root}/rows", self.schema).where(F.col("batch_id") < batch_id)

    def _known(self, fresh: DataFrame, batch_id: int) -> DataFrame:
        """The rows of earlier batches that have one of the ids."""
        none = self.spark.createDataFrame([], self.schema)
        if not batch_id:
            return none
        again = self._store(self.ids.seen_among(batch_id, fresh, self._store), "again")
        if again.isEmpty():
            return none
        return self._store(self._latest(self._history(batch_id).join(again, "event_id", "left_semi")).drop("batch_id"), "known")

    def _after(self, late: DataFrame, batch_id: int) -> DataFrame:
        """The rows of earlier batches that lie at or behind the start of their sensor."""
        least = late.agg(F.min(F.col("_start")[self.order_by[0]])).first()[0] if batch_id else None
        if least is None and (not batch_id or late.isEmpty()):
            return self.spark.createDataFrame([], self.schema)
        history = self._history(batch_id)
        if least is not None:
            # Known to the scan, so files and row groups before it are not read; nulls sort first.
            history = history.where(F.col(self.order_by[0]) >= F.lit(least))
        history = history.withColumn("_key", F.struct("sensor_id")).join(late, "_key").where(self._at() >= F.col("_start"))
        return self._store(self._latest(history).drop("batch_id", "_key", "_start"), "after")
