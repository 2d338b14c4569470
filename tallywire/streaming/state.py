"""What earlier batches left behind: levels of tables that grow by a factor, and Bloom filters over the ids."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywire.operators.summary import merge_states, sensor_state
from tallywire.schema import DUPLICATE

IDS_SCHEMA = T.StructType([T.StructField("event_id", T.StringType())])

FILTERS_SCHEMA = T.StructType(
    [
        T.StructField("bucket", T.IntegerType()),
        T.StructField("least", T.StringType()),
        T.StructField("greatest", T.StringType()),
        T.StructField("bits", T.LongType()),
        T.StructField("words", T.ArrayType(T.LongType())),
    ]
)

# A filter has at least this many bits for each id, and an id sets as many of them as there are hashes: about one id in
# two thousand that was never seen passes.
BITS_PER_ID = 16
HASHES = 8


def bucket_of(event_id: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(event_id), F.lit(buckets)).cast("int")


def _bit(event_id: Column, number: int, bits: Column) -> Column:
    return F.pmod(F.xxhash64(event_id, F.lit(number + 1)), bits)


def bloom_filters(ids: DataFrame, buckets: int, count: int) -> DataFrame:
    """A Bloom filter and the range of the ids for each bucket of a table (bucket, event_id) of so many rows.

    All filters of a table are of one size, for buckets of half again as many ids as they have on average.
    """
    bits = 64
    while bits < BITS_PER_ID * count * 1.5 / buckets:
        bits *= 2
    words = bits // 64
    places = F.explode(F.array(*[_bit(F.col("event_id"), k, F.lit(bits).cast("long")) for k in range(HASHES)]))
    mask = F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("bit") % 64).cast("int"))
    held = ids.select("bucket", places.alias("bit")).select("bucket", _word(F.col("bit")).alias("word"), mask.alias("mask"))
    # Words without a bit as well, so that a word is found by its place.
    every = ids.sparkSession.range(buckets * words).select(
        F.call_function("div", F.col("id"), F.lit(words)).cast("int").alias("bucket"), (F.col("id") % words).alias("word"), F.lit(0).cast("long").alias("mask")
    )
    merged = held.unionByName(every).groupBy("bucket", "word").agg(F.bit_or("mask").alias("mask"))
    in_order = F.array_sort(F.collect_list(F.struct("word", "mask")))
    arrays = merged.groupBy("bucket").agg(F.transform(in_order, lambda w: w["mask"]).alias("words"))
    ranges = ids.groupBy("bucket").agg(F.min("event_id").alias("least"), F.max("event_id").alias("greatest"))
    # A row for each bucket.
    return arrays.join(F.broadcast(ranges), "bucket").withColumn("bits", F.lit(bits).cast("long")).select(*FILTERS_SCHEMA.fieldNames())


def _word(bit: Column) -> Column:
    return F.call_function("div", bit, F.lit(64))


def may_hold(event_id: Column) -> Column:
    """Whether the filter of the same row may hold the id: never false for one that it holds."""
    found = F.col("least").isNotNull() & (event_id >= F.col("least")) & (event_id <= F.col("greatest"))
    for k in range(HASHES):
        bit = _bit(event_id, k, F.col("bits"))
        word = F.get("words", _word(bit).cast("int"))
        found = found & (F.call_function("getbit", word, (bit % 64).cast("int")) == 1)
    return found


def runs_before(batch_id: int, factor: int) -> list[tuple[int, int]]:
    """The tables that together cover all batches before this one, as (level, number), oldest first.

    Number `n` of a level covers `factor ** level` batches from `n * factor ** level` on. They are the digits of
    `batch_id` to the base `factor`, so there are at most `factor - 1` for each level, and the levels grow with the
    logarithm of the batches.
    """
    found, done, level = [], 0, 0
    while factor ** (level + 1) <= batch_id:
        level += 1
    for at in range(level, -1, -1):
        size = factor**at
        while done + size <= batch_id:
            found.append((at, done // size))
            done += size
    return found


class LogState:
    """Seen ids and sensor states of a stream.

    Each batch writes a table of level 0. Whenever `factor` tables of a level are whole, the batch that completed them
    merges them into one of the next level: sensor states become one row per sensor again, ids move together. What to
    read follows from the number of the batch alone, so batch `i` reads only what batches before `i` wrote, replaces
    whatever an earlier attempt at `i` wrote, and can be repeated any number of times. Batch ids count up from 0 without
    holes, as those of one streaming checkpoint do; a state folder belongs to one checkpoint. Tables that were merged
    are not read again.

    Ids lie in `buckets` files by their hash, each with its range of ids and a Bloom filter. A batch compares its ids
    with the filters, which are about two bytes for each id ever seen, and opens only the files that may hold one.
    """

    def __init__(self, spark: SparkSession, path: str, state_schema: T.StructType, factor: int = 8, buckets: int = 16):
        if factor < 2:
            raise ValueError("tables are merged two at a time at least")
        self.spark = spark
        self.path = path
        self.state_schema = state_schema
        self.factor = factor
        self.buckets = buckets

    def seen_among(self, batch_id: int, ids: DataFrame, store: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
        """Those of the distinct ids that were seen before the batch, each once."""
        files = self.files_for(batch_id, ids, store)
        if files is None:
            return ids.where("false")
        maybe, paths = files
        return self._read("ids", paths).join(maybe.select("event_id").distinct(), "event_id", "left_semi")

    def files_for(
        self, batch_id: int, ids: DataFrame, store: Callable[[DataFrame, str], DataFrame]
    ) -> tuple[DataFrame, list[str]] | None:
        """The ids that may have been seen before the batch, and the files they may be in."""
        runs = runs_before(batch_id, self.factor)
        if not runs:
            return None
        typed = T.StructType([*FILTERS_SCHEMA.fields, T.StructField("level", T.IntegerType()), T.StructField("number", T.IntegerType())])
        reader = self.spark.read.schema(typed).option("basePath", f"{self.path}/filters")
        filters = reader.parquet(*[self._place("filters", *run) for run in runs])
        asked = ids.select("event_id", bucket_of(F.col("event_id"), self.buckets).alias("bucket"))
        maybe = asked.join(filters, "bucket").where(may_hold(F.col("event_id")))
        maybe = store(maybe.select("event_id", "level", "number", "bucket"), "maybe-seen")
        # One row for each file of the state at most.
        files = maybe.select("level", "number", "bucket").distinct().collect()
        return maybe, sorted(f"{self._place('ids', f.level, f.number)}/bucket={f.bucket}" for f in files)

    def sensors_before(self, batch_id: int) -> DataFrame:
        """The states of all sensors, of everything before the batch."""
        return merge_states(self._read("sensors", [self._place("sensors", *run) for run in runs_before(batch_id, self.factor)]))

    def writes(self, batch_id: int, audit: DataFrame, order_by: Sequence[str]) -> list[Callable[[], None]]:
        """What stores the ids and the sensor states that the audit rows of a batch add, to be called in any order.

        `batch_id` leads the order in which readings arrived. When both are done, `merge` is due.
        """
        good = audit.where(F.col("reason").isNull())
        fresh = good.where((F.col("status") != DUPLICATE) & F.col("event_id").isNotNull()).select("event_id")
        states = sensor_state(good, ("batch_id", *order_by))
        return [lambda: self.write_ids(0, batch_id, fresh), lambda: self._write("sensors", 0, batch_id, states)]

    def merge(self, batch_id: int) -> None:
        """Merge the tables that the batch completed into those of the next level."""
        self.merge_ids(batch_id)
        for level, number, parts in self._completed(batch_id):
            states = self._read("sensors", [self._place("sensors", level - 1, p) for p in parts])
            self._write("sensors", level, number, merge_states(states))

    def merge_ids(self, batch_id: int) -> None:
        for level, number, parts in self._completed(batch_id):
            self.write_ids(level, number, self._read("ids", [self._place("ids", level - 1, p) for p in parts]))

    def _completed(self, batch_id: int) -> list[tuple[int, int, range]]:
        """Level and number of the tables that are whole with this batch, lowest first, and the numbers of their parts."""
        found, level, number = [], 0, batch_id
        while number % self.factor == self.factor - 1:
            parts = range(number - self.factor + 1, number + 1)
            level, number = level + 1, number // self.factor
            found.append((level, number, parts))
        return found

    def write_ids(self, level: int, number: int, ids: DataFrame) -> None:
        """Ids in their buckets, and the filters over them."""
        dealt = ids.select("event_id", bucket_of(F.col("event_id"), self.buckets).alias("bucket"))
        dealt = dealt.repartition(self.buckets, "bucket").sortWithinPartitions("bucket", "event_id")
        path = self._place("ids", level, number)
        dealt.write.mode("overwrite").partitionBy("bucket").parquet(path)
        written = self.spark.read.schema(T.StructType([*IDS_SCHEMA.fields, T.StructField("bucket", T.IntegerType())])).parquet(path)
        self._write("filters", level, number, bloom_filters(written, self.buckets, written.count()))

    def _place(self, kind: str, level: int, number: int) -> str:
        return f"{self.path}/{kind}/level={level}/number={number}"

    def _read(self, kind: str, paths: Iterable[str]) -> DataFrame:
        """These folders and no others: nothing is listed that is not read, and none may be missing."""
        paths, schema = list(paths), IDS_SCHEMA if kind == "ids" else self.state_schema
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", f"{self.path}/{kind}").parquet(*paths).select(*schema.fieldNames())

    def _write(self, kind: str, level: int, number: int, df: DataFrame) -> None:
        df.write.mode("overwrite").parquet(self._place(kind, level, number))


def read_batches(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A table with a folder per batch, empty when no batch has written yet."""
    typed = T.StructType([*schema.fields, T.StructField("batch_id", T.LongType())])
    try:
        return spark.read.schema(typed).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], typed)
