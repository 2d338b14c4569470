"""Reading a record log: from Kafka, or from any table or file stream with the same columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywire.schema import ENVELOPE


def kafka_options(servers: str, topic: str, options: dict[str, str] | None = None) -> dict[str, str]:
    """Options of a scan of one topic from its first record, headers included."""
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "earliest",
        "includeHeaders": "true",
        **(options or {}),
    }


def read_log_stream(
    spark: SparkSession, servers: str, topic: str, options: dict[str, str] | None = None
) -> DataFrame:
    """An unbounded scan of a topic. Needs the Kafka connector on the class path."""
    return spark.readStream.format("kafka").options(**kafka_options(servers, topic, options)).load()


def read_log(spark: SparkSession, servers: str, topic: str, options: dict[str, str] | None = None) -> DataFrame:
    """A scan of what a topic holds now (up to `endingOffsets`, by default the latest)."""
    bounded = {"endingOffsets": "latest", **(options or {})}
    return spark.read.format("kafka").options(**kafka_options(servers, topic, bounded)).load()


def log_from_table(df: DataFrame, topic: str | None = None) -> DataFrame:
    """Any table or stream with at least `value`, `partition` and `offset`, completed to the columns of a log."""
    missing = {"value", "partition", "offset"} - set(df.columns)
    if missing:
        raise ValueError(f"a log needs the columns {', '.join(sorted(missing))}")
    columns = []
    for wanted in ENVELOPE.fields:
        if wanted.name in df.columns:
            column = F.col(wanted.name).cast(wanted.dataType)
        else:
            column = F.lit(topic if wanted.name == "topic" else None).cast(wanted.dataType)
        columns.append(column.alias(wanted.name))
    extra = [c for c in df.columns if c not in ENVELOPE.fieldNames()]
    return df.select(*columns, *extra)


def read_log_files(
    spark: SparkSession, path: str, max_files_per_trigger: int | None = None, stream: bool = True
) -> DataFrame:
    """A log kept as Parquet files: a stream of new files, or everything there is."""
    if not stream:
        return spark.read.schema(ENVELOPE).parquet(path)
    reader = spark.readStream.schema(ENVELOPE)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)
