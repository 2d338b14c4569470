"""Bounded scans of a log kept as files: an index says which offsets and times each file holds."""

from __future__ import annotations

import re
from collections.abc import Sequence
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywire.schema import ENVELOPE

INDEX = T.StructType(
    [
        T.StructField("file", T.StringType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("records", T.LongType()),
        T.StructField("first_offset", T.LongType()),
        T.StructField("last_offset", T.LongType()),
        T.StructField("first_time", T.TimestampType()),
        T.StructField("last_time", T.TimestampType()),
    ]
)


def _name(file: str) -> str:
    """The same for a local file however many slashes follow its scheme."""
    return re.sub(r"^file:/+", "file:/", file)


class LogIndex:
    """Least and greatest offset and time of each file and partition of a log folder.

    `refresh` looks at files that are new since the last time and adds them to the index, in a table of its own for each
    call; the offsets and times come from four columns, nothing else is read. `read` picks the files by the index and opens
    no others. A file without records is no part of the answer, nor looked at again. Files are never changed once they
    are in the folder, as in any log.
    """

    def __init__(self, spark: SparkSession, log_path: str, index_path: str):
        self.spark = spark
        self.log_path = log_path
        self.index_path = index_path

    def entries(self) -> DataFrame:
        try:
            return self.spark.read.schema(INDEX).parquet(self.index_path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], INDEX)

    def refresh(self) -> None:
        """Add the files that came since the last call."""
        known = {_name(r.file) for r in self.entries().select("file").distinct().collect()}
        present = self.spark.read.schema(ENVELOPE).parquet(self.log_path).inputFiles()
        fresh = [f for f in present if _name(f) not in known]
        if not fresh:
            return
        log = self.spark.read.schema(ENVELOPE).parquet(*fresh).select("topic", "partition", "offset", "timestamp", F.col("_metadata.file_path").alias("file"))
        found = log.groupBy("file", "topic", "partition").agg(
            F.count(F.lit(1)).alias("records"),
            F.min("offset").alias("first_offset"),
            F.max("offset").alias("last_offset"),
            F.min("timestamp").alias("first_time"),
            F.max("timestamp").alias("last_time"),
        )
        found.write.mode("append").parquet(self.index_path)

    def read(
        self,
        first: int | None = None,
        last: int | None = None,
        since: datetime | None = None,
        until: datetime | None = None,
        topics: Sequence[str] | None = None,
        partitions: Sequence[int] | None = None,
    ) -> DataFrame:
        """The records with offsets from `first` to `last` and times from `since` to `until`, ends included."""
        entries, kept = F.lit(True), F.lit(True)
        for column, least, greatest, low, high in (
            ("offset", first, last, "first_offset", "last_offset"),
            ("timestamp", since, until, "first_time", "last_time"),
        ):
            if least is not None:
                entries, kept = entries & (F.col(high) >= F.lit(least)), kept & (F.col(column) >= F.lit(least))
            if greatest is not None:
                entries, kept = entries & (F.col(low) <= F.lit(greatest)), kept & (F.col(column) <= F.lit(greatest))
        for column, wanted in (("topic", topics), ("partition", partitions)):
            if wanted is not None:
                entries, kept = entries & F.col(column).isin(list(wanted)), kept & F.col(column).isin(list(wanted))
        # The names of the files to open, and no more of them than there are.
        files = [r.file for r in self.entries().where(entries).select("file").distinct().collect()]
        if not files:
            return self.spark.createDataFrame([], ENVELOPE)
        return self.spark.read.schema(ENVELOPE).parquet(*sorted(files)).where(kept)
