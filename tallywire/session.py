"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

# Runtime settings every job relies on: ISO text is written in UTC, and a JSON object that repeats a key keeps the
# last value instead of failing to parse.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.variant.allowDuplicateKeys": "true",
}

# Settings a session can only be created with. Without the last one, PySpark sends the call site of every column
# function to the JVM, which is most of the time it takes to build a plan.
STARTUP_CONF = {
    "spark.ui.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}

CHECKPOINT_DIR = "spark.checkpoint.dir"


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the settings the operators rely on to a session somebody else created."""
    for name, value in RUNTIME_CONF.items():
        spark.conf.set(name, value)
    return spark


def build_session(master: str | None = None, app_name: str = "tallywire", **conf: str) -> SparkSession:
    """A session with the settings of this package; `conf` uses Spark's own names and wins over the defaults."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for name, value in {**STARTUP_CONF, **RUNTIME_CONF, **conf}.items():
        builder = builder.config(name, value)
    return prepare(builder.getOrCreate())


_LOCAL: list[str] = []


def work_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder below the one the cluster names in `spark.checkpoint.dir`.

    A machine-local folder would vanish with its executor, so on a cluster the setting is required. Only a local
    session without it, as in a trial, gets a folder of its own; the session's settings stay as they are.
    """
    root = spark.conf.get(CHECKPOINT_DIR, None)
    if not root:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError(f"set {CHECKPOINT_DIR} to a folder that every executor can reach")
        if not _LOCAL:
            _LOCAL.append(tempfile.mkdtemp(prefix="tallywire-"))
        root = _LOCAL[0]
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write `df` as a table in the shared folder and read it back.

    Cuts the lineage, so lost executors never force the work above it to run again, and later passes read only the
    columns they need. The table stays until the owner of the folder clears it, as results are read from it lazily.
    """
    return _stored(df, work_dir(df.sparkSession, label))


def stage_below(path: str) -> Callable[[DataFrame, str], DataFrame]:
    """Like `stage`, but in a folder of the caller's, one table for each label, replaced whenever it is written again."""
    return lambda df, label: _stored(df, f"{path}/{label}")


def _stored(df: DataFrame, path: str) -> DataFrame:
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stage_by_key(df: DataFrame, label: str, key: Sequence[str], order_by: Sequence[str] = (), buckets: int | None = None) -> DataFrame:
    """Like `stage`, with the rows dealt into files by `key`, by default as many as shuffle partitions, and sorted in each.

    Windows, aggregates and joins by that key then move no rows. A key is whole in its file: hand in logs whose keys are
    of a size for one task (`running.large_keys` tells which are not).
    """
    spark = df.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = work_dir(spark, label)
    name = path.rsplit("/", 1)[1].replace("-", "_")
    writer = df.repartition(buckets, *key).write.bucketBy(buckets, *key).sortBy(*key, *order_by)
    writer.mode("overwrite").option("path", path).saveAsTable(name)
    return spark.table(name)
