"""Letting each record of a stream through once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Ids are kept in RocksDB on the executors' disks, not in their memory; a checkpoint then holds what changed in a batch.
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def drop_duplicates_stream(stream: DataFrame, id_col: str = "event_id", place: Sequence[str] = ("topic", "partition", "offset")) -> DataFrame:
    """The stream without records whose id came before, ever: there is no watermark, so nothing new is lost however late.

    The ids seen are Spark's own state, partitioned by id and restored from the checkpoint of the query. Records without
    an id all stay; `place` tells them apart. Of records that share an id and a micro-batch, any one stays.
    """
    for name, value in STATE_CONF.items():
        stream.sparkSession.conf.set(name, value)
    missing = F.col(id_col).isNull()
    alone = F.when(missing, F.struct(*place))
    keyed = stream.withColumn("_id", F.struct(F.col(id_col), alone))
    return keyed.dropDuplicates(["_id"]).drop("_id")
