"""What several operators share: words, hashes of word sequences, and Arrow batches of a bounded size."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallywire.session import stage

__all__ = ["NO_ID", "buckets", "id_column", "sequence_hashes", "ship", "slices", "stage", "table", "word_hashes", "words"]

# Stands for a null id inside the operators, so that a null sorts behind every other id.
NO_ID = 2**63 - 1

_STEP = np.uint64(0x9E3779B97F4A7C15)
_LAST = np.uint64(0xBF58476D1CE4E5B9)
_HALF = np.uint64(32)
_TAIL = np.uint64(29)


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, whose Python workers import it; once for each application."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    root = Path(__file__).resolve().parent.parent
    path = Path(tempfile.mkdtemp(prefix="package-"), f"{root.name}.zip")
    with zipfile.ZipFile(path, "w") as packed:
        for file in sorted(root.rglob("*.py")):
            packed.write(file, file.relative_to(root.parent))
    # Spark serves the file from the driver, so executors need not see the driver's folders.
    context.addPyFile(str(path))
    _SHIPPED.add(context.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def id_column(name: str) -> Column:
    """The id as a long, a null as the largest one."""
    return F.coalesce(F.col(name).cast("long"), F.lit(NO_ID))


def buckets(spark: SparkSession) -> int:
    """Into how many groups packed rows are dealt: as many as shuffle partitions, so that it follows the data."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def words(text: str | None, lower: bool = False) -> list[bytes]:
    """Runs of anything but space and U+0009 to U+000D, in UTF-8; `lower` changes A-Z alone."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    return (raw.lower() if lower else raw).split()


def word_hashes(found: list[bytes], key: str | None = None) -> np.ndarray:
    """A 64-bit SipHash of every word, the same in every process; `key` (16 characters) stands for another such hash."""
    if not found:
        return np.zeros(0, np.uint64)
    held = np.empty(len(found), dtype=object)
    held[:] = found
    return pd.util.hash_array(held, categorize=False, **({"hash_key": key} if key else {}))


def sequence_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """A 64-bit hash of each `width` consecutive words; none if there are fewer words."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        mixed = hashes[:n].copy()
        for k in range(1, width):
            mixed ^= mixed >> _HALF
            mixed *= _STEP
            mixed += hashes[k : k + n]
        mixed ^= mixed >> _HALF
        mixed *= _LAST
        mixed ^= mixed >> _TAIL
    return mixed


def slices(batches: Iterator[pa.RecordBatch], column: str, most_bytes: int = 1 << 22) -> Iterator[pa.RecordBatch]:
    """The batches again, cut so that none holds much more than `most_bytes` of text in `column`.

    Nothing is left out: a single text beyond the bound comes in a batch of its own.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = np.nan_to_num(np.array(pa.compute.binary_length(batch[column]).to_numpy(zero_copy_only=False), dtype=float))
        groups = (np.cumsum(sizes) // most_bytes).astype(np.int64)
        edges = [0, *(np.flatnonzero(np.diff(groups)) + 1).tolist(), batch.num_rows]
        for a, b in zip(edges, edges[1:]):
            yield batch.slice(a, b - a)
