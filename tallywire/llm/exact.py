"""Exact de-duplication by progressive refinement: by length, then by the hash of a prefix, then by the full hash.

Texts are equal when they are identical after each run of space and U+0009 to U+000D has become one space. A null text
counts as empty. Of equal texts the row with the smallest id stays; a null id counts as the largest. Rows that repeat
both an id and its text are one document and share its verdict, so if it stays, all of them do. An empty table gives an
empty result. Only the id and the text are read, so further columns and their names do not matter.

Lengths and prefix hashes are narrow rows; the text itself is moved once, and only the documents that share length and
prefix with another are hashed whole. All groups are counted by partial aggregates, so a group may hold any share of
the rows; where rows meet their group again it is in a join that Spark splits when one key is hot.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from tallywire.llm.common import NO_ID, id_column, slices, stage

PREFIX_BYTES = 256


def normalised(text: str | None) -> bytes:
    """The text in UTF-8, each run of white space as one space."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    if not raw:
        return raw
    body = b" ".join(raw.split())
    if not body:
        return b" "
    return b" " * raw[:1].isspace() + body + b" " * raw[-1:].isspace()


def _outlines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        texts = [normalised(t) for t in batch["text"].to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [
                batch["id"],
                pa.array([len(t) for t in texts], pa.int64()),
                pa.array([xxhash.xxh3_64_intdigest(t[:PREFIX_BYTES]) - 2**63 for t in texts], pa.int64()),
            ],
            ["id", "size", "head"],
        )


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        found = [hashlib.sha256(normalised(t)).digest() for t in batch["text"].to_pylist()]
        yield pa.RecordBatch.from_arrays([batch["id"], pa.array(found, pa.binary())], ["id", "digest"])


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(id_column(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))


def text_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, digest: SHA-256 of the normalised text of every row."""
    return _texts(docs, id_col, text_col).mapInArrow(_digests, "id long, digest binary")


def duplicate_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """digest, keep_id, group_size of every text that more than one row has."""
    texts = _texts(docs, id_col, text_col)
    outlines = stage(texts.mapInArrow(_outlines, "id long, size long, head long"), "outlines")
    lengths = outlines.groupBy("size").agg(F.count("*").alias("rows")).where("rows > 1").select("size")
    lengths = stage(lengths, "lengths")
    # Stored groups let Spark split the join where a length is common; stored rows are counted where they are next.
    same_length = stage(outlines.join(lengths, "size", "left_semi"), "same-length")
    heads = same_length.groupBy("size", "head").agg(F.count("*").alias("rows")).where("rows > 1").select("size", "head")
    heads = stage(heads, "heads")
    open_ids = same_length.join(heads, ["size", "head"], "left_semi").select("id").distinct()
    full = texts.join(open_ids, "id", "left_semi").mapInArrow(_digests, "id long, digest binary")
    groups = full.groupBy("digest").agg(F.min("id").alias("keep_id"), F.count("*").alias("group_size"))
    return stage(groups.where("group_size > 1"), "copies")


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, digest, keep_id, group_size, kept for every row of `docs`."""
    groups = duplicate_groups(docs, id_col, text_col)
    rows = text_digests(docs, id_col, text_col).join(groups.hint("merge"), "digest", "left")
    keep = F.coalesce(F.col("keep_id"), F.col("id"))
    return rows.select(
        F.nullif("id", F.lit(NO_ID)).alias("id"),
        "digest",
        F.nullif(keep, F.lit(NO_ID)).alias("keep_id"),
        F.coalesce(F.col("group_size"), F.lit(1).cast("long")).alias("group_size"),
        (F.col("id") == keep).alias("kept"),
    )


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs` that stay, with all their columns."""
    groups = duplicate_groups(docs, id_col, text_col)
    # Repeated rows are united before the join; after it they would keep Spark from splitting a digest that many rows have.
    rows = text_digests(docs, id_col, text_col).distinct().join(groups.hint("merge"), "digest").where("id <> keep_id")
    gone = rows.select("id", "digest")
    row_id, row_digest = "__exact_id", "__exact_digest"
    digest = F.pandas_udf(lambda texts: texts.map(lambda t: hashlib.sha256(normalised(t)).digest()), "binary")
    marked = docs.withColumns({row_id: id_column(id_col), row_digest: digest(F.col(text_col).cast("string"))})
    renamed = gone.select(F.col("id").alias("__gone_id"), F.col("digest").alias("__gone_digest"))
    same = (F.col(row_id) == F.col("__gone_id")) & (F.col(row_digest) == F.col("__gone_digest"))
    return marked.join(renamed, same, "left_anti").drop(row_id, row_digest)
