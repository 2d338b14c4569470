"""WARC archives: writing records, and reading them back with a verified chain of record boundaries.

Writing. A page's payload is its html in UTF-8 (null: empty). Of pages with equal payloads of at least `LEAST_BYTES`
bytes, the one with the smallest page_id is a response, the others are revisits that name it; smaller payloads are all
responses. A null page_id sorts behind all others and is written without its header; a null url likewise; rows that
repeat a page are written again, and a repeat of the response is a response too. White space and control characters of
a url are percent-encoded. An empty table writes no records. Archives are plain `.warc` bytes; Spark writes them as
text files whose lines end with the last line feed of each record, so any store that Spark reaches will do.

Reading. The record magic may stand inside a payload, and a reader that starts in the middle of a file cannot tell.
So every task emits each place with the magic as a candidate, together with where its record would end, that is, its
successor. Only candidates that the chain from the start of the file reaches are records. Within a split the chain is
followed in one pass; between splits pointers are jumped, doubling each round. Payloads are digested by the task that
meets them; the few records that go on past the end of a split are put together afterwards, at most one for a split.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tallywire.llm.common import NO_ID, id_column, stage
from tallywire.session import work_dir

MAGIC = b"WARC/1.1\r\n"
LEAST_BYTES = 100
# The end of a record; Spark's text writer adds the line feed.
CLOSING = "\r\n\r"

_NUMBER = re.compile(rb"[0-9]{1,18}")


def _header(name: str, value) -> Column:
    return F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))


def write_archives(pages: DataFrame, path: str) -> None:
    """Write a record for every row of `pages` (page_id, url, html) below `path`."""
    payload = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(id_column("page_id").alias("id"), F.col("url").cast("string").alias("url"), payload.alias("body"))
    digest = F.sha2(F.encode("body", "UTF-8"), 256)
    large = rows.where(F.octet_length("body") >= LEAST_BYTES).select("id", digest.alias("digest"))
    first = large.groupBy("digest").agg(F.min("id").alias("first"), F.max("id").alias("last")).where("first < last")
    first = stage(first, "first-pages")
    # What refers to another page is told by id, so that bodies are not moved while this stays small.
    repeats = large.join(first, "digest").where("id > first").select("id", "digest", "first").distinct()
    repeats = stage(repeats, "repeats")
    told = rows.withColumn("sha", digest).join(
        repeats.select("id", F.col("digest").alias("sha"), "first"), ["id", "sha"], "left"
    )
    again = F.col("first").isNotNull()
    unsafe = F.regexp_replace(F.col("url"), r"[\x00-\x20\x7F]", "%20")
    block = F.when(again, F.lit("")).otherwise(F.col("body"))
    record = F.concat(
        F.lit(MAGIC.decode()),
        _header("WARC-Type", F.when(again, F.lit("revisit")).otherwise(F.lit("response"))),
        F.when(F.col("id") < NO_ID, _header("X-Page-ID", F.col("id").cast("string"))).otherwise(F.lit("")),
        F.coalesce(_header("WARC-Target-URI", unsafe), F.lit("")),
        _header("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("sha"))),
        F.coalesce(_header("X-Refers-To-Page-ID", F.col("first").cast("string")), F.lit("")),
        _header("X-Payload-Length", F.octet_length("body").cast("string")),
        F.lit("Content-Type: text/html; charset=utf-8\r\n"),
        _header("Content-Length", F.octet_length(block).cast("string")),
        F.lit("\r\n"),
        block,
        F.lit(CLOSING),
    )
    told.select(record.alias("value")).write.text(path, lineSep="\n")


class _Open:
    """A candidate whose block is still being read."""

    def __init__(self, row: list, left: int):
        self.row, self.left, self.digest = row, left, hashlib.sha256()

    def take(self, data: bytes) -> None:
        part = data[: self.left]
        self.digest.update(part)
        self.left -= len(part)


def parse_header(data: bytes) -> tuple[dict[bytes, bytes], int] | None:
    """Header fields by lower-case name and the length of the header, or nothing if it is not one."""
    end = data.find(b"\r\n\r\n")
    if end < 0:
        return None
    fields = {}
    for line in data[:end].split(b"\r\n"):
        name, colon, value = line.partition(b":")
        if not colon:
            return None
        fields[name.strip().lower()] = value.strip()
    if not _NUMBER.fullmatch(fields.get(b"content-length", b"")) or b"warc-type" not in fields:
        return None
    return fields, end + 4


_FOUND = (
    "file string, block long, local long, size long, total long, done boolean, page_id long, record_type string, "
    "refers_to long, said_bytes long, said_digest string, block_digest string, block_bytes long"
)
_SCHEMA = pa.schema(
    [
        ("file", pa.string()), ("block", pa.int64()), ("local", pa.int64()), ("size", pa.int64()), ("total", pa.int64()),
        ("done", pa.bool_()), ("page_id", pa.int64()), ("record_type", pa.string()), ("refers_to", pa.int64()),
        ("said_bytes", pa.int64()), ("said_digest", pa.string()), ("block_digest", pa.string()), ("block_bytes", pa.int64()),
    ]
)


def _number(value: bytes | None) -> int | None:
    return int(value) if value and _NUMBER.fullmatch(value) else None


def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every fragment between two magics of a split, as a candidate record; `local` counts bytes in the split."""
    place, at, open_records, rows = None, 0, [], []

    def close(record: _Open, done: bool) -> list:
        return [*record.row[:5], done, *record.row[6:11], record.digest.hexdigest() if done else None, record.row[12]]

    for batch in batches:
        for file, block, data in zip(batch["file"].to_pylist(), batch["block"].to_pylist(), batch["data"].to_pylist()):
            if (file, block) != place:
                rows += [close(r, False) for r in open_records]
                place, at, open_records = (file, block), 0, []
            for record in open_records:
                record.take(MAGIC)
                record.take(data)
            rows += [close(r, True) for r in open_records if not r.left]
            open_records = [r for r in open_records if r.left]
            row = [file, block, at, len(data) + len(MAGIC), *[None] * 9]
            at += row[3]
            parsed = parse_header(data)
            if parsed is None:
                rows.append(row)
            else:
                fields, length = parsed
                size = int(fields[b"content-length"])
                row[4] = len(MAGIC) + length + size + 4
                row[6] = _number(fields.get(b"x-page-id"))
                row[7] = fields[b"warc-type"].decode("utf-8", "replace")
                row[8] = _number(fields.get(b"x-refers-to-page-id"))
                row[9] = _number(fields.get(b"x-payload-length"))
                row[10] = fields.get(b"warc-payload-digest", b"").decode("utf-8", "replace").removeprefix("sha256:")
                row[12] = size
                record = _Open(row, size)
                record.take(data[length:])
                if record.left:
                    open_records.append(record)
                else:
                    rows.append(close(record, True))
        if len(rows) > 10_000:
            yield pa.RecordBatch.from_pylist([dict(zip(_SCHEMA.names, r)) for r in rows], _SCHEMA)
            rows = []
    rows += [close(r, False) for r in open_records]
    if rows:
        yield pa.RecordBatch.from_pylist([dict(zip(_SCHEMA.names, r)) for r in rows], _SCHEMA)


def _fragments(spark: SparkSession, path: str) -> DataFrame:
    """file, block (where the split starts), data: what lies between magics; the empty start of a file included.

    The first fragment of a file is what precedes its first magic, and has no magic of its own.
    """
    lines = spark.read.option("lineSep", MAGIC.decode()).schema("value string").text(path)
    place = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")]
    return lines.select(*place, F.col("value").cast("binary").alias("data"))


def _exits(rows: pa.Table) -> pa.Table:
    """For every candidate of one split, where the chain leaves the split."""
    known: dict[int, int | None] = {}
    order = sorted(zip(rows["start"].to_pylist(), rows["next"].to_pylist(), strict=True), reverse=True)
    last = order[0][0]
    for start, after in order:
        known[start] = after if after is None or after > last else known.get(after)
    file = rows["file"][0].as_py()
    return pa.table({"file": [file] * len(known), "start": list(known), "leap": pa.array(known.values(), pa.int64())})


def _walked(rows: pa.Table) -> pa.Table:
    """The candidates of one split that are reached from the place where the chain enters it."""
    after = dict(zip(rows["start"].to_pylist(), rows["next"].to_pylist(), strict=True))
    at, found = rows["enter"][0].as_py(), []
    while at in after:
        found.append(at)
        at = after[at]
    return pa.table({"file": pa.array([rows["file"][0].as_py()] * len(found), pa.string()), "start": pa.array(found, pa.int64())})


def reachable(candidates: DataFrame) -> DataFrame:
    """file, start of the candidates (file, block, start, next) that the chain from the start of their file reaches."""
    leaps = candidates.groupBy("file", "block").applyInArrow(_exits, "file string, start long, leap long")
    leaps = stage(leaps.where("leap IS NOT NULL"), "leaps")
    found = stage(candidates.where("start = 0").select("file", "start").distinct(), "found")
    count = found.count()
    while True:
        further = found.join(leaps, ["file", "start"]).select("file", F.col("leap").alias("start"))
        found = stage(further.unionByName(found).distinct(), "found")
        before, count = count, found.count()
        # As many places as before: every chain has come to its end.
        if count == before:
            break
        twice = leaps.select("file", F.col("start").alias("from"), F.col("leap").alias("start")).join(leaps, ["file", "start"])
        leaps = stage(twice.select("file", F.col("from").alias("start"), "leap"), "leaps")
    entered = candidates.join(found, ["file", "start"]).select("file", "block", F.col("start").alias("enter"))
    entered = entered.groupBy("file", "block").agg(F.min("enter").alias("enter"))
    rows = candidates.join(entered, ["file", "block"]).select("file", "start", "next", "enter", "block")
    return rows.groupBy("file", "block").applyInArrow(_walked, "file string, start long")


def _offsets(found: DataFrame) -> DataFrame:
    """file, block, base: where in its file the magic of the first fragment of a split stands; fragments tile the file."""
    sizes = found.groupBy("file", "block").agg(F.sum("size").alias("bytes"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    # A window over the splits of one file, of which there are as many as its size allows.
    base = F.coalesce(F.sum("bytes").over(before), F.lit(0)) - len(MAGIC)
    return sizes.select("file", "block", base.alias("base"))


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """page_id, record_type, refers_to, payload_bytes, payload_digest of every record of the archives below `path`.

    A response's size and digest come from the bytes read; `valid` tells whether they are those its header names.
    A revisit's are those of its header.
    """
    found = stage(_fragments(spark, path).mapInArrow(_candidates, _FOUND), "fragments")
    bases = _offsets(found)
    # The first fragment of a file is what stands before its first magic, and gets a negative place.
    placed = found.join(bases, ["file", "block"]).withColumn("start", F.col("base") + F.col("local"))
    candidates = stage(
        placed.where("start >= 0").drop("base").withColumn("next", F.expr("start + total")),
        "candidates",
    )
    records = candidates.join(reachable(candidates.select("file", "block", "start", "next")), ["file", "start"], "left_semi")
    records = stage(records.where("total IS NOT NULL"), "records")

    split = records.where("NOT done").select("file", "start", "next", "block")
    if not split.isEmpty():
        # At most one record runs over the end of each split, so this table is no larger than the list of splits.
        parts = _fragments(spark, path).mapInArrow(_pieces, "file string, block long, local long, size long, data binary")
        parts = parts.join(F.broadcast(bases), ["file", "block"]).withColumn("at", F.col("base") + F.col("local"))
        spans = F.broadcast(split.select("file", F.col("start").alias("from"), "next"))
        parts = parts.join(spans, "file").where("at >= from AND at < next").select("file", "from", "at", "data")
        joined = parts.groupBy("file", "from").applyInArrow(_joined, "file string, start long, digest string")
        records = records.join(joined, ["file", "start"], "left")
    else:
        records = records.withColumn("digest", F.lit(None).cast("string"))
    revisit = F.col("record_type") == "revisit"
    read_digest = F.coalesce("block_digest", "digest")
    digest = F.when(revisit, F.col("said_digest")).otherwise(read_digest)
    size = F.when(revisit, F.col("said_bytes")).otherwise(F.col("block_bytes"))
    valid = revisit | ((read_digest == F.col("said_digest")) & (F.col("block_bytes") == F.col("said_bytes")))
    return records.select(
        "page_id",
        "record_type",
        "refers_to",
        size.alias("payload_bytes"),
        digest.alias("payload_digest"),
        F.coalesce(valid, F.lit(False)).alias("valid"),
    )


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    place, at = None, 0
    for batch in batches:
        local, size = [], []
        for file, block, data in zip(batch["file"].to_pylist(), batch["block"].to_pylist(), batch["data"]):
            if (file, block) != place:
                place, at = (file, block), 0
            size.append(len(data.as_buffer()) + len(MAGIC))
            local.append(at)
            at += size[-1]
        columns = [batch["file"], batch["block"], pa.array(local, pa.int64()), pa.array(size, pa.int64()), batch["data"]]
        yield pa.RecordBatch.from_arrays(columns, ["file", "block", "local", "size", "data"])


def _joined(rows: pa.Table) -> pa.Table:
    """The digest of the block of one record, put together from its fragments."""
    rows = rows.sort_by("at")
    data = MAGIC.join(rows["data"].to_pylist())
    fields, length = parse_header(data)
    block = data[length : length + int(fields[b"content-length"])]
    return pa.table(
        {
            "file": rows["file"][:1].cast(pa.string()),
            "start": rows["from"][:1],
            "digest": pa.array([hashlib.sha256(block).hexdigest()]),
        }
    )


def archive_round_trip(pages: DataFrame) -> DataFrame:
    """Write `pages` as archives in the shared folder and read them back."""
    spark = pages.sparkSession
    path = work_dir(spark, "warc")
    write_archives(pages, path)
    return read_archives(spark, path)
