"""Substring de-duplication with difference-cover anchors.

A window is `WINDOW` consecutive words of one text (words end at space and U+0009 to U+000D and are compared as they
are). A word goes when some window that covers it also starts in a text with a smaller id. Windows are judged on the
input. A null or empty text has no words and loses none; rows that repeat an id are the same document, so what they
share with each other does not go, but each is judged by its own text; rows without an id are documents of their own
behind all ids, in the order of the digests of their words, and those with the same words are one document; an empty
table gives an empty result. Only id and text are read.

Method: positions are taken modulo 7, and {0, 1, 3} is a difference cover: whatever two positions are, at most six
steps on both stand on cover positions at once. So of two equal windows of 13 words at any two positions, both hold the
same 7 words at a cover position, and hashing 7 words at three of seven positions finds every shared window. Anchors
that two documents have are extended: the whole windows around them are hashed to 128 bits, and the smallest document of
each window is found; windows with equal hashes count as equal. Both searches pack (hash, document) into arrays, one for each bucket of hashes and batch of documents;
what a batch already knows of its own documents goes to them directly, so a hash adds at most one entry a batch to its
bucket, however common it is. Texts move once, and again only where an anchor was found in another document. A document
whose whole word sequence is that of an earlier one is known by its digest and takes no part in the second search.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tallywire.llm.common import NO_ID, buckets, id_column, sequence_hashes, slices, stage, word_hashes, words

WINDOW = 13
PERIOD = 7
COVER = (0, 1, 3)
ANCHOR = WINDOW - PERIOD + 1

# Bytes of a hash that are kept beside its bucket. For anchors five do: a chance hit only costs a look at more windows,
# and a bucket holds about the same number of them at any size of the corpus. What is deleted is decided by the windows,
# so those keep all of two hashes with keys of their own, 128 bits. Which windows of one document were found is then told
# by the first hash alone.
ANCHOR_BYTES, WINDOW_BYTES, TOLD_BYTES = 5, 16, 8

# At most about so many words of the corpus go into one group of packed hashes.
GROUP_WORDS = 8_000_000

_SECOND_KEY = "substring-second"

_PACKED = "bucket int, hashes binary, ids binary, known boolean"


def squeeze(values: np.ndarray, width: int = 8) -> bytes:
    """The low `width` bytes of each value or pair of values, all lowest bytes first, so that bytes alike stand together."""
    columns = values.shape[1] if values.ndim == 2 else 1
    return np.ascontiguousarray(values, "<u8").view(np.uint8).reshape(len(values), 8 * columns)[:, :width].T.tobytes()


def expand(data: bytes, width: int = 8) -> np.ndarray:
    """The values, or pairs of values if `width` is beyond one."""
    planes = np.frombuffer(data, np.uint8).reshape(width, -1)
    out = np.zeros((planes.shape[1], 8 * -(-width // 8)), np.uint8)
    out[:, :width] = planes.T
    found = out.view("<u8")
    return found if width > 8 else found.ravel()


def _keys(hashes: np.ndarray) -> list[np.ndarray]:
    """What to sort hashes by, least important first."""
    return [hashes] if hashes.ndim == 1 else [*hashes.T[::-1]]


def _changes(hashes: np.ndarray) -> np.ndarray:
    """Whether each value, or pair of them, differs from the one before it; the first does."""
    apart = hashes[1:] != hashes[:-1]
    return np.r_[True, apart if hashes.ndim == 1 else apart.any(axis=1)][: len(hashes)]


def _pack_rows(bucket: np.ndarray, ids: np.ndarray, hashes: np.ndarray, width: int, known: bool) -> Iterator[tuple]:
    """One packed row for each bucket; ids ascend and are kept as differences."""
    order = np.lexsort((ids, bucket))
    bucket, ids, hashes = bucket[order], ids[order].view(np.uint64), hashes[order]
    begins = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]) if len(bucket) else []
    for a, b in zip(begins, [*begins[1:], len(bucket)]):
        yield int(bucket[a]), squeeze(hashes[a:b], width), squeeze(np.diff(ids[a:b], prepend=np.uint64(0))), known


def _unpack(rows: pa.Table, width: int) -> tuple[np.ndarray, np.ndarray]:
    ids = [np.cumsum(expand(x)) for x in rows["ids"].to_pylist()]
    hashes = [expand(x, width) for x in rows["hashes"].to_pylist()]
    if not ids:
        return np.zeros(0, np.int64), expand(b"", width)
    return np.concatenate(ids).view(np.int64), np.concatenate(hashes)


def _table(rows: Iterator[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [[], [], [], []]
    kinds = (pa.int32(), pa.binary(), pa.binary(), pa.bool_())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["bucket", "hashes", "ids", "known"])


def _by_document(ids: np.ndarray, into: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return (ids.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)) % np.uint64(into)


def cover_positions(n: int) -> np.ndarray:
    at = np.arange(max(n, 0))
    return at[np.isin(at % PERIOD, COVER)]


def low(hashes: np.ndarray, width: int) -> np.ndarray:
    """The part of a hash that is kept beside its bucket."""
    return hashes & np.uint64((1 << 8 * width) - 1)


def anchors(hashes: np.ndarray) -> np.ndarray:
    """Hashes of the anchors of a text, given those of its words."""
    found = sequence_hashes(hashes, ANCHOR)
    return found[cover_positions(len(found))]


def open_windows(hashes: np.ndarray, shared: np.ndarray) -> np.ndarray:
    """Starts of the windows that hold a shared anchor."""
    n = len(hashes) - WINDOW + 1
    found = sequence_hashes(hashes, ANCHOR)
    at = cover_positions(len(found))
    at = at[np.isin(low(found[at], ANCHOR_BYTES), shared)]
    starts = np.unique((at[:, None] - np.arange(PERIOD)[None, :]).ravel())
    return starts[(starts >= 0) & (starts < n)]


def window_hashes(found: list[bytes], hashes: np.ndarray) -> np.ndarray:
    """Two hashes of every window of the words, in a row for each window, given the first hash of each word."""
    return np.stack([sequence_hashes(hashes, WINDOW), sequence_hashes(word_hashes(found, _SECOND_KEY), WINDOW)], axis=1)


def _packed(ids: np.ndarray, hashes: np.ndarray, into: int, width: int, smallest_stays: bool) -> Iterator[tuple]:
    """A batch's distinct (document, hash) pairs: those already known as found, and one entry for each hash.

    What is known is dealt by document, so that a common hash does not gather its documents in one bucket.
    """
    if not len(ids):
        return
    order = np.lexsort((ids, *_keys(hashes)))
    ids, hashes = ids[order], hashes[order]
    first = _changes(hashes)
    new = first | np.r_[True, ids[1:] != ids[:-1]]
    ids, hashes, first = ids[new], hashes[new], first[new]
    known = ~first
    if not smallest_stays:
        known[:-1] |= known[1:] & first[:-1]
    yield from _pack_rows(_by_document(ids[known], into), ids[known], hashes[known], min(width, TOLD_BYTES), True)
    # Other batches have to see the smallest document of each hash, whatever is known of it here.
    ids, hashes = ids[first], hashes[first]
    lead = hashes if hashes.ndim == 1 else hashes[:, 0]
    yield from _pack_rows((lead >> np.uint64(40)) % np.uint64(2 * into), ids, hashes, width, False)


def _pack(hashes_of: Callable, into: int, width: int, smallest_stays: bool, most: int = 1_000_000) -> Callable:
    """A step for mapInArrow: batches with id and text to packed rows, `most` hashes at a time."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, hashes, held = [], [], 0
        for batch in slices(batches, "text"):
            for row in batch.to_pylist():
                found = hashes_of(row)
                ids.append(np.full(len(found), row["id"], np.int64))
                hashes.append(found)
                held += len(found)
                if held > most:
                    yield _table(_packed(np.concatenate(ids), np.concatenate(hashes), into, width, smallest_stays))
                    ids, hashes, held = [], [], 0
        if ids:
            yield _table(_packed(np.concatenate(ids), np.concatenate(hashes), into, width, smallest_stays))

    return step


def _meet(into: int, width: int, smallest_stays: bool) -> Callable:
    """A step for applyInArrow: the packed rows of one bucket to packed rows of what is found, dealt by document."""

    def step(rows: pa.Table) -> pa.Table:
        known = rows["known"]
        told = rows.filter(known)
        i, h = _unpack(rows.filter(pa.compute.invert(known)), width)
        order = np.lexsort((i, *_keys(h)))
        i, h = i[order], h[order]
        if len(h):
            new = _changes(h)
            begins, group = np.flatnonzero(new), np.cumsum(new) - 1
            least, most = i[begins][group], i[np.r_[begins[1:], len(i)] - 1][group]
            found = i > least if smallest_stays else most > least
            i, h = i[found], h[found]
        met = _table(_pack_rows(_by_document(i, into), i, h, min(width, TOLD_BYTES), True))
        return pa.concat_tables([told.select(met.schema.names).cast(met.schema), pa.Table.from_batches([met])])

    return step


def _gather(width: int) -> Callable:
    """A step for applyInArrow: the packed rows of one bucket of documents to a row for each document."""

    def step(rows: pa.Table) -> pa.Table:
        i, h = _unpack(rows, width)
        order = np.lexsort((h, i))
        i, h = i[order], h[order]
        begins = np.flatnonzero(np.r_[True, i[1:] != i[:-1]]) if len(i) else np.zeros(0, int)
        packed = [squeeze(h[a:b], width) for a, b in zip(begins, np.r_[begins[1:], len(i)])]
        return pa.table({"id": pa.array(i[begins], pa.int64()), "hashes": pa.array(packed, pa.binary())})

    return step


def _groups(spark: SparkSession, n_words: int) -> int:
    """Into how many groups hashes are packed: as many as shuffle partitions, or more if that makes them too large."""
    return max(buckets(spark), -(-n_words // GROUP_WORDS))


def _shared(texts: DataFrame, hashes_of: Callable, width: int, smallest_stays: bool, into: int) -> DataFrame:
    """id, hashes: for each document the packed hashes it shares with another, or with one that has a smaller id."""
    packed = texts.mapInArrow(_pack(hashes_of, into, width, smallest_stays), _PACKED)
    met = packed.repartition(2 * into, "bucket").groupBy("bucket").applyInArrow(_meet(into, width, smallest_stays), _PACKED)
    return met.repartition(into, "bucket").groupBy("bucket").applyInArrow(_gather(min(width, TOLD_BYTES)), "id long, hashes binary")


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        split = [words(t) for t in batch["text"].to_pylist()]
        found = pa.array([hashlib.sha256(b" ".join(w)).digest() for w in split], pa.binary())
        sizes = pa.array([len(w) for w in split], pa.int64())
        yield pa.RecordBatch.from_arrays([batch["id"], batch["text"], found, sizes], ["id", "text", "digest", "n"])


def _copies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _digested(batches):
        yield batch.select(["id", "digest", "n"])


def _with_digests(texts: DataFrame) -> DataFrame:
    return texts.mapInArrow(_digested, "id long, text string, digest binary, n long").drop("n")


def _numbered(texts: DataFrame, digests: DataFrame) -> tuple[DataFrame, DataFrame, int]:
    """Both tables with numbers behind all ids in place of null ids, one for each digest; and the largest id."""
    nameless = F.col("id") == NO_ID
    last = digests.agg(F.max(F.when(~nameless, F.col("id"))).alias("last"), F.max(nameless).alias("some")).first()
    largest = last["last"] if last["last"] is not None else 0
    if not last["some"]:
        return texts, digests, NO_ID - 1
    found = digests.where(nameless).select("digest").distinct().orderBy("digest")
    # Stored, so that the order is one and the same wherever the numbers are used.
    found = stage(found.select("digest", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at")), "without-id")
    parts = found.groupBy("part").agg(F.count("*").alias("n"), F.min("at").alias("begin"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", "begin", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    numbers = found.join(F.broadcast(parts), "part").select("digest", (F.col("at") - F.col("begin") + F.col("before") + 1).alias("number"))
    if numbers.count() >= NO_ID - largest:
        raise ValueError("no numbers are left behind the largest id for rows without one")
    number = (F.col("number") + F.lit(largest)).alias("id")
    rows = _with_digests(texts.where(nameless)).join(numbers, "digest").select(number, "text")
    told = digests.where(nameless).join(numbers, "digest").select(number, "digest")
    return texts.where(~nameless).unionByName(rows), digests.where(~nameless).unionByName(told), largest


def _later_copies(digests: DataFrame) -> DataFrame:
    """id, digest of the texts whose words are, all and in order, those of a document with a smaller id."""
    first = digests.groupBy("digest").agg(F.min("id").alias("first"), F.max("id").alias("last")).where("first < last")
    # Both sides of the join come from a shuffle of their own and neither is broadcast after it, so Spark can split a
    # digest that very many documents have.
    first = stage(first, "first-copies").hint("merge")
    return digests.distinct().join(first, "digest").where("id > first").select("id", "digest")


def _anchor_hashes(row: dict) -> np.ndarray:
    return anchors(word_hashes(words(row["text"])))


def _window_hashes(row: dict) -> np.ndarray:
    found = words(row["text"])
    hashes = word_hashes(found)
    return window_hashes(found, hashes)[open_windows(hashes, expand(row["hashes"], ANCHOR_BYTES))]


def removed_words(text: str | None, repeated: bytes | None, copy: bool | None = None) -> tuple[list[bytes], np.ndarray]:
    """The words of a text and whether each goes, given its packed hashes of repeated windows.

    All words of a copy of an earlier document go, if they make a window at all.
    """
    found = words(text)
    if copy:
        return found, np.full(len(found), len(found) >= WINDOW)
    gone = np.zeros(len(found) + 1, np.int64)
    if repeated:
        starts = np.flatnonzero(np.isin(sequence_hashes(word_hashes(found), WINDOW), expand(repeated, TOLD_BYTES)))
        np.add.at(gone, starts, 1)
        np.add.at(gone, starts + WINDOW, -1)
    return found, np.cumsum(gone)[:-1] > 0


def _judged(batch: pa.RecordBatch) -> Iterator[tuple[list[bytes], np.ndarray]]:
    for row in batch.to_pylist():
        yield removed_words(row["text"], row["hashes"], row["copy"])


def _reports(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        total, lost, digests = [], [], []
        for found, gone in _judged(batch):
            kept = [w for w, g in zip(found, gone) if not g] if gone.any() else found
            total.append(len(found))
            lost.append(len(found) - len(kept))
            digests.append(hashlib.sha256(b" ".join(kept)).hexdigest())
        columns = [batch["id"], pa.array(total, pa.int64()), pa.array(lost, pa.int64()), pa.array(digests, pa.string())]
        yield pa.RecordBatch.from_arrays(columns, ["id", "n_words", "n_removed", "kept_sha256"])


def _cleaned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        kept = [b" ".join(w for w, g in zip(found, gone) if not g) for found, gone in _judged(batch)]
        texts = pa.array([k.decode("utf-8", "surrogatepass") for k in kept], pa.string())
        yield pa.RecordBatch.from_arrays([batch["id"], texts], ["id", "text"])


def repeated_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_words, n_removed, kept_sha256 (of the kept words joined by one space) for every row of `docs`."""
    return _finish(docs, id_col, text_col, _reports, "id long, n_words long, n_removed long, kept_sha256 string")


def remove_repeated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, text (the kept words joined by one space) for every row of `docs`."""
    return _finish(docs, id_col, text_col, _cleaned, "id long, text string")


def _finish(docs: DataFrame, id_col: str, text_col: str, step: Callable, schema: str) -> DataFrame:
    texts = docs.select(id_column(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    digests = stage(texts.mapInArrow(_copies, "id long, digest binary, n long"), "word-digests")
    into = _groups(docs.sparkSession, digests.agg(F.sum("n")).first()[0] or 0)
    texts, digests, largest = _numbered(texts, digests.drop("n"))
    told = stage(_shared(texts, _anchor_hashes, ANCHOR_BYTES, False, into), "anchors")
    # An id that repeats may stand for a copy and for other texts, so a verdict goes by id and digest.
    told = told.join(digests.distinct(), "id").join(_later_copies(digests).withColumn("copy", F.lit(True)), ["id", "digest"], "full")
    # A later copy is judged by its being one, so its anchors need not come along.
    told = told.select("id", "digest", F.expr("CASE WHEN copy IS NULL THEN hashes END").alias("hashes"), "copy")
    # The one join that moves every text; what shares nothing, or all, is finished at once and its text left behind.
    placed = _with_digests(texts).join(told, ["id", "digest"], "left").drop("digest")
    columns = [c.split() for c in schema.split(", ")]
    names = [name for name, _ in columns]
    kinds = {"long": pa.int64(), "string": pa.string()}

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shares = pa.compute.is_valid(batch["hashes"])
            alone, rest = batch.filter(pa.compute.invert(shares)), batch.filter(shares)
            for done in step(iter([alone])):
                extra = [pa.nulls(done.num_rows, pa.string()), pa.nulls(done.num_rows, pa.binary())]
                yield pa.RecordBatch.from_arrays([*done.columns, *extra], [*names, "open_text", "hashes"])
            if rest.num_rows:
                blank = [pa.nulls(rest.num_rows, kinds[kind]) for _, kind in columns[1:]]
                yield pa.RecordBatch.from_arrays([rest["id"], *blank, rest["text"], rest["hashes"]], [*names, "open_text", "hashes"])

    parts = stage(placed.mapInArrow(split, f"{schema}, open_text string, hashes binary"), "parts")
    done = parts.where("hashes IS NULL").select(*names)
    rest = parts.where("hashes IS NOT NULL").select("id", F.col("open_text").alias("text"), "hashes")
    repeated = _shared(rest, _window_hashes, WINDOW_BYTES, True, into)
    judged = rest.drop("hashes").join(repeated, "id", "left").withColumn("copy", F.lit(False)).mapInArrow(step, schema)
    return done.unionByName(judged).withColumn("id", F.when(F.col("id") <= largest, F.col("id")))
