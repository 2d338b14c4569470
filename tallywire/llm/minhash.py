"""Near-duplicates by MinHash: universal hash minima, banding, verified signatures, and connected components.

A document's set holds its distinct shingles of `width` words (a-z for A-Z, words end at space and U+0009 to U+000D); a
document with fewer words has its whole word sequence as the only shingle, one without words or with a null text has an
empty set and is linked with nothing. Two documents are linked when 100 * common >= percent * union, counted on the
full sets. Documents with equal sets form a class, which takes part once. A null id sorts behind every other id; rows
that repeat an id or a text are rows of their own with the same answer; an empty table gives an empty result. Only id
and text are read, whatever else the table holds.

A class is told by 128 bits of its set and has a number of its own, its node, in all that follows.

Candidates are classes that agree on one of 32 bands of 4 minima, which a pair at the limit misses once in 200,000
times. In a bucket all members are compared with one hub instead of with each other, so a large group of copies costs
one comparison a member; the hub is the member that shares most buckets with most others, which is the copy that is
changed least. Buckets whose members are then still in different components are finished by comparing across
components. A pair is made only in the first bucket it shares, and only if longer signatures of `FINE` minima, four
bits of each, agree as often as those of a linked pair do but for four standard deviations; all such pairs are then
held against the full sets. Nothing is capped: this last step grows with the pairs that are almost alike, not with the
square of a group of copies, whose members the hubs have joined.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from tallywire.llm.common import NO_ID, id_column, sequence_hashes, slices, stage, word_hashes, words
from tallywire.llm.graph import components

WIDTH = 5
PERCENT = 75
ROWS, BANDS = 4, 32
HASHES = ROWS * BANDS
# Signatures of a pair at the limit agree less often than this once in 50,000 times (four standard deviations).
AGREE = 75
FINE = 512
FINE_AGREE = 352

_DRAW = np.random.default_rng(20240229)
_FACTORS = (_DRAW.integers(0, 2**63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1))[:, None]
_ADDENDS = _DRAW.integers(0, 2**64, HASHES, dtype=np.uint64)[:, None]
_FINE_FACTORS = (_DRAW.integers(0, 2**63, FINE, dtype=np.uint64) * np.uint64(2) + np.uint64(1))[:, None]
_FINE_ADDENDS = _DRAW.integers(0, 2**64, FINE, dtype=np.uint64)[:, None]


def shingles(text: str | None, width: int = WIDTH) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles."""
    hashes = word_hashes(words(text, lower=True))
    if not len(hashes):
        return hashes
    return np.unique(sequence_hashes(hashes, min(width, len(hashes))))


def _minima(found: np.ndarray, factors: np.ndarray, addends: np.ndarray) -> np.ndarray:
    """The minima of universal hash functions (multiply and add modulo 2**64) over a set."""
    least = np.full(len(factors), np.iinfo(np.uint64).max, np.uint64)
    with np.errstate(over="ignore"):
        for at in range(0, len(found), 1024):
            hashed = factors * found[None, at : at + 1024]
            hashed += addends
            np.minimum(least, hashed.min(axis=1), out=least)
    return least


def signature(found: np.ndarray) -> np.ndarray:
    """The upper halves of the `HASHES` minima of a set."""
    return (_minima(found, _FACTORS, _ADDENDS) >> np.uint64(32)).astype("<u4")


def fine_signature(found: np.ndarray) -> np.ndarray:
    """Four bits of each of `FINE` minima, sixteen to a long."""
    bits = (_minima(found, _FINE_FACTORS, _FINE_ADDENDS) >> np.uint64(36)) & np.uint64(15)
    shifts = np.arange(0, 64, 4, dtype=np.uint64)
    return np.bitwise_or.reduce(bits.reshape(-1, 16) << shifts, axis=1).view(np.int64)


def _mark(found: np.ndarray) -> bytes:
    """128 bits that tell a set from others."""
    return xxhash.xxh3_128_digest(found.tobytes(), seed=len(found))


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        sets = [shingles(t) for t in batch["text"].to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [
                batch["id"],
                batch["digest"],
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array([_mark(s) if len(s) else None for s in sets], pa.binary()),
                pa.array([signature(s).tobytes() if len(s) else None for s in sets], pa.binary()),
            ],
            ["id", "digest", "size", "mark", "signature"],
        )


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        sets = [shingles(t) for t in batch["text"].to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [pa.array([_mark(s) for s in sets], pa.binary()), pa.array([s.tobytes() for s in sets], pa.binary())],
            ["mark", "shingles"],
        )


def _agreeing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            a, b = (np.frombuffer(b"".join(batch[c].to_pylist()), "<u4").reshape(-1, HASHES) for c in ("sa", "sb"))
            keep = pa.array((a == b).sum(axis=1) >= AGREE)
            yield batch.select(["a", "b"]).filter(keep)


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = []
        for left, right in zip(batch["la"], batch["lb"]):
            a, b = (np.frombuffer(x.as_buffer(), np.uint64) for x in (left, right))
            common = len(np.intersect1d(a, b, assume_unique=True))
            keep.append(100 * common >= PERCENT * (len(a) + len(b) - common))
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _band_keys(signatures: np.ndarray) -> np.ndarray:
    """A 64-bit key for each band of each signature (rows of `HASHES` minima)."""
    parts = signatures.reshape(-1, BANDS, ROWS).astype(np.uint64)
    keys = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64) << np.uint64(40), parts.shape[:2]).copy()
    for k in range(ROWS):
        keys = _mixed(keys, parts[:, :, k])
    return keys


def _mixed(keys: np.ndarray, more: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        keys = (keys ^ (keys >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15) + more
        keys = (keys ^ (keys >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return keys ^ (keys >> np.uint64(32))


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 2000):
            part = batch.slice(at, 2000)
            keys = _band_keys(np.frombuffer(b"".join(part["signature"].to_pylist()), "<u4").reshape(-1, HASHES))
            own = [np.repeat(part[c].to_numpy(), BANDS) for c in ("node", "size")]
            yield pa.RecordBatch.from_arrays([*map(pa.array, own), pa.array(keys.ravel().view(np.int64))], ["node", "size", "key"])


def _fine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in batch["shingles"]]
        fine = [fine_signature(s).tolist() for s in sets]
        keys = [_band_keys(signature(s)).ravel().view(np.int64).tolist() for s in sets]
        longs = pa.list_(pa.int64())
        yield pa.RecordBatch.from_arrays([batch["node"], pa.array(fine, longs), pa.array(keys, longs)], ["node", "fine", "keys"])


def _shared_buckets(classes: DataFrame) -> DataFrame:
    """node, size, key, pop of every class in each bucket that has others; pop counts the others in all its buckets."""
    members = classes.select("node", "size", "signature").mapInArrow(_members, "node long, size long, key long")
    counts = stage(members.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "buckets")
    shared = stage(members.join(counts, "key"), "members")
    popular = stage(shared.groupBy("node").agg(F.sum(F.col("n") - 1).alias("pop")), "popular")
    return stage(shared.drop("n").join(popular, "node"), "ranked")


def _hub_pairs(ranked: DataFrame) -> DataFrame:
    """a, b: the hub of each bucket, its most popular member, with every other member.

    Hubs are stored first: a join can split a hot bucket only if both its sides come from a shuffle of their own.
    """
    hubs = ranked.groupBy("key").agg(F.max(F.struct("pop", "node")).alias("hub")).select("key", F.col("hub.node").alias("hub"))
    near = ranked.join(stage(hubs, "hubs"), "key").where("node <> hub")
    return near.select(F.least("hub", "node").alias("a"), F.greatest("hub", "node").alias("b")).distinct()


def _alike(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs of similar size whose signatures agree often enough."""
    a = classes.select(F.col("node").alias("a"), F.col("size").alias("na"), F.col("signature").alias("sa"))
    b = classes.select(F.col("node").alias("b"), F.col("size").alias("nb"), F.col("signature").alias("sb"))
    near = f"100 * least(na, nb) >= {PERCENT} * greatest(na, nb)"
    alike = pairs.join(a, "a").join(b, "b").where(near).select("a", "b", "sa", "sb")
    return stage(alike.mapInArrow(_agreeing, "a long, b long"), "alike")


def _links(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs whose full sets prove the link."""
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("la"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("lb"))
    return stage(pairs.join(left, "a").join(right, "b").mapInArrow(_linked, "a long, b long"), "links")


def _open(ranked: DataFrame, roots: DataFrame) -> DataFrame:
    """node, size, key, root of the members of buckets that hold several components."""
    rooted = ranked.drop("pop").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    rooted = stage(rooted, "rooted")
    kept = rooted.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi"))
    return stage(rooted.join(stage(kept.where("lo < hi").select("key"), "mixed-buckets"), "key", "left_semi"), "open-buckets")


def _nibbles_apart(a: Column, b: Column) -> Column:
    """In how many of its sixteen groups of four bits a long differs from another."""
    x = a.bitwiseXOR(b)
    x = x.bitwiseOR(F.shiftrightunsigned(x, 1))
    x = x.bitwiseOR(F.shiftrightunsigned(x, 2))
    return F.bit_count(x.bitwiseAND(F.lit(0x1111111111111111)))


def _cross_pairs(members: DataFrame, sets: DataFrame) -> DataFrame:
    """a, b: members of different components in a bucket, the first they share, that can be linked by size and signature."""
    fine = stage(sets.join(members.select("node").distinct(), "node", "left_semi").mapInArrow(_fine, "node long, fine array<long>, keys array<long>"), "fine")
    told = stage(members.join(fine, "node"), "told")
    a = told.select("key", F.col("node").alias("a"), F.col("root").alias("ra"), F.col("size").alias("na"), F.col("fine").alias("fa"), F.col("keys").alias("ka"))
    b = told.select(F.col("key").alias("other"), F.col("node").alias("b"), F.col("root").alias("rb"), F.col("size").alias("nb"), F.col("fine").alias("fb"), F.col("keys").alias("kb"))
    apart = sum((_nibbles_apart(F.get("fa", F.lit(i)), F.get("fb", F.lit(i))) for i in range(FINE // 16)), F.lit(0))
    common = F.zip_with("ka", "kb", lambda x, y: F.when(x == y, x))
    first = F.get(F.filter(common, lambda k: k.isNotNull()), F.lit(0))
    near = F.expr(f"ra < rb AND 100 * least(na, nb) >= {PERCENT} * greatest(na, nb)")
    able = (F.col("key") == F.col("other")) & near & (apart <= FINE - FINE_AGREE) & (first == F.col("key"))
    return stage(a.join(b, able).select("a", "b"), "cross-pairs")


def _tied(roots: DataFrame) -> DataFrame:
    """Components as edges a, b."""
    return roots.select(F.col("node").alias("a"), F.col("root").alias("b"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, digest of the text, size, component_id for every row of `docs`."""
    texts = docs.select(id_column(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), _digest(text_col).alias("digest"))
    rows = stage(texts.mapInArrow(_signatures, "id long, digest long, size long, mark binary, signature binary"), "signatures")
    classes = rows.where("mark IS NOT NULL").groupBy("mark").agg(
        F.min("id").alias("id"), F.min("size").alias("size"), F.any_value("signature").alias("signature")
    )
    # Numbered in the job that stores them: the numbers are those of the stored rows, whatever is repeated later.
    classes = stage(classes.withColumn("node", F.monotonically_increasing_id()), "classes")

    ranked = _shared_buckets(classes)
    alike = _alike(_hub_pairs(ranked), classes)
    # The sets of all that share a bucket with another, made in one pass over the texts.
    nodes = stage(ranked.select("node").distinct(), "nodes")
    wanted = stage(classes.join(nodes, "node", "left_semi").select("id", "mark", "node"), "wanted")
    sets = texts.join(wanted.select("id"), "id", "left_semi").mapInArrow(_sets, "mark binary, shingles binary")
    sets = stage(sets.join(wanted.select("mark", "node"), "mark").select("node", "shingles"), "sets")
    roots = stage(components(_links(alike, sets)), "roots")

    members = _open(ranked, roots)
    if not members.isEmpty():
        more = _links(_cross_pairs(members, sets), sets)
        roots = stage(components(_tied(roots).unionByName(more)), "roots")

    linked = classes.select("node", "mark", "id").join(roots, "node")
    first = stage(linked.groupBy("root").agg(F.min("id").alias("component_id")), "component-ids")
    found = linked.join(first, "root").select("mark", "component_id")
    # A class without links still unites the rows that share its set.
    alone = classes.join(roots, "node", "left_anti").select("mark", F.col("id").alias("component_id"))
    found = rows.select("id", "digest", "size", "mark").join(found.unionByName(alone), "mark", "left")
    component = F.nullif(F.coalesce("component_id", "id"), F.lit(NO_ID))
    return found.select(F.nullif("id", F.lit(NO_ID)).alias("id"), "digest", "size", component.alias("component_id"))


def _digest(text_col: str) -> Column:
    return F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit("")))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs` that are the smallest of their component, with all their columns.

    A verdict is on an id together with its text, so where an id repeats, each of its texts is judged by itself. Rows
    without an id go if their component has one; among themselves none is the smallest, and all stay.
    """
    found = near_duplicates(docs, id_col, text_col)
    gone = found.where(~F.col("id").eqNullSafe(F.col("component_id")))
    gone = gone.select(F.col("id").alias("__near_id"), F.col("digest").alias("__near_digest")).distinct()
    same = F.col(id_col).cast("long").eqNullSafe(F.col("__near_id")) & (_digest(text_col) == F.col("__near_digest"))
    return docs.join(gone, same, "left_anti")
