"""Ranked lexical search without random access: impact-sorted lists are read from the top until the answer is settled.

The score of a document for an item is a sum over the item's terms of an impact: the term's weight times a whole number
that grows with how often the document says the term and falls with its length (`impacts`). For every part of the
corpus a task builds one list of (impact, document) for each term, greatest impact first, and works on each item by
NRA: lists are read in turn down to a falling threshold, never looked up by document. A document then scores at least
what was read of it (lower), and at most that plus, for each list that it was not met in, the impact the list has got to
(upper). Reading goes on until no document outside the ten best can reach the tenth score, equal scores included, and
nothing is left open in the scores of those that can. The tenth best of the parts a task has done is a bound for the
next. Each part answers whole and exactly, so the best of all parts' answers are the best of the corpus.

Parts are made of rows of a scan and bounded by postings, so no term, document or source can make one large, and nothing
is shuffled but ten rows for each item and part. Weights need counts over all documents: these are partial aggregates.
Items are worked off in blocks of `BLOCK_CHARS` characters of text, at most that much goes through the driver or to
tasks, plus one item; for each block the documents are read once.

Terms are maximal runs of letters A-Z, digits and anything beyond ASCII, of the whole text, A-Z in lower case. Texts that
are null or without terms match nothing and do not count in the number of documents. Every row is a document, whatever
its id, which may repeat; null ids come behind all others of the same score. Items that repeat id and text are one item;
a null id is an id. Empty tables give an empty result. Further columns are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tallywire.llm.common import NO_ID, id_column, slices, stage

TOP = 10
BLOCK_CHARS = 4_000_000
PART_POSTINGS = 1 << 21
PART_DOCUMENTS = 1 << 14

# Letters, digits and bytes beyond ASCII stay; all else separates terms.
_KEPT = bytes(c if chr(c).isalnum() or c >= 0x80 else 0x20 for c in range(256))
_TERM_BYTES = _KEPT.lower()

# One list of a part: numbers of documents by falling impact, the impacts, and how often the item says the term.
Postings = tuple[np.ndarray, np.ndarray, int]


def terms(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_TERM_BYTES).split()


def weight(documents: int, holders: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holders + 1)))


def impacts(weights: np.ndarray, times: np.ndarray, lengths: np.ndarray, documents: int, total: int) -> np.ndarray:
    """weight * (1000000000 * times div (1000 * times + 8 * m)), m being 25 + (75 * length * documents div total)."""
    if len(lengths) and int(lengths.max()) * 75 * documents >= 2**63:
        relative = np.array([75 * int(n) * documents // total for n in lengths], np.int64)
    else:
        relative = lengths * (75 * documents) // max(total, 1)
    return weights * (1_000_000_000 * times // (1000 * times + 8 * (25 + relative)))


def resolve(lists: Sequence[Postings], documents: int, top: int = TOP, least: int = 1) -> tuple[np.ndarray, np.ndarray, int]:
    """The documents that can be among the `top` best with at least `least`, their exact scores, and the postings read.

    `documents` is how many there are; lists name them by number. More than `top` come back where scores are equal or
    where they were settled on the way.
    """
    lower = np.zeros(documents, np.int64)
    at = [0] * len(lists)
    threshold = max((int(impact[0]) for _, impact, _ in lists if len(impact)), default=0)
    while True:
        threshold //= 4
        left = []
        for k, (docs, impact, times) in enumerate(lists):
            upto = int(np.searchsorted(-impact, -threshold, side="right"))
            if upto > at[k]:
                lower[docs[at[k] : upto]] += times * impact[at[k] : upto]
                at[k] = upto
            if upto < len(impact):
                left.append((k, times * int(impact[upto])))
        upper = lower + sum(ahead for _, ahead in left)
        for k, ahead in left:
            upper[lists[k][0][: at[k]]] -= ahead
        tenth = int(np.partition(lower, documents - top)[documents - top]) if documents >= top else 0
        alive = np.flatnonzero(upper >= max(tenth, least, 1))
        if not left or np.array_equal(upper[alive], lower[alive]):
            return alive, lower[alive], sum(at)


def _profiles(vocabulary: dict[bytes, int]):
    """For each document its number of terms, and which terms of the vocabulary it says how often."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            found = [terms(t) for t in batch["text"].to_pylist()]
            lengths = np.array([len(f) for f in found], np.int64)
            flat = np.empty(int(lengths.sum()), dtype=object)
            flat[:] = [t for f in found for t in f]
            codes, distinct = pd.factorize(flat)
            number = np.array([vocabulary.get(t, -1) for t in distinct], np.int64)
            said = number[codes] if len(flat) else np.zeros(0, np.int64)
            owner = np.repeat(np.arange(len(found)), lengths)
            pairs, times = np.unique(owner[said >= 0] * len(vocabulary) + said[said >= 0], return_counts=True)
            held = np.bincount(pairs // max(len(vocabulary), 1), minlength=len(found))
            offsets = pa.array(np.concatenate([[0], np.cumsum(held)]), pa.int32())
            numbers = pa.array(pairs % max(len(vocabulary), 1), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    batch["id"],
                    pa.array(lengths),
                    pa.ListArray.from_arrays(offsets, numbers),
                    pa.ListArray.from_arrays(offsets, pa.array(times, pa.int32())),
                ],
                ["id", "length", "terms", "times"],
            )

    return step


def _part(batches: list[pa.RecordBatch], weights: np.ndarray, documents: int, total: int) -> tuple[np.ndarray, dict[int, tuple]]:
    """Ids of a part's documents, and its lists by term."""
    table = pa.Table.from_batches(batches).combine_chunks()
    ids, lengths = table["id"].to_numpy(), table["length"].to_numpy()
    held = pa.compute.list_value_length(table["terms"]).to_numpy()
    term = pa.compute.list_flatten(table["terms"]).to_numpy()
    times = pa.compute.list_flatten(table["times"]).to_numpy().astype(np.int64)
    doc = np.repeat(np.arange(len(ids)), held)
    impact = impacts(weights[term], times, lengths[doc], documents, total)
    order = np.lexsort((-impact, term))
    order = order[impact[order] > 0]
    term, doc, impact = term[order], doc[order], impact[order]
    edges = [0, *(np.flatnonzero(np.diff(term)) + 1).tolist(), len(term)]
    return ids, {int(term[a]): (doc[a:b], impact[a:b]) for a, b in zip(edges, edges[1:]) if b > a}


def _answers(items: list[Counter], weights: np.ndarray, documents: int, total: int, top: int):
    """The best documents of each part of a task, for every item."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        floors = [1] * len(items)
        best: list[list[int]] = [[] for _ in items]

        def answer(held: list[pa.RecordBatch]) -> pa.RecordBatch:
            ids, lists = _part(held, weights, documents, total)
            out: list[tuple[int, int, int]] = []
            for k, item in enumerate(items):
                own = [(*lists[t], times) for t, times in item.items() if t in lists]
                if not own:
                    continue
                found, scores, _ = resolve(own, len(ids), top, floors[k])
                first = np.lexsort((ids[found], -scores))[:top]
                out += [(k, int(ids[found[i]]), int(scores[i])) for i in first]
                best[k] = sorted([*best[k], *(int(scores[i]) for i in first)], reverse=True)[:top]
                if len(best[k]) == top:
                    floors[k] = best[k][-1]
            columns = list(zip(*out)) or [(), (), ()]
            kinds = (pa.int32(), pa.int64(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], ["item", "id", "score"])

        held, postings, rows = [], 0, 0
        for batch in batches:
            for a in range(0, batch.num_rows, 1024):
                piece = batch.slice(a, 1024)
                held.append(piece)
                postings += len(pa.compute.list_flatten(piece["terms"]))
                rows += piece.num_rows
                if postings >= PART_POSTINGS or rows >= PART_DOCUMENTS:
                    yield answer(held)
                    held, postings, rows = [], 0, 0
        if held:
            yield answer(held)

    return step


def _block(texts: DataFrame, items: list[tuple[int | None, str]], top: int) -> DataFrame:
    """The best documents for a block of items: item_id, rank, id, score."""
    spark = texts.sparkSession
    said = [Counter(terms(text)) for _, text in items]
    vocabulary = {t: k for k, t in enumerate(sorted(set().union(*said)))}
    said = [Counter({vocabulary[t]: n for t, n in s.items()}) for s in said]
    profiles = texts.mapInArrow(_profiles(vocabulary), "id long, length long, terms array<int>, times array<int>")
    profiles = stage(profiles, "profiles")
    documents, total = profiles.agg(F.count_if(F.col("length") > 0), F.coalesce(F.sum("length"), F.lit(0))).first()
    holders = profiles.select(F.explode("terms").alias("term")).groupBy("term").count().collect()
    weights = np.zeros(len(vocabulary), np.int64)
    for row in holders:
        weights[row.term] = weight(documents, row["count"])
    found = profiles.mapInArrow(_answers(said, weights, documents, total, top), "item int, id long, score long")
    place = Window.partitionBy("item").orderBy(F.desc("score"), "id")
    found = found.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= top)
    names = spark.createDataFrame([(k, i) for k, (i, _) in enumerate(items)], "item int, item_id long")
    return found.join(F.broadcast(names), "item").select("item_id", "rank", "id", "score")


def search(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
    item_text: str = "text", top: int = TOP, block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """The `top` documents of each item with a score above 0: item_id, rank from 1, id, score."""
    texts = docs.select(id_column(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    wanted = items.select(F.col(item_col).cast("long").alias("item"), F.coalesce(F.col(item_text).cast("string"), F.lit("")).alias("body"))
    wanted = wanted.distinct()
    size = wanted.agg(F.coalesce(F.sum(F.length("body") + 32), F.lit(0))).first()[0]
    blocks = -(-size // block_chars)
    found = None
    for block in range(blocks):
        part = wanted.where(F.pmod(F.xxhash64("item", "body"), F.lit(blocks)) == block) if blocks > 1 else wanted
        held = sorted(((r.item, r.body) for r in part.collect()), key=lambda r: (r[0] is None, r))
        if held:
            answer = _block(texts, held, top)
            # Many blocks must not become one plan.
            answer = answer if blocks == 1 else stage(answer, "answers")
            found = answer if found is None else found.unionByName(answer)
    if found is None:
        found = docs.sparkSession.createDataFrame([], "item_id long, rank int, id long, score long")
    return found.withColumn("id", F.when(F.col("id") != NO_ID, F.col("id")))
