"""Benchmark decontamination by pigeonhole edit matching.

Texts are compared normalised: small letters, runs of anything but letters and digits as one space, and a space at both
ends, so that an item counts as words and not inside of others. An item leaks into a document when some part of the
document is within `budget` edits of the whole item, the budget being 5 % of the item's characters. An item cut into
budget + 1 pieces leaves at least one piece whole under that many edits, so all exact hits of pieces, found together by
an Aho-Corasick automaton, are all places worth a look. Around each, Myers' bit-parallel algorithm gives the least edit
distance of the item to any part of the document.

Items are a stated query set: they are taken in blocks of `BLOCK_CHARS` characters, or of one item beyond, each block's
automaton goes to every task, and every block passes over all documents (in `drop_leaks` over those left). What a block
gives is stored before the next one is read, so neither the plan nor what the driver holds at a time grows with the
number of items. An item without letters and digits, or a null one, is never
found; neither is anything in a null or empty text. Items that repeat a text are found each under its own id; rows that
repeat a document's id are looked at together, the least distance counts; null ids stay null. Empty tables give an
empty result. Only the ids and texts are read.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import ahocorasick
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tallywire.llm.common import slices, stage
from tallywire.session import work_dir

ERROR_RATE = 0.05
BLOCK_CHARS = 4_000_000

_SIGNS = re.compile(r"[\W_]+")


def normalised(text: str | None) -> str:
    return _SIGNS.sub(" ", (text or "").lower()).strip()


def pieces(item: str, budget: int) -> list[tuple[int, str]]:
    """The item cut into budget + 1 pieces of nearly the same length, with their offsets."""
    edges = [len(item) * k // (budget + 1) for k in range(budget + 2)]
    return [(a, item[a:b]) for a, b in zip(edges, edges[1:]) if a < b]


def myers(pattern: str, text: str) -> tuple[int, int]:
    """The least edit distance of `pattern` to any part of `text`, and where the first such part ends."""
    m = len(pattern)
    masks: dict[str, int] = {}
    for i, c in enumerate(pattern):
        masks[c] = masks.get(c, 0) | 1 << i
    full, high = (1 << m) - 1, 1 << (m - 1)
    plus, minus, score = full, 0, m
    best, end = m, 0
    for at, c in enumerate(text, 1):
        eq = masks.get(c, 0)
        d0 = ((((eq & plus) + plus) ^ plus) | eq | minus) & full
        hp, hn = (minus | ~(d0 | plus)) & full, plus & d0
        if hp & high:
            score += 1
        elif hn & high:
            score -= 1
        hp, hn = (hp << 1) & full, (hn << 1) & full
        plus, minus = (hn | ~(d0 | hp)) & full, hp & d0
        if score < best:
            best, end = score, at
    return best, end


def _regions(places: list[int], size: int, budget: int) -> Iterator[tuple[int, int]]:
    """Where a match that starts near one of the ascending places can lie; regions that overlap are one."""
    begin = upto = None
    for place in places:
        a, b = max(0, place - budget), place + size + budget
        if upto is not None and a <= upto:
            upto = b
            continue
        if upto is not None:
            yield begin, upto
        begin, upto = a, b
    if upto is not None:
        yield begin, upto


def _finder(items: list[tuple[int | None, str]], rate: float) -> Callable[[str], dict]:
    automaton = ahocorasick.Automaton()
    held: dict[str, list[tuple[int, int]]] = {}
    asked = [(f" {item} ", int(rate * len(item))) for _, item in items]
    for number, (item, budget) in enumerate(asked):
        for offset, piece in pieces(item, budget):
            held.setdefault(piece, []).append((number, offset))
    for piece, uses in held.items():
        automaton.add_word(piece, (len(piece), uses))
    automaton.make_automaton()

    def find(text: str) -> dict[int, tuple[int, int]]:
        """Least distance and end of the match, which is the first with that distance, by number of the item."""
        text = f" {text} "
        starts: dict[int, set[int]] = {}
        for end, (size, uses) in automaton.iter(text):
            for number, offset in uses:
                starts.setdefault(number, set()).add(end + 1 - size - offset)
        found = {}
        for number, places in starts.items():
            item, budget = asked[number]
            best = None
            for a, b in _regions(sorted(places), len(item), budget):
                distance, at = myers(item, text[a:b])
                if distance <= budget and (best is None or distance < best[0]):
                    # Neither the space in front nor the one that ends the match counts.
                    end = a + at - 1
                    best = (distance, end - (text[end] == " "))
                    if distance == 0:
                        break
            if best is not None:
                found[number] = best
        return found

    return find


def _search(items: list[tuple[int | None, str]], rate: float) -> Callable:
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = _finder(items, rate)
        for batch in slices(batches, "text"):
            ids, item_ids, distances, ends = [], [], [], []
            for doc, text in zip(batch["id"].to_pylist(), batch["text"].to_pylist()):
                for number, (distance, end) in find(normalised(text)).items():
                    ids.append(doc)
                    item_ids.append(items[number][0])
                    distances.append(distance)
                    ends.append(end)
            columns = [pa.array(ids, pa.int64()), pa.array(item_ids, pa.int64()), pa.array(distances, pa.int32()), pa.array(ends, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "item_id", "distance", "match_end"])

    return step


def _blocks(items: DataFrame, id_col: str, text_col: str, most: int) -> Iterator[list[tuple[int | None, str]]]:
    block, size = [], 0
    for row in items.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).toLocalIterator():
        item = normalised(row.text)
        if item:
            block.append((row.id, item))
            size += len(item)
            if size >= most:
                yield block
                block, size = [], 0
    if block:
        yield block


def leaks(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    error_rate: float = ERROR_RATE,
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """doc_id, item_id, distance, match_end (in the normalised text) of every item found in a document."""
    schema = "doc_id long, item_id long, distance int, match_end long"
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    spark = docs.sparkSession
    path = work_dir(spark, "leaks")
    spark.createDataFrame([], schema).write.parquet(path)
    for block in _blocks(items, item_id_col, item_text_col, block_chars):
        rows.mapInArrow(_search(block, error_rate), schema).write.mode("append").parquet(path)
    found = spark.read.schema(schema).parquet(path)
    first = F.min(F.struct("distance", "match_end")).alias("m")
    return found.groupBy("doc_id", "item_id").agg(first).select("doc_id", "item_id", "m.distance", "m.match_end")


def _is_leak(items: list[tuple[int | None, str]], rate: float) -> Callable[[Column], Column]:
    def step(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        find = _finder(items, rate)
        for part in parts:
            yield part.map(lambda t: bool(find(normalised(t)))).astype(bool)

    step.__annotations__ = {"parts": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(step, "boolean")


def drop_leaks(
    docs: DataFrame, items: DataFrame, text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text",
    error_rate: float = ERROR_RATE, block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """The rows of `docs` into which no item leaks, with all their columns. Each row is judged where it is."""
    for number, block in enumerate(_blocks(items, item_id_col, item_text_col, block_chars)):
        docs = stage(docs, "clean") if number else docs
        docs = docs.where(~_is_leak(block, error_rate)(F.col(text_col).cast("string")))
    return docs
