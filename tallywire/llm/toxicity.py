"""Toxicity by class-conditional Kneser-Ney models.

Two models of how words are spelled, one of toxic and one of ordinary documents, tell how likely each character is after
the `ORDER - 1` before it. Both discount what they counted and share what they back off to: interpolated Kneser-Ney over
shorter contexts, from continuation counts of all training documents together. An expression that is rare in a class is
thus judged by the shared model, and one that neither class holds speaks for neither. A document counts a word once.

The evidence of a text is the log-likelihood of its words under the toxic model less that under the ordinary one, for
each character of a run of `WINDOW` consecutive words, in the run where that is greatest: a few words make a long
document toxic as well as a short one. Texts of fewer words are one run. The score is a logistic function of the evidence;
its slope and the threshold, where it is 0.5, are the likeliest ones for documents kept out of counting. (The fewest errors
among them hang on a handful of documents where the classes overlap.)

Counts are taken from all labelled documents allowed, but those of which crc32(id as text) leaves 4 modulo 5: these set slope
and threshold, by a histogram of fixed size. Counts and models are Spark tables. To score, tasks get the models as two sorted
arrays if these have at most `MOST_GRAMS` entries (16 bytes each); beyond that all distinct words meet the models, and the
documents' words their evidence, in joins. Likewise labels go to the tasks up to `MOST_LABELS` rows, else documents and labels are shuffled.

Only the text is an input of a score. Words are what white space separates, in lower case; U+0002 and U+0003 count as
white space. A text without words, or null, has no evidence and scores as evidence 0 does. Labels that are null or have
a null id are left out; a document labelled several times is toxic if any label says so. Where an id repeats, each of
its rows counts and is scored by itself, null ids too. If one of the classes has no document to count, all score 0. Empty
tables give an empty result. Further columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tallywire.llm.common import slices, stage

ORDER = 5
WINDOW = 4
DISCOUNT = 0.75
THRESHOLD = 0.5
MOST_LABELS = 4_000_000
MOST_GRAMS = 8_000_000
MOST_WORDS = 200_000
MOST_CHARACTERS = 1 << 18
BINS = 200
FARTHEST = 20

# Stand before the first and behind the last character of a word.
START, END = "\x02", "\x03"

_STEP = np.uint64(0x9E3779B97F4A7C15)
_SHIFT = np.uint64(29)


def word_list(text: str | None) -> list[str]:
    return (text or "").replace(START, " ").replace(END, " ").lower().split()


def spelled(word: str) -> str:
    return START * (ORDER - 1) + word + END


def _keys(codes: np.ndarray, width: int) -> np.ndarray:
    """A 64-bit hash of each `width` consecutive characters."""
    count = len(codes) - width + 1
    mixed = np.full(max(count, 0), width, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(width if count > 0 else 0):
            mixed ^= codes[k : k + count]
            mixed *= _STEP
            mixed ^= mixed >> _SHIFT
    return mixed


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)


@dataclass
class Grams:
    """The n-grams of some words: their hashes, those of their contexts, whose word each is, and where it starts in `flat`."""

    flat: str
    keys: np.ndarray
    contexts: np.ndarray
    owners: np.ndarray
    starts: np.ndarray


def grams(found: list[str]) -> Grams:
    flat = "".join(map(spelled, found))
    codes = _codes(flat)
    sizes = np.array([len(w) + ORDER for w in found], np.int64)
    owners = np.repeat(np.arange(len(found)), sizes)
    left = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(codes))
    starts = np.flatnonzero(left >= ORDER)
    return Grams(flat, _keys(codes, ORDER)[starts], _keys(codes, ORDER - 1)[starts], owners[starts], starts)


def _parts(found: list[str]) -> Iterator[list[str]]:
    """The words in turn, cut so that no part holds much more than `MOST_CHARACTERS`, as arrays take many bytes a character.

    Nothing is left out: a single word beyond the bound comes with those before it.
    """
    at = np.cumsum([len(w) + ORDER for w in found]) // MOST_CHARACTERS
    edges = [0, *(np.flatnonzero(np.diff(at)) + 1).tolist(), len(found)]
    for a, b in zip(edges, edges[1:]):
        yield found[a:b]


def _summed(keys: np.ndarray, times: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """The distinct keys, where each is first, and the sums of its times."""
    kept, first, which = np.unique(keys, return_index=True, return_inverse=True)
    return kept, first, [np.bincount(which, t, len(kept)) for t in times]


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many documents of either class hold each n-gram, counted once for each word that has it."""
    held = (Counter(), Counter())

    def emit() -> pa.RecordBatch:
        keys, texts, times = [], [], ([], [])
        for part in _parts(list(held[0].keys() | held[1].keys())):
            cut = grams(part)
            kept, first, sums = _summed(cut.keys, [np.array([c[w] for w in part], float)[cut.owners] for c in held])
            keys.append(kept)
            texts.append(pa.array([cut.flat[a : a + ORDER] for a in cut.starts[first].tolist()], pa.string()))
            for all_of, own in zip(times, sums):
                all_of.append(own)
        _, first, sums = _summed(np.concatenate(keys), [np.concatenate(t) for t in times])
        columns = [pa.concat_arrays(texts).take(pa.array(first)), *(pa.array(t.astype(np.int64)) for t in sums)]
        return pa.RecordBatch.from_arrays(columns, ["gram", "ordinary", "toxic"])

    for batch in slices(batches, "text"):
        for text, toxic in zip(batch["text"].to_pylist(), batch["toxic"].to_pylist()):
            held[toxic].update(set(word_list(text)))
        if len(held[0]) + len(held[1]) > MOST_WORDS:
            yield emit()
            held = (Counter(), Counter())
    if held[0] or held[1]:
        yield emit()


def _prefix(size: int) -> Column:
    return F.substring("gram", 1, size - 1).alias("context")


def _suffix() -> Column:
    return F.expr("substring(gram, 2)")


def shared_backoff(counts: DataFrame) -> DataFrame:
    """The Kneser-Ney probability of the last character of every n-gram's suffix, from continuation counts: gram, shared."""
    # A suffix counts the distinct grams of one character more that end in it; all sizes are stored at once.
    shorter = F.explode(F.array(*(F.expr(f"substring(gram, {ORDER - size + 1})") for size in range(ORDER - 1, 1, -1))))
    kinds = counts.select("gram").union(counts.select(shorter.alias("gram")).distinct())
    every = stage(kinds.groupBy(_suffix().alias("gram")).agg(F.count(F.lit(1)).alias("times")), "continuations")
    lower: DataFrame | None = None
    for size in range(1, ORDER):
        level = every.where(F.length("gram") == size)
        contexts = level.groupBy(_prefix(size)).agg(F.sum("times").alias("total"), F.count(F.lit(1)).alias("kinds"))
        joined = level.withColumn("context", _prefix(size)).join(contexts, "context")
        if lower is None:
            joined = joined.withColumn("lower", 1 / F.lit(level.count() + 1))
        else:
            joined = joined.withColumn("suffix", _suffix()).join(lower.select(F.col("gram").alias("suffix"), F.col("shared").alias("lower")), "suffix")
        kept = (F.col("times") - DISCOUNT) / F.col("total")
        lower = joined.select("gram", (kept + DISCOUNT * F.col("kinds") / F.col("total") * F.col("lower")).alias("shared"))
    return lower


def evidence_table(counts: DataFrame) -> DataFrame:
    """What each n-gram, and any other character after a context, adds to the evidence: gram, evidence.

    A context stands as a gram of one character less.
    """
    classes = ("ordinary", "toxic")
    totals = [F.sum(c).alias(f"{c}_total") for c in classes] + [F.count_if(F.col(c) > 0).alias(f"{c}_kinds") for c in classes]
    contexts = counts.groupBy(_prefix(ORDER)).agg(*totals)

    def back(name: str) -> Column:
        """The share that a context leaves to the shared model."""
        total = F.col(f"{name}_total")
        return F.when(total > 0, DISCOUNT * F.col(f"{name}_kinds") / total).otherwise(1.0)

    def likely(name: str) -> Column:
        own = F.when(F.col(f"{name}_total") > 0, F.greatest(F.col(name) - DISCOUNT, F.lit(0.0)) / F.col(f"{name}_total")).otherwise(0.0)
        return own + back(name) * F.col("shared")

    shared = shared_backoff(counts).withColumnRenamed("gram", "suffix")
    joined = counts.withColumns({"context": _prefix(ORDER), "suffix": _suffix()}).join(contexts, "context").join(shared, "suffix")
    whole = joined.select("gram", F.ln(likely("toxic") / likely("ordinary")).alias("evidence"))
    return whole.unionByName(contexts.select(F.col("context").alias("gram"), F.ln(back("toxic") / back("ordinary")).alias("evidence")))


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = np.array(batch["gram"].to_pylist(), dtype=object)
        keys = np.zeros(len(texts), np.uint64)
        whole = np.array([len(t) == ORDER for t in texts], bool)
        for own, width in ((whole, ORDER), (~whole, ORDER - 1)):
            if own.any():
                keys[own] = _keys(_codes("".join(texts[own])), width)[::width]
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys.view(np.int64)), pa.array(whole), batch["evidence"]], ["key", "whole", "evidence"]
        )


@dataclass
class Model:
    """Evidence of n-grams and of contexts, by sorted hashes."""

    keys: np.ndarray
    worth: np.ndarray
    context_keys: np.ndarray
    context_worth: np.ndarray

    def of_words(self, found: list[str]) -> np.ndarray:
        return np.concatenate([self._of_part(part) for part in _parts(found)])

    def _of_part(self, found: list[str]) -> np.ndarray:
        cut = grams(found)
        value, known = _looked_up(self.keys, self.worth, cut.keys)
        rest = np.flatnonzero(~known)
        value[rest] = _looked_up(self.context_keys, self.context_worth, cut.contexts[rest])[0]
        return np.bincount(cut.owners, value, len(found))

    def of_texts(self, texts: list[str | None]) -> np.ndarray:
        split = [word_list(t) for t in texts]
        flat = np.empty(sum(map(len, split)), dtype=object)
        flat[:] = [w for s in split for w in s]
        if not len(flat):
            return np.zeros(len(texts))
        codes, distinct = pd.factorize(flat)
        value = self.of_words(list(distinct))[codes]
        size = np.array([len(w) + 1 for w in distinct])[codes]
        edges = np.cumsum([0, *map(len, split)])
        return np.array([strongest(value[a:b], size[a:b]) for a, b in zip(edges, edges[1:])])


def _looked_up(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(keys):
        return np.zeros(len(wanted)), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    known = keys[at] == wanted
    return np.where(known, values[at], 0).astype(float), known


def strongest(value: np.ndarray, size: np.ndarray) -> float:
    """The greatest evidence per character of `WINDOW` consecutive words; 0 without words."""
    if not len(value):
        return 0.0
    width = min(WINDOW, len(value))
    sums = np.lib.stride_tricks.sliding_window_view(value, width).sum(axis=1)
    return float((sums / np.lib.stride_tricks.sliding_window_view(size, width).sum(axis=1)).max())


def evidence(docs: DataFrame, table: DataFrame, text_col: str = "text", most_grams: int = MOST_GRAMS) -> DataFrame:
    """`docs` with the column `_evidence`, by an evidence table."""
    if table.count() > most_grams:
        return _evidence_by_joins(docs, table, text_col)
    rows = table.mapInArrow(_hashed, "key long, whole boolean, evidence double").toArrow().combine_chunks()
    halves = []
    whole = rows["whole"].to_numpy(zero_copy_only=False)
    for own in (whole, ~whole):
        keys, worth = rows["key"].to_numpy()[own].view(np.uint64), rows["evidence"].to_numpy()[own]
        order = np.argsort(keys)
        halves += [keys[order], worth[order]]
    model = Model(*halves)

    def step(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in texts:
            sizes = np.cumsum(part.str.len().fillna(0).to_numpy(dtype=float)) // (1 << 21)
            pieces = np.split(part.to_numpy(), np.flatnonzero(np.diff(sizes)) + 1) if len(part) else []
            yield pd.Series(np.concatenate([model.of_texts(list(p)) for p in pieces]) if pieces else [], dtype=float)

    step.__annotations__ = {"texts": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return docs.withColumn("_evidence", F.pandas_udf(step, "double")(F.col(text_col).cast("string")))


def _placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text", 1 << 20):
        for row, text in zip(batch["row"].to_pylist(), batch["text"].to_pylist()):
            found = word_list(text)
            for a in range(0, len(found), 10_000):
                part = found[a : a + 10_000]
                columns = [pa.array([row] * len(part)), pa.array(range(a, a + len(part)), pa.int64()), pa.array(part, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, ["row", "place", "word"])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "word", 1 << 18):
        found = batch["word"].to_pylist()
        cut = grams(found)
        texts = [cut.flat[a : a + ORDER] for a in cut.starts.tolist()]
        columns = [pa.array([found[k] for k in cut.owners.tolist()], pa.string()), pa.array(texts, pa.string())]
        yield pa.RecordBatch.from_arrays(columns, ["word", "gram"])


def _evidence_by_joins(docs: DataFrame, table: DataFrame, text_col: str) -> DataFrame:
    """The same for a model of any size. Rows are numbered in a stored table, so that a task that runs again agrees."""
    docs = stage(docs.withColumn("_row", F.monotonically_increasing_id()), "numbered")
    texts = docs.select(F.col("_row").alias("row"), F.col(text_col).cast("string").alias("text"))
    placed = stage(texts.mapInArrow(_placed, "row long, place long, word string"), "words")
    cut = placed.select("word").distinct().mapInArrow(_cut, "word string, gram string")
    cut = cut.join(table, "gram", "left").withColumn("context", _prefix(ORDER))
    contexts = table.select(F.col("gram").alias("context"), F.col("evidence").alias("other"))
    value = F.coalesce("evidence", "other", F.lit(0.0))
    words = cut.join(contexts, "context", "left").groupBy("word").agg(F.sum(value).alias("value"))
    ahead = Window.partitionBy("row").orderBy("place").rowsBetween(0, WINDOW - 1)
    worth = placed.join(stage(words, "word-evidence"), "word").withColumn("size", F.length("word") + 1)
    count = F.count(F.lit(1)).over(ahead)
    runs = worth.select("row", "place", (F.sum("value").over(ahead) / F.sum("size").over(ahead)).alias("mean"), count.alias("long"))
    # The last runs of a text are shorter, unless the text is.
    best = runs.where((F.col("long") == WINDOW) | (F.col("place") == 0)).groupBy(F.col("row").alias("_row")).agg(F.max("mean").alias("_evidence"))
    return docs.join(best, "_row", "left").withColumn("_evidence", F.coalesce("_evidence", F.lit(0.0))).drop("_row")


def calibrated(histogram: list[tuple[int, int, int]]) -> tuple[float, float]:
    """Slope and threshold from (bin of the evidence, toxic or not, documents)."""
    bins = sorted({b for b, _, _ in histogram})
    times = {(b, y): n for b, y, n in histogram}
    toxic = np.array([times.get((b, 1), 0) for b in bins], float)
    ordinary = np.array([times.get((b, 0), 0) for b in bins], float)
    if not toxic.sum() or not ordinary.sum():
        return 20.0, 0.4
    middle = (np.array(bins) + 0.5) / BINS
    between = [float(middle[0]) - 0.05, *((middle[1:] + middle[:-1]) / 2).tolist(), float(middle[-1]) + 0.05]

    def loss(slope: float, threshold: float) -> float:
        far = middle - threshold
        return float(toxic @ np.logaddexp(0, -slope * far) + ordinary @ np.logaddexp(0, slope * far))

    def likeliest(slope: float) -> float:
        """The loss is convex in the threshold, so it falls up to the best one and rises from there."""
        low, high = 0, len(between) - 1
        while low < high:
            at = (low + high) // 2
            if loss(slope, between[at]) <= loss(slope, between[at + 1]):
                high = at
            else:
                low = at + 1
        return between[low]

    return min(((slope, likeliest(slope)) for slope in (2.0**k for k in range(7))), key=lambda found: loss(*found))


def held_out(id_col: Column) -> Column:
    """Rows kept out of training: crc32 of the id as text leaves 0 modulo 5."""
    return F.coalesce(_fold(id_col) == 0, F.lit(False))


def _fold(id_col: Column) -> Column:
    return F.crc32(id_col.cast("string").cast("binary")) % 5


def _small(df: DataFrame, most: int) -> DataFrame:
    """The table to be sent to the tasks if it has at most `most` rows."""
    return F.broadcast(df) if df.count() <= most else df


def score(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
    allowed: Column | None = None, most_labels: int = MOST_LABELS, most_grams: int = MOST_GRAMS,
) -> DataFrame:
    """id and `score`, from 0 to 1, of every row, by models of the labelled rows for which `allowed` (over the labels) holds."""
    known = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
    known = known if allowed is None else known.where(allowed)
    known = known.groupBy(F.col(id_col).cast("long").alias("id")).agg((F.max(label_col) > 0).cast("int").alias("toxic"))
    known = _small(known.withColumn("checks", _fold(F.col("id")) == 4), most_labels)
    every = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    texts = every.join(known, "id")

    counting = texts.where(~F.col("checks")).select("text", "toxic")
    partial = counting.mapInArrow(_counted, "gram string, ordinary long, toxic long")
    counts = partial.groupBy("gram").agg(F.sum("ordinary").alias("ordinary"), F.sum("toxic").alias("toxic"))
    counts = stage(counts, "grams")
    either = counts.agg(F.coalesce(F.max("ordinary"), F.lit(0)), F.coalesce(F.max("toxic"), F.lit(0))).first()
    if not all(either):
        return every.select("id", F.lit(0.0).alias("score"))
    table = stage(evidence_table(counts), "evidence")

    checked = evidence(texts.where("checks"), table, "text", most_grams)
    place = F.floor(F.greatest(F.lit(-FARTHEST), F.least(F.lit(FARTHEST), F.col("_evidence"))) * BINS)
    histogram = checked.groupBy(place.alias("bin"), "toxic").count().collect()
    slope, threshold = calibrated([(r.bin, r.toxic, r["count"]) for r in histogram])
    scored = evidence(every, table, "text", most_grams)
    return scored.select("id", (1 / (1 + F.exp(-slope * (F.col("_evidence") - threshold)))).alias("score"))
