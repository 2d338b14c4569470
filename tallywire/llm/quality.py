"""Quality classifier: supervised subword embeddings.

A text is the average of learned vectors of its words and of the character n-grams of its words, all hashed into a
fixed table, and of one more vector that stands for a word said twice in a row; a linear layer with softmax turns the average into the probability of label 1. Vectors and layer are
trained together by stochastic gradient descent in numpy, on at most `most_rows` labelled rows, which are those with
the smallest hash of their id. Whole texts are read, for training and for scoring. Only the text is an input.

A text that is null or has no words scores by the bias alone. Labels with a null id or label are left out; a document
with several labels counts with the smallest. Without any label nothing speaks against a text, and all score 1. Rows
that repeat an id are scored each on its own; an empty table gives an empty result.

The layer is linear in the average, so a trained model comes down to one weight for each row of the table: 0.8 MB that go to
every task, at any size of the corpus.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tallywire.llm.common import slices, word_hashes, words

WORD_ROWS = 1 << 16
GRAM_ROWS = 1 << 17
ROWS = WORD_ROWS + GRAM_ROWS + 1
# The last row stands for a word that is the same as the one before it; such a word counts it as often as this.
AGAIN = ROWS - 1
AGAIN_TIMES = 8
GRAMS = (3, 4, 5)
SIZE = 8
MOST_ROWS = 3000
EPOCHS = 5
THRESHOLD = 0.7


def _grams(found: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Row of the table and number of the word, for every character n-gram of `<word>`."""
    sizes = np.array([len(w) + 2 for w in found])
    raw = np.frombuffer(b"<" + b"><".join(found) + b">", np.uint8).astype(np.uint32)
    number = np.repeat(np.arange(len(found)), sizes)
    left = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(raw))
    rows, owners = [], []
    with np.errstate(over="ignore"):
        for n in GRAMS:
            count = len(raw) - n + 1
            if count <= 0:
                continue
            mixed = np.full(count, n, np.uint32)
            for k in range(n):
                mixed = (mixed ^ raw[k : k + count]) * np.uint32(0x01000193)
            mixed ^= mixed >> np.uint32(15)
            mixed *= np.uint32(0x2C1B3C6D)
            mixed ^= mixed >> np.uint32(13)
            inside = left[:count] >= n
            rows.append(mixed[inside] % np.uint32(GRAM_ROWS) + np.uint32(WORD_ROWS))
            owners.append(number[:count][inside])
    return np.concatenate(rows), np.concatenate(owners)


def _word_rows(found: list[bytes]) -> np.ndarray:
    return (word_hashes(found) % np.uint64(WORD_ROWS)).astype(np.uint32)


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the table and how often the text uses each."""
    found = words(text)
    if not found:
        return np.zeros(0, np.int32), np.zeros(0, np.float32)
    held = np.empty(len(found), dtype=object)
    held[:] = found
    codes, distinct = pd.factorize(held)
    times = np.bincount(codes).astype(np.float64)
    rows, owners = _grams(list(distinct))
    used = np.bincount(np.concatenate([rows, _word_rows(list(distinct))]), np.concatenate([times[owners], times]))
    used = np.pad(used, (0, ROWS - len(used)))
    used[AGAIN] = AGAIN_TIMES * np.count_nonzero(codes[1:] == codes[:-1])
    at = np.flatnonzero(used)
    return at.astype(np.int32), used[at].astype(np.float32)


@dataclass
class Model:
    """The weight of every row of the table and the bias, in favour of label 1."""

    weights: np.ndarray
    bias: float

    def scores(self, texts: list[str | None]) -> np.ndarray:
        split = [words(t) for t in texts]
        counts = np.array([len(s) for s in split], np.int64)
        flat = [w for s in split for w in s]
        total, number = np.zeros(len(texts)), np.zeros(len(texts))
        if flat:
            held = np.empty(len(flat), dtype=object)
            held[:] = flat
            codes, distinct = pd.factorize(held)
            distinct = list(distinct)
            rows, owners = _grams(distinct)
            worth = np.bincount(owners, self.weights[rows], len(distinct)) + self.weights[_word_rows(distinct)]
            uses = np.bincount(owners, minlength=len(distinct)) + 1.0
            owner = np.repeat(np.arange(len(texts)), counts)
            total = np.bincount(owner, worth[codes], len(texts))
            number = np.bincount(owner, uses[codes], len(texts))
            same = (codes[1:] == codes[:-1]) & (owner[1:] == owner[:-1])
            again = AGAIN_TIMES * np.bincount(owner[1:][same], minlength=len(texts))
            total, number = total + again * self.weights[AGAIN], number + again
        return 1 / (1 + np.exp(-(total / np.maximum(number, 1) + self.bias)))


def fit(samples: list[tuple[np.ndarray, np.ndarray, int]], epochs: int = EPOCHS, seed: int = 7) -> Model:
    """Train on (rows, counts, label); steps are scaled by how many rows of the table a text spreads over."""
    draw = np.random.default_rng(seed)
    vectors = draw.uniform(-1 / SIZE, 1 / SIZE, (ROWS, SIZE)).astype(np.float32)
    layer, bias = np.zeros((SIZE, 2), np.float32), np.zeros(2, np.float32)
    shares = [(rows, counts / counts.sum(), label) for rows, counts, label in samples if len(rows)]
    steps, done = epochs * len(shares), 0
    for _ in range(epochs):
        for i in draw.permutation(len(shares)):
            rows, share, label = shares[i]
            rate = 0.5 * (1 - done / steps)
            mean = share @ vectors[rows]
            logits = mean @ layer + bias
            error = np.exp(logits - logits.max())
            error /= error.sum()
            error[label] -= 1
            back = layer @ error
            layer -= rate * np.outer(mean, error)
            bias -= 0.1 * rate * error
            vectors[rows] -= (rate / float(share @ share)) * np.outer(share, back)
            done += 1
    return Model(vectors @ (layer[:, 1] - layer[:, 0]), float(bias[1] - bias[0]))


def train(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
    allowed: Column | None = None, most_rows: int = MOST_ROWS, epochs: int = EPOCHS,
) -> Model:
    """A model of the labelled rows for which `allowed` (over the labels) holds, of which at most `most_rows` are used."""
    known = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
    known = known if allowed is None else known.where(allowed)
    known = known.groupBy(F.col(id_col).cast("long").alias("id")).agg(F.min(F.col(label_col).cast("int")).alias("label"))
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    # No more rows than the bound of the sample.
    chosen = F.broadcast(known.orderBy(F.xxhash64("id"), "id").limit(most_rows))
    rows = texts.join(chosen, "id")

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            found = [features(t) for t in batch["text"].to_pylist()]
            columns = [batch["id"], batch["label"], *(pa.array([f[k].tobytes() for f in found], pa.binary()) for k in (0, 1))]
            yield pa.RecordBatch.from_arrays(columns, ["id", "label", "rows", "counts"])

    samples, seen = [], set()
    found = rows.mapInArrow(step, "id long, label int, rows binary, counts binary").collect()
    # Where an id repeats with other texts, which of them is taken does not depend on the order they come in.
    for row in sorted(found, key=lambda r: (r.id, bytes(r.rows), bytes(r.counts))):
        if row.id not in seen:
            seen.add(row.id)
            samples.append((np.frombuffer(row.rows, np.int32), np.frombuffer(row.counts, np.float32), int(row.label > 0)))
    if not samples:
        return Model(np.zeros(ROWS, np.float32), float("inf"))
    return fit(samples, epochs)


def score_column(model: Model, text: Column) -> Column:
    """The score of a text, 0 to 1."""

    def step(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in texts:
            sizes = np.cumsum(part.str.len().fillna(0).to_numpy()) // (1 << 21)
            pieces = np.split(part.to_numpy(), np.flatnonzero(np.diff(sizes)) + 1) if len(part) else []
            yield pd.Series(np.concatenate([model.scores(list(p)) for p in pieces]) if pieces else [], dtype=float)

    step.__annotations__ = {"texts": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(step, "double")(text.cast("string"))


def held_out(id_col: Column) -> Column:
    """Rows kept out of training: crc32 of the id as text leaves 2 modulo 4."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def drop_low_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs` that score `THRESHOLD` or more, with all their columns."""
    model = train(docs, labels, id_col, text_col, allowed=~held_out(F.col(id_col)))
    return docs.where(score_column(model, F.col(text_col)) >= THRESHOLD)
