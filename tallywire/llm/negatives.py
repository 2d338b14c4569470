"""Hard negatives by bounds along a spanning tree of anchors.

Vectors become whole numbers, floor(256 * x) for each component, and a row's score for an anchor is the inner product.
The anchors of a label, taken block by block, are joined to a minimum spanning tree by the distance of their vectors. A
task walks the tree from its root for every batch of rows: a row whose score at the parent lies between two numbers has
at the child a score between these, less and plus the length of the edge times the norm of the row (by Cauchy-Schwarz).
Only rows whose interval reaches the window a child still wants are scored anew; for the others the interval goes on to
its children.

First every anchor finds its best rows of the same label, the positives: the window is what reaches the fifth best so
far. Then each positive's score p opens a window from p / 2 to 0.95 p, in which the best rows of other labels are the
hard negatives: the window shrinks to what reaches the third best so far. Each task emits five and three rows at most for
each anchor and positive, and the best of them are picked by windows over anchors, which Spark limits before it shuffles.

A block holds at most `BLOCK_ANCHORS` anchors and about `BLOCK_BYTES` of vectors: that much goes through the driver to the
tasks, and for each block the rows are scanned twice. Scans are split by files, so no label or vector, however common,
makes a task large. Scores are exact: where products could leave the whole numbers a double holds, Python's integers are
used, and a score beyond 64 bits becomes the nearest number within.

Rows with a null id, label or vector, or with a component that is null or not finite (256 times it
included), take no part. Where the id is
divisible by 7 the label becomes (label + 1) % 10. Vectors of unequal lengths are compared as if zeros stood behind the
shorter one. Anchors are the rows whose id is divisible by 50; rows that repeat id, label and vector are one anchor. A row with
the id of the anchor is not an "other row"; all further rows count, each by itself, also where they repeat an id. An
empty table gives an empty result. Further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tallywire.llm.common import stage

POSITIVES = 5
NEGATIVES = 3
BLOCK_ANCHORS = 2048
BLOCK_BYTES = 1 << 24
BATCH_ROWS = 512
_EXACT = 2.0**53

FOUND = "anchor int, place int, score long, id long"


@dataclass
class Tree:
    """Anchors of one label, each behind its parent; `parent` and `edge` of the first are -1 and 0."""

    label: int
    numbers: np.ndarray
    ids: np.ndarray
    vectors: np.ndarray
    parent: list[int]
    edge: list[float]


def quantised(vectors: list) -> np.ndarray:
    """floor(256 * x) as doubles, one row for each vector, zeros behind the shorter ones."""
    width = max((len(v) for v in vectors), default=0)
    out = np.zeros((len(vectors), width))
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return np.floor(256 * out)


def spanning_tree(label: int, numbers: np.ndarray, ids: np.ndarray, vectors: np.ndarray) -> Tree:
    """The minimum spanning tree by Prim's method, from the anchor nearest to the mean."""
    count = len(ids)
    start = int(np.argmin(np.linalg.norm(vectors - vectors.mean(axis=0), axis=1)))
    order, parent, edge = [start], [-1], [0.0]
    place = {start: 0}
    nearest = np.linalg.norm(vectors - vectors[start], axis=1)
    by = np.full(count, start)
    inside = np.zeros(count, bool)
    inside[start] = True
    while len(order) < count:
        k = int(np.argmin(np.where(inside, np.inf, nearest)))
        place[k] = len(order)
        order.append(k)
        parent.append(place[int(by[k])])
        edge.append(float(np.linalg.norm(vectors[k] - vectors[by[k]])))
        inside[k] = True
        away = np.linalg.norm(vectors - vectors[k], axis=1)
        closer = away < nearest
        nearest[closer], by[closer] = away[closer], k
    return Tree(label, numbers[order], ids[order], vectors[order], parent, edge)


def trees(ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray) -> list[Tree]:
    out = []
    for label in np.unique(labels):
        own = np.flatnonzero(labels == label)
        out.append(spanning_tree(int(label), own, ids[own], vectors[own]))
    return out


def products(rows: np.ndarray, anchor: np.ndarray) -> np.ndarray:
    """Inner products, exact."""
    reach = np.sqrt((rows**2).sum(axis=1)) * np.sqrt((anchor**2).sum())
    out = np.zeros(len(rows), np.int64)
    safe = reach < _EXACT / 2
    out[safe] = (rows[safe] @ anchor).astype(np.int64)
    if not safe.all():
        whole = [int(a) for a in anchor]
        for i in np.flatnonzero(~safe):
            total = sum(int(x) * a for x, a in zip(rows[i], whole))
            out[i] = min(max(total, -(2**63)), 2**63 - 1)
    return out


class Best:
    """The best `most` (score, id) met so far, by falling score and then rising id."""

    def __init__(self, most: int):
        self.most = most
        self.scores = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.int64)

    def reach(self) -> float:
        """What a score must reach to matter."""
        return float(self.scores[-1]) if len(self.scores) == self.most else -np.inf

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        if not len(scores):
            return
        scores, ids = np.concatenate([self.scores, scores]), np.concatenate([self.ids, ids])
        first = np.lexsort((ids, ~scores))[: self.most]
        self.scores, self.ids = scores[first], ids[first]


def windows(positives: list[int]) -> list[tuple[int, int]]:
    """For each positive score the least and the greatest score of its hard negatives."""
    return [(-(-p // 2), 95 * p // 100) for p in positives]


def walk(tree: Tree, rows: np.ndarray, norms: np.ndarray, wanted, found) -> int:
    """Go through the anchors, parents first; the number of products worked out.

    `wanted(k, low, high)` tells which rows matter to anchor k, given what their scores lie between, and `found(k, which,
    scores)` gets their scores.
    """
    scored = 0
    low, high = np.empty((len(tree.ids), len(rows))), np.empty((len(tree.ids), len(rows)))
    for k, parent in enumerate(tree.parent):
        if parent < 0:
            low[k], high[k] = -np.inf, np.inf
        else:
            # A little more than the product, for the rounding of doubles; no bound at all where it leaves their range.
            slack = np.nan_to_num(tree.edge[k] * norms * (1 + 1e-9) + 1e-3, nan=np.inf, posinf=np.inf)
            low[k] = low[parent] - slack - 1e-12 * np.abs(low[parent])
            high[k] = high[parent] + slack + 1e-12 * np.abs(high[parent])
        which = np.flatnonzero(wanted(k, low[k], high[k]))
        if len(which):
            scores = products(rows[which], tree.vectors[k])
            low[k, which] = high[k, which] = scores
            scored += len(which)
            found(k, which, scores)
    return scored


def _batches(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Ids, labels and vectors of a few rows at a time; vectors as long as `width`, beyond which anchors have zeros."""
    for batch in batches:
        for a in range(0, batch.num_rows, BATCH_ROWS):
            piece = batch.slice(a, BATCH_ROWS)
            sizes = pa.compute.list_value_length(piece["vector"]).to_numpy()
            flat = pa.compute.list_flatten(piece["vector"]).to_numpy().astype(float)
            if (sizes == width).all():
                rows = np.floor(256 * flat.reshape(len(sizes), width))
            else:
                parts = np.split(flat, np.cumsum(sizes)[:-1])
                rows = quantised([*(p[:width] for p in parts), np.zeros(width)])[:-1]
            yield piece["id"].to_numpy(), piece["label"].to_numpy(), rows


def _emitted(best: dict[tuple[int, int], Best]) -> pa.RecordBatch:
    lists = [
        np.concatenate([np.full(len(b.ids), key[i], np.int32) for key, b in best.items()] or [np.zeros(0, np.int32)]) for i in (0, 1)
    ]
    lists += [np.concatenate([getattr(b, c) for b in best.values()] or [np.zeros(0, np.int64)]) for c in ("scores", "ids")]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in lists], ["anchor", "place", "score", "id"])


def _same_label(forest: list[Tree], width: int, most: int):
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = {(int(n), 0): Best(most) for tree in forest for n in tree.numbers}
        for ids, labels, rows in _batches(batches, width):
            for tree in forest:
                own = labels == tree.label
                if not own.any():
                    continue
                own_ids, own_rows = ids[own], rows[own]
                held = [best[int(n), 0] for n in tree.numbers]

                def wanted(k, low, high):
                    return (high >= held[k].reach()) & (own_ids != tree.ids[k])

                def found(k, which, scores):
                    held[k].add(scores, own_ids[which])

                walk(tree, own_rows, np.sqrt((own_rows**2).sum(axis=1)), wanted, found)
        yield _emitted(best)

    return step


def _other_labels(forest: list[Tree], width: int, asked: list[list[tuple[int, int]]], most: int):
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = {(n, j): Best(most) for n, own in enumerate(asked) for j in range(len(own))}
        for ids, labels, rows in _batches(batches, width):
            for tree in forest:
                other = labels != tree.label
                if not other.any():
                    continue
                other_ids, other_rows = ids[other], rows[other]

                def wanted(k, low, high):
                    out = np.zeros(len(low), bool)
                    for j, (least, greatest) in enumerate(asked[tree.numbers[k]]):
                        out |= (high >= max(least, best[int(tree.numbers[k]), j].reach())) & (low <= greatest)
                    return out

                def found(k, which, scores):
                    for j, (least, greatest) in enumerate(asked[tree.numbers[k]]):
                        inside = (scores >= least) & (scores <= greatest)
                        best[int(tree.numbers[k]), j].add(scores[inside], other_ids[which[inside]])

                walk(tree, other_rows, np.sqrt((other_rows**2).sum(axis=1)), wanted, found)
        yield _emitted(best)

    return step


def _top(found: DataFrame, most: int) -> DataFrame:
    place = Window.partitionBy("anchor", "place").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= most)


def _block(spark: SparkSession, rows: DataFrame, anchors: list) -> DataFrame:
    """The hard negatives of a block of anchors."""
    ids, labels = np.array([a.id for a in anchors], np.int64), np.array([a.label for a in anchors], np.int64)
    vectors = quantised([a.vector for a in anchors])
    width = vectors.shape[1]
    forest = trees(ids, labels, vectors)
    near = _top(rows.mapInArrow(_same_label(forest, width, POSITIVES), FOUND), POSITIVES).collect()
    positives: list[list] = [[] for _ in anchors]
    for row in sorted(near, key=lambda r: r.rank):
        positives[row.anchor].append(row)
    asked = [windows([r.score for r in own]) for own in positives]
    far = _top(rows.mapInArrow(_other_labels(forest, width, asked, NEGATIVES), FOUND), NEGATIVES)
    names = [(n, j, anchors[n].id, r.id, r.score) for n, own in enumerate(positives) for j, r in enumerate(own)]
    names = spark.createDataFrame(names, "anchor int, place int, anchor_id long, positive_id long, positive_score long")
    # At most five rows for each anchor of the block.
    return far.join(F.broadcast(names), ["anchor", "place"]).select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )


def usable(embeddings: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """Rows that take part, as id, label (changed where the id is divisible by 7) and vector."""
    known = F.col(label_col).cast("long")
    rows = embeddings.select(
        F.col(id_col).cast("long").alias("id"),
        F.when(F.col(id_col) % 7 == 0, (known + 1) % 10).otherwise(known).alias("label"),
        F.col(vector_col).cast("array<double>").alias("vector"),
    )
    finite = F.forall("vector", lambda x: x.isNotNull() & (F.abs(x) < float("inf")) & (F.abs(x) * 256 < float("inf")))
    return rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull() & finite)


def hard_negatives(
    embeddings: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
    block_anchors: int = BLOCK_ANCHORS,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score."""
    spark = embeddings.sparkSession
    rows = usable(embeddings, id_col, vector_col, label_col)
    anchors = rows.where(F.col("id") % 50 == 0).distinct()
    count, size = anchors.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size("vector") * 8 + 16), F.lit(0))).first()
    # Half full on average, as a hash deals them out.
    blocks = max(-(-count // block_anchors), -(-size // BLOCK_BYTES))
    blocks = blocks if blocks <= 1 else 2 * blocks
    out = None
    for block in range(blocks):
        held = anchors if blocks == 1 else anchors.where(F.pmod(F.xxhash64("id", "label", "vector"), F.lit(blocks)) == block)
        held = sorted(held.collect(), key=lambda r: (r.id, r.label, r.vector))
        if held:
            found = _block(spark, rows, held)
            # Many blocks must not become one plan.
            found = found if blocks == 1 else stage(found, "negatives")
            out = found if out is None else out.unionByName(found)
    if out is None:
        out = spark.createDataFrame(
            [], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
        )
    return out
