"""SentencePiece encoding and decoding as a weighted finite-state transducer.

A model file is compiled into three machines. The normaliser rewrites white space as U+2581 and puts one in front of a
text that is not empty. The pieces map text to ids; a character without a piece falls back to the ids of its UTF-8
bytes, or, in a model that has none, one run of such characters to the unknown piece, which decodes to U+2047 between
spaces. Pieces that a user defined are cut out of a text first in a BPE model, leftmost and longest. The third accepts sequences of pieces: for a unigram model all of them, with the pieces' negated scores as
weights; for a BPE model those in which each two neighbours are what the merges make of the two together, since a
sequence is the merges' result exactly if that holds everywhere. Composed with an input this gives a lattice whose
states are a position and the piece that ended there, and the shortest path in the tropical semiring (weights add up,
the least sum wins) is the encoding. Decoding runs the pieces backwards.

No piece holds a letter beside a sign, say, or U+2581 after anything else; where two characters meet that no piece holds
side by side the lattice falls apart, and each part is solved once for a task, within a bound on memory. Models with their own character map are refused.

Null and empty texts have no ids and decode to the empty text. U+2581 in a text decodes to a space, as the model cannot tell them
apart; everything else comes back as it was. Rows that repeat an id are encoded each on its own; an empty table gives
an empty result; texts may be of any length. Only id and text are read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tallywire.llm.common import slices

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
# Bounds of what a worker keeps: parts in each of two halves, and pairs of pieces.
MOST_PARTS = 150_000
MOST_PAIRS = 800_000

# Fixed values of the model format: field numbers, and kinds of models and pieces.
PIECES, TRAINER, NORMALISER = 1, 2, 3
UNIGRAM, BPE = 1, 2
NORMAL, UNKNOWN, USER, BYTE = 1, 2, 4, 6
UNKNOWN_TEXT = " ⁇ "


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Number and value of every field of a protocol buffer message."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = number()
        if key & 7 == 0:
            yield key >> 3, number()
            continue
        size = {1: 8, 5: 4}.get(key & 7) or number()
        yield key >> 3, data[at : at + size]
        at += size


@dataclass
class Model:
    """What a model file says, small enough to go along with every task."""

    pieces: list[str]
    scores: list[float]
    kinds: list[int]
    bpe: bool
    prefix: bool
    squeeze: bool

    @staticmethod
    def load(path: str) -> Model:
        pieces, scores, kinds, bpe, prefix, squeeze = [], [], [], False, True, True
        for key, value in _fields(Path(path).read_bytes()):
            if key == PIECES:
                piece = dict(_fields(value))
                pieces.append(piece.get(1, b"").decode())
                scores.append(float(np.frombuffer(piece.get(2, b"\0\0\0\0"), "<f4")[0]))
                kinds.append(piece.get(3, NORMAL))
            elif key == TRAINER:
                kind = dict(_fields(value)).get(3, UNIGRAM)
                if kind not in (UNIGRAM, BPE):
                    raise ValueError("only unigram and BPE models have a lattice of pieces")
                bpe = kind == BPE
            elif key == NORMALISER:
                rules = dict(_fields(value))
                if rules.get(2):
                    raise ValueError("models with a character map of their own are not supported")
                prefix, squeeze = bool(rules.get(3, 1)), bool(rules.get(4, 1))
        return Model(pieces, scores, kinds, bpe, prefix, squeeze)


class _Parts(dict):
    """Encodings of parts, made when first asked for; the younger half is kept when there are too many."""

    def __init__(self, solve: Callable[[str], bytes]):
        super().__init__()
        self.solve, self.older = solve, {}

    def __missing__(self, part: str) -> bytes:
        found = self.older.get(part)
        if found is None:
            found = self.solve(part)
        if len(part) <= 64:
            if len(self) >= MOST_PARTS:
                self.older = dict(self)
                self.clear()
            self[part] = found
        return found


def _parts_pattern(pieces: Iterable[str]) -> str:
    """Matches the parts of a text between which the lattice falls apart.

    Characters that some piece holds side by side belong to one class; no piece crosses from one class to another, and
    none holds U+2581 after anything else, unless the model has such pieces: then a text is one part.
    """
    above: dict[str, str] = {}
    joined: set[str] = set()

    def top(c: str) -> str:
        while above.setdefault(c, c) != c:
            c = above[c]
        return c

    for piece in pieces:
        tail = piece.lstrip(SPACE)
        if SPACE in tail:
            return "(?s:.+)"
        for a, b in zip(tail, tail[1:]):
            above[top(a)] = top(b)
            joined |= {a, b}
    classes: dict[str, list[str]] = {}
    for c in sorted(joined):
        classes.setdefault(top(c), []).append(re.escape(c))
    runs = "|".join(f"[{''.join(c)}]+" for c in classes.values())
    return f"{SPACE}*(?:{runs + '|' * bool(runs)}[^{SPACE}])|{SPACE}+"


@dataclass
class Transducer:
    """The compiled machines of a model."""

    model: Model
    ids: dict[str, int] = field(init=False)
    scores: dict[str, float] = field(init=False)

    def __post_init__(self):
        m = self.model
        self.ids = {p: i for i, (p, k) in enumerate(zip(m.pieces, m.kinds)) if k == NORMAL}
        self.scores = {p: m.scores[i] for p, i in self.ids.items()}
        self.bytes = {int(p[3:-1], 16): i for i, (p, k) in enumerate(zip(m.pieces, m.kinds)) if k == BYTE}
        self.unknown = min(self.scores.values()) - 10
        fixed = {p: i for i, (p, k) in enumerate(zip(m.pieces, m.kinds)) if k == USER}
        if not m.bpe:
            # In a unigram model pieces of the user are pieces like others, but for what they weigh.
            best = max(self.scores.values())
            self.ids |= fixed
            self.scores |= {p: len(p.encode()) * best - 0.1 for p in fixed}
            fixed = {}
        # What a text in the lattice can be: 2 and 3 a piece, 1 and 3 the start of a longer one.
        self.known: dict[str, int] = {}
        for piece in self.ids:
            if not self.model.bpe or len(piece) == 1 or self.merged(piece) == [piece]:
                self.known[piece] = self.known.get(piece, 0) | 2
                for n in range(1, len(piece)):
                    self.known[piece[:n]] = self.known.get(piece[:n], 0) | 1
        self.cut = re.compile(_parts_pattern(self.known))
        # In a BPE model they stand for themselves wherever they come, the longest first, and no merge crosses them.
        longest = sorted(fixed, key=len, reverse=True)
        self.fixed = re.compile("|".join(map(re.escape, longest))) if longest else None
        nameless = [i for i, k in enumerate(m.kinds) if k == UNKNOWN]
        if not self.bytes and not nameless:
            raise ValueError("a model without pieces for bytes needs an unknown piece")
        self.nameless = nameless[0] if not self.bytes else None
        self.codes = {p: np.int32(i).astype("<i4").tobytes() for p, i in (self.ids | fixed).items()}
        self.pairs: dict[str, dict[str, bool]] = {}
        self.held = 0
        self.parts = _Parts(self._ids)
        texts = [p.replace(SPACE, " ").encode() if k in (NORMAL, USER) else b"" for p, k in zip(m.pieces, m.kinds)]
        for i in nameless:
            texts[i] = UNKNOWN_TEXT.encode()
        for byte, i in self.bytes.items():
            texts[i] = bytes([byte])
        self.texts = texts

    def normalise(self, text: str) -> str:
        if self.model.squeeze:
            text = re.sub(" +", " ", text).strip(" ")
        if text and self.model.prefix:
            text = " " + text
        return text.replace(" ", SPACE)

    def merged(self, text: str) -> list[str]:
        """What the merges make of a text: ever again the best piece two neighbours form, the first one on a tie."""
        parts = list(text)
        while len(parts) > 1:
            ranked = [(-self.scores.get(a + b, -np.inf), i) for i, (a, b) in enumerate(zip(parts, parts[1:]))]
            cost, i = min(ranked)
            if cost == np.inf:
                break
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def path(self, part: str) -> list[str]:
        """The shortest path through the lattice of a part, as the pieces along it."""
        return self._merge_path(part) if self.model.bpe else self._weighted_path(part)

    def _merge_path(self, part: str) -> list[str]:
        """Weights are 0 and infinity here, so the first path found is a shortest one.

        Every start of a part has just one encoding, so a position that leads nowhere once never has to be seen again.
        """
        n, known = len(part), self.known
        path: list[str] = []
        ahead: list[list[str]] = []
        dead: set[int] = set()
        i = 0
        while i < n:
            if len(ahead) == len(path):
                pieces, j = [part[i : i + 1]], i + 1
                kind = known.get(pieces[0], 0)
                while kind & 1 and j < n:
                    j += 1
                    kind = known.get(part[i:j], 0)
                    if kind > 1:
                        pieces.append(part[i:j])
                ahead.append(pieces)
            left = path[-1] if path else ""
            while ahead[-1]:
                piece = ahead[-1].pop()
                if i + len(piece) not in dead and self._fits(left, piece):
                    path.append(piece)
                    i += len(piece)
                    break
            else:
                dead.add(i)
                ahead.pop()
                i -= len(path.pop())
        return path

    def _fits(self, left: str, right: str) -> bool:
        """Whether the merges of both together give just these two."""
        if not left:
            return True
        fits = self.pairs.get(left)
        if fits is None:
            fits = self.pairs[left] = {}
        good = fits.get(right)
        if good is None:
            if self.held > MOST_PAIRS:
                self.pairs, self.held = {}, 0
                fits = self.pairs[left] = {}
            good = fits[right] = self.merged(left + right) == [left, right]
            self.held += 1
        return good

    def _weighted_path(self, part: str) -> list[str]:
        n, known, scores = len(part), self.known, self.scores
        best: list[tuple[float, str]] = [(0.0, "")] + [(np.inf, "")] * n
        for i in range(n):
            weight, j = best[i][0], i + 1
            while True:
                piece = part[i:j]
                kind = known.get(piece, 0)
                if kind > 1 or j == i + 1:
                    there = weight - scores.get(piece, self.unknown)
                    if there < best[j][0]:
                        best[j] = (there, piece)
                if j == n or not kind & 1:
                    break
                j += 1
        found, at = [], n
        while at:
            found.append(best[at][1])
            at -= len(best[at][1])
        return found[::-1]

    def _ids(self, part: str) -> bytes:
        found = []
        for piece in self.path(part):
            known = self.codes.get(piece)
            if known is None and self.nameless is not None:
                known = np.int32(self.nameless).astype("<i4").tobytes()
            elif known is None:
                raw = piece.encode("utf-8", "surrogatepass")
                known = np.array([self.bytes[b] for b in raw], "<i4").tobytes()
            found.append(known)
        return b"".join(found)

    def encode(self, text: str | None) -> np.ndarray:
        text, parts = self.normalise(text or ""), self.parts
        if self.fixed is None:
            found = b"".join([parts[p] for p in self.cut.findall(text)])
        else:
            joined, at = [], 0
            for match in self.fixed.finditer(text):
                joined += [parts[p] for p in self.cut.findall(text[at : match.start()])]
                joined.append(self.codes[match.group()])
                at = match.end()
            found = b"".join([*joined, *[parts[p] for p in self.cut.findall(text[at:])]])
        ids = np.frombuffer(found, "<i4")
        if self.nameless is not None:
            # Unknown characters in a row are one unknown piece.
            again = (ids[1:] == self.nameless) & (ids[:-1] == self.nameless)
            ids = ids[np.r_[True, ~again][: len(ids)]]
        return ids

    def decode(self, ids: np.ndarray) -> str:
        texts = self.texts
        text = b"".join([texts[i] for i in ids.tolist()]).decode("utf-8", "replace")
        return text[1:] if self.model.prefix and text.startswith(" ") else text


_COMPILED: dict[str, Transducer] = {}


def _compiled(model: Model, key: str) -> Transducer:
    """The machines of a model, compiled once in each worker."""
    if key not in _COMPILED:
        _COMPILED.clear()
        _COMPILED[key] = Transducer(model)
    return _COMPILED[key]


def _key(model: Model) -> str:
    return hashlib.sha256(repr((model.pieces, model.scores, model.kinds, model.bpe)).encode()).hexdigest()


def encode(docs: DataFrame, model_path: str = MODEL, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, ids (of the pieces), and round_trip (whether the ids decode to the text) for every row of `docs`."""
    model = Model.load(model_path)
    key = _key(model)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = _compiled(model, key)
        for batch in slices(batches, "text"):
            texts = batch["text"].to_pylist()
            found = [machine.encode(t) for t in texts]
            same = [machine.decode(ids) == (t or "") for ids, t in zip(found, texts)]
            edges = np.concatenate([[0], np.cumsum([len(ids) for ids in found])]).astype(np.int32)
            ids = pa.ListArray.from_arrays(pa.array(edges), pa.array(np.concatenate(found)))
            yield pa.RecordBatch.from_arrays([batch["id"], ids, pa.array(same, pa.bool_())], ["id", "ids", "round_trip"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(step, "id long, ids array<int>, round_trip boolean")


def decode(encoded: DataFrame, model_path: str = MODEL, id_col: str = "id", ids_col: str = "ids") -> DataFrame:
    """id, text for every row of `encoded`."""
    model = Model.load(model_path)
    key = _key(model)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = _compiled(model, key)
        for batch in batches:
            texts = [machine.decode(np.array(ids or [], np.int32)) for ids in batch["ids"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["id"], pa.array(texts, pa.string())], ["id", "text"])

    return encoded.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids")).mapInArrow(step, "id long, text string")
