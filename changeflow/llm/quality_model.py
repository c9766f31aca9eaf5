"""Quality scores: random-indexing vectors, pooled, and a two-layer network.

Words are runs of one class of characters (lower case and other letters, upper
case, digits, each other characters), keyed by a 64-bit hash of all their
bytes.  Each word has a sparse random index vector, drawn from its hash.  Its
context vector is the sum of the index vectors of its neighbours over the
whole corpus, divided by its length.  Context vectors are rows of a table of
``2**SLOT_BITS`` slots that the first bits of the hash choose, so the table
that is broadcast has one size for any corpus (16 MB) and words that share a
slot share its vector; index vectors use all bits.
A document is pooled from the context vectors of its words, in their order:
their mean, the mean size of the steps between neighbours, and the logarithm of
how many there are.  A two-layer network trained in numpy scores it, and a
temperature fitted on labelled rows set aside calibrates the probability.

The corpus pass and the scoring pass read every text whole, whatever its
length; training uses at most ``bound`` labelled rows, those whose id a hash
puts first.  Only texts are inputs of a score.

A null text counts as empty and is scored like any other.  Without usable
labels, or with one class only, every score is the share of label 1 (0.5
without labels).  Of labelled rows that share an id the one whose text has the
smallest digest is learned from.  A score of exactly 0.5 predicts 1.  Repeated
rows repeat; an empty table gives an empty result; extra columns are ignored,
whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import fitting
from . import textkernel as tk
from .store import small_batches

#: Dimensions of the words' vectors (a power of 2), and how many of an index vector's numbers aren't 0.
DIMENSIONS, NONZERO = 32, 4
#: Numbers of a pooled text: two a dimension, and its length.
INPUTS = 2 * DIMENSIONS + 1
INDEX_SEED = np.uint64(20)
#: Rows of the table of context vectors, as a power of 2; a word's row is taken from the hash of all its bytes.
SLOT_BITS = 18
HIDDEN, EPOCHS, RATE, DECAY, SET_ASIDE = 32, 60, 3e-3, 1e-3, 5
PIECE = 1_000_000

CLASS = np.full(256, 4, np.uint8)
CLASS[tk.BLANK] = 0
CLASS[[*range(ord("a"), ord("z") + 1), *range(0x80, 0x100)]] = 1
CLASS[ord("A") : ord("Z") + 1] = 2
CLASS[ord("0") : ord("9") + 1] = 3


def _keys(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words and per text the number of its first."""
    n = int(offsets[-1])
    kind = CLASS[buf[:n]]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    change = np.ones(n, bool)
    change[1:] = (kind[1:] != kind[:-1]) | edge[1:n]
    starts = np.flatnonzero(change)
    ends = np.append(starts[1:], n)
    words = kind[starts] > 0
    starts, ends = starts[words], ends[words]
    return tk.hash_spans(buf, starts, ends), np.searchsorted(starts, offsets)


def _neighbours(slots: np.ndarray, keys: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct slots of some texts' words, and per slot the sum of the
    index vectors of its words' neighbours in the same text."""
    found, of = np.unique(slots, return_inverse=True)
    near = np.ones(max(len(keys) - 1, 0), bool)
    near[first[(first > 0) & (first < len(keys))] - 1] = False  # the next word is in another text
    left = np.flatnonzero(near)
    draws = tk.mix(keys ^ INDEX_SEED)
    sums = np.zeros(len(found) * DIMENSIONS)
    for at, other in ((left, left + 1), (left + 1, left)):
        row, draw = of[at] * DIMENSIONS, draws[other]
        for k in range(NONZERO):  # 5 bits of the hash are a place, one more the sign
            bits = (draw >> np.uint64(6 * k)).astype(np.int64)
            sums += np.bincount(row + (bits & (DIMENSIONS - 1)), 1.0 - 2.0 * (bits >> 5 & 1), len(sums))
    return found, sums.reshape(-1, DIMENSIONS).astype(np.int32)


def _slots(keys: np.ndarray) -> np.ndarray:
    return (keys >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


def _unit(sums: np.ndarray) -> np.ndarray:
    """Context sums as vectors of length 1; without neighbours all are 0."""
    rows = sums.reshape(-1, DIMENSIONS).astype(np.float64)
    length = np.sqrt((rows**2).sum(1, keepdims=True))
    return (rows / np.where(length > 0, length, 1)).ravel()


def context_vectors(texts: DataFrame) -> np.ndarray:
    """The table of context vectors: per slot of words' hashes the sum of the
    neighbours' index vectors over all texts, of length 1.  Its size is fixed."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, held = np.zeros((1 << SLOT_BITS, DIMENSIONS), np.int32), 0
        for batch in batches:
            for _, _, buf, offsets in tk.pieces(batch.column(0), PIECE):
                keys, first = _keys(buf, offsets)
                found, sums = _neighbours(_slots(keys), keys, first)
                table[found] += sums
                held += len(keys)
                if held > 1 << 28:  # far below what 32 bits hold
                    yield from fitting.emit(table)
                    table[:], held = 0, 0
        yield from fitting.emit(table)

    parts = texts.select("text").mapInArrow(tk.released(count), "chunk int, numbers binary")
    return fitting.summed(parts, DIMENSIONS << SLOT_BITS, _unit, np.float16).reshape(-1, DIMENSIONS)


def pooled(texts: pa.Array, table: np.ndarray) -> np.ndarray:
    """Per text the mean of its words' context vectors, the mean size of the
    steps from each to the next, and the logarithm of its length."""
    out = []
    for a, b, buf, offsets in tk.pieces(texts, PIECE):
        rows = np.zeros((b - a, INPUTS), np.float32)
        keys, first = _keys(buf, offsets)
        counts = np.diff(first)
        some = np.flatnonzero(counts)
        if len(some):
            begin, n = first[:-1][some], counts[some, None]
            vectors = table[_slots(keys)].astype(np.float32)
            rows[some, :DIMENSIONS] = np.add.reduceat(vectors, begin, axis=0) / n
            vectors[:-1] -= vectors[1:]
            vectors[first[1:][some] - 1] = 0  # no step leads out of a text
            rows[some, DIMENSIONS:-1] = np.add.reduceat(np.abs(vectors, out=vectors), begin, axis=0) / n
        rows[:, -1] = np.log1p(counts)
        out.append(rows)
    return np.concatenate(out) if out else np.zeros((0, INPUTS), np.float32)


@dataclass
class Network:
    mean: np.ndarray
    scale: np.ndarray
    weights: dict[str, np.ndarray]
    temperature: float

    def logits(self, rows: np.ndarray) -> np.ndarray:
        w = self.weights
        hidden = np.maximum((rows - self.mean) / self.scale @ w["w1"] + w["b1"], 0)
        return hidden @ w["w2"] + w["b2"]

    def score(self, rows: np.ndarray) -> np.ndarray:
        return fitting.sigmoid(self.logits(rows).astype(np.float64) / self.temperature)


@dataclass
class Constant:
    value: float

    def score(self, rows: np.ndarray) -> np.ndarray:
        return np.full(len(rows), self.value)


def train(rows: np.ndarray, labels: np.ndarray) -> Network | Constant:
    """Fit on four fifths of the rows, calibrate on the rest."""
    if len(set(labels.tolist())) < 2:
        return Constant(float(labels.mean()) if len(labels) else 0.5)
    draw = np.random.default_rng(9)
    aside = np.arange(len(rows)) % SET_ASIDE == 0
    if len(set(labels[aside].tolist())) < 2 or len(set(labels[~aside].tolist())) < 2:
        aside = np.zeros(len(rows), bool)
    x, y = rows[~aside].astype(np.float64), labels[~aside].astype(np.float64)
    mean, scale = x.mean(0), x.std(0) + 1e-3
    x = (x - mean) / scale
    w = {"w1": draw.normal(0, (2 / x.shape[1]) ** 0.5, (x.shape[1], HIDDEN)), "b1": np.zeros(HIDDEN), "w2": draw.normal(0, HIDDEN**-0.5, HIDDEN), "b2": np.zeros(())}
    steps = fitting.Adam(w, RATE)
    for _ in range(max(EPOCHS, 3000 * 128 // len(x) if len(x) < 6400 else 0)):
        order = draw.permutation(len(x))
        for at in range(0, len(x), 128):
            some = order[at : at + 128]
            hidden = np.maximum(x[some] @ w["w1"] + w["b1"], 0)
            error = (fitting.sigmoid(hidden @ w["w2"] + w["b2"]) - y[some]) / len(some)
            back = np.outer(error, w["w2"]) * (hidden > 0)
            steps.step({"w1": x[some].T @ back + DECAY * w["w1"], "b1": back.sum(0), "w2": hidden.T @ error + DECAY * w["w2"], "b2": error.sum()})
    net = Network(mean, scale, w, 1.0)
    held = aside if aside.any() else np.ones(len(rows), bool)
    net.temperature = fitting.temperature(net.logits(rows[held]), labels[held])
    return net


@dataclass
class Model:
    """A fitted model: broadcast context vectors and network, both of a fixed size."""

    vectors: object
    network: object

    def apply(self, docs: DataFrame, text: str, keep: tuple[str, ...]) -> DataFrame:
        """The columns ``keep`` in their order, then ``score`` and ``predicted``."""
        vectors, network = self.vectors, self.network

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                p = network.value.score(pooled(batch.column(0), vectors.value))
                yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(p, pa.float64()), pa.array((p >= 0.5).astype(np.int32), pa.int32())], names)

        rows = docs.select(F.col(text).alias("t"), *[F.col(c).alias(f"k{i}") for i, c in enumerate(keep)])
        names = [*rows.columns[1:], "score", "predicted"]
        schema = T.StructType([*rows.schema.fields[1:], T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])
        out = rows.mapInArrow(tk.released(run), schema)
        return out.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)], "score", "predicted")


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", usable: Callable[[Column], Column] = lambda i: F.lit(True), row_id: str = "doc_id", text: str = "text", bound: int = 20_000) -> Model:
    """``usable`` of an id tells whether its label may be learned from."""
    small_batches(docs.sparkSession)
    context = docs.sparkSession.sparkContext
    vectors = context.broadcast(context_vectors(docs.select(F.col(text).alias("text"))))

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = pooled(batch.column(1), vectors.value)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), batch.column(3), pa.array([r.tobytes() for r in rows], pa.binary())], ["id", "label", "digest", "row"])

    chosen = fitting.sample(docs, labels, label, usable, bound, row_id, text).withColumn("digest", F.md5("text"))
    schema = T.StructType([chosen.schema["id"], *T._parse_datatype_string("label int, digest string, row binary").fields])
    made = chosen.select("id", "text", "label", "digest").mapInArrow(tk.released(features), schema)
    found = fitting.one_per_id(made, "digest", "row", "label").toPandas()  # at most ``bound`` short rows
    rows = np.frombuffer(b"".join(found["row"]), np.float32).reshape(-1, INPUTS)
    return Model(vectors, context.broadcast(train(rows, found["label"].to_numpy(np.int64))))


def score(docs: DataFrame, labels: DataFrame, row_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """Per row of ``docs``: ``row_id``, ``score`` (0 to 1) and ``predicted``."""
    return fit(docs, labels, row_id=row_id, text=text, **options).apply(docs, text, (row_id,))


def keep_good(docs: DataFrame, labels: DataFrame, row_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that are predicted to be good, with their columns."""
    scored = fit(docs, labels, row_id=row_id, text=text, **options).apply(docs.withColumnsRenamed({"score": "_score", "predicted": "_predicted"}), text, tuple({"score": "_score", "predicted": "_predicted"}.get(c, c) for c in docs.columns))
    return scored.filter("predicted = 1").drop("score", "predicted").withColumnsRenamed({"_score": "score", "_predicted": "predicted"})
