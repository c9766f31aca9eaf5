"""What the trained operators share: labelled samples, sums over tasks, training.

A label counts if it is 0 or 1; of several for one id the smaller counts.  Ids
are put in order by a hash, ties by the id, so a sample is the same on reruns.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import textkernel as tk

#: Numbers that a task sends at once.
CHUNK = 1 << 16


def fold(row_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id is in fold 0."""
    return F.coalesce(F.crc32(row_id.cast("string").cast("binary")) % folds, F.lit(0))


def sample(docs: DataFrame, labels: DataFrame, label: str, usable: Callable[[Column], Column], bound: int, row_id: str, text: str) -> DataFrame:
    """(id, text, label) of up to ``bound`` labelled rows, those that a hash of
    the id puts first among the ids that both tables have.  A text of any
    length may be among them; of several rows with one id the caller takes
    that with the smallest digest (``one_per_id``)."""
    own = labels.select(F.col(row_id).alias("_id"), F.col(label).cast("int").alias("label"))
    own = own.filter(F.col("label").isin(0, 1) & F.col("_id").isNotNull() & usable(F.col("_id"))).groupBy("_id").agg(F.min("label").alias("label"))
    there = docs.select(F.col(row_id).alias("id"))  # ids only: the bound is filled with labels that have a text
    own = own.join(there, F.col("_id") == F.col("id"), "left_semi").orderBy(F.md5(F.col("_id").cast("string")), "_id").limit(bound)
    rows = docs.select(F.col(row_id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return rows.join(F.broadcast(own), F.col("id") == F.col("_id")).select("id", "text", "label")  # at most ``bound`` rows are broadcast


def one_per_id(rows: DataFrame, digest: str, *columns: str) -> DataFrame:
    """Of rows with one id that with the smallest digest, ordered by a hash of the id."""
    best = rows.groupBy("id").agg(F.min(F.struct(digest, *columns)).alias("r"))
    return best.select("id", *[F.col(f"r.{c}") for c in columns]).orderBy(F.md5(F.col("id").cast("string")), "id")


def _packed(numbers: np.ndarray) -> bytes:
    """Mostly small integers: signs folded in, then the bytes of one weight together."""
    folded = (numbers << 1) ^ (numbers >> (8 * numbers.itemsize - 1))
    planes = folded.view(np.uint8).reshape(-1, numbers.itemsize).T
    return zlib.compress(np.ascontiguousarray(planes).tobytes(), 1)


def _unpacked(packed: bytes) -> np.ndarray:
    """Of a chunk, as 64-bit integers."""
    raw = np.frombuffer(zlib.decompress(packed), np.uint8)
    planes = raw.reshape(len(raw) // CHUNK, CHUNK)
    folded = np.zeros(CHUNK, np.int64)
    for k, plane in enumerate(planes):
        folded |= plane.astype(np.int64) << (8 * k)
    return (folded >> 1) ^ -(folded & 1)


def emit(table: np.ndarray) -> Iterator[pa.RecordBatch]:
    """A task's table of integers (a multiple of ``CHUNK``) as rows (chunk, numbers), without empty chunks."""
    flat = table.ravel()
    for at in range(0, len(flat), CHUNK):
        part = flat[at : at + CHUNK]
        if part.any():
            yield pa.RecordBatch.from_arrays([pa.array([at // CHUNK], pa.int32()), pa.array([_packed(part)], pa.binary())], ["chunk", "numbers"])


def summed(parts: DataFrame, size: int, finish: Callable[[np.ndarray], np.ndarray], dtype) -> np.ndarray:
    """``finish`` of each chunk of the sum of the tasks' tables, which all have ``size`` numbers."""

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray]]:
        totals: dict[int, np.ndarray] = {}  # a task gets few of the chunks, each of a fixed size
        for batch in batches:
            for chunk, numbers in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                part = _unpacked(numbers.as_py())
                totals[chunk] = totals[chunk] + part if chunk in totals else part
        yield from totals.items()

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk, numbers in total(batches):
            yield pa.RecordBatch.from_arrays([pa.array([chunk], pa.int32()), pa.array([_packed(numbers)], pa.binary())], ["chunk", "numbers"])

    def end(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk, numbers in total(batches):
            yield pa.RecordBatch.from_arrays([pa.array([chunk], pa.int32()), pa.array([zlib.compress(finish(numbers).astype(dtype).tobytes(), 1)], pa.binary())], ["chunk", "numbers"])

    # sums of parts of the tasks first, so that no task reads a chunk of every task
    once = parts.repartition("chunk", F.pmod(F.hash("numbers"), F.lit(16))).mapInArrow(tk.released(add), "chunk int, numbers binary")
    sums = once.repartition("chunk").mapInArrow(tk.released(end), "chunk int, numbers binary")
    out = np.zeros(size, dtype)
    for chunk, numbers in sums.collect():  # a table of a fixed size, packed
        out[chunk * CHUNK : chunk * CHUNK + CHUNK] = np.frombuffer(zlib.decompress(numbers), dtype)
    return out


class Adam:
    """Gradient steps for a dict of arrays."""

    def __init__(self, parameters: dict[str, np.ndarray], rate: float):
        self.p, self.rate, self.t = parameters, rate, 0
        self.m = {k: np.zeros_like(v) for k, v in parameters.items()}
        self.v = {k: np.zeros_like(v) for k, v in parameters.items()}

    def step(self, gradient: dict[str, np.ndarray]) -> None:
        self.t += 1
        for k, g in gradient.items():
            self.m[k] += 0.1 * (g - self.m[k])
            self.v[k] += 0.001 * (g * g - self.v[k])
            self.p[k] -= self.rate * (self.m[k] / (1 - 0.9**self.t)) / (np.sqrt(self.v[k] / (1 - 0.999**self.t)) + 1e-8)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The divisor of the logits under which the labels are likeliest.

    Labels count as the shares (n1 + 1) / (n1 + 2) and 1 / (n0 + 2), as in
    Platt's calibration, so classes that the logits part wholly have a finite
    optimum too.  The loss is convex in the inverse of the temperature: the
    zero of its slope is found by halving, between bounds that it is inside.
    """
    n1 = int(labels.sum())
    target = np.where(labels > 0, (n1 + 1) / (n1 + 2), 1 / (len(labels) - n1 + 2))
    z = logits.astype(np.float64)

    def slope(inverse: float) -> float:
        return float(np.mean((sigmoid(z * inverse) - target) * z))

    low, high = 0.0, 1.0
    if slope(low) >= 0:  # the logits tell nothing, or the opposite
        return 1e3
    while slope(high) < 0 and high < 1e6:
        high *= 2
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if slope(middle) < 0 else (low, middle)
    return 1 / max(high, 1e-3)
