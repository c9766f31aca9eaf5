"""Exact top-k inner products with a vector-approximation file.

Vectors are integers: each component x becomes floor(scale * x).  Three tables
are written, none of which repeats equal vectors:

* the exact vectors, with the ids that have them in order;
* the approximation file: blocks of vectors with a byte for each component,
  the number of its cell between the block's least and greatest value of that
  component.  It is an eighth of the components as doubles;
* the queries, in blocks.

1. Each block of queries meets the blocks of the approximation file, and only
   these.  A product of cells with the query gives for every vector a lower
   and an upper bound of its score; a vector stays while fewer than k others
   are certain to be ahead of it.  Tasks hold a group of blocks and let query
   blocks pass; thresholds of all groups are then combined.
2. The exact vectors of what is left are fetched by number and read, query by
   query, by falling upper bound (the least distance first) until the kth best
   score is above every bound left.

Vectors that are null or empty, hold null or non-finite components, or differ
in length from the query take no part (a query of that kind has no rows).
Scores are exact integers; beyond 64 bits they count, and are ranked, as the
largest or smallest of 64 bits.  Components beyond 2**480 have no bounds that
floating point can hold; such vectors are all read.  Ties go to the smaller id.

Every candidate row counts, repeated ones too.  A query is an id: repeated
query rows ask once, and where rows of one query id have different vectors a
candidate's score is the highest over them.  A query never meets rows of its
own id.  Vectors are bounded by their components only; a long one makes fewer
fit in a block.  An empty table gives an empty result, and extra columns are
ignored, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import textkernel as tk
from .store import Scratch

#: Vectors of a block of the file, its components at most, and queries of a block.
BLOCK_ROWS, BLOCK_CELLS, BLOCK_QUERIES = 8192, 1 << 21, 512
#: Blocks of the file that a task holds, query blocks that pass it, and pairs of vectors that are worth a task.
GROUP_BLOCKS, PASSING_BLOCKS, TASK_PAIRS = 48, 64, 16_000_000
#: Up to so many numbers of vectors (long) are broadcast to fetch them; beyond, the vectors are shuffled.
BROADCAST_IDS = 2_000_000
#: Survivors of a query whose exact vectors are read at once, in units of k.
STEP = 2
LONG_MAX, LONG_MIN = 2**63 - 1, -(2**63)
#: Beyond this components have no bounds.
HUGE = 2.0**480
NO_ID = LONG_MAX


def usable(vector: Column) -> Column:
    """A vector's components as doubles, null for one that takes no part."""
    wide = vector.cast("array<double>")
    odd = F.exists(wide, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.when((F.size(wide) > 0) & ~odd, wide)


def _integers(values: np.ndarray, scale: float) -> np.ndarray:
    """floor(scale * x): int64, or Python integers where these don't fit."""
    if values.size == 0 or np.abs(values).max() < 2**52 / abs(scale):
        return np.floor(values * scale).astype(np.int64)
    factor = Fraction(scale)
    return np.array([[math.floor(Fraction(x) * factor) for x in row] for row in values.tolist()], dtype=object).reshape(values.shape)


def _pack(values: np.ndarray) -> tuple[list[int], list[bytes]]:
    """Per row the bytes of a component (0: text) and all components; equal vectors have equal bytes."""
    if values.dtype != object:
        top = np.abs(values).max(1)
        kinds = np.select([top < 2**7, top < 2**15, top < 2**31], [1, 2, 4], 8)
        cast = {k: values[kinds == k].astype(f"<i{k}") for k in (1, 2, 4, 8)}
        at = {k: iter(v) for k, v in cast.items()}
        return kinds.tolist(), [next(at[k]).tobytes() for k in kinds.tolist()]
    out = []
    for row in values.tolist():
        top = max(map(abs, row))
        k = next((k for k in (1, 2, 4, 8) if top < 2 ** (8 * k - 1)), 0)
        out.append((k, np.array(row, f"<i{k}").tobytes() if k else ",".join(map(str, row)).encode()))
    return [k for k, _ in out], [b for _, b in out]


def _unpack(kind: int, packed: list[bytes], width: int) -> np.ndarray:
    if kind:
        return np.frombuffer(b"".join(packed), f"<i{kind}").reshape(-1, width)
    return np.array([[int(x) for x in p.split(b",")] for p in packed], dtype=object).reshape(-1, width)


def _floats(kinds: np.ndarray, packed: list[bytes], width: int) -> np.ndarray:
    """Components as doubles, rounded where they have more than 53 bits; infinite beyond ``HUGE``."""
    out = np.empty((len(packed), width))
    for kind in np.unique(kinds):
        some = np.flatnonzero(kinds == kind)
        rows = _unpack(int(kind), [packed[i] for i in some], width)
        if kind:
            out[some] = rows
        else:
            limit = int(HUGE)
            out[some] = [[float(x) if abs(x) < limit else (math.inf if x > 0 else -math.inf) for x in row] for row in rows.tolist()]
    return out


class Block:
    """A block of the approximation file."""

    def __init__(self, vec: np.ndarray, least: np.ndarray, second: np.ndarray, low: np.ndarray, step: np.ndarray, cells: np.ndarray):
        self.vec, self.least, self.second, self.low, self.step, self.cells = vec, least, second, low, step, cells
        self.order = np.argsort(least, kind="stable")
        self.sorted_least = least[self.order]
        self.top = cells.max(0, initial=0).astype(np.float64)
        self.whole = bool((np.abs(low) + 256 * step < 2**52).all())  # corners and cells are exact integers
        # what a value may be above its cell's corner
        self.span = step - 1 if self.whole else step

    @classmethod
    def make(cls, vec: np.ndarray, least: np.ndarray, second: np.ndarray, values: np.ndarray) -> Block:
        with np.errstate(invalid="ignore", over="ignore"):
            low = values.min(0)
            step = np.maximum(1.0, np.ceil((values.max(0) - low + 1) / 256))
            cells = np.clip(np.floor((values - low) / step), 0, 255)
        known = np.isfinite(values).all()
        return cls(vec, least, second, low if known else np.full(len(low), np.inf), step if known else np.ones(len(low)), cells.astype(np.uint8) if known else np.zeros(values.shape, np.uint8))

    def bounds(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Products of cells with every query, and per query what to add to
        them for the lower and for the upper bound of the scores."""
        if not np.isfinite(self.low).all():
            return np.zeros((len(queries), len(self.vec)), np.float32), np.full(len(queries), -np.inf), np.full(len(queries), np.inf)
        finite = np.isfinite(queries).all(1)
        q = np.where(finite[:, None], queries, 0)
        steps = q * self.step
        size = np.abs(q) @ (np.abs(self.low) + 256 * self.step)
        exact = self.whole and bool((size < 2**53).all())
        # sums of whole numbers below 2 ** 24 have no error in 32 bits
        kind = np.float32 if exact and float((np.abs(steps) @ self.top).max(initial=0)) < 2**24 else np.float64
        product = steps.astype(kind) @ self.cells.astype(kind).T
        corner = q @ self.low
        error = 0.0 if exact else 2.0**-44 * (q.shape[1] + 8) * size
        under = np.where(finite, corner + np.minimum(q, 0) @ self.span - error, -np.inf)
        over = np.where(finite, corner + np.maximum(q, 0) @ self.span + error, np.inf)
        return product, under, over

    def packed(self) -> list[bytes]:
        return [x.tobytes() for x in (self.vec, self.least, self.second, self.low, self.step, self.cells)]

    @classmethod
    def unpacked(cls, width: int, vec: bytes, least: bytes, second: bytes, low: bytes, step: bytes, cells: bytes) -> Block:
        return cls(*[np.frombuffer(x, np.int64) for x in (vec, least, second)], np.frombuffer(low), np.frombuffer(step), np.frombuffer(cells, np.uint8).reshape(-1, width))


class Survivors:
    """What may be among the best k of each query of a block."""

    def __init__(self, ids: np.ndarray, values: np.ndarray, k: int):
        self.ids, self.values, self.k = ids, values, k
        self.order = np.argsort(ids, kind="stable")
        self.least = np.full(len(ids), -np.inf)  # the kth lower bound
        self.rows: tuple[np.ndarray, ...] = tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.float64, np.float64))  # query, vector, id, bounds

    def _own(self, block: Block) -> tuple[np.ndarray, np.ndarray]:
        """(query, vector) pairs where the vector's smallest id is the query's own."""
        ids = self.ids[self.order]
        start, stop = (np.searchsorted(block.sorted_least, ids, side) for side in ("left", "right"))
        n = stop - start
        at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(start, n)
        return np.repeat(self.order, n), block.order[at]

    def add(self, block: Block) -> None:
        product, under, over = block.bounds(self.values)
        q, v = self._own(block)
        alone = block.second[v] == NO_ID  # no other row has this vector
        product[q[alone], v[alone]] = -np.inf
        n = product.shape[1]
        with np.errstate(invalid="ignore"):
            first = np.isneginf(self.least)
            least = self.least.copy()  # a lower bound that k vectors have
            if first.any() and n > self.k:
                kth = np.partition(product[first], n - self.k, axis=1)[:, n - self.k].astype(np.float64)
                least[first] = np.where(np.isfinite(under[first]) & np.isfinite(kth), kth + under[first], -np.inf)
            # scores end at 64 bits: what is above counts as that, and below nothing is told apart
            floor = np.where(least > float(LONG_MIN), np.minimum(least, 2.0**63), -np.inf) - over
        floor[np.isnan(floor)] = -np.inf
        # thresholds are rounded down to the products' type
        low = np.nextafter(floor.astype(product.dtype), product.dtype.type(-np.inf))
        hit = np.flatnonzero((product >= low[:, None]) & (product > -np.inf))
        qi, vi = hit // n, hit % n
        found = product.ravel()[hit].astype(np.float64)
        own = block.least[vi] == self.ids[qi]
        clipped = [np.clip(found + side[qi], float(LONG_MIN), 2.0**63) for side in (under, over)]
        new = (qi, block.vec[vi], np.where(own, block.second[vi], block.least[vi]), *clipped)
        self.rows = tuple(np.concatenate(x) for x in zip(self.rows, new, strict=True))
        self._prune()

    def _prune(self) -> None:
        q, _, ids, lower, upper = self.rows
        order = np.lexsort((ids, -lower, q))
        start = np.searchsorted(q[order], np.arange(len(self.ids)))
        at = start + self.k - 1
        full = at < np.append(start[1:], len(q))
        kth = order[at[full]]
        self.least[full] = lower[kth]
        last = np.full(len(self.ids), LONG_MAX)
        last[full] = ids[kth]
        keep = (upper > self.least[q]) | (upper == self.least[q]) & (ids <= last[q])
        self.rows = tuple(x[keep] for x in self.rows)


def _stored(rows: DataFrame, row_id: str, vector: str, queries: Column, scale: float) -> DataFrame:
    """(id, q, width, kind, packed) of the rows that take part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(2)
            widths = np.diff(values.offsets.to_numpy())
            flat = values.flatten().to_numpy(zero_copy_only=False)
            starts = np.cumsum(widths) - widths
            for width in np.unique(widths).tolist():
                some = np.flatnonzero(widths == width)
                kinds, packed = _pack(_integers(flat[starts[some][:, None] + np.arange(width)], scale))
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(some)), batch.column(1).take(pa.array(some)), pa.array([width] * len(some), pa.int32()), pa.array(kinds, pa.int32()), pa.array(packed, pa.binary())], ["id", "q", "width", "kind", "packed"])

    own = rows.select(F.col(row_id).cast("long").alias("id"), F.coalesce(queries, F.lit(False)).alias("q"), usable(F.col(vector)).alias("v")).filter("id IS NOT NULL AND v IS NOT NULL")
    return own.mapInArrow(tk.released(run), "id long, q boolean, width int, kind int, packed binary")


def _file(exact: DataFrame) -> DataFrame:
    """The approximation file: blocks of the vectors as they stand, without a shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}

        def block(width: int) -> pa.RecordBatch:
            vec, least, second, kinds, packed = zip(*held.pop(width), strict=True)
            made = Block.make(np.array(vec), np.array(least), np.array(second), _floats(np.array(kinds), list(packed), width))
            return pa.RecordBatch.from_arrays([pa.array([width], pa.int32()), pa.array([len(vec)], pa.int64()), *[pa.array([x], pa.binary()) for x in made.packed()]], ["width", "n", "vec", "least", "second", "low", "step", "cells"])

        for batch in batches:
            for width, *row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                own = held.setdefault(width, [])
                own.append(row)
                if len(own) >= min(BLOCK_ROWS, max(1, BLOCK_CELLS // width)):
                    yield block(width)
        for width in list(held):
            yield block(width)

    rows = exact.select("width", "vec", F.col("ids")[0]["id"].alias("least"), F.when(F.size("ids") > 1, F.get("ids", F.lit(1))["id"]).otherwise(F.lit(NO_ID)).alias("second"), "kind", "packed")
    blocks = rows.mapInArrow(tk.released(run), "width int, n long, vec binary, least binary, second binary, low binary, step binary, cells binary")
    return blocks.withColumn("block", F.monotonically_increasing_id())


def _query_blocks(asked: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}

        def block(width: int) -> pa.RecordBatch:
            numbers, ids, kinds, packed = zip(*held.pop(width), strict=True)
            columns = np.array(numbers), np.array(ids), _floats(np.array(kinds), list(packed), width)
            return pa.RecordBatch.from_arrays([pa.array([width], pa.int32()), *[pa.array([x.tobytes()], pa.binary()) for x in columns]], ["width", "numbers", "q_ids", "q_values"])

        for batch in batches:
            for width, *row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                own = held.setdefault(width, [])
                own.append(row)
                if len(own) >= BLOCK_QUERIES:
                    yield block(width)
        for width in list(held):
            yield block(width)

    rows = asked.select("width", "number", "id", "kind", "packed").mapInArrow(tk.released(run), "width int, numbers binary, q_ids binary, q_values binary")
    return rows.withColumn("q_block", F.monotonically_increasing_id())


def survivors(file: DataFrame, blocks: DataFrame, k: int) -> tuple[DataFrame, int]:
    """(number, vec, id, lower, upper) of the vectors that may be among a
    query's best k within a group of blocks, and how many groups there are."""
    n_blocks, n_rows = file.agg(F.count(F.lit(1)), F.sum("n")).first()
    n_asked = blocks.count()
    groups = -(-n_blocks // GROUP_BLOCKS) or 1
    passing = max(1, min(PASSING_BLOCKS, TASK_PAIRS // max(1, BLOCK_QUERIES * (n_rows or 0) // groups)))
    streams = -(-n_asked // passing) or 1
    # both sides are numbered in a row, so that groups and streams are even; both tables are few and large rows
    place = lambda df, key: df.withColumn("at", F.row_number().over(Window.orderBy(key)) - 1)
    order_file = place(file.select("block"), "block").select("block", F.pmod("at", F.lit(groups)).alias("g"))
    order_asked = place(blocks.select("q_block"), "q_block").select("q_block", F.pmod("at", F.lit(streams)).alias("h"))
    none = lambda *names: [F.lit(None).cast("binary").alias(c) for c in names]
    if max(n_blocks, n_asked) <= BROADCAST_IDS:  # a row of two numbers for each block
        order_file, order_asked = F.broadcast(order_file), F.broadcast(order_asked)
    held = file.join(order_file, "block").select("g", F.explode(F.sequence(F.lit(0), F.lit(streams - 1))).alias("h"), F.lit(0).alias("side"), "width", "vec", "least", "second", "low", "step", "cells", *none("numbers", "q_ids", "q_values"))
    passed = blocks.join(order_asked, "q_block").select(F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("g"), "h", F.lit(1).alias("side"), "width", *none("vec", "least", "second", "low", "step", "cells"), "numbers", "q_ids", "q_values")
    sent = held.unionByName(passed).repartitionById(groups * streams, (F.col("g") * streams + F.col("h")).cast("int")).sortWithinPartitions("side")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine: dict[int, list[Block]] = {}  # the blocks of a group, by width; then queries pass
        for batch in batches:
            for i in range(batch.num_rows):
                side, width, *rest = (batch.column(c)[i].as_py() for c in range(2, 13))
                if side == 0:
                    mine.setdefault(width, []).append(Block.unpacked(width, *rest[:6]))
                    continue
                numbers, ids = (np.frombuffer(x, np.int64) for x in rest[6:8])
                left = Survivors(ids, np.frombuffer(rest[8]).reshape(-1, width), k)
                for block in mine.get(width, ()):
                    left.add(block)
                q, vec, found, lower, upper = left.rows
                yield pa.RecordBatch.from_arrays([pa.array(numbers[q]), pa.array(vec), pa.array(found), pa.array(lower), pa.array(upper)], ["number", "vec", "id", "lower", "upper"])

    return sent.mapInArrow(tk.released(run), "number long, vec long, id long, lower double, upper double"), groups


def _best(parts: DataFrame, k: int) -> DataFrame:
    """Survivors of all groups under the kth lower bound of all."""
    order = Window.partitionBy("number").orderBy(F.col("lower").desc(), "id")
    first = parts.select("number", "lower", "id", F.row_number().over(order).alias("place")).filter(F.col("place") <= k)
    kth = first.filter(F.col("place") == k).select("number", F.col("lower").alias("t_lower"), F.col("id").alias("t_id"))
    both = parts.join(kth, "number", "left")
    return both.filter("t_lower IS NULL OR upper > t_lower OR (upper = t_lower AND id <= t_id)").drop("t_lower", "t_id")


def _scores(rows: list[bytes], kinds: list[int], query: np.ndarray, width: int) -> list[int]:
    """Exact scores, those beyond 64 bits cut to 64."""
    out = np.empty(len(rows), object)
    for kind in set(kinds):
        some = [i for i, x in enumerate(kinds) if x == kind]
        values = _unpack(kind, [rows[i] for i in some], width)
        if kind and query.dtype != object and max(map(abs, query.tolist())) * width << (8 * kind - 1) < 2**63:
            found = values.astype(np.int64) @ query.astype(np.int64)
        else:
            wide = [int(x) for x in query.tolist()]
            found = [max(min(sum(a * b for a, b in zip(row, wide, strict=True)), LONG_MAX), LONG_MIN) for row in values.tolist()]
        out[some] = [int(x) for x in found]
    return out.tolist()


def _read_exact(rows: DataFrame, k: int) -> DataFrame:
    """(query_id, vec, id, copy, score): the best k rows of each query vector.

    Rows are (number, upper, vec, the query's and the vector's components, ids);
    they stream by query and falling bound, and nothing is read behind the
    point where the kth result is certain.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, query, query_id, best, waiting, certain = None, None, None, [], [], False

        def read() -> None:
            nonlocal best, waiting
            if waiting:
                scores = _scores([w[2] for w in waiting], [w[1] for w in waiting], query, len(query))
                for (vec, _, _, ids), score in zip(waiting, scores, strict=True):
                    best += [(-score, x["id"], vec, c) for x in ids if x["id"] != query_id for c in range(x["n"])]
                best = sorted(best)[:k]
                waiting = []

        def result() -> pa.RecordBatch:
            read()
            columns = [[query_id] * len(best), [b[2] for b in best], [b[1] for b in best], [b[3] for b in best], [-b[0] for b in best]]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["query_id", "vec", "id", "copy", "score"])

        for batch in batches:
            for number, upper, vec, width, q_id, q_kind, q_packed, kind, packed, ids in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if number != at:
                    if at is not None:
                        yield result()
                    at, query, query_id, best, certain = number, _unpack(q_kind, [q_packed], width)[0], q_id, [], False
                if certain:
                    continue
                if len(waiting) >= STEP * k:
                    read()
                    certain = len(best) >= k and upper < -best[k - 1][0]
                    if certain:
                        continue
                waiting.append((vec, kind, packed, ids))
        if at is not None:
            yield result()

    own = rows.repartition("number").sortWithinPartitions("number", F.col("upper").desc(), "id")
    own = own.select("number", "upper", "vec", "width", "q_id", "q_kind", "q_packed", "kind", "packed", "ids")
    return own.mapInArrow(tk.released(run), "query_id long, vec long, id long, copy long, score long")


def top_k(vectors: DataFrame, queries: Column, k: int = 20, row_id: str = "vec_id", vector: str = "embedding", scale: float = 64.0) -> DataFrame:
    """``query_id``, ``rank`` (from 1), the found row's id and ``score``.

    ``queries`` is the condition that makes a row a query; all rows but those
    of the query's own id are candidates.
    """
    scratch = Scratch(vectors.sparkSession, "vafile")
    rows = _stored(vectors, row_id, vector, queries, scale)
    key = ["width", "kind", "packed"]
    # of one vector the k + 1 smallest ids matter, each up to k times: that leaves k rows besides any query's own
    counted = rows.groupBy(*key, "id").agg(F.least(F.count(F.lit(1)), F.lit(k)).cast("int").alias("n"))
    first = counted.withColumn("place", F.row_number().over(Window.partitionBy(*key).orderBy("id"))).filter(F.col("place") <= k + 1)
    exact = first.groupBy(*key).agg(F.sort_array(F.collect_list(F.struct("id", "n"))).alias("ids")).withColumn("vec", F.monotonically_increasing_id())
    exact = scratch.save(exact, "exact")
    asked = scratch.save(rows.filter("q").select(*key, "id").distinct().withColumn("number", F.monotonically_increasing_id()), "queries")
    file = scratch.save(_file(exact), "file")
    blocks = scratch.save(_query_blocks(asked), "query-blocks")
    parts, groups = survivors(file, blocks, k)
    left = scratch.save(parts, "survivors")
    if groups > 1:
        left = scratch.save(_best(left, k), "best")
    scratch.drop("file", "query-blocks")
    wanted = left.select("vec").distinct()
    few = wanted.count() <= BROADCAST_IDS
    fetched = exact.join(F.broadcast(wanted) if few else wanted, "vec", "left_semi")
    of_query = asked.select("number", F.col("id").alias("q_id"), F.col("kind").alias("q_kind"), F.col("packed").alias("q_packed"))
    found = _read_exact(left.select("number", "vec", "id", "upper").join(fetched, "vec").join(of_query, "number"), k)
    # a query id with several vectors: the highest score of each candidate row
    found = found.groupBy("query_id", "vec", "id", "copy").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", F.col("id").alias(row_id), "score")
