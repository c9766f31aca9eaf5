r"""Similarity join of texts by the Jaccard measure of their word n-grams.

A-Z is lowered; words are runs of ``[^\x20\x09-\x0D]``; the tokens of a text
are its distinct shingles of ``width`` words (fewer words: the whole sequence
as one), held as 64-bit hashes.  Two texts link when
100 * |intersection| >= percent * |union|.  The result is the connected
components of the links.

1. Texts with equal token sets form classes by a digest; one of each goes on.
2. A count sketch over the tokens of all documents tells frequent tokens, those
   whose counters stand out from the load that all have.  It only shapes the
   orders below, so its errors cost time, never a link.
3. Under a global order of tokens, two texts that link share a token among
   the first n - ceil(percent * n / 100) + 1 of each.  There are three orders,
   each with frequent tokens last and hashed differently within a frequency.
   The first makes candidates: tokens are dealt to buckets, and each group of
   up to ``SMALL`` texts with a token in their prefixes gives its pairs, less
   those that lengths and positions rule out.  Candidates that share no prefix
   token under the second and the third order are dropped.
4. What is left is verified on whole sets.
5. Larger groups make no pairs.  First their texts are compared with three
   hubs each, which joins most copies.  Then the texts of groups that still
   hold several components are packed in blocks of like lengths, by component
   where it is large, and only blocks that share a frequent prefix token, whose
   lengths fit and that are not of one component meet, each once.  Of two
   blocks the texts stay that have a prefix token of the other block under
   each of the three orders; a product of incidence matrices counts their
   intersections.  So no group is capped and every link is found or implied.

A null text and one without words have no tokens and link with nothing.  Ids
that are null, repeated or no integers are replaced by row numbers inside; rows
that share an id are rows of their own, and a component carries the smallest
id of its rows, null last.  Extra columns are ignored, whatever their names;
an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import fitting
from . import textkernel as tk
from .graph import components
from .store import Scratch

#: Groups of up to so many texts give their pairs, larger ones go to blocks.
SMALL = 64
#: Texts and tokens of a block, and the size from which a component has blocks of its own.
BLOCK_TEXTS, BLOCK_TOKENS, OWN_BLOCKS = 256, 100_000, 64
#: Blocks of a group; a task compares the blocks of two groups, so a block is sent once per group.
GROUP_BLOCKS = 12
#: Counters of the sketch, as powers of two.
LEAST_COUNTERS, MOST_COUNTERS = 16, 25
COUNTERS_PER_TEXT = 32
#: Texts from which a token is frequent, besides what other tokens add to its counter.
FREQUENT = 24
#: Prefix tokens that a bucket holds and that a task gathers before it deals them out.
BUCKET_TOKENS, GATHERED, LEAST_BUCKETS = 200_000, 1_000_000, 256
#: Bytes of text that are worked on at once.
PIECE = 1_000_000
#: Rows that go back to the JVM at once.
OUT_ROWS = 100_000
#: Up to so many ids (long numbers) are broadcast to find their texts; beyond, texts are shuffled to them.
BROADCAST_IDS = 2_000_000
#: Shared tokens above the threshold from which counts of 32-bit tokens decide.
MARGIN = 4
SEEDS = tuple(np.uint64(x) for x in (0x243F6A8885A308D3, 0x13198A2E03707344, 0xA4093822299F31D0))


@dataclass(frozen=True)
class Measure:
    width: int = 5
    percent: int = 75

    def prefix(self, n):
        """Tokens of n of which two linked texts share one, under any order."""
        return n + (-self.percent * n) // 100 + 1


def _token_sets(texts: pa.Array, measure: Measure) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, tokens, begin) of pieces of a batch."""
    for a, _, buf, offsets in tk.pieces(texts, PIECE):
        buf = tk.LOWER[buf]
        starts, ends, first = tk.spans(buf, offsets)
        yield a, *tk.distinct(*tk.shingles(tk.hash_spans(buf, starts, ends), first, measure.width))


def _counter(tokens: np.ndarray, bits: int) -> np.ndarray:
    return (tk.mix(tokens) >> np.uint64(64 - bits)).astype(np.int64)


def _profiles(rows: DataFrame, measure: Measure, bits: int) -> DataFrame:
    """Per text its number of tokens and the digest of its set; per task the sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(max(1 << bits, fitting.CHUNK), np.int32)

        def rows_of(ref, ids, n, digests, chunks, packed):
            k = len(ids)
            return pa.RecordBatch.from_arrays([ref, pa.array(ids, pa.int64()), pa.array(n, pa.int64()), pa.array(digests, pa.binary()), pa.array(chunks, pa.int32()), pa.array(packed, pa.binary())], names) if k else None

        for batch in batches:
            ids, n, digests = batch.column(1), [], []
            for _, tokens, begin in _token_sets(batch.column(2), measure):
                at = np.sort(_counter(tokens, bits).astype(np.int32))
                each = np.flatnonzero(np.diff(at, prepend=-1))
                counts[at[each]] += np.diff(each, append=len(at)).astype(np.int32)
                view = memoryview(tokens).cast("B") if len(tokens) else b""
                n.extend(np.diff(begin).tolist())
                digests.extend(hashlib.md5(view[8 * a : 8 * b]).digest() if b > a else None for a, b in zip(begin[:-1], begin[1:], strict=True))
            if len(ids):
                yield rows_of(batch.column(0), ids, n, digests, [None] * len(ids), [None] * len(ids))
        for part in fitting.emit(counts):
            yield rows_of(pa.nulls(1, ref_type), [None], [None], [None], part.column(0).to_pylist(), part.column(1).to_pylist())

    names = ["ref", "id", "n", "digest", "chunk", "counts"]
    schema = T.StructType([rows.schema["ref"], *T._parse_datatype_string("id long, n long, digest binary, chunk int, counts binary").fields])
    schema["ref"].nullable = True
    from pyspark.sql.pandas.types import to_arrow_type

    ref_type = to_arrow_type(rows.schema["ref"].dataType)
    return rows.select("ref", "id", "text").mapInArrow(tk.released(run), schema)


def _kinds(counts: np.ndarray) -> np.ndarray:
    """0 for counters of rare tokens, else by the logarithm how frequent.

    Counters hold what rare tokens share them too.  Nearly all hold nothing
    else, so their median is that load; it varies by its root, and a token
    is frequent if its counter stands out by several of these.
    """
    load = float(np.median(counts))
    least = FREQUENT + 6 * load**0.5
    above = np.maximum(counts - load, 1) / least
    return np.where(above < 1, 0, 1 + np.log2(above)).clip(0, 63)


def _sketch(profiles: DataFrame, bits: int) -> np.ndarray:
    """The kinds of all counters, a byte each: at most 2 ** MOST_COUNTERS bytes."""
    chunks = profiles.filter("chunk IS NOT NULL").select("chunk", F.col("counts").alias("numbers"))
    return fitting.summed(chunks, max(1 << bits, fitting.CHUNK), _kinds, np.uint8)


def _rank(tokens: np.ndarray, kind: np.ndarray, order: int) -> np.ndarray:
    """A number by which to sort: frequent tokens last, hashed within a frequency."""
    return (kind.astype(np.uint64) << np.uint64(58)) | (tk.mix(tokens ^ SEEDS[order]) >> np.uint64(6))


def _heads(tokens: np.ndarray, begin: np.ndarray, kind: np.ndarray, measure: Measure) -> Iterator[list[np.ndarray]]:
    """Per text the places of its prefixes under the three orders."""
    ranks = [_rank(tokens, kind, o) for o in range(3)]
    for a, b in zip(begin[:-1].tolist(), begin[1:].tolist(), strict=True):
        p, heads = measure.prefix(b - a) if b > a else 0, []
        for r in ranks:
            r = r[a:b]
            head = np.argpartition(r, p - 1)[:p] if p < b - a else np.arange(b - a)
            heads.append(a + head[np.argsort(r[head])])
        yield heads


def _features(texts: DataFrame, measure: Measure, sketch, bits: int) -> DataFrame:
    """Per text the prefix under the first order, rare and frequent tokens
    apart, and fingerprints of the prefixes under the other two."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = sketch.value
        for batch in batches:
            for first, tokens, begin in _token_sets(batch.column(1), measure):
                kind = counts[_counter(tokens, bits)]
                out = []
                for n, heads in zip(np.diff(begin).tolist(), _heads(tokens, begin, kind, measure), strict=True):
                    p = len(heads[0])
                    rare = kind[heads[0]] == 0
                    mine = tokens[heads[0]]
                    # fingerprints of 16 bits tell short prefixes apart, long ones get 32
                    wide = np.uint16 if p <= 48 else np.uint32
                    prints = [np.unique(tokens[h].astype(wide)).tobytes() for h in heads[1:]]
                    out.append((n, mine[rare].tobytes(), mine[~rare].tobytes(), *prints))
                ids = batch.column(0).slice(first, len(out))
                columns = list(zip(*out, strict=True))
                yield pa.RecordBatch.from_arrays([ids, pa.array(columns[0], pa.int64()), *[pa.array(c, pa.binary()) for c in columns[1:]]], ["id", "n", "rare", "frequent", "print2", "print3"])

    return texts.mapInArrow(tk.released(run), "id long, n long, rare binary, frequent binary, print2 binary, print3 binary")


def _postings(features: DataFrame, buckets: int) -> DataFrame:
    """Rare prefix tokens dealt to buckets, many to a row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        size = 0

        def deal() -> Iterator[pa.RecordBatch]:
            nonlocal held, size
            if size:
                token, doc, n, at = (np.concatenate(x) for x in zip(*held, strict=True))
                bucket = (tk.mix(token ^ SEEDS[1]) % np.uint64(buckets)).astype(np.int32)
                order = np.argsort(bucket, kind="stable")
                bucket = bucket[order]
                cut = np.flatnonzero(np.diff(bucket, prepend=-1))
                n, at = (x.astype(np.uint16) if n.max() < 1 << 16 else x for x in (n, at))
                columns = [np.split(x[order], cut[1:]) for x in (token, doc, n, at)]
                yield pa.RecordBatch.from_arrays([pa.array(bucket[cut], pa.int32()), *[pa.array([x.tobytes() for x in c], pa.binary()) for c in columns]], ["bucket", "token", "doc", "n", "at"])
            held, size = [], 0

        for batch in batches:
            for doc, n, rare in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                token = np.frombuffer(rare.as_py(), np.uint64)
                if len(token):
                    held.append((token, np.full(len(token), doc), np.full(len(token), n, np.uint32), np.arange(len(token), dtype=np.uint32)))
                    size += len(token)
                    if size >= GATHERED:
                        yield from deal()
        yield from deal()

    return features.select("id", "n", "rare").mapInArrow(tk.released(run), "bucket int, token binary, doc binary, n binary, at binary")


def _candidates(postings: DataFrame, measure: Measure) -> DataFrame:
    """Pairs (a, b) of small groups; rows (token, a, n) of the texts of larger ones."""
    percent = measure.percent

    def of_bucket(parts: list[tuple[bytes, ...]]) -> Iterator[tuple[np.ndarray, ...]]:
        token, doc = (np.frombuffer(b"".join(p[i] for p in parts), t) for i, t in enumerate((np.uint64, np.int64)))
        # sizes and places have 16 bits where they fit, else 32
        n, at = (np.concatenate([np.frombuffer(p[i], f"<u{len(p[i]) * 8 // len(p[0])}").astype(np.int64) for p in parts]) for i in (2, 3))
        order = np.argsort(token, kind="stable")
        token, doc, n, at = token[order], doc[order], n[order], at[order]
        begin = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]]))
        sizes = np.diff(np.append(begin, len(token)))
        found = []
        for size in np.unique(sizes[(sizes > 1) & (sizes <= SMALL)]):
            left, right = np.triu_indices(size, 1)
            groups = begin[sizes == size]
            for some in np.array_split(groups, -(-len(groups) * len(left) // 500_000)):
                x, y = (some[:, None] + left).ravel(), (some[:, None] + right).ravel()
                low, high = np.minimum(n[x], n[y]), np.maximum(n[x], n[y])
                # were this the first shared token, so much of both is left to share
                left_over = np.minimum(n[x] - at[x], n[y] - at[y])
                good = (100 * low >= percent * high) & ((100 + percent) * left_over >= percent * (low + high)) & (doc[x] != doc[y])
                x, y = doc[x[good]], doc[y[good]]
                found.append(np.stack([np.minimum(x, y), np.maximum(x, y)], 1))
        if found:
            pairs = np.unique(np.concatenate(found), axis=0)
            yield pairs[:, 0], pairs[:, 1], None, None
        large = np.repeat(sizes > SMALL, sizes)
        if large.any():
            yield doc[large], None, token[large].astype(np.int64), n[large]

    def rows(parts) -> Iterator[pa.RecordBatch]:
        for a, b, token, n in of_bucket(parts):
            for k in range(0, len(a), OUT_ROWS):
                columns = [pa.nulls(len(a[k : k + OUT_ROWS]), pa.int64()) if x is None else pa.array(x[k : k + OUT_ROWS], pa.int64()) for x in (a, b, token, n)]
                yield pa.RecordBatch.from_arrays(columns, ["a", "b", "token", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, parts = None, []
        for batch in batches:
            columns = [batch.column(i) for i in range(5)]
            for i in range(batch.num_rows):
                bucket = columns[0][i].as_py()
                if bucket != at and parts:
                    yield from rows(parts)
                    parts = []
                at = bucket
                parts.append(tuple(c[i].as_py() for c in columns[1:]))
        if parts:
            yield from rows(parts)

    dealt = postings.repartition("bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(tk.released(run), "a long, b long, token long, n long")


def _frequent_postings(features: DataFrame) -> DataFrame:
    """(token, a, n) of the frequent tokens in prefixes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens = [np.frombuffer(x.as_py(), np.int64) for x in batch.column(2)]
            sizes = [len(x) for x in tokens]
            columns = [np.repeat(batch.column(i).to_numpy(), sizes) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(tokens) if tokens else np.zeros(0, np.int64)), *map(pa.array, columns)], ["token", "a", "n"])

    return features.filter(F.octet_length("frequent") > 0).select("id", "n", "frequent").mapInArrow(tk.released(run), "token long, a long, n long")


def _star_pairs(large: DataFrame, scratch: Scratch, measure: Measure) -> DataFrame:
    """Each text of a large group with the hubs of its first such group.

    The hubs are the texts that three hashes put first, so groups with the
    same texts have the same hubs.
    """
    hubs = large.groupBy("token").agg(F.count(F.lit(1)).alias("size"), *[F.min(F.struct(F.xxhash64("a", F.lit(s)).alias("h"), F.col("a").alias("b"), F.col("n").alias("m"))).alias(f"hub{s}") for s in range(3)])
    hubs = scratch.save(hubs.filter("size > 1").select("token", F.array("hub0", "hub1", "hub2").alias("hubs")), "hubs")
    mine = large.join(hubs.select("token"), "token", "left_semi").groupBy("a", "n").agg(F.min("token").alias("token"))
    mine = scratch.save(mine, "starred")
    pairs = mine.join(hubs, "token").select("a", "n", F.explode("hubs").alias("x")).select("a", "n", "x.b", "x.m")
    fits = 100 * F.least("n", "m") >= measure.percent * F.greatest("n", "m")
    return pairs.filter((F.col("a") != F.col("b")) & fits).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def _share(left: bytes, right: bytes, wide_left: bool, wide_right: bool) -> bool:
    x, y = (np.frombuffer(b, np.uint32 if w else np.uint16) for b, w in ((left, wide_left), (right, wide_right)))
    if wide_left != wide_right:
        x, y = np.unique(x.astype(np.uint16)), np.unique(y.astype(np.uint16))
    both = np.concatenate([x, y])
    both.sort()
    return bool((both[1:] == both[:-1]).any())


def _filtered(pairs: DataFrame, features: DataFrame, measure: Measure) -> DataFrame:
    """Pairs that may share prefix tokens under the second and third order too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*[batch.column(i).to_pylist() for i in range(8)], strict=True)
            kept = []
            for a, b, n, a2, a3, m, b2, b3 in rows:
                wide = measure.prefix(n) > 48, measure.prefix(m) > 48
                if _share(a2, b2, *wide) and _share(a3, b3, *wide):
                    kept.append((a, b))
            columns = zip(*kept, strict=True) if kept else ([], [])
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["a", "b"])

    left, right = (features.select(F.col("id").alias(x), F.col("n").alias(f"n_{x}"), F.col("print2").alias(f"{x}2"), F.col("print3").alias(f"{x}3")) for x in "ab")
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "n_a", "a2", "a3", "n_b", "b2", "b3")
    return both.mapInArrow(tk.released(run), "a long, b long")


def _sets(texts: DataFrame, measure: Measure, bits: int = 64) -> DataFrame:
    """(id, tokens): whole sets, sorted, of the first ``bits`` of each token."""
    kind = {64: np.uint64, 32: np.uint32}[bits]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, tokens, begin in _token_sets(batch.column(1), measure):
                tokens = (tokens >> np.uint64(64 - bits)).astype(kind)
                packed = [tokens[a:b].tobytes() for a, b in zip(begin[:-1], begin[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(packed)), pa.array(packed, pa.binary())], ["id", "tokens"])

    return texts.mapInArrow(tk.released(run), "id long, tokens binary")


def _marked_sets(texts: DataFrame, measure: Measure, sketch, bits: int) -> DataFrame:
    """(id, tokens, marks): whole sets, and of each token in which orders' prefixes it is."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, tokens, begin in _token_sets(batch.column(1), measure):
                marks = np.zeros(len(tokens), np.uint8)
                for heads in _heads(tokens, begin, sketch.value[_counter(tokens, bits)], measure):
                    for order, head in enumerate(heads):
                        marks[head] |= 1 << order
                cuts = list(zip(begin[:-1].tolist(), begin[1:].tolist(), strict=True))
                packed = [[x[a:b].tobytes() for a, b in cuts] for x in (tokens, marks)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(cuts)), *[pa.array(x, pa.binary()) for x in packed]], ["id", "tokens", "marks"])

    return texts.mapInArrow(tk.released(run), "id long, tokens binary, marks binary")


def _verified(pairs: DataFrame, sets: DataFrame, measure: Measure, bits: int) -> DataFrame:
    """The pairs that link, with ``sure``.

    Tokens cut to 32 bits can only seem to share more, so what falls short
    doesn't link; what is up to ``MARGIN`` shared tokens above is not sure,
    and more for long texts, by the square of their size that chance hits have.
    """
    percent, kind = measure.percent, {64: np.uint64, 32: np.uint32}[bits]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, sure = [], []
            for i in range(batch.num_rows):
                x, y = (np.frombuffer(batch.column(k)[i].as_py(), kind) for k in (2, 3))
                both = np.concatenate([x, y])
                both.sort(kind="stable")
                shared = int((both[1:] == both[:-1]).sum())
                kept.append(100 * shared >= percent * (len(both) - shared))
                if kept[-1]:
                    margin = MARGIN + (len(both) ** 2 >> 31) if bits < 64 else 0
                    sure.append(100 * (shared - margin) >= percent * (len(both) - shared + margin))
            mask = pa.array(kept, pa.bool_())
            yield pa.RecordBatch.from_arrays([*[batch.column(k).filter(mask) for k in (0, 1)], pa.array(sure, pa.bool_())], ["a", "b", "sure"])

    left, right = (sets.select(F.col("id").alias(x), F.col("tokens").alias(f"{x}_tokens")) for x in "ab")
    return pairs.join(left, "a").join(right, "b").select("a", "b", "a_tokens", "b_tokens").mapInArrow(tk.released(run), "a long, b long, sure boolean")


def _overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """The sizes of all intersections, by products of incidence matrices."""
    flat = [np.concatenate(x) for x in (left, right)]
    shared = np.intersect1d(np.unique(flat[0]), np.unique(flat[1]), assume_unique=True)
    out = np.zeros((len(left), len(right)), np.float32)
    if not len(shared):
        return out
    sides = []
    for values, parts in zip(flat, (left, right), strict=True):
        row = np.repeat(np.arange(len(parts)), [len(x) for x in parts])
        at = np.minimum(np.searchsorted(shared, values), len(shared) - 1)
        hit = shared[at] == values
        row, at = row[hit], at[hit]
        order = np.argsort(at, kind="stable")
        sides.append((row[order], at[order], len(parts)))
    for begin in range(0, len(shared), 4096):
        matrices = []
        for row, at, n in sides:
            some = slice(*np.searchsorted(at, (begin, begin + 4096)))
            m = np.zeros((n, 4096), np.float32)
            m[row[some], at[some] - begin] = 1
            matrices.append(m)
        out += matrices[0] @ matrices[1].T
    return out


Text = tuple[np.ndarray, np.ndarray]  # tokens and their marks


def _sharing(left: list[Text], right: list[Text], measure: Measure) -> tuple[np.ndarray, np.ndarray]:
    """Texts of either side that may link with one of the other: by length, and
    by a prefix token of the other side under each of the orders in turn."""
    kept = [np.arange(len(side)) for side in (left, right)]
    for order in range(-1, 3):
        sides = [[side[i] for i in some] for side, some in zip((left, right), kept, strict=True)]
        if order < 0:
            sizes = [np.array([len(t) for t, _ in side]) for side in sides]
            good = [(100 * own >= measure.percent * other.min()) & (measure.percent * own <= 100 * other.max()) for own, other in (sizes, sizes[::-1])]
        else:
            heads = [[t[m >> order & 1 > 0] for t, m in side] for side in sides]
            flat = [np.concatenate(h) for h in heads]
            shared = np.intersect1d(*flat)
            good = []
            for h, f in zip(heads, flat, strict=True):
                begin = np.concatenate([[0], np.cumsum([len(x) for x in h])])
                hits = np.concatenate([[0], np.cumsum(np.isin(f, shared))])
                good.append(hits[begin[1:]] > hits[begin[:-1]])
        kept = [some[g] for some, g in zip(kept, good, strict=True)]
        if not (len(kept[0]) and len(kept[1])):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return kept[0], kept[1]


def _compared(left: tuple[np.ndarray, list[Text]], right: tuple[np.ndarray, list[Text]], measure: Measure) -> np.ndarray:
    """Links between texts of two blocks as pairs of their labels."""
    some = _sharing(left[1], right[1], measure)
    labels = [side[0][x] for side, x in zip((left, right), some, strict=True)]
    if not len(some[0]):
        return np.zeros((0, 2), np.int64)
    sides = [[side[1][i][0] for i in x] for side, x in zip((left, right), some, strict=True)]
    shared = _overlaps(*sides)
    sizes = [np.array([len(t) for t in side], np.float64) for side in sides]
    union = sizes[0][:, None] + sizes[1][None, :] - shared
    i, j = np.nonzero((100.0 * shared >= measure.percent * union) & (labels[0][:, None] != labels[1][None, :]))
    return np.unique(np.stack([labels[0][i], labels[1][j]], 1), axis=0)


def _block_links(large: DataFrame, roots: DataFrame, texts_of, sketch, bits: int, scratch: Scratch, measure: Measure) -> DataFrame | None:
    """Links between the components that large groups still hold."""
    labelled = large.join(roots.select(F.col("id").alias("a"), "root"), "a", "left").select("token", "a", "n", F.coalesce("root", "a").alias("label"))
    labelled = scratch.save(labelled, "labelled")
    mixed = scratch.save(labelled.groupBy("token").agg(F.min("label").alias("x"), F.max("label").alias("y")).filter("x < y").select("token"), "mixed")
    if not mixed.limit(1).count():
        return None
    rows = scratch.save(labelled.join(mixed, "token", "left_semi"), "mixed-rows")
    docs = scratch.save(rows.groupBy("a", "n", "label").agg(F.min("token").alias("token")), "mixed-docs")
    sizes = scratch.save(docs.groupBy("label").agg(F.count(F.lit(1)).alias("size")).filter(F.col("size") >= OWN_BLOCKS), "mixed-labels")
    # a large component has blocks of its own, other texts are packed by their first token; all by length
    band = F.floor(F.log(100 / measure.percent if measure.percent < 100 else 2.0, F.col("n").cast("double"))).cast("int")
    docs = docs.join(sizes, "label", "left").select("a", "n", "label", band.alias("band"), F.when(F.col("size").isNotNull(), F.col("label")).alias("own"), F.when(F.col("size").isNull(), F.col("token")).alias("cell"))
    docs = scratch.save(docs, "cells")
    parts = F.ceil(F.greatest(F.count(F.lit(1)) / BLOCK_TEXTS, F.sum("n") / BLOCK_TOKENS)).cast("long")
    cells = scratch.save(docs.groupBy(F.col("own").alias("o"), F.col("cell").alias("c"), F.col("band").alias("l")).agg(parts.alias("parts")), "cell-sizes")
    placed = docs.join(cells, docs.own.eqNullSafe(cells.o) & docs.cell.eqNullSafe(cells.c) & (docs.band == cells.l))
    placed = placed.select("a", "n", "label", "own", F.xxhash64("own", "cell", "band", F.pmod(F.xxhash64("a"), F.col("parts"))).alias("block"))
    placed = scratch.save(placed, "placed")
    seen = rows.select("token", "a").join(placed.select("a", "n", "block", "own"), "a").groupBy("token", "block", "own").agg(F.min("n").alias("low"), F.max("n").alias("high"))
    seen = scratch.save(seen, "block-tokens")
    other = seen.select("token", *[F.col(c).alias(f"{c}2") for c in ("block", "own", "low", "high")])
    fits = (100 * F.col("high") >= measure.percent * F.col("low2")) & (100 * F.col("high2") >= measure.percent * F.col("low"))
    meet = seen.join(other, "token").filter(fits & F.expr("block <= block2 AND NOT coalesce(own = own2, false)")).select("block", "block2").distinct()
    meet = scratch.save(meet, "meet")
    whole = _marked_sets(texts_of(placed.select(F.col("a").alias("id")), "placed-ids"), measure, sketch, bits)
    packed = placed.select(F.col("a").alias("id"), "label", "block").join(whole, "id").groupBy("block").agg(F.collect_list(F.struct("label", "tokens", "marks")).alias("texts"))
    packed = scratch.save(packed.select("block", *[F.col(f"texts.{c}").alias(c if c != "label" else "labels") for c in ("label", "tokens", "marks")]), "blocks")

    n_groups = -(-packed.count() // GROUP_BLOCKS) or 1
    group = [F.pmod(F.xxhash64(x, F.lit(7)), F.lit(n_groups)).cast("int") for x in ("block", "block2")]
    meet = meet.withColumns({"g": F.least(*group), "h": F.greatest(*group)})
    lists = meet.groupBy("g", "h").agg(F.collect_list("block").alias("left"), F.collect_list("block2").alias("right"))
    needed = meet.select("g", "h", "block").unionByName(meet.select("g", "h", F.col("block2").alias("block"))).distinct()
    # the list of a pair of groups comes before its blocks
    none = F.lit(None).cast("array<binary>")
    sent = needed.join(packed, "block").select("g", "h", "block", "labels", "tokens", "marks", F.lit(None).cast("array<long>").alias("right"))
    sent = sent.unionByName(lists.select("g", "h", F.lit(None).cast("long").alias("block"), F.col("left").alias("labels"), none.alias("tokens"), none.alias("marks"), "right"))

    def found(pairs: list[tuple[int, int]], held: dict[int, tuple[np.ndarray, list[Text]]]) -> pa.RecordBatch:
        links = np.unique(np.concatenate([np.zeros((0, 2), np.int64), *[_compared(held[x], held[y], measure) for x, y in pairs]]), axis=0)
        return pa.RecordBatch.from_arrays([pa.array(links[:, 0], pa.int64()), pa.array(links[:, 1], pa.int64())], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, pairs, held = None, [], {}
        for batch in batches:
            for i in range(batch.num_rows):
                g, h, block, labels, tokens, marks, right = (batch.column(k)[i].as_py() for k in range(7))
                if (g, h) != at:
                    if held:
                        yield found(pairs, held)
                    at, pairs, held = (g, h), [], {}
                if block is None:
                    pairs = list(zip(labels, right, strict=True))
                else:
                    held[block] = np.array(labels), [(np.frombuffer(x, np.uint64), np.frombuffer(m, np.uint8)) for x, m in zip(tokens, marks, strict=True)]
        if held:
            yield found(pairs, held)

    dealt = sent.repartition("g", "h").sortWithinPartitions("g", "h", F.col("block").asc_nulls_first())
    return scratch.save(dealt.mapInArrow(tk.released(run), "a long, b long"), "block-links")


def join(docs: DataFrame, measure: Measure = Measure(), row_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: ``row_id``, ``n_shingles`` and ``component_id``."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "ngram_join")

    integer = isinstance(docs.schema[row_id].dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType))
    n_docs, n_ids, n_distinct = docs.agg(F.count(F.lit(1)), F.count(row_id), F.count_distinct(row_id)).first()
    own = integer and n_docs == n_ids == n_distinct
    if own:
        rows = docs.select(F.col(row_id).alias("ref"), F.col(row_id).cast("long").alias("id"), F.col(text).alias("text"))
    else:
        rows = scratch.save(docs.select(F.col(row_id).alias("ref"), F.monotonically_increasing_id().alias("id"), F.col(text).alias("text")), "rows")
    bits = int(np.clip(np.ceil(np.log2(max(n_docs, 1) * COUNTERS_PER_TEXT)), LEAST_COUNTERS, MOST_COUNTERS))
    profiles = scratch.save(_profiles(rows, measure, bits), "profiles")
    sketch = spark.sparkContext.broadcast(_sketch(profiles, bits))
    profiles = profiles.filter("chunk IS NULL").drop("chunk", "counts")
    classes = scratch.save(profiles.filter("n > 0").groupBy("digest").agg(F.min("id").alias("rep")), "classes")
    texts = rows.select("id", "text")
    reps = classes.select(F.col("rep").alias("id"))
    n_copies = profiles.filter("n > 0").count() - classes.count()
    if n_copies <= BROADCAST_IDS:
        copies = profiles.filter("n > 0").select("id").join(reps, "id", "left_anti")
        of_reps = texts.join(F.broadcast(copies), "id", "left_anti")
    else:
        of_reps = texts.join(reps, "id", "left_semi")

    def texts_of(ids: DataFrame, name: str) -> DataFrame:
        ids = scratch.save(ids.select("id").distinct(), name)
        return texts.join(F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids, "id", "left_semi")

    def both_ids(pairs: DataFrame) -> DataFrame:
        return pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id")))

    features = scratch.save(_features(of_reps, measure, sketch, bits), "features")
    n_rare = features.agg(F.sum(F.octet_length("rare"))).first()[0] or 0
    buckets = max(LEAST_BUCKETS, n_rare // 8 // BUCKET_TOKENS)
    raw = scratch.save(_candidates(_postings(features, buckets), measure), "raw")
    large = raw.filter("token IS NOT NULL").select("token", "a", "n").unionByName(_frequent_postings(features))
    large = scratch.save(large, "large")
    pairs = raw.filter("token IS NULL").select("a", "b").unionByName(_star_pairs(large, scratch, measure)).distinct()
    likely = scratch.save(_filtered(pairs, features, measure), "likely")
    scratch.drop("raw", "features")
    sets = scratch.save(_sets(texts_of(both_ids(likely), "likely-ids"), measure, 32), "sets")
    links = scratch.save(_verified(likely, sets, measure, 32), "links")
    scratch.drop("sets", "likely")
    unsure = links.filter("NOT sure").select("a", "b")
    exact = _verified(unsure, scratch.save(_sets(texts_of(both_ids(unsure), "unsure-ids"), measure), "exact-sets"), measure, 64)
    links = scratch.save(links.filter("sure").select("a", "b").unionByName(exact.select("a", "b")), "all-links")
    roots = components(links, scratch, "first")
    more = _block_links(large, roots, texts_of, sketch, bits, scratch, measure)
    if more is not None:
        roots = components(roots.select(F.col("id").alias("a"), F.col("root").alias("b")).unionByName(more), scratch, "second")
        scratch.drop("blocks")
    scratch.drop("large", "links", "all-links", "exact-sets")
    known = classes.join(roots.withColumnRenamed("id", "rep"), "rep", "left").select("digest", F.coalesce("root", "rep").alias("component"))
    known = scratch.save(known, "components")
    # a class with a third of all rows is a skewed key of this join, which Spark splits
    members = profiles.filter("n > 0").join(known, "digest").select("ref", "n", "component")
    alone = profiles.filter("n = 0").select("ref", "n", F.col("id").alias("component"))
    out = members.unionByName(alone)
    if not own:
        out = scratch.save(out, "members")
        names = scratch.save(out.groupBy("component").agg(F.min("ref").alias("name")), "names")
        out = out.join(names, "component").select("ref", "n", F.col("name").alias("component"))
    else:
        out = out.withColumn("component", F.col("component").cast(docs.schema[row_id].dataType))
    return out.select(F.col("ref").alias(row_id), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"))


def one_of_each(docs: DataFrame, measure: Measure = Measure(), row_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each component, that with the smallest id, with its columns.

    Where ids are null, repeated or no integers, the first row of the
    component stays.
    """
    scratch = Scratch(docs.sparkSession, "one_of_each")
    columns = docs.columns
    n, n_ids, n_distinct = docs.agg(F.count(F.lit(1)), F.count(row_id), F.count_distinct(row_id)).first()
    if not (n == n_ids == n_distinct and isinstance(docs.schema[row_id].dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType))):
        docs = scratch.save(docs.withColumn("_row", F.monotonically_increasing_id()), "rows")
        row_id = "_row"
    gone = join(docs, measure, row_id, text).filter(F.col(row_id) != F.col("component_id")).select(row_id)
    gone = scratch.save(gone, "gone")
    few = gone.count() <= BROADCAST_IDS
    return docs.join(F.broadcast(gone) if few else gone, row_id, "left_anti").select(*columns)
