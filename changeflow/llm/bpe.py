"""Byte-level BPE: encoding by merge ranks and decoding by concatenation.

A text is cut at the vocabulary's special strings, the rest into words by the
vocabulary's pattern, each word into bytes.  The bytes form a doubly linked
list of symbols; a priority queue holds the adjacent pairs that can merge, by
rank and then position.  The least is taken off the queue again and again: if
the list still has that pair at that place its two symbols become one and the
new neighbours are queued, else the entry is stale and skipped.  Words recur,
so each worker keeps the results of a bounded number of them.  Decoding
concatenates the byte strings of the ids.

``transcode`` returns a row for each row: the id column, ``ids`` and
``decoded``.  A null text counts as empty: no ids, an empty decoded text.  A
text of any length is coded whole, in the memory of its row (a few times its
bytes); a word of n bytes takes n log n steps.  Pairs of equal rank are merged
from the left.
Rows are independent, so repeated rows repeat, an empty table stays empty, and
extra columns are ignored whatever their names.
"""

from __future__ import annotations

import heapq
import json
import sys
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import textkernel as tk
from .store import small_batches

#: Words whose ids a worker remembers, in each of two generations.
REMEMBERED = 300_000
#: Words longer than this are not remembered.
LONGEST_REMEMBERED = 64
#: Characters of text that go back to the JVM at once.
OUT_CHARS = 4_000_000
#: Byte-level pre-tokenisation as published with this family of vocabularies.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in a vocabulary file."""
    shown = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    rest = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(rest)}


def _unassigned() -> np.ndarray:
    """Of each code point, whether Python's tables don't know it."""
    return np.fromiter((unicodedata.category(chr(c)) == "Cn" for c in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1)


class _Memory(dict):
    """Ids by word.  When the newer generation is full it becomes the older
    one, and what was in the older one and not asked for since is dropped."""

    def __init__(self, make):
        super().__init__()
        self.make, self.older = make, {}

    def __missing__(self, word: str) -> bytes:
        ids = self.older.get(word)
        if ids is None:
            ids = self.make(word)
        if len(word) <= LONGEST_REMEMBERED:
            if len(self) >= REMEMBERED:
                self.older = dict(self)
                self.clear()
            self[word] = ids
        return ids


class Vocabulary:
    """A vocabulary file of the tokenizers library: byte-level BPE without
    normaliser, prefix space or special cases of merging."""

    def __init__(self, content: bytes):
        spec = json.loads(content)
        model, pre, alphabet = spec["model"], spec["pre_tokenizer"], byte_alphabet()
        plain = not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
        if model["type"] != "BPE" or not plain or spec.get("normalizer") or pre["type"] != "ByteLevel" or pre["add_prefix_space"] or not pre.get("use_regex", True):
            raise ValueError("not a plain byte-level BPE vocabulary")
        ids = model["vocab"]
        self.bytes_of = {i: bytes(alphabet[c] for c in s) for s, i in ids.items()}
        self.special = {}
        for t in spec["added_tokens"]:
            if t["single_word"] or t["lstrip"] or t["rstrip"]:
                raise ValueError(f"special string with conditions: {t['content']}")
            self.special[t["content"]] = t["id"]
            self.bytes_of[t["id"]] = t["content"].encode()
        self.of_byte = [0] * 256
        for c, b in alphabet.items():
            self.of_byte[b] = ids[c]
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.merges[ids[left], ids[right]] = rank, ids[left + right]
        self.word = regex.compile(PATTERN)
        self.unassigned = _unassigned()
        self.cut = regex.compile("(" + "|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True)) + ")") if self.special else None
        #: Ids are kept as numbers of 16 bits where all fit.
        self.kind = np.dtype("<u2" if max(self.bytes_of) < 1 << 16 else "<u4")
        self.known = _Memory(lambda word: np.array(self.encode_word(word), self.kind).tobytes())

    def encode_word(self, word: str) -> tuple[int, ...]:
        symbols = [self.of_byte[b] for b in word.encode()]
        n = len(symbols)
        if n == 1:
            return (symbols[0],)
        after, before = [*range(1, n), -1], [*range(-1, n - 1)]
        rank_of = self.merges.get
        queue = [(r[0], i, symbols[i], symbols[i + 1], r[1]) for i in range(n - 1) if (r := rank_of((symbols[i], symbols[i + 1])))]
        heapq.heapify(queue)
        while queue:
            _, i, left, right, made = heapq.heappop(queue)
            j = after[i]
            if symbols[i] != left or j < 0 or symbols[j] != right:
                continue  # stale: one of the two has merged since
            symbols[i], symbols[j] = made, -1
            k = after[j]
            after[i] = k
            if k >= 0:
                before[k] = i
                if r := rank_of((made, symbols[k])):
                    heapq.heappush(queue, (r[0], i, made, symbols[k], r[1]))
            h = before[i]
            if h >= 0 and (r := rank_of((symbols[h], made))):
                heapq.heappush(queue, (r[0], h, symbols[h], made, r[1]))
        return tuple(s for s in symbols if s >= 0)

    def words(self, text: str) -> list[str]:
        if not text.isascii() and self.unassigned[np.frombuffer(text.encode("utf-32-le"), np.uint32)].any():
            # characters on whose class newer and older tables differ: the library's own are asked
            from tokenizers import pre_tokenizers

            spans = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True).pre_tokenize_str(text)
            return [text[a:b] for _, (a, b) in spans]
        return self.word.findall(text)

    def encode(self, text: str) -> np.ndarray:
        if self.cut is None or not any(s in text for s in self.special):
            packed = b"".join(map(self.known.__getitem__, self.words(text)))
        else:
            one = lambda i: np.array([i], self.kind).tobytes()
            packed = b"".join(one(self.special[p]) if p in self.special else b"".join(map(self.known.__getitem__, self.words(p))) for p in self.cut.split(text))
        return np.frombuffer(packed, self.kind)

    def decode(self, ids: Iterable[int]) -> str:
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")


_loaded: dict[int, Vocabulary] = {}


def _vocabulary(content: bytes) -> Vocabulary:
    """The worker's copy, kept between tasks."""
    key = hash(content)
    if key not in _loaded:
        _loaded.clear()
        _loaded[key] = Vocabulary(content)
    return _loaded[key]


def transcode(docs: DataFrame, vocabulary: str, row_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``row_id``, ``ids`` of each text and ``decoded``, the text of these ids.

    ``vocabulary`` is a path that the driver can open; the file, of a size
    that does not depend on the data, is sent to the executors.
    """
    small_batches(docs.sparkSession)
    with open(vocabulary, "rb") as f:
        content = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = _vocabulary(content.value)
        text, of, back = "", v.encode(""), ""
        for batch in batches:
            texts, start, ids, decoded, chars = batch.column(1), 0, [], [], 0
            for at in range(batch.num_rows):
                now = texts[at].as_py() or ""
                if now != text:  # rows that repeat the one before them, as a mix makes them, are coded once
                    text, of = now, v.encode(now)
                    back = v.decode(of.tolist())
                ids.append(of)
                decoded.append(back)
                chars += len(decoded[-1])
                if chars >= OUT_CHARS or at == batch.num_rows - 1:
                    ends = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
                    lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(ids).astype(np.int32)))
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(start, len(ids)), lists, pa.array(decoded, pa.string())], ["row_id", "ids", "decoded"])
                    start, ids, decoded, chars = at + 1, [], [], 0

    rows = docs.select(F.col(row_id).alias("row_id"), F.col(text).alias("text"))
    schema = T.StructType([T.StructField("row_id", rows.schema[0].dataType), T.StructField("ids", T.ArrayType(T.IntegerType(), False)), T.StructField("decoded", T.StringType())])
    return rows.mapInArrow(tk.released(run), schema).withColumnRenamed("row_id", row_id)


def digests(coded: DataFrame, row_id: str = "doc_id") -> DataFrame:
    """Counts and digests of what ``transcode`` returns."""
    return coded.select(
        row_id,
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )
