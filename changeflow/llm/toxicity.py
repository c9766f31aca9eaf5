"""Toxicity scores by a bidirectional gated recurrent network.

Words are runs of letters, lowered.  The input of a word is the embedding of
the word and the sum of the embeddings of its character n-grams (starts and
ends), both from hashed tables, so unseen words made of known parts count too.
A text is scored in all its overlapping windows of ``WINDOW`` words: two gated
recurrent passes, attention pooling over both, a logit.  The score of a text
is a logistic function of its highest logit, the mean of its three highest and
the number of windows.

Everything is trained in numpy, embeddings included.  First a noisy-or over
the words of each whole text is fitted by gradient steps on one number of each
embedding; it finds the words and parts of words that toxic texts have.  Then
the network is trained on the window that each text scores highest in, and the
gradient goes on into the other numbers of the embeddings.  What the network
sees of the first step while it is trained comes from texts of other folds, so
that it learns how far that holds on new texts.  At most ``bound`` labelled
rows are used, those whose id a hash puts first, each whole.

Texts are read in segments of ``SEGMENT`` bytes that end between words, so a
text of any length takes the memory of a segment (of its longest word, if that
is longer); training holds four bytes for each word of the sample.

A null or empty text is one empty window.  Without usable labels, or with one
class only, every score is the share of label 1 (0 without labels).  Of
labelled rows that share an id the one whose text has the smallest digest is
learned from.  Windows of equal logits don't differ; a score of exactly 0.5
predicts 1.  Repeated rows repeat; an empty table gives an empty result; extra
columns are ignored, whatever their names.  Only texts are inputs of a score.
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

WINDOW, STRIDE = 32, 16
WORD_BITS, GRAM_BITS = 16, 18
#: Bytes of the starts and the ends of words that have embeddings.
STARTS, ENDS = (2, 3, 4, 5, 6, 7, 8), (3, 4, 5, 6)
#: Numbers of an embedding of a word, of an n-gram, and of the input of a word (with its length).
WORD_SIZE, GRAM_SIZE = 4, 4
INPUTS = WORD_SIZE + GRAM_SIZE + 1
HIDDEN, ATTENTION = 6, 6
#: The noisy-or: steps, their size, the pull to 0.
EVIDENCE_STEPS, EVIDENCE_RATE, EVIDENCE_DECAY = 60, 0.1, 2e-4
FOLDS, ROUNDS, MOST_ROUNDS, RATE, TABLE_RATE = 3, 14, 100, 0.01, 0.005
#: Bytes of text and windows that are worked on at once.
SEGMENT, BATCH = 1_000_000, 4096

NOT_LETTER = np.ones(256, bool)
NOT_LETTER[[*range(ord("a"), ord("z") + 1), *range(0x80, 0x100)]] = False


def _lowered(buf: np.ndarray) -> np.ndarray:
    """Lower case of A-Z and of the accented capitals U+00C0 to U+00DE."""
    buf = tk.LOWER[buf]
    capital = (buf[:-1] == 0xC3) & (buf[1:] >= 0x80) & (buf[1:] <= 0x9E) & (buf[1:] != 0x97)
    buf[1:][capital] += 0x20
    return buf


@dataclass
class Words:
    """The distinct words of some texts with their rows of the tables."""

    of: np.ndarray  # number of the distinct word, for each word in turn
    first: np.ndarray  # per text the number of its first word
    hash: np.ndarray  # per distinct word all its bytes' hash
    grams: np.ndarray  # per distinct word its n-grams' rows, -1 where it is too short
    length: np.ndarray

    @property
    def word(self) -> np.ndarray:
        """Per distinct word its row."""
        return (self.hash >> np.uint64(64 - WORD_BITS)).astype(np.int32)


def _words(buf: np.ndarray, offsets: np.ndarray) -> tuple[Words, np.ndarray, np.ndarray]:
    """Also the first bytes and the ends of all words; ``buf`` is in lower case."""
    starts, ends, first = tk.spans(buf, offsets, NOT_LETTER)
    h, at, of = np.unique(tk.hash_spans(buf, starts, ends), return_index=True, return_inverse=True)
    length = ends[at] - starts[at]
    lanes = np.ndarray((len(buf) - 7,), "<u8", buf, strides=(1,))
    grams = np.full((len(at), len(STARTS) + len(ENDS)), -1, np.int32)
    for k, (n, tail) in enumerate([(n, False) for n in STARTS] + [(n, True) for n in ENDS]):
        long = length >= n
        lane = lanes[(ends[at[long]] - n) if tail else starts[at[long]]] & tk.KEEP[n]
        grams[long, k] = (tk.mix(lane ^ np.uint64((n + 100 * tail) << 56 | n * 0x1F3)) >> np.uint64(64 - GRAM_BITS)).astype(np.int32)
    return Words(of.astype(np.int32), first, h, grams, length), starts, ends


@dataclass
class Tables:
    """Embeddings of words and of n-grams; the last row of the second stands for none."""

    word: np.ndarray
    grams: np.ndarray

    @classmethod
    def drawn(cls, seed: int = 10) -> Tables:
        draw = np.random.default_rng(seed)
        word, grams = (draw.normal(0, 0.05, ((1 << bits) + extra, size)).astype(np.float32) for bits, size, extra in ((WORD_BITS, WORD_SIZE, 0), (GRAM_BITS, GRAM_SIZE, 1)))
        word[:, 0], grams[:, 0], grams[-1] = 0, 0, 0
        return cls(word, grams)

    def inputs(self, word: np.ndarray, grams: np.ndarray, length: np.ndarray) -> np.ndarray:
        """The network's inputs of words."""
        out = np.empty((len(word), INPUTS), np.float32)
        out[:, :WORD_SIZE] = self.word[word]
        out[:, WORD_SIZE:-1] = self.grams[grams].sum(1)
        out[:, -1] = np.log1p(length) - 1.5
        return out


def _windows(first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per window the number of its first word and of the word behind its
    text; per text the number of its first window."""
    counts = np.diff(first)
    made = np.where(counts > WINDOW, -(-(counts - WINDOW) // STRIDE) + 1, 1)
    begin = np.concatenate([[0], np.cumsum(made)])
    text = np.repeat(np.arange(len(counts)), made)
    return first[:-1][text] + (np.arange(begin[-1]) - begin[:-1][text]) * STRIDE, first[1:][text], begin


def _filled(of: np.ndarray, start: np.ndarray, end: np.ndarray, none: int) -> np.ndarray:
    """The word numbers of windows, ``none`` behind the end of their text."""
    at = start[:, None] + np.arange(WINDOW)
    return np.where(at < end[:, None], np.append(of, 0)[np.minimum(at, len(of))], none)


def _used(windows: np.ndarray, none: int) -> tuple[np.ndarray, np.ndarray]:
    """The word numbers that windows have, and the windows in numbers of these (as many as there are: none)."""
    some, of = np.unique(windows, return_inverse=True)
    of = of.reshape(windows.shape)
    return some[some < none], of


def _sig(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


class Network:
    """Bidirectional gated recurrent units, attention pooling, one logit."""

    def __init__(self, seed: int = 10):
        draw = np.random.default_rng(seed)
        p: dict[str, np.ndarray] = {}
        for side in "fb":
            p[f"w{side}"] = draw.normal(0, INPUTS**-0.5, (INPUTS, 3 * HIDDEN))
            p[f"u{side}"] = draw.normal(0, HIDDEN**-0.5, (HIDDEN, 3 * HIDDEN))
            p[f"c{side}"] = np.zeros(3 * HIDDEN)
        p["wa"], p["ca"] = draw.normal(0, (2 * HIDDEN) ** -0.5, (2 * HIDDEN, ATTENTION)), np.zeros(ATTENTION)
        p["va"], p["wo"], p["co"] = draw.normal(0, ATTENTION**-0.5, ATTENTION), draw.normal(0, (2 * HIDDEN) ** -0.5, 2 * HIDDEN), np.zeros(1)
        self.p = {k: v.astype(np.float32) for k, v in p.items()}

    def gates(self, inputs: np.ndarray, side: str) -> np.ndarray:
        """What inputs add to the gates, with a last row for no word."""
        out = inputs @ self.p[f"w{side}"] + self.p[f"c{side}"]
        return np.concatenate([out, np.zeros((1, out.shape[1]), np.float32)])

    def forward(self, inputs: np.ndarray, windows: np.ndarray, keep: bool = False):
        """Logits of the windows, and with ``keep`` what the gradient needs."""
        p, n = self.p, len(windows)
        there = (windows < len(inputs)).T[:, :, None]
        states = np.empty((WINDOW, n, 2 * HIDDEN), np.float32)
        kept: dict[str, list] = {"f": [], "b": []}
        for side in "fb":
            gates, u = self.gates(inputs, side), p[f"u{side}"]
            h = np.zeros((n, HIDDEN), np.float32)
            half = slice(0, HIDDEN) if side == "f" else slice(HIDDEN, 2 * HIDDEN)
            for t in range(WINDOW) if side == "f" else range(WINDOW - 1, -1, -1):
                x, hu = gates[windows[:, t]], h @ u
                zr = _sig(x[:, : 2 * HIDDEN] + hu[:, : 2 * HIDDEN])
                z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
                new = np.tanh(x[:, 2 * HIDDEN :] + r * hu[:, 2 * HIDDEN :])
                after = np.where(there[t], new + z * (h - new), h)
                if keep:
                    kept[side].append((t, h, hu[:, 2 * HIDDEN :], z, r, new))
                h = after
                states[t, :, half] = h
        e = np.tanh(states @ p["wa"] + p["ca"])
        a = np.where(there[:, :, 0], e @ p["va"], -np.inf)
        top = a.max(0)
        weight = np.exp(a - np.where(np.isfinite(top), top, 0))
        weight /= np.maximum(weight.sum(0), 1e-9)
        context = (weight[:, :, None] * states).sum(0)
        logits = context @ p["wo"] + p["co"][0]
        return (logits, (there, states, kept, e, weight, context)) if keep else logits

    def gradient(self, inputs: np.ndarray, windows: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> tuple[dict[str, np.ndarray], np.ndarray]:
        """Of the weighted mean log loss, by the parameters and by the inputs."""
        p = self.p
        logits, (there, states, kept, e, weight, context) = self.forward(inputs, windows, True)
        error = ((fitting.sigmoid(logits) - labels) * weights / weights.sum()).astype(logits.dtype)
        g = {k: np.zeros_like(v) for k, v in p.items()}
        g["wo"], g["co"] = context.T @ error, error.sum(keepdims=True)
        d_context = np.outer(error, p["wo"])
        d_weight = (states * d_context).sum(2)
        d_a = weight * (d_weight - (weight * d_weight).sum(0))
        g["va"] = np.einsum("tn,tna->a", d_a, e)
        d_e = d_a[:, :, None] * p["va"] * (1 - e * e)
        g["wa"], g["ca"] = np.einsum("tns,tna->sa", states, d_e), d_e.sum((0, 1))
        d_states = weight[:, :, None] * d_context + d_e @ p["wa"].T
        rows = np.concatenate([inputs, np.zeros((1, INPUTS), inputs.dtype)])
        d_rows = np.zeros_like(rows)
        for side in "fb":
            half = slice(0, HIDDEN) if side == "f" else slice(HIDDEN, 2 * HIDDEN)
            u, d_h = p[f"u{side}"], 0
            d_gates = np.zeros((len(rows), 3 * HIDDEN), inputs.dtype)
            for t, h, hn, z, r, new in reversed(kept[side]):
                d_h = d_h + d_states[t, :, half]
                on = np.where(there[t], d_h, 0)
                d_new = on * (1 - z) * (1 - new * new)
                d_z = on * (h - new) * z * (1 - z)
                d_r = d_new * hn * r * (1 - r)
                d_x = np.concatenate([d_z, d_r, d_new], 1)
                d_hu = np.concatenate([d_z, d_r, d_new * r], 1)
                np.add.at(d_gates, windows[:, t], d_x)
                g[f"u{side}"] += h.T @ d_hu
                d_h = np.where(there[t], on * z, d_h) + d_hu @ u.T
            g[f"w{side}"], g[f"c{side}"] = rows.T @ d_gates, d_gates.sum(0)
            d_rows += d_gates @ p[f"w{side}"].T
        return g, d_rows[:-1]


def _summary(logits: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Per text: highest logit, mean of the three highest, log of how many, 1."""
    counts = np.diff(begin)
    which = np.repeat(np.arange(len(counts)), counts)
    order = np.lexsort((-logits, which))
    place = np.arange(len(logits)) - begin[:-1][which]
    best = logits[order]
    three = np.bincount(which[place < 3], best[place < 3], len(counts)) / np.minimum(counts, 3)
    return np.stack([best[begin[:-1]], three, np.log(counts), np.ones(len(counts))], 1)


def _boundary(data: np.ndarray, at: int) -> int:
    """The first place from ``at`` on that is inside no word (the end, if there is none)."""
    for k in range(at, len(data), 65536):
        found = np.flatnonzero(NOT_LETTER[tk.LOWER[data[k : k + 65536]]])
        if len(found):
            return k + int(found[0])
    return len(data)


@dataclass
class Scorer:
    tables: Tables
    network: Network
    weights: np.ndarray

    def _logits(self, words: Words, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        inputs = self.tables.inputs(words.word, words.grams, words.length)
        parts = [self.network.forward(inputs, _filled(words.of, start[k : k + BATCH], end[k : k + BATCH], len(inputs))) for k in range(0, len(start), BATCH)]
        return np.concatenate([np.zeros(0), *parts])

    def _long(self, data: np.ndarray) -> np.ndarray:
        """The summary of one long text, a segment at a time.

        Windows that end with a segment wait for the next: the words from the
        first of them on are put before it.
        """
        best, n, at, carried = np.zeros(0), 0, 0, b""
        while True:
            end = _boundary(data, min(at + SEGMENT, len(data)))
            buf = np.zeros(len(carried) + end - at + 8, np.uint8)
            buf[: len(carried)] = np.frombuffer(carried, np.uint8)
            buf[len(carried) : -8] = data[at:end]
            buf = _lowered(buf)
            words, starts, ends = _words(buf, np.array([0, len(buf) - 8]))
            start, stop, _ = _windows(words.first)
            if end < len(data):
                start = start[start + WINDOW < len(words.of)]
            logits = self._logits(words, start, stop[: len(start)])
            best, n = np.sort(np.concatenate([best, logits]))[-3:], n + len(start)
            if end >= len(data):
                return np.array([best[-1], best.mean(), np.log(n), 1.0])
            rest = slice(start[-1] + STRIDE if len(start) else 0, None)
            carried = b"".join(bytes(buf[a:b]) + b" " for a, b in zip(starts[rest], ends[rest], strict=True))
            at = end

    def summaries(self, texts: pa.Array) -> np.ndarray:
        data, offsets = tk.raw(texts)
        out, at = [np.zeros((0, 4))], 0
        for i in [*np.flatnonzero(np.diff(offsets) > SEGMENT).tolist(), len(texts)]:
            for _, _, buf, places in tk.pieces(texts.slice(at, i - at), SEGMENT):
                words, _, _ = _words(_lowered(buf), places)
                start, end, begin = _windows(words.first)
                out.append(_summary(self._logits(words, start, end), begin))
            if i < len(texts):
                out.append(self._long(data[offsets[i] : offsets[i + 1]])[None])
            at = i + 1
        return np.concatenate(out)

    def score(self, texts: pa.Array) -> np.ndarray:
        return fitting.sigmoid(self.summaries(texts) @ self.weights)


@dataclass
class Constant:
    value: float

    def score(self, texts: pa.Array) -> np.ndarray:
        return np.full(len(texts), self.value)


def _evidence(words: Words, texts: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One number of each embedding: a text is toxic if one of its words is.

    The odds of a text are the sum of the odds of its distinct words, those of
    a word the product of those of the word and of its n-grams.
    """
    used = [np.unique(words.of[words.first[i] : words.first[i + 1]]) for i in texts]
    begin = np.concatenate([[0], np.cumsum([len(u) for u in used])])
    pairs, text = np.concatenate(used), np.repeat(np.arange(len(texts)), np.diff(begin))
    y = labels[texts].astype(np.float64)
    some, of = np.unique(pairs, return_inverse=True)
    word, grams, empty = words.word[some], words.grams[some], 1 << GRAM_BITS
    grams = np.where(grams < 0, empty, grams)
    flat = grams.ravel()
    p = {"word": np.zeros(1 << WORD_BITS), "grams": np.zeros(empty + 1), "bias": np.array([np.log(y.mean() / (1 - y.mean())) - np.log(max(1.0, len(pairs) / len(texts)))])}
    steps = fitting.Adam(p, EVIDENCE_RATE)
    for done in range(EVIDENCE_STEPS):
        steps.rate = EVIDENCE_RATE * (1 - 0.7 * done / EVIDENCE_STEPS)
        a = (p["word"][word] + p["grams"][grams].sum(1))[of] + p["bias"][0]
        odds = np.exp(np.clip(a, -30, 15))
        total = np.bincount(text, odds, len(texts)) + 1e-12
        share = odds * ((total / (1 + total) - y) / total / len(texts))[text]
        c = np.bincount(of, share, len(some))
        slope = {"word": np.bincount(word, c, 1 << WORD_BITS), "grams": np.bincount(flat, np.repeat(c, grams.shape[1]), empty + 1), "bias": np.array([share.sum()])}
        slope["grams"][empty] = 0
        steps.step({k: g + (EVIDENCE_DECAY * p[k] if k != "bias" else 0) for k, g in slope.items()})
    return p["word"].astype(np.float32), p["grams"].astype(np.float32)


def _sampled(texts: pa.Array) -> Words:
    """The words of whole texts, a segment at a time: four bytes a word are kept, and the distinct words."""
    data, offsets = tk.raw(texts)
    counts, parts = np.zeros(len(texts), np.int64), []

    def add(at: int, buf: np.ndarray, places: np.ndarray) -> None:
        words, _, _ = _words(_lowered(buf), places)
        counts[at : at + len(places) - 1] += np.diff(words.first)
        parts.append(words)

    at = 0
    for i in [*np.flatnonzero(np.diff(offsets) > SEGMENT).tolist(), len(texts)]:
        for a, _, buf, places in tk.pieces(texts.slice(at, i - at), SEGMENT):
            add(at + a, buf, places)
        if i < len(texts):
            begin, end = offsets[i], offsets[i + 1]
            while begin < end:
                stop = min(_boundary(data[:end], min(begin + SEGMENT, end)), end)
                add(i, np.concatenate([data[begin:stop], np.zeros(8, np.uint8)]), np.array([0, stop - begin]))
                begin = stop
        at = i + 1
    h, first, which = np.unique(np.concatenate([p.hash for p in parts]), return_index=True, return_inverse=True)
    cuts = np.cumsum([0, *(len(p.hash) for p in parts)])
    of = np.concatenate([which[a : a + len(p.hash)][p.of].astype(np.int32) for a, p in zip(cuts, parts, strict=False)])
    return Words(of, np.concatenate([[0], np.cumsum(counts)]), h, np.concatenate([p.grams for p in parts])[first], np.concatenate([p.length for p in parts])[first])


class _Rows:
    """Steps for the rows of a table that a batch uses, each sized by the row's own past slopes."""

    def __init__(self, table: np.ndarray, fixed: int):
        self.table, self.fixed, self.past = table, fixed, np.zeros(len(table), np.float32)

    def step(self, rows: np.ndarray, slopes: np.ndarray) -> None:
        """``fixed``: a number of each row that stays."""
        some, of = np.unique(rows, return_inverse=True)
        g = np.zeros((len(some), self.table.shape[1]), np.float32)
        np.add.at(g, of, slopes)
        g[:, self.fixed] = 0
        self.past[some] += (g * g).mean(1)
        self.table[some] -= TABLE_RATE * g / np.sqrt(self.past[some] + 1e-8)[:, None]


def train(texts: list[str], labels: np.ndarray) -> Scorer | Constant:
    """Fit on whole texts; held are four bytes a word, windows are made when they are used."""
    labels = np.asarray(labels, np.int64)
    if min(labels.sum(), len(labels) - labels.sum()) < FOLDS:
        return Constant(float(labels.mean()) if len(labels) else 0.0)
    words = _sampled(pa.array(texts, pa.large_string()))
    word_row = words.word
    start, end, begin = _windows(words.first)
    # folds of equal shares of both classes
    place = np.empty(len(labels), np.int64)
    for c in (0, 1):
        place[labels == c] = np.arange((labels == c).sum())
    fold = place % FOLDS
    text_of = np.repeat(np.arange(len(labels)), np.diff(begin))
    tables, none = Tables.drawn(), len(word_row)
    known = [_evidence(words, np.flatnonzero(fold != k), labels) for k in range(FOLDS)]

    def inputs(some: np.ndarray, k: np.ndarray) -> np.ndarray:
        """Of words as texts of fold k see them."""
        out = tables.inputs(word_row[some], words.grams[some], words.length[some])
        for j in range(FOLDS):
            own = np.flatnonzero(k == j)
            out[own, 0] = known[j][0][word_row[some[own]]]
            out[own, WORD_SIZE] = known[j][1][words.grams[some[own]]].sum(1)
        return out

    def seen(some: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct words of windows by fold, and the windows in numbers of these."""
        filled = _filled(words.of, start[some], end[some], none)
        both, of = _used(np.where(filled < none, filled + none * fold[text_of[some]][:, None], none * FOLDS), none * FOLDS)
        return both % none, both // none, of

    def all_logits(forward: Callable) -> np.ndarray:
        parts = []
        for k in range(0, len(start), BATCH):
            which, of_fold, windows = seen(np.arange(k, min(k + BATCH, len(start))))
            parts.append(forward(inputs(which, of_fold), windows))
        return np.concatenate(parts)

    def evidence(rows: np.ndarray, windows: np.ndarray) -> np.ndarray:
        return np.append(rows[:, 0] + rows[:, WORD_SIZE], -np.inf)[windows].max(1)

    net, draw = Network(), np.random.default_rng(10)
    logits = all_logits(evidence)
    steps, word_rows, gram_rows = fitting.Adam(net.p, RATE), _Rows(tables.word, 0), _Rows(tables.grams, 0)
    rounds = max(ROUNDS, min(MOST_ROUNDS, 20_000 // len(labels)))
    for done in range(rounds):
        if done in (rounds // 14, rounds // 7, rounds // 3, 2 * rounds // 3):
            logits = all_logits(net.forward)
        shown = np.lexsort((logits, text_of))[begin[1:] - 1]  # the window that each text scores highest in
        steps.rate = RATE * (1 - 0.8 * done / rounds)
        for part in np.array_split(draw.permutation(len(labels)), -(-len(labels) // 64)):
            which, of_fold, windows = seen(shown[part])
            if len(which):
                slope, by_input = net.gradient(inputs(which, of_fold), windows, labels[part], np.ones(len(part)))
                steps.step(slope)
                word_rows.step(word_row[which], by_input[:, :WORD_SIZE])
                grams = words.grams[which]
                gram_rows.step(grams[grams >= 0], np.repeat(by_input[:, WORD_SIZE:-1], (grams >= 0).sum(1), axis=0))
    x = _summary(all_logits(net.forward).astype(np.float64), begin)
    weights = np.array([0.7, 0.3, 0.0, 0.0])
    for _ in range(50):  # Newton steps of a ridge logistic regression
        p = fitting.sigmoid(x @ weights)
        slope = x.T @ (p - labels) + 0.5 * (weights - [0.7, 0.3, 0, 0])
        weights = weights - np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 0.5 * np.eye(4), slope)
    tables.word[:, 0], tables.grams[:, 0] = _evidence(words, np.arange(len(labels)), labels)
    return Scorer(tables, net, weights)


def score(docs: DataFrame, labels: DataFrame, label: str = "toxic", usable: Callable[[Column], Column] = lambda i: F.lit(True), row_id: str = "doc_id", text: str = "text", bound: int = 4000) -> DataFrame:
    """Per row of ``docs``: ``row_id``, ``score`` (0 to 1) and ``predicted``.

    ``usable`` of an id tells whether its label may be learned from.
    """
    small_batches(docs.sparkSession)
    chosen = fitting.sample(docs, labels, label, usable, bound, row_id, text).withColumn("digest", F.md5("text"))
    found = fitting.one_per_id(chosen, "digest", "text", "label").toPandas()  # at most ``bound`` rows
    model = docs.sparkSession.sparkContext.broadcast(train(found["text"].tolist(), found["label"].to_numpy(np.int64)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = model.value.score(batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(p, pa.float64()), pa.array((p >= 0.5).astype(np.int32), pa.int32())], ["id", "score", "predicted"])

    rows = docs.select(F.col(row_id).alias("id"), F.col(text).alias("text"))
    schema = T.StructType([rows.schema["id"], T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])
    return rows.mapInArrow(tk.released(run), schema).withColumnRenamed("id", row_id)
