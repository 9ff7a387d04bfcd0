"""Quality classifier: histogram gradient-boosted trees over document statistics."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ready, carried, carried_text, first_by_hash, with_row
from .textbytes import BLANK, LOWER, Words, shingles, text_bytes, words

_CLASS = np.zeros((256, 12), bool)
for _j, _chars in enumerate(("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", ".,;:?", "!", "|", "#$%&*", "<>{}[]()/=\\", "\n", "-_~^+@\"'`")):
    _CLASS[[ord(c) for c in _chars], _j] = True
_CLASS[128:, 10] = True
_CLASS[:32, 11] = ~BLANK[:32]

NAMES = [
    "log_bytes", "lower", "upper", "digit", "stops", "exclaim", "bar", "signs", "brackets", "newline", "other_signs", "wide", "control",
    "log_words", "word_len", "word_len_sd", "distinct_words", "top_word", "repeat_next", "distinct_triples", "distinct_lines", "words_per_line", "short_words", "word_end_sign",
]


def _distinct(h: np.ndarray, doc: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of each document and the count of its most frequent one."""
    order = np.lexsort((h, doc))
    h, doc = h[order], doc[order]
    first = np.ones(len(h), bool)
    first[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    at = np.flatnonzero(first)
    runs = np.diff(np.append(at, len(h)))
    top = np.zeros(n, np.int64)
    np.maximum.at(top, doc[at], runs)
    return np.bincount(doc[at], minlength=n), top


def statistics(w: Words, raw: np.ndarray) -> np.ndarray:
    """A row of NAMES for each document of the slice; an empty one has zeros."""
    n = w.hi - w.lo
    size = np.diff(w.first)
    of_byte = np.repeat(np.arange(n), size)
    per = np.maximum(size, 1)
    cls = [np.bincount(of_byte[_CLASS[raw, j]], minlength=n) for j in range(_CLASS.shape[1])]
    n_words = np.diff(w.ptr)
    of_word = np.repeat(np.arange(n), n_words)
    many = np.maximum(n_words, 1)
    length = (w.end - w.start).astype(float)
    mean = np.bincount(of_word, length, n) / many
    var = np.bincount(of_word, length**2, n) / many - mean**2
    distinct, top = _distinct(w.hash, of_word, n)
    same = np.zeros(len(w.hash), bool)
    same[1:] = (w.hash[1:] == w.hash[:-1]) & (of_word[1:] == of_word[:-1])
    sh, sp = shingles(w, 3)
    triples, _ = _distinct(sh, np.repeat(np.arange(n), np.diff(sp)), n)
    # Lines, as the run of word hashes from the first word after a line break.
    line_of_byte = np.cumsum(raw == 10)
    line = line_of_byte[w.start] if len(w.start) else np.zeros(0, np.int64)
    new = np.ones(len(line), bool)
    new[1:] = (line[1:] != line[:-1]) | (of_word[1:] != of_word[:-1])
    at = np.flatnonzero(new)
    pos = np.arange(len(line)) - np.repeat(at, np.diff(np.append(at, len(line))))
    line_hash = np.add.reduceat(w.hash * (2 * pos + 1).astype(np.uint64), at) if len(at) else np.zeros(0, np.uint64)
    lines, _ = _distinct(line_hash, of_word[at], n)
    n_lines = np.bincount(of_word[at], minlength=n)
    tail = raw[w.end - 1] if len(w.end) else np.zeros(0, np.uint8)
    sign = ~(_CLASS[tail, 0] | _CLASS[tail, 1] | _CLASS[tail, 2] | _CLASS[tail, 3] | _CLASS[tail, 10])
    cols = [
        np.log1p(size), *(c / per for c in cls), np.log1p(n_words), mean, np.sqrt(np.maximum(var, 0)), distinct / many, top / many,
        np.bincount(of_word, same, n) / many, triples / np.maximum(np.diff(sp), 1), lines / np.maximum(n_lines, 1), n_words / np.maximum(n_lines, 1),
        np.bincount(of_word, length <= 3, n) / many, np.bincount(of_word, sign, n) / many,
    ]
    return np.stack(cols, 1)


def _slices(col: pa.Array) -> Iterator[tuple[Words, np.ndarray]]:
    raw, offs = text_bytes(col)
    for w in words(col):
        yield w, statistics(w, raw[offs[w.lo] : offs[w.hi]])


class Trees(NamedTuple):
    """All trees' nodes in flat arrays; a leaf leads to itself."""

    root: np.ndarray
    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    depth: int
    base: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Chance of label 1 for each row, walking all trees of all rows a level at a time."""
        out = np.full(len(x), self.base)
        if len(self.root) and len(x):
            node = np.broadcast_to(self.root, (len(x), len(self.root)))
            rows = np.arange(len(x))[:, None]
            for _ in range(self.depth):
                node = np.where(x[rows, self.feature[node]] <= self.cut[node], self.left[node], self.right[node])
            out = out + self.value[node].sum(1)
        return 1 / (1 + np.exp(-np.clip(out, -30, 30)))


def boost(x: np.ndarray, y: np.ndarray, *, trees: int = 60, depth: int = 4, rate: float = 0.15, bins: int = 64, ridge: float = 2.0, least: int = 8) -> Trees:
    """Gradient-boosted trees on logistic loss; splits are found on histograms of at most ``bins`` bins."""
    if not len(y) or y.min() == y.max():
        base = 30.0 if len(y) and y[0] else 0.0 if not len(y) else -30.0
        return Trees(*(np.zeros(0, np.int64) for _ in range(2)), np.zeros(0), *(np.zeros(0, np.int64) for _ in range(2)), np.zeros(0), 0, base)
    n, k = x.shape
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(k)]
    code = np.stack([np.searchsorted(c, x[:, j], "left") for j, c in enumerate(cuts)], 1)  # bin b: x <= cuts[b]
    slot = code + np.arange(k) * bins
    base = float(np.log(y.mean() / (1 - y.mean())))
    f = np.full(n, base)
    root, feature, cut, left, right, value = [], [], [], [], [], []

    def node() -> int:
        i = len(feature)
        for a, v in ((feature, 0), (cut, np.inf), (left, i), (right, i), (value, 0.0)):
            a.append(v)
        return i

    for _ in range(trees):
        p = 1 / (1 + np.exp(-f))
        g, h = y - p, p * (1 - p)
        root.append(node())
        level = [(root[-1], np.arange(n))]
        for d in range(depth + 1):
            nxt = []
            for at, rows in level:
                gs, hs = g[rows].sum(), h[rows].sum()
                best = (1e-6, -1, -1)
                if d < depth and len(rows) >= 2 * least:
                    s = slot[rows].ravel()
                    gh = np.bincount(s, np.repeat(g[rows], k), k * bins).reshape(k, bins).cumsum(1)
                    hh = np.bincount(s, np.repeat(h[rows], k), k * bins).reshape(k, bins).cumsum(1)
                    nh = np.bincount(s, minlength=k * bins).reshape(k, bins).cumsum(1)
                    gain = gh**2 / (hh + ridge) + (gs - gh) ** 2 / (hs - hh + ridge) - gs**2 / (hs + ridge)
                    gain[(nh < least) | (len(rows) - nh < least)] = -1
                    for j, c in enumerate(cuts):
                        gain[j, len(c) :] = -1
                    j, b = divmod(int(gain.argmax()), bins)
                    best = max(best, (float(gain[j, b]), j, b))
                if best[1] < 0:
                    value[at] = rate * gs / (hs + ridge)
                    f[rows] += value[at]
                    continue
                _, j, b = best
                feature[at], cut[at] = j, cuts[j][b]
                goes = code[rows, j] <= b
                left[at], right[at] = node(), node()
                nxt += [(left[at], rows[goes]), (right[at], rows[~goes])]
            level = nxt
    return Trees(np.array(root), np.array(feature), np.array(cut), np.array(left), np.array(right), np.array(value), depth, base)


def _statistics(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for w, x in _slices(b.column(0)):
            yield pa.RecordBatch.from_arrays([b.column(1).slice(w.lo, w.hi - w.lo), pa.array(list(x), pa.list_(pa.float64()))], ["y", "x"])


def fit(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", sample: int = 20_000, **boosting) -> Trees:
    """Fit on the statistics of at most ``sample`` labelled documents, the first by a hash of their id.

    Null ids or labels teach nothing; without labels every score is 0.5. An id with several labels has the largest;
    of rows that share an id, the first by a hash of its text teaches.
    """
    ready(docs.sparkSession)
    marked = labels.where(F.col(label_col).isin(0, 1)).select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y")).where("id is not null")
    picked = first_by_hash(marked.groupBy("id").agg(F.max("y").alias("y")), "id", sample, "quality")
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    some = rows.join(F.broadcast(picked), "id").groupBy("id", "y").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    got = some.select("text", "y").mapInArrow(_statistics, "y int, x array<double>").toPandas()  # at most `sample` ids
    order = np.lexsort([got.y, *np.stack(got.x).T]) if len(got) else []  # the trees don't depend on the rows' order
    x = np.stack(got.x)[order] if len(got) else np.zeros((0, len(NAMES)))
    return boost(x, got.y.to_numpy(float)[order], **boosting)


def _score(trees: Trees, text_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s = [trees.score(x) for _, x in _slices(carried_text(b, text_col))]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.concatenate([np.zeros(0), *s]))], ["row", "score"])

    return run


def score(docs: DataFrame, trees: Trees, *, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``(row, score)``: the columns to keep (None: all) as a struct and the chance of label 1; null text as empty.

    Each row is scored by its text alone, so null, repeated or tied ids change nothing and equal texts have equal
    scores. Empty input: empty output.
    """
    ready(docs.sparkSession)
    return carried(docs, text_col, keep).mapInArrow(_score(trees, text_col), with_row(docs, keep, score="double"))
