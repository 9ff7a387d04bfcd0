"""Toxicity: noisy-channel deobfuscation under a character language model, then a score of the restored text.

A writer who hides a word swaps letters for digits and signs, spaces it out or repeats letters. Spans that look
so are turned into a lattice of what each character may stand for; the likeliest reading under a character
language model, found by Viterbi search, replaces them. The restored text is scored by words and word beginnings
that toxic labelled documents use and others don't.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, carried, carried_text, first_by_hash, ready, small, with_row
from .textbytes import LOWER, slices, text_bytes

#: Symbols of the character model: 0 what is no letter, 1 to 26 a to z, 27 any other letter.
SYMBOLS = 28
ORDER = 4
#: What a sign may stand for besides itself.
LEET = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g", "@": "a",
    "$": "s", "!": "i", "|": "li", "+": "t", "*": "aeiou", "(": "c", "€": "e", "¡": "i",
}
#: What may stand between the letters of a word that is spaced out.
GAPS = " .-_*"
#: Signs that, beside a letter, make a word suspect; some only before one.
_BEFORE, _AFTER = "0123456789@$!|+*(€¡", "0123456789@$€¡"
_LETTER = r"[^\W\d_]"
#: Single letters spaced out.
SPACED = re.compile(rf"(?<![^\W_])(?:{_LETTER}[ .\-_*]{{1,2}}){{3,}}{_LETTER}(?![^\W_])")
#: Words with letters beside signs, or with a letter three times or more. Only tried where a word starts, so a long
#: word is looked at twice, not once for each of its letters.
MIXED = re.compile(rf"(?<!\S)(?:(?=\S*(?:[{re.escape(_BEFORE)}]{_LETTER}|{_LETTER}[{re.escape(_AFTER)}]))|(?=\S*?({_LETTER})\1\1))\S+")
#: Runs of a sign or letter are read as so many of it; where so many characters in a row are no letters, no word is hidden.
RUN, NO_WORD = 4, 9
_LONG_RUN = re.compile(rf"(.)\1{{{RUN},}}", re.S)
_NO_LETTERS = re.compile(rf"(?:(?!{_LETTER}).){{{NO_WORD},}}", re.S)
_WORD = re.compile(rf"{_LETTER}+")

_CODE = np.zeros(256, np.int64)
_CODE[97:123] = np.arange(1, 27)
_CODE[128:] = 27
_GAP = np.zeros(256, bool)
_GAP[[ord(c) for c in GAPS]] = True
_HINT = np.zeros(256, bool)
_HINT[[ord(c) for c in _BEFORE if ord(c) < 128]] = True
_FAR_HINT = [ord(c) for c in _BEFORE if ord(c) >= 128]


def letter_code(c: str) -> int:
    return ord(c) - 96 if "a" <= c <= "z" else 27 if c.isalpha() else 0


class CharModel(NamedTuple):
    """log P(symbol | the three before), of shape (SYMBOLS ** 3, SYMBOLS)."""

    logp: np.ndarray

    @classmethod
    def from_counts(cls, counts: np.ndarray, lexicon: list[str], share: float = 0.5) -> CharModel:
        """Interpolated counts of every order; ``share`` of the mass follows the lexicon's own words."""

        def smooth(c: np.ndarray) -> np.ndarray:
            grams = c.reshape((SYMBOLS,) * ORDER).astype(float)
            p = np.full(SYMBOLS, 1 / SYMBOLS)
            for n in range(1, ORDER + 1):
                g = grams.sum(axis=tuple(range(ORDER - n)))
                p = (g + 4.0 * p) / (g.sum(-1, keepdims=True) + 4.0)
            return p.reshape(-1, SYMBOLS)

        own = np.zeros(SYMBOLS**ORDER)
        for word in lexicon:
            s = [0] * (ORDER - 1) + [letter_code(c) for c in word] + [0]
            for i in range(ORDER - 1, len(s)):
                k = 0
                for x in s[i - ORDER + 1 : i + 1]:
                    k = k * SYMBOLS + x
                own[k] += 20  # so that a few words outweigh the smoothing
        p = smooth(counts)
        return cls(np.log((1 - share) * p + share * smooth(own) if lexicon else p))


def _gram_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(SYMBOLS**ORDER, np.int64)
    for b in batches:
        raw, offs = text_bytes(b.column(0))
        for lo, hi in slices(offs):
            code = _CODE[LOWER[raw[offs[lo] : offs[hi]]]]
            # A letter of several bytes counts once; runs of what is no letter count as one; texts are kept apart.
            use = np.ones(len(code), bool)
            use[1:] = ~((code[1:] == code[:-1]) & ((code[1:] == 0) | (raw[offs[lo] + 1 : offs[hi]] & 0xC0 == 0x80)))
            code = np.concatenate([np.zeros(ORDER - 1, np.int64), code[use]])
            k = code[: len(code) - ORDER + 1].copy()
            for j in range(1, ORDER):
                k = k * SYMBOLS + code[j : len(code) - ORDER + 1 + j]
            total += np.bincount(k, minlength=len(total))
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["gram", "n"])


def arcs(c: str, before: str) -> list[tuple[str, float]]:
    """What a character may stand for after another ("" for nothing), with the channel's log likelihood."""
    if c.isalpha():
        return [(c, 0.0), ("", -0.5)] if c == before else [(c, 0.0)]
    out = [(x, -1.0) for x in LEET.get(c, "")]
    if c in GAPS or c == before:
        out.append(("", -0.7 if c in GAPS else -4.0))
    return [*out, (" ", -2.0 if c not in GAPS else 0.0)]


def viterbi(span: str, model: CharModel) -> str:
    """The likeliest reading of a span, exactly: states are the last three symbols read, all of them are followed.

    Where all readings agree on the last three symbols, what was read is settled, so that long spans stay cheap.
    """
    logp, top, settled = model.logp, SYMBOLS ** (ORDER - 1), []
    # A state's score and reading; a reading is a pair of the one before it and the character added.
    states: dict[int, tuple[float, tuple | None]] = {0: (0.0, None)}
    before = ""
    for c in span + " ":
        best: dict[int, tuple[float, tuple | None]] = {}
        stands = [(x, letter_code(x) if x else 0, channel) for x, channel in arcs(c, before)]
        for state, (score, read) in states.items():
            for x, k, channel in stands:
                # A space after a space adds nothing.
                if not x or (k == 0 and state % SYMBOLS == 0):
                    nxt, s, r = state, score + channel, read
                else:
                    nxt, s, r = (state * SYMBOLS + k) % top, score + channel + logp[state, k], (read, x)
                if nxt not in best or s > best[nxt][0]:
                    best[nxt] = (s, r)
        if len(best) == 1:
            ((state, (_, read)),) = best.items()
            settled.append(_spelled(read))
            best = {state: (0.0, None)}
        states, before = best, c
    settled.append(_spelled(max(states.values(), key=lambda v: v[0])[1]))
    return "".join(settled).strip()


def _spelled(read: tuple | None) -> str:
    out = []
    while read:
        read, x = read
        out.append(x)
    return "".join(reversed(out))


def _lowered() -> np.ndarray:
    """Each code point in lower case, but for the dotted I, of which that makes two; both forms of small sigma are one."""
    out = np.arange(0x110000, dtype=np.uint32)
    out[:0x20000] = [ord(x) if len(x := chr(c).lower()) == 1 else c for c in range(0x20000)]
    out[0x3C2] = 0x3C3
    return out


_lower: list[np.ndarray] = []
_DOTTED = 0x130


def _code_points(d: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each code point of UTF-8 bytes starts, and the code points in lower case."""
    if not _lower:
        _lower.append(_lowered())
    at = np.flatnonzero((d & 0xC0) != 0x80)
    lead = d[at].astype(np.uint32)
    size = 1 + (lead >= 0xC0).astype(np.int64) + (lead >= 0xE0) + (lead >= 0xF0)
    c = np.where(size == 1, lead, lead & (0xFF >> (size + 1)).astype(np.uint32))
    for k in (1, 2, 3):
        more = np.flatnonzero(size > k)
        c[more] = c[more] << 6 | d[at[more] + k] & 0x3F
    return at, _lower[0][c]


def suspects(raw: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Which texts may hold a suspect span: all that SPACED or MIXED finds one in, and few others.

    Works on code points; one beyond ASCII may be a letter or not.
    """
    n = len(offs) - 1
    out = np.zeros(n, bool)
    for lo, hi in slices(offs):
        d = LOWER[raw[offs[lo] : offs[hi]]]
        if len(d) < 2:
            continue
        at = None
        if (d >= 0x80).any():
            at, c = _code_points(d)
            b = np.minimum(c, 0x80).astype(np.uint8)
        else:
            c = b = d
        letter, hint, gap = _CODE[b] > 0, _HINT[b], _GAP[b]
        hit = np.zeros(len(b), bool)
        if at is not None:
            hint = hint | np.isin(c, _FAR_HINT)
        hit[1:] = (hint[:-1] & letter[1:]) | (letter[:-1] & hint[1:])
        hit |= c == _DOTTED
        hit[2:] |= letter[2:] & (c[2:] == c[1:-1]) & (c[1:-1] == c[:-2])
        # Single letters: none that is surely one stands beside them in their text. Four in a row, one or two gaps apart.
        sure = letter & (b < 0x80)
        first = np.zeros(len(b) + 1, bool)
        starts = offs[lo : hi + 1] - offs[lo]
        first[starts if at is None else np.searchsorted(at, starts)] = True
        single = letter.copy()
        single[1:] &= ~sure[:-1] | first[1:-1]
        single[:-1] &= ~sure[1:] | first[1:-1]
        q = np.flatnonzero(single)
        apart = np.diff(q)
        near = ((apart == 2) | (apart == 3)) & gap[np.minimum(q[:-1] + 1, len(b) - 1)] & gap[q[1:] - 1]
        hit[q[3:][near[:-2] & near[1:-1] & near[2:]]] = True
        found = np.flatnonzero(hit)
        out[np.searchsorted(offs, (found if at is None else at[found]) + offs[lo], "right") - 1] = True
    return out


class Restorer:
    """Restores suspect spans; remembers short ones it has read."""

    def __init__(self, model: CharModel, remember: int = 50_000, short: int = 40):
        self.model, self.known, self.remember, self.short = model, {}, remember, short

    def read(self, core: str) -> str:
        if len(core) > self.short:
            return viterbi(core, self.model)
        if core not in self.known:
            if len(self.known) >= self.remember:
                self.known.clear()
            self.known[core] = viterbi(core, self.model)
        return self.known[core]

    def span(self, m: re.Match) -> str:
        # Signs at the ends are punctuation, except one sign that opens or closes a word in a letter's place.
        core = _LONG_RUN.sub(lambda r: r[1] * RUN, m[0].rstrip(".,!?;:)\"'*|+-_"))
        return f" {' '.join(self.read(part) for part in _NO_LETTERS.split(core))} "

    def __call__(self, text: str) -> str:
        out, at = [], 0
        for m in SPACED.finditer(text):
            out += [MIXED.sub(self.span, text[at : m.start()]), self.span(m)]
            at = m.end()
        return "".join([*out, MIXED.sub(self.span, text[at:])])


def tokens(text: str) -> set[str]:
    return set(_WORD.findall(text))


def features(word: str) -> list[str]:
    """A word of four letters or more, and its beginnings."""
    n = len(word)
    return [word] + [f"^{word[:k]}" for k in (4, 5, 6) if n >= k] if n >= 3 else []


def _texts(col: pa.Array, restore: Restorer | None) -> Iterator[str]:
    raw, offs = text_bytes(col)
    flags = suspects(raw, offs) if restore else None
    for i, t in enumerate(col.to_pylist()):
        t = (t or "").lower()
        yield restore(t) if restore and flags[i] else t


def _feature_places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Features of toxic texts, each with the word before it, and how often features stand in other texts; by fold.

    A word that is used in many places tells more than one that many copies of a text repeat, so a toxic text's
    feature counts once for each word before it; elsewhere every use counts. Columns text, toxic, fold.
    """

    def flush() -> pa.RecordBatch:
        flags = np.array(list(toxic_at.values()), np.int64)
        uses = np.array(list(clean.values()), np.int64).reshape(-1, 2)
        none, zero = np.full(len(uses), -1), np.zeros(len(flags), np.int64)
        cols = [
            pa.array([*(f for f, _ in toxic_at), *clean], pa.string()), pa.array(np.concatenate([np.array([p for _, p in toxic_at], np.int64), none])),
            *(pa.array(np.concatenate([zero, uses[:, j]])) for j in (0, 1)), *(pa.array(np.concatenate([flags >> j & 1, none * 0])) for j in (0, 1)),
        ]
        return pa.RecordBatch.from_arrays(cols, ["feature", "before", "c0", "c1", "t0", "t1"])

    toxic_at: dict[tuple[str, int], int] = {}
    clean: dict[str, list[int]] = {}
    for b in small(batches, lambda b: b.column(0)):
        for t, toxic, fold in zip(_texts(b.column(0), None), b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
            found = _WORD.findall(t)
            if toxic:
                before = 0
                for w in found:
                    for f in features(w):
                        toxic_at[f, before] = toxic_at.get((f, before), 0) | 1 << fold
                    before = zlib.crc32(w.encode())
            else:
                for w, n in Counter(found).items():
                    for f in features(w):
                        clean.setdefault(f, [0, 0])[fold] += n
        if len(toxic_at) + len(clean) > 150_000:
            yield flush()
            toxic_at, clean = {}, {}
    yield flush()


def measure(text: str, lexicon: dict[str, float]) -> list[float]:
    """What the score sees of a text: the weights of its distinct words that the lexicon knows."""
    hits = []
    for w in tokens(text):
        best = lexicon.get(w, 0.0)
        if len(w) >= 4:
            best = max(best, lexicon.get("^" + w[:4], 0.0), lexicon.get("^" + w[:5], 0.0) if len(w) > 4 else 0.0, lexicon.get("^" + w[:6], 0.0) if len(w) > 5 else 0.0)
        if best > 0:
            hits.append(best)
    return [min(sum(hits), 40.0) / 10, math.log1p(len(hits)), max(hits, default=0.0) / 5]


def _measures(lexicons: list[dict[str, float]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small(batches, lambda b: b.column(0)):
            x = [measure(t, lexicons[fold]) for t, fold in zip(_texts(b.column(0), None), b.column(2).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(1), pa.array(x, pa.list_(pa.float64()))], ["toxic", "x"])

    return run


class ToxicModel(NamedTuple):
    chars: CharModel
    lexicon: dict[str, float]
    coef: np.ndarray


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    x = np.hstack([np.ones((len(x), 1)), x])
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        w += np.linalg.solve(h, x.T @ (y - p) - ridge * w)
    return w


def _weights(c: np.ndarray, t: np.ndarray, clean: int, toxic: int, surely: float = 22.0) -> np.ndarray:
    """Log odds of features, 0 where a likelihood-ratio test can't tell them from chance among as many features."""
    share = toxic / (toxic + clean)
    ratio = 2 * (t * np.log(np.maximum(t, 1e-9) / ((t + c) * share + 1e-12) + 1e-12) + c * np.log(np.maximum(c, 1e-9) / ((t + c) * (1 - share) + 1e-12)))
    odds = np.log((t + 0.3) / (toxic + 1)) - np.log((c + 0.3) / (clean + 1))
    return np.where((ratio >= surely) & (odds > 1.5), odds, 0.0)


def _restored(chars: CharModel):
    """Columns text, toxic, fold, with the text restored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restore = Restorer(chars)
        for b in small(batches, lambda b: b.column(0)):
            yield pa.RecordBatch.from_arrays([pa.array(list(_texts(b.column(0), restore)), pa.string()), *b.columns[1:]], b.schema.names)

    return run


def _lexicons(some: DataFrame, most: int, scratch: Scratch) -> list[dict[str, float]]:
    """Weights of words and beginnings learned from fold 0's rows, fold 1's and all, for fold 1, fold 0 and new texts."""
    kinds = ("c0", "c1", "t0", "t1")
    places = some.mapInArrow(_feature_places, "feature string, before long, c0 long, c1 long, t0 long, t1 long")
    sums = places.groupBy("feature", "before").agg(*[(F.sum if c[0] == "c" else F.max)(c).alias(c) for c in kinds]).groupBy("feature").agg(*[F.sum(c).alias(c) for c in kinds])
    sums = scratch.save(sums)
    c0, c1, t0, t1 = sums.agg(*[F.sum(c) for c in kinds]).first()
    share = (c0 + c1 + 1) / (t0 + t1 + 1)
    top = (
        sums.withColumn("t", F.col("t0") + F.col("t1")).where("t >= 3")
        .where((F.col("t") * share) > 4 * (F.col("c0") + F.col("c1")))
        .orderBy(F.desc("t"), "feature").limit(most).toPandas()
    )
    scratch.drop(sums)
    out = []
    for c, t, clean, toxic in ((top.c1, top.t1, c1, t1), (top.c0, top.t0, c0, t0), (top.c0 + top.c1, top.t0 + top.t1, c0 + c1, t0 + t1)):
        w = _weights(c.to_numpy(float), t.to_numpy(float), clean, toxic)
        out.append(dict(zip(top.feature[w > 0], w[w > 0].tolist(), strict=True)))
    return out


def fit(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", sample: int = 20_000, lexicon_size: int = 20_000) -> ToxicModel:
    """Learn from labelled rows.

    The classifier is fitted on at most ``sample`` toxic and ``sample`` other labelled ids, the first by a hash of
    their id; of these it keeps at most ``lexicon_size`` words and beginnings. A first lexicon, of the texts as they
    are, lets the character model read hidden words; what is scored with is learned from the texts that it restores,
    as all texts are restored before their score. The character counts cover all of ``docs``; there are at most
    SYMBOLS ** ORDER of them.

    Rows with a null id or label teach nothing. An id that has both labels teaches both; of rows that share an id
    and a text, one teaches. Without labels of both kinds, or without rows, the model's scores are 0.
    """
    ready(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    marked = labels.where(F.col(label_col).isin(0, 1)).select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("toxic")).where("id is not null")
    turn = F.xxhash64("id", F.lit("toxicity"))
    picked = None
    for y in (0, 1):
        part = first_by_hash(marked.where(F.col("toxic") == y).distinct(), "id", sample, "toxicity")
        picked = part if picked is None else picked.unionByName(part)
    scratch = Scratch(docs.sparkSession, "toxicity")
    picked = scratch.save(picked)
    some = scratch.save(rows.join(F.broadcast(picked), "id").select("text", "toxic", F.pmod(turn, F.lit(2)).cast("int").alias("fold")).dropDuplicates(["text", "toxic"]))  # at most 2 x sample ids
    n = {(r["toxic"], r["fold"]): r["count"] for r in some.groupBy("toxic", "fold").count().collect()}
    grams = rows.select("text").mapInArrow(_gram_counts, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(SYMBOLS**ORDER)
    counts[grams.gram.to_numpy(np.int64)] = grams.n.to_numpy()
    if not all(n.get((y, f), 0) for y in (0, 1) for f in (0, 1)):
        scratch.drop(some, picked)
        return ToxicModel(CharModel.from_counts(counts, []), {}, np.array([-30.0, 0, 0, 0]))
    first = _lexicons(some, lexicon_size, scratch)[2]
    chars = CharModel.from_counts(counts, [w for w in first if w[0] != "^"])
    read = scratch.save(some.mapInArrow(_restored(chars), some.schema))
    lex = _lexicons(read, lexicon_size, scratch)
    # Each fold is measured with the other fold's lexicon, as unseen documents will be.
    got = read.mapInArrow(_measures(lex[:2]), "toxic int, x array<double>").toPandas()
    scratch.drop(some, picked, read)
    return ToxicModel(chars, lex[2], _logistic(np.stack(got.x), got.toxic.to_numpy(float)))


def _score(model: ToxicModel, text_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restore = Restorer(model.chars)
        for b in small(batches, lambda b: carried_text(b, text_col)):
            x = np.array([measure(t, model.lexicon) for t in _texts(carried_text(b, text_col), restore)]).reshape(-1, 3)
            z = model.coef[0] + x @ model.coef[1:]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(1 / (1 + np.exp(-np.clip(z, -30, 30))))], ["row", "score"])

    return run


def score(docs: DataFrame, model: ToxicModel, *, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``(row, score)``: the columns to keep (None: all) as a struct and the chance that its text is toxic; null text as empty.

    Each row is scored by its text alone, so null, repeated or tied ids change nothing and equal texts have equal
    scores. Empty input: empty output.
    """
    ready(docs.sparkSession)
    return carried(docs, text_col, keep).mapInArrow(_score(model, text_col), with_row(docs, keep, score="double"))
