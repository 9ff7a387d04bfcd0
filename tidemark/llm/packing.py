"""Best-fit packing of tokenised documents into sequences of a fixed length.

The histogram of piece lengths, at most as long as a sequence, is all that the driver sees. Over it the
configuration linear program (least number of sequences that cover every length's demand) is solved by
multiplicative weights until every length is covered; a knapsack dynamic program prices the configurations. Its
solution, rounded and solved again over what rounding leaves, places most pieces; the residue is placed best-fit, by
runs of equal sequences, so that the work doesn't grow with the input.
"""

from __future__ import annotations

import os
import re
import unicodedata
import zlib
from array import array
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, ready, small

#: Printable ASCII without capitals, and Latin-1's small letters: the tokenizer's normaliser leaves words of these as they are.
_LETTERS = "a-z\u00df-\u00f6\u00f8-\u00ff"
_PLAIN = re.compile(f"[!-@\\[-`{{-~{_LETTERS}]+").fullmatch
#: What the tokenizer's own splitting makes of such a word, each of which it encodes by itself.
_PARTS = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[0-9]|[^{_LETTERS}0-9]+").findall
#: Bytes as the characters that a byte-level vocabulary writes for them.
_SHOWN = {b: 256 + i for i, b in enumerate(b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or 174 <= b))}
#: Marks of the tokenizer's special tokens begin so; they are told by case and found before anything else.
_SPECIAL = "<|"


def _ends_in_letter(word: str) -> bool:
    """Whether a word of letters still ends in one when the tokenizer has lower-cased it: U+0130 gets a mark, which keeps
    a sign that follows."""
    return word.isalpha() and (word.isascii() or unicodedata.normalize("NFC", word).lower()[-1].isalpha())


class _Words(dict):
    """The ids of words that a tokenizer has seen: a table in use, and the one before, whose words may come back.

    Plain words are cut as the tokenizer cuts them, and only its model is asked for the parts; all others go through
    the whole tokenizer, without the full stop or comma that ends a word of letters, which is a token of its own.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.before: dict[str, bytes] = {}

    def __missing__(self, word: str) -> bytes:
        ids = self.before.get(word)
        if ids is None:
            if not _PLAIN(word) or _SPECIAL in word:
                if word[-1:] in (".", ",") and _ends_in_letter(word[:-1]):
                    ids = self[word[:-1]] + self[word[-1]]
                else:
                    ids = array("I", self.tokenizer.encode_batch_fast([word], add_special_tokens=False)[0].ids).tobytes()
            elif len(parts := _PARTS(word)) > 1:
                ids = b"".join([self[x] for x in parts])
            else:
                shown = word if word.isascii() else word.encode().decode("latin-1").translate(_SHOWN)
                ids = array("I", [x.id for x in self.model.tokenize(shown)]).tobytes()
        self[word] = ids
        return ids

    def turn(self) -> None:
        """Begin a new table."""
        self.before = dict(self)
        self.clear()


_words: dict[str, _Words] = {}


def encode(texts: list[str], path: str, most: int = 250_000) -> list[bytes]:
    """Each text's ids as little-endian unsigned 32-bit numbers.

    The tokenizer lower-cases, drops white space and never joins what stands on both sides of it, so each
    blank-separated word is encoded by itself, once for as long as it stays in two tables of about ``most`` words.
    """
    table = _words.get(path) or _words.setdefault(path, _Words(path))
    out = []
    for text in texts:
        # Lower-casing here only lets more words share an entry; where it might differ, the text stays as it is.
        low = text.lower()
        if _SPECIAL not in text and (text.isascii() or (unicodedata.is_normalized("NFC", text) and unicodedata.is_normalized("NFC", low) and "\u03a3" not in text and "\u0130" not in text)):
            text = low
        if len(table) > most:
            table.turn()
        out.append(b"".join(map(table.__getitem__, text.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" "))))
    return out


def _tokenise(path: str, end: int, size: int, with_ids: bool):
    """Rows (doc_id, piece, length, ids_crc32), and the ids if they are wanted: a text's ids cut into pieces."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stop = np.array([end], "<u4").tobytes()
        for b in small(batches, lambda b: b.column(1)):
            row, piece, cut, size_of, crcs = [], [], [], [], []
            for i, ids in enumerate(encode([t or "" for t in b.column(1).to_pylist()], path)):
                ids += stop
                for at in range(0, len(ids), 4 * size):
                    part = ids[at : at + 4 * size]
                    row.append(i)
                    piece.append(at // (4 * size))
                    size_of.append(len(part) // 4)
                    crcs.append(zlib.crc32(part))
                    if with_ids:
                        cut.append(part)
            cols = [b.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), pa.array(size_of, pa.int64()), pa.array(crcs, pa.int64())]
            if with_ids:
                offs = np.concatenate([[0], np.cumsum(size_of)]).astype(np.int32)
                cols.append(pa.ListArray.from_arrays(pa.array(offs), pa.array(np.frombuffer(b"".join(cut), "<i4"))))
            yield pa.RecordBatch.from_arrays(cols, ["doc_id", "piece", "length", "ids_crc32", "ids"][: len(cols)])

    return run


def _price_configs(lens: np.ndarray, price: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Unbounded knapsack: for each room its highest price, the length put in at it, and the next room below to put one in (0: none)."""
    best, pick = np.zeros(size + 1), np.full(size + 1, -1)
    upto = np.searchsorted(lens, np.arange(size + 1), "right")
    for c in range(1, size + 1):
        best[c] = best[c - 1]
        if k := upto[c]:
            v = best[c - lens[:k]] + price[:k]
            j = int(v.argmax())
            if v[j] > best[c]:
                best[c], pick[c] = v[j], j
    return best, pick, np.maximum.accumulate(np.where(pick >= 0, np.arange(size + 1), 0))


def cover_program(hist: dict[int, int], size: int, steps: int = 4, sharp: float = 12.0, within: float = 1e-3, near: float = 0.02) -> dict[tuple, float]:
    """The configuration linear program by multiplicative weights: configurations, ((length, copies), ...), and their uses.

    Every length's demand is covered to a share of ``within``. Coverage rises in ``steps`` even steps; a length's price
    falls exponentially with the share that is covered. Each pricing gives the best configuration that holds a length,
    for each length; those that come ``near`` the best of all are used, as far as the step's demand goes, which closes
    at least one length. So it ends, however many lengths there are.
    """
    lens = np.array(sorted(hist), np.int64)
    want = np.array([hist[int(x)] for x in lens], np.float64)
    cover, plan = np.zeros(len(lens)), {}
    rng = np.random.default_rng(11)
    for step in range(1, steps + 1):
        goal = step / steps
        while len(at := np.flatnonzero(goal - cover > within)):
            part, least = lens[at].tolist(), (within * want[at]).tolist()
            # Prices that are all but equal are told apart, so that configurations differ.
            price = lens[at] * np.exp(sharp * (goal - cover[at])) * (1 + 1e-5 * rng.random(len(at)))
            best, pick, below = _price_configs(lens[at], price, size)
            value = price + best[size - lens[at]]
            pick, below, room = pick.tolist(), below.tolist(), ((goal - cover[at]) * want[at]).tolist()
            used = 0
            for j in np.argsort(-value, kind="stable").tolist():
                if value[j] < (1 - near) * best[size]:
                    break
                config, c = {j: 1}, below[size - part[j]]
                while c:
                    config[pick[c]] = config.get(pick[c], 0) + 1
                    c = below[c - part[pick[c]]]
                if any(room[i] <= least[i] for i in config):
                    continue
                x = min(room[i] / k for i, k in config.items())
                for i, k in config.items():
                    room[i] -= x * k
                key = tuple(sorted((part[i], k) for i, k in config.items()))
                plan[key] = plan.get(key, 0.0) + x
                used += 1
            cover[at] = goal - np.array(room) / want[at]
            # Lengths that lag have higher prices in the next step; the last one covers all.
            if step < steps and used * 20 < len(at):
                break
    return plan


def program_rounds(hist: dict[int, int], size: int, steps: int = 4, sharp: float = 12.0) -> Iterator[tuple[list[tuple[dict[int, int], int]], dict[int, int]]]:
    """Ever more of the rounded program: configurations with how often each is used, and the pieces that are left.

    The first solution's uses are rounded down to fours, to twos and to ones, so that of what coarser rounding leaves
    open the residue can make better use; then they are rounded up while pieces last. The program is solved again over
    what is left until that places less than a tenth of it. Configurations that don't fill a sequence are taken last,
    rounded down, so that others may top them up.
    """
    left = {a: n for a, n in hist.items() if n}
    out = [({size: 1}, left.pop(size))] if size in left else []
    if not left:
        yield list(out), {}
    first = True
    while left:
        before = sum(a * n for a, n in left.items())
        plan = cover_program(left, size, steps, sharp)
        full = {key: x for key, x in plan.items() if sum(a * k for a, k in key) == size}
        taken: dict[tuple, int] = {}

        def take(some: dict[tuple, float], order, most) -> None:
            for key, x in sorted(some.items(), key=order):
                if times := min([most(x), *(left[a] // k for a, k in key)]):
                    taken[key] = taken.get(key, 0) + times
                    for a, k in key:
                        left[a] -= k * times

        def so_far() -> tuple[list[tuple[dict[int, int], int]], dict[int, int]]:
            return out + [(dict(key), times) for key, times in taken.items()], {a: n for a, n in left.items() if n}

        for unit in (4, 2, 1) if first else (1,):
            take({key: x - taken.get(key, 0) for key, x in full.items()}, lambda p: (-p[1], p[0]), lambda x, unit=unit: int(x / unit) * unit)
            if first:
                yield so_far()
        first = False
        take(full, lambda p: (-(p[1] % 1), p[0]), lambda x: 1)
        last = sum(a * n for a, n in left.items()) > 0.9 * before
        if last:
            take({key: x for key, x in plan.items() if key not in full}, lambda p: (-p[1], p[0]), int)
        out, left = so_far()
        yield list(out), dict(left)
        if last:
            break


def program_configs(hist: dict[int, int], size: int, steps: int = 4, sharp: float = 12.0) -> tuple[list[tuple[dict[int, int], int]], dict[int, int]]:
    """The last of ``program_rounds``: as much as the program places."""
    out: tuple[list[tuple[dict[int, int], int]], dict[int, int]] = [], {}
    for out in program_rounds(hist, size, steps, sharp):
        pass
    return out


def solve_configs(hist: dict[int, int], size: int, steps: int = 4, sharp: float = 12.0) -> list[tuple[dict[int, int], int]]:
    """Configurations (length to copies) and how often each is used; together they hold the histogram exactly.

    After each of the program's roundings the residue is placed best-fit; the plan with the fewest sequences counts, of
    equals the one that the program placed more of. The program isn't solved again once a plan has as few sequences as
    all tokens fill, which nothing beats.
    """
    fills = lambda c: sum(a * k for a, k in c.items()) == size
    least, best, fewest = -(-sum(a * n for a, n in hist.items()) // size), [], None
    for out, left in program_rounds(hist, size, steps, sharp):
        plan = [p for p in out if fills(p[0])] + best_fit(left, size, [p for p in out if not fills(p[0])])
        many = sum(n for _, n in plan)
        if fewest is not None and fewest == least < many:
            break
        if fewest is None or many <= fewest:
            best, fewest = plan, many
    return best


def best_fit(hist: dict[int, int], size: int, begun: Sequence[tuple[dict[int, int], int]] = ()) -> list[tuple[dict[int, int], int]]:
    """Best-fit decreasing over runs of equal pieces and runs of equal sequences, those ``begun`` first."""
    runs: dict[int, list[list]] = {}  # room -> [configuration, how many]
    for config, many in begun:
        runs.setdefault(size - sum(a * k for a, k in config.items()), []).append([config, many])
    for length in sorted(hist, reverse=True):
        n = hist[length]
        while n:
            room = min((r for r in runs if r >= length), default=None)
            if room is None:
                config, many = {}, -(-n // (size // length))
                room = size
            else:
                config, many = runs[room].pop()
                if not runs[room]:
                    del runs[room]
            fit = room // length
            used = min(many, n // fit) or 1
            put = min(fit, n)
            done = config | {length: config.get(length, 0) + put}
            runs.setdefault(room - put * length, []).append([done, used])
            n -= put * used
            if config and many > used:
                runs.setdefault(room, []).append([config, many - used])
    return [(c, k) for group in runs.values() for c, k in group]


def _places(plan: list[tuple[dict[int, int], int]]) -> np.ndarray:
    """Rows (length, first rank, copies, first sequence, offset), sorted: where the pieces of a length go."""
    rows, rank, seq = [], {}, 0
    for config, times in plan:
        off = 0
        for length in sorted(config, reverse=True):
            k = config[length]
            rows.append((length, rank.get(length, 0), k, seq, off))
            rank[length] = rank.get(length, 0) + k * times
            off += k * length
        seq += times
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def _assign(places: np.ndarray, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = places[:, 0] * (1 << 44) + places[:, 1]
        for b in batches:
            length, rank = (b.column(b.schema.get_field_index(c)).to_numpy(zero_copy_only=False) for c in ("length", "rank"))
            row = places[np.searchsorted(key, length * (1 << 44) + rank, "right") - 1]
            i = rank - row[:, 1]
            keep = [b.column(b.schema.get_field_index(c)) for c in names]
            yield pa.RecordBatch.from_arrays([*keep, pa.array(row[:, 3] + i // row[:, 2]), pa.array(row[:, 4] + i % row[:, 2] * length)], [*names, "sequence_id", "offset"])

    return run


def pack(docs: DataFrame, tokenizer: str, *, id_col: str = "doc_id", text_col: str = "text", size: int = 2048, end_id: int = 0, steps: int = 4, shard_rows: int = 50_000, with_ids: bool = True) -> DataFrame:
    """Pack each document's ids and then ``end_id`` into sequences of at most ``size`` ids.

    Returns a row for each piece: doc_id, piece, start, length, ids (if ``with_ids``), ids_crc32, sequence_id, offset. Only documents
    longer than ``size`` are cut, into pieces of ``size``; the last may be shorter. Null or empty text: the end id
    alone. Null or repeated ids: each row is a document of its own. Empty input: empty output.

    Pieces of a length are ranked in shards of about ``shard_rows`` pieces, so that a length that most pieces
    share isn't ranked in one task; the driver gets the histogram alone.
    """
    spark = docs.sparkSession
    ready(spark)
    scratch = Scratch(spark, "pack")
    pieces = scratch.save(
        docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
        .mapInArrow(_tokenise(tokenizer, end_id, size, with_ids), "doc_id long, piece int, length long, ids_crc32 long" + ", ids array<int>" * with_ids)
        .select("doc_id", "piece", (F.col("piece").cast("long") * size).alias("start"), "length", *["ids"] * with_ids, "ids_crc32")
    )
    hist = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}  # at most `size` rows
    if not hist:
        return pieces.select("*", F.lit(0).cast("long").alias("sequence_id"), F.lit(0).cast("long").alias("offset")).limit(0)
    places = _places(solve_configs(hist, size, steps))
    most = max(1, -(-max(hist.values()) // shard_rows))
    shards = F.create_map(*[F.lit(x).cast("long") for k, n in hist.items() if n > shard_rows for x in (k, -(-n // shard_rows))]) if most > 1 else None
    ways = F.coalesce(F.try_element_at(shards, F.col("length")), F.lit(1).cast("long")) if most > 1 else F.lit(1)
    # Short lengths that few documents have share partitions; at least 16 ways keep the tasks even.
    pieces = pieces.withColumn("shard", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.greatest(ways, F.lit(16).cast("long"))))
    counts = pieces.groupBy("length", "shard").count()
    before = counts.select("length", "shard", (F.sum("count").over(Window.partitionBy("length").orderBy("shard")) - F.col("count")).alias("before"))
    inside = F.row_number().over(Window.partitionBy("length", "shard").orderBy("doc_id", "piece", "ids_crc32")) - 1
    ranked = pieces.withColumn("inside", inside).join(before, ["length", "shard"]).withColumn("rank", F.col("before") + F.col("inside"))
    names = ["doc_id", "piece", "start", "length", *["ids"] * with_ids, "ids_crc32"]
    kinds = {"piece": "int", "ids": "array<int>"}
    return ranked.select(*names, "rank").mapInArrow(_assign(places, names), ", ".join(f"{c} {kinds.get(c, 'long')}" for c in [*names, "sequence_id", "offset"]))
