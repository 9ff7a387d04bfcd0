"""Exact dedup by Grace hashing: records are partitioned by hash until each bucket's texts fit a table that compares them whole."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Scratch, ready, small


class OpenTable:
    """Texts by open addressing: a slot holds an entry's number, probing goes on to the next slot, and an entry is the
    text's own only if hash and complete content agree."""

    #: What an entry takes besides its text, roughly.
    ENTRY = 200

    def __init__(self, slots: int = 1024):
        self.slots = [-1] * slots
        self.hashes: list[int] = []
        self.texts: list[bytes] = []
        self.size = 0

    def find(self, h: int, text: bytes, insert: bool = True) -> int:
        """The text's entry, a new one if it has none; -1 if it has none and ``insert`` is False."""
        slots, mask = self.slots, len(self.slots) - 1
        i = h & mask
        while (e := slots[i]) >= 0:
            if self.hashes[e] == h and self.texts[e] == text:
                return e
            i = (i + 1) & mask
        if not insert:
            return -1
        slots[i] = e = len(self.texts)
        self.hashes.append(h)
        self.texts.append(text)
        self.size += len(text) + self.ENTRY
        if 2 * len(self.texts) > len(slots):
            self._grow()
        return e

    def _grow(self) -> None:
        self.slots = slots = [-1] * (2 * len(self.slots))
        mask = len(slots) - 1
        for e, h in enumerate(self.hashes):
            i = h & mask
            while slots[i] >= 0:
                i = (i + 1) & mask
            slots[i] = e


def content_hash(text: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(text, digest_size=8).digest(), "little", signed=True)


_LOCAL = T.StructType().add("local", "long").add("h", "long").add("n", "long").add("top", "long").add("at", "integer").add("size", "long").add("text", "binary")


def _lists(values: pa.Array, lengths: list[int]) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)), values)


def _collapse(most: int, most_rows: int, hashed=content_hash):
    """Equal texts of a partition as one row each, with its members; a table that is full is given out, and a new one begun."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33
        table, members, rows, ids, held = OpenTable(), [], [], [], 0

        def out() -> Iterator[pa.RecordBatch]:
            nonlocal number
            kept, known = pa.concat_arrays(rows), len(table.texts)
            top = [max((x for i in m if (x := ids[i]) is not None), default=None) for m in members]
            at = [next((j for j, i in enumerate(m) if ids[i] == t), 0) for m, t in zip(members, top, strict=True)]
            cols = [
                pa.array(range(number, number + known), pa.int64()), pa.array(table.hashes, pa.int64()), pa.array([len(m) for m in members], pa.int64()), pa.array(top, pa.int64()), pa.array(at, pa.int32()),
                pa.array([len(t) for t in table.texts], pa.int64()), pa.array(table.texts, pa.binary()), _lists(kept.take(pa.array([i for m in members for i in m], pa.int64())), [len(m) for m in members]),
            ]
            number += known
            yield from small([pa.RecordBatch.from_arrays(cols, [*_LOCAL.names, "members"])], lambda b: b.column(6))

        for whole_batch in batches:
            for b in small([whole_batch], lambda b: b.column(2)):
                rows.append(b.column(0))
                held += b.column(0).nbytes
                for i, text in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                    text = (text or b"").lower()  # of bytes: A-Z alone
                    e = table.find(hashed(text), text)
                    if e == len(members):
                        members.append([])
                    members[e].append(len(ids))
                    ids.append(i)
                if held + table.size > most or len(ids) >= most_rows:
                    yield from out()
                    table, members, rows, ids, held = OpenTable(), [], [], [], 0
        if ids:
            yield from out()

    return run


_FOUND = "local long, keep_id long, group_size long, holds boolean, sha binary, h long, n long, top long, text binary"


def _bucket(most: int):
    """A bucket's classes by one table. Texts that it has no room for are given on, to be partitioned anew; all copies of
    such a text are, as the table has none of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, places, sizes, tops, full = OpenTable(), [], [], [], False
        for whole_batch in batches:
            for b in small([whole_batch], lambda b: b.column(4)):
                over = []
                cols = [b.column(i).to_pylist() for i in range(5)]
                for j, (local, h, n, top, text) in enumerate(zip(*cols, strict=True)):
                    full = full or table.size >= most
                    e = table.find(h, text, not full)
                    if e < 0:
                        over.append(j)
                        continue
                    if e == len(places):
                        places.append([])
                        sizes.append(0)
                        tops.append((top is not None, top or 0, -local))
                    places[e].append(local)
                    sizes[e] += n
                    # The largest id; of tables that share it, or have none, the first.
                    tops[e] = max(tops[e], (top is not None, top or 0, -local))
                if over:
                    some = b.take(pa.array(over, pa.int64()))
                    none = [pa.nulls(len(over), t) for t in (pa.int64(), pa.int64(), pa.bool_(), pa.binary())]
                    yield pa.RecordBatch.from_arrays([some.column(0), *none, *some.columns[1:]], _NAMES)
        for lo in range(0, len(places), 4096):
            part = range(lo, min(lo + 4096, len(places)))
            each = [(local, tops[e][1] if tops[e][0] else None, sizes[e], local == -tops[e][2], hashlib.sha256(table.texts[e]).digest()) for e in part for local in places[e]]
            cols = [pa.array(c, t) for c, t in zip(zip(*each, strict=True), (pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.binary()), strict=True)]
            yield pa.RecordBatch.from_arrays([*cols, *[pa.nulls(len(each), t) for t in (pa.int64(), pa.int64(), pa.int64(), pa.binary())]], _NAMES)

    return run


_NAMES = [c.split()[0] for c in _FOUND.split(", ")]


def exact_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None, bucket_bytes: int = 48 << 20, table_rows: int = 100_000, hashed=content_hash) -> DataFrame:
    """Groups of texts that are identical after lower-casing A-Z: ``(row, keep_id, group_size, kept, text_sha256)``.

    ``row`` is a struct of the columns to ``keep`` (None: all), whatever they are called. Of a group the row with the
    largest id stays; of several rows with that id just one, so that each group has one row that is ``kept``.

    Tasks first bring equal texts of their partition together, so that of a text with very many copies few rows are left
    (one a partition). These are written with their members, and their texts dealt out by hash into buckets, each read
    into one table of about ``bucket_bytes``. What a full table has no room for is written to the shared folder and
    partitioned anew by another hash, until nothing is left. ``hashed`` only has to be equal for equal texts.

    Null text: empty. Null ids are below all others; a group without ids has a null ``keep_id``. Repeated rows are rows
    like others. Empty input: empty output.
    """
    spark = docs.sparkSession
    ready(spark)
    scratch = Scratch(spark, "exact")
    names = docs.columns if keep is None else keep
    slim = docs.select(F.struct(*[docs[f"`{c}`"] for c in names]).alias("row"), docs[f"`{id_col}`"].cast("long").alias("id"), docs[f"`{text_col}`"].cast("string").cast("binary").alias("text"))
    schema = T.StructType([*_LOCAL.fields, T.StructField("members", T.ArrayType(slim.schema["row"].dataType))])
    local = scratch.save(slim.mapInArrow(_collapse(bucket_bytes // 2, table_rows, hashed), schema))
    todo, level, found = local.select("local", "h", "n", "top", "text"), 0, None
    need = local.agg(F.coalesce(F.sum(F.col("size") + OpenTable.ENTRY), F.lit(0))).first()[0]
    while True:
        ways = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-3 * need // (2 * bucket_bytes)))
        # The level is part of the hash, so that texts that met in a bucket part in the next one.
        dealt = todo.repartition(int(ways), F.xxhash64("h", F.lit(level)))
        done = scratch.save(dealt.mapInArrow(_bucket(bucket_bytes), _FOUND))
        part = done.where("text is null").select("local", "keep_id", "group_size", "holds", "sha")
        found = part if found is None else found.unionByName(part)
        todo = done.where("text is not null").select("local", "h", "n", "top", "text")
        need = todo.agg(F.sum(F.length("text") + OpenTable.ENTRY)).first()[0]
        if not need:
            break
        level += 1
    each = local.select("local", "at", "members").join(found, "local").select("keep_id", "group_size", "holds", "sha", "at", F.posexplode("members").alias("i", "row"))
    return each.select("row", "keep_id", "group_size", (F.col("holds") & (F.col("i") == F.col("at"))).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"))


def deduplicate(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that stay, with their columns; see ``exact_duplicates``."""
    return exact_duplicates(docs, id_col=id_col, text_col=text_col).where("kept").select("row.*")
