"""Line dedup over levelled, sorted runs of line hashes."""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.files import Files
from .common import Scratch, ready, small, with_row

#: What is stripped from both ends of a line before it is compared.
STRIP = b" \t\n\x0b\x0c\r"
LAST = (1 << 63) - 1
#: Whether Spark takes the order of a bucket that is one file as it is, rather than sort it again.
STORED_ORDER = "spark.sql.legacy.bucketedTableScan.outputOrdering"


def line_key(line: bytes) -> bytes:
    return line.strip(STRIP).lower()  # bytes.lower() changes A-Z alone


def _long_enough(key: bytes, least: int) -> bool:
    return len(key) >= least and (len(key) >= 4 * least or len(key.decode("utf-8", "replace")) >= least)


def _digest(key: bytes) -> tuple[int, int]:
    d = hashlib.blake2b(key, digest_size=16).digest()
    return int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True)


def _keys(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small(batches, lambda b: b.column(1)):
            docs, k1, k2 = [], [], []
            for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                got = {line_key(x) for x in (text or "").encode().split(b"\n")}
                for a, c in {_digest(k) for k in got if _long_enough(k, least)}:
                    docs.append(doc)
                    k1.append(a)
                    k2.append(c)
            yield pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(k1, pa.int64()), pa.array(k2, pa.int64())], ["doc", "k1", "k2"])

    return run


def _rewrite(text_col: str, least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small(batches, lambda b: b.column(0).field(text_col)):
            kept, n, gone = [], [], []
            for text, drop in zip(b.column(0).field(text_col).to_pylist(), b.column(1).to_pylist(), strict=True):
                lines = (text or "").encode().split(b"\n")
                stay = lines
                if drop:
                    drop = {(d["k1"], d["k2"]) for d in drop}
                    stay = [x for x in lines if not (_long_enough(k := line_key(x), least) and _digest(k) in drop)]
                kept.append(b"\n".join(stay).decode())
                n.append(len(lines))
                gone.append(len(lines) - len(stay))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(kept, pa.string()), pa.array(n, pa.int64()), pa.array(gone, pa.int64())], ["row", "kept_text", "n_lines", "n_dropped"])

    return run


class LineRuns:
    """Levelled runs of line keys with the document that owns each, in a folder that outlives the session.

    A run is a table bucketed and sorted by key. A batch becomes such a table too and is then merged with older runs
    as they lie. Runs hold different keys; ``fan_in`` runs of a level are merged into one of the next. A manifest beside
    them, replaced in one step, names the runs that count; what a lost job leaves behind isn't among them.
    """

    SCHEMA = "k1 BIGINT, k2 BIGINT, owner BIGINT"

    def __init__(self, spark: SparkSession, path: str, buckets: int | None = None, fan_in: int = 2):
        self.spark, self.path, self.fan_in, self.files = spark, path, fan_in, Files(spark, path)
        known = json.loads(self.files.read(f"{path}/manifest.json") or "{}")
        self.buckets = known.get("buckets") or buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.runs: list[tuple[int, str]] = [tuple(r) for r in known.get("runs", [])]  # level and folder
        self._names: dict[str, str] = {}

    def _table(self, folder: str) -> DataFrame:
        if folder not in self._names:
            name = f"line_run_{uuid.uuid4().hex}"
            self.spark.sql(f"CREATE TABLE {name} ({self.SCHEMA}) USING parquet CLUSTERED BY (k1, k2) SORTED BY (k1, k2) INTO {self.buckets} BUCKETS LOCATION '{self.path}/{folder}'")
            self._names[folder] = name
        return self.spark.table(self._names[folder])

    def _write(self, df: DataFrame) -> str:
        folder = f"run-{uuid.uuid4().hex}"
        name = f"line_run_{uuid.uuid4().hex}"
        df.write.format("parquet").option("compression", "zstd").bucketBy(self.buckets, "k1", "k2").sortBy("k1", "k2").option("path", f"{self.path}/{folder}").saveAsTable(name)
        self._names[folder] = name
        return folder

    def _forget(self, folder: str) -> None:
        if name := self._names.pop(folder, None):
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")

    def sort_batch(self, keys: DataFrame) -> str:
        """Write rows (doc, k1, k2) as a sorted run of their own, each key with its smallest document; its folder.

        Keys are reduced before they are shuffled: Spark would move an anti-join below the aggregation, so the batch
        is written before it is joined.
        """
        new = keys.groupBy("k1", "k2").agg(F.min("doc").alias("owner"))
        if int(self.spark.conf.get("spark.sql.shuffle.partitions")) != self.buckets:
            new = new.repartition(self.buckets, "k1", "k2")
        return self._write(new)

    def new_keys(self, batch: str) -> DataFrame:
        """Of a sorted batch, the keys that no run has: bucket by bucket the batch is merged with each run.

        Batch and runs lie in the same buckets in the same order, so nothing is shuffled, sorted or broadcast,
        whatever the session's settings are.
        """
        new = self._table(batch)
        for _, folder in self.runs:
            new = new.join(self._table(folder).select("k1", "k2").hint("merge"), ["k1", "k2"], "left_anti")
        return new

    @contextmanager
    def as_stored(self) -> Iterator[None]:
        """Tables are read in the order they were written in while a batch is joined; the setting is put back after it.

        Each bucket of a run is one file: a task that writes a bucket holds all of it. Where a bucket is more than one
        file after all, Spark sorts it.
        """
        before = self.spark.conf.get(STORED_ORDER)
        self.spark.conf.set(STORED_ORDER, "true")
        try:
            yield
        finally:
            self.spark.conf.set(STORED_ORDER, before)

    def add(self, keys: DataFrame) -> None:
        """Add a batch's keys as a run, then merge runs where a level is full."""
        gone = []
        with self.as_stored():
            batch = self.sort_batch(keys)
            if self.runs:
                gone.append((0, batch))
                batch = self._write(self.new_keys(batch))
        self.runs.append((0, batch))
        while len(same := [r for r in self.runs if r[0] == self.runs[-1][0]]) >= self.fan_in:
            merged = self._table(same[0][1])
            for _, folder in same[1:]:
                merged = merged.unionByName(self._table(folder))
            gone += same
            self.runs = [r for r in self.runs if r not in same] + [(same[0][0] + 1, self._write(merged.repartition(self.buckets, "k1", "k2")))]
        self.files.write(f"{self.path}/manifest.json", json.dumps({"buckets": self.buckets, "runs": self.runs}))
        for _, folder in gone:
            self._forget(folder)
            self.files.delete(f"{self.path}/{folder}")

    def drops(self, keys: DataFrame) -> DataFrame:
        """(doc, drop): the keys of each document that another one owns.

        Here runs are read as plain files, so that both sides are shuffled and Spark can split a line that most
        documents hold.
        """
        found = None
        for _, folder in self.runs:
            part = keys.join(self.spark.read.schema(self.SCHEMA).parquet(f"{self.path}/{folder}"), ["k1", "k2"]).where("owner <> doc").select("doc", "k1", "k2")
            found = part if found is None else found.unionByName(part)
        return found.groupBy("doc").agg(F.collect_list(F.struct("k1", "k2")).alias("drop"))

    def add_batch(self, docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 10) -> DataFrame:
        """Deduplicate a batch against all before it, and remember its lines; the result of ``line_dedup``.

        Lines that an earlier batch holds go, whatever the ids are; within the batch the smallest id keeps them.
        """
        ready(self.spark)
        scratch = Scratch(self.spark, "line-batch")
        keys = scratch.save(_slim(docs, id_col, text_col).mapInArrow(_keys(min_chars), "doc long, k1 long, k2 long"))
        self.add(keys)
        drops = scratch.save(self.drops(keys))
        scratch.drop(keys)
        return _rewritten(docs, drops, id_col, text_col, min_chars)

    def close(self) -> None:
        """Take the runs' names out of the catalog; their files stay."""
        for folder in list(self._names):
            self._forget(folder)


def _order(id_col: str):
    return F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(LAST))


def _slim(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(_order(id_col).alias("doc"), F.col(f"`{text_col}`").alias("text"))


def _rewritten(docs: DataFrame, drops: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    rows = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"), _order(id_col).alias("doc"))
    joined = rows.join(drops, "doc", "left").select("row", "drop")
    return joined.mapInArrow(_rewrite(text_col, min_chars), with_row(docs, kept_text="string", n_lines="long", n_dropped="long"))


def line_dedup(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 10, batches: int = 4, fan_in: int = 2) -> DataFrame:
    """Drop lines that an earlier document holds; returns ``(row, kept_text, n_lines, n_dropped)``.

    ``row`` is a struct of the input row, whatever its columns are called. A line's key is the line stripped of
    blanks at both ends with A-Z lower-cased; keys of at least ``min_chars`` code points stay only in the
    smallest id that holds them, with all their repeats there.

    Ids come in ``batches`` ascending ranges. Each batch is merge-anti-joined with the runs of the batches
    before it, and what is new becomes a run of its own, sorted by key; ``fan_in`` runs of a level are merged
    into one of the next. A run holds each key once with its owner, so hot lines don't grow. Runs that are to
    outlive the call are kept with ``LineRuns``.

    Null text: one empty line. Null ids: together they count as one document that comes last. Rows that share an
    id count as one document and all keep what it owns. Empty input: empty output.
    """
    spark = docs.sparkSession
    ready(spark)
    scratch = Scratch(spark, "line-dedup")
    slim = _slim(docs, id_col, text_col)
    cuts = sorted(set(slim.approxQuantile("doc", [i / batches for i in range(1, batches)], 0.01))) if batches > 1 else []
    part = sum((F.when(F.col("doc") > int(c), 1).otherwise(0) for c in cuts), F.lit(0))
    keys = scratch.save(slim.mapInArrow(_keys(min_chars), "doc long, k1 long, k2 long").withColumn("batch", part), "batch")
    runs = LineRuns(spark, f"{scratch.base}/runs", fan_in=fan_in)
    try:
        for i in range(len(cuts) + 1):
            runs.add(keys.where(F.col("batch") == i).select("doc", "k1", "k2"))
        drops = scratch.save(runs.drops(keys.select("doc", "k1", "k2")))
    finally:
        runs.close()
        runs.files.delete(runs.path)
    scratch.drop(keys)
    return _rewritten(docs, drops, id_col, text_col, min_chars)
