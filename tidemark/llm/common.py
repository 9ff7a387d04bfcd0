"""Helpers that the corpus operators share: scratch tables, graph components, safe names."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_own_dir: dict[str, str] = {}
_shipped: set[str] = set()
_bases: dict[str, list[str]] = {}


def work_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, from spark.checkpoint.dir.

    Where the setting is missing, a local session gets a temporary folder; a cluster has none that is shared.
    """
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.conf.get(
        "spark.checkpoint.dir", None
    )
    if base:
        return base
    app, master = spark.sparkContext.applicationId, spark.sparkContext.master
    if app not in _own_dir:
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        _own_dir[app] = _temporary()
    return _own_dir[app]


def _temporary() -> str:
    """A folder of the driver that goes when the program ends."""
    path = tempfile.mkdtemp(prefix="tidemark-")
    atexit.register(shutil.rmtree, path, ignore_errors=True)
    return path


class Scratch:
    """Tables written to the shared folder, to cut lineage so that lost executors cost no recomputation."""

    def __init__(self, spark: SparkSession, tag: str):
        self.spark = spark
        self.base = f"{work_dir(spark)}/{tag}-{uuid.uuid4().hex}"
        bases = _bases.setdefault(spark.sparkContext.applicationId, [])
        if not bases:
            atexit.register(_clear_at_exit, bases, _file_system(spark, self.base), spark.sparkContext._jvm)
        bases.append(self.base)
        self._n = 0
        self._paths: dict[int, tuple[str, DataFrame]] = {}

    def save(self, df: DataFrame, partition_by: str | None = None) -> DataFrame:
        self._n += 1
        path = f"{self.base}/t{self._n}"
        writer = df.write.option("compression", "zstd")
        if partition_by:
            writer = writer.partitionBy(partition_by)
        writer.parquet(path)
        back = self.spark.read.schema(df.schema).parquet(path)
        self._paths[id(back)] = (path, back)
        return back

    def drop(self, *tables: DataFrame) -> None:
        """Delete tables that nothing reads any more."""
        for df in tables:
            path, _ = self._paths.pop(id(df), (None, None))
            if path:
                _delete(self.spark, path)


def _file_system(spark: SparkSession, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _delete(spark: SparkSession, path: str) -> None:
    _file_system(spark, path).delete(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path), True)


def _clear_at_exit(bases: list[str], fs, jvm) -> None:
    """What a program leaves goes with it, as far as its file system still answers."""
    for base in bases:
        try:
            fs.delete(jvm.org.apache.hadoop.fs.Path(base), True)
        except Exception:  # noqa: BLE001  the JVM may be gone before
            return


def clear_scratch(spark: SparkSession, keep: set[str] = frozenset()) -> None:
    """Delete the tables that this session's operators have written, once their results are written or no more wanted."""
    bases = _bases.get(spark.sparkContext.applicationId, [])
    for base in [b for b in bases if b not in keep]:
        _delete(spark, base)
        bases.remove(base)


@contextmanager
def cleared(spark: SparkSession) -> Iterator[None]:
    """Delete what operators write inside, for results that are saved inside too."""
    before = set(_bases.get(spark.sparkContext.applicationId, []))
    yield
    clear_scratch(spark, keep=before)


def first_by_hash(df: DataFrame, key: str, n: int, seed: str) -> DataFrame:
    """The ``n`` rows of the smallest hash of ``key``, all if there are no more.

    Only rows whose hash is below a bound that a fifth more than ``n`` are expected under come together in one task.
    """
    turn = F.xxhash64(key, F.lit(seed))
    if (many := df.count()) > 2 * n:
        df = df.where(turn <= int(-(1 << 63) + (1 << 64) * min(1.0, (1.2 * n + 100) / many)))
    return df.orderBy(turn, key).limit(n)


def carried(docs: DataFrame, text_col: str, keep: list[str] | None) -> DataFrame:
    """The columns to keep (None: all) as a struct ``row``, and the text beside them unless it is among them."""
    names = docs.columns if keep is None else keep
    row = F.struct(*[docs[f"`{c}`"] for c in names]).alias("row")
    return docs.select(row) if text_col in names else docs.select(row, docs[f"`{text_col}`"].alias("text"))


def carried_text(b: pa.RecordBatch, text_col: str) -> pa.Array:
    """The texts of a batch of ``carried`` rows."""
    return b.column(1) if b.num_columns > 1 else b.column(0).field(text_col)


def with_row(docs: DataFrame, keep: list[str] | None = None, **columns: str) -> T.StructType:
    """A schema of the kept part of the input row, whatever its columns are called, and further columns."""
    fields = docs.schema.fields if keep is None else [docs.schema[c] for c in keep]
    out = T.StructType([T.StructField("row", T.StructType(fields))])
    for name, kind in columns.items():
        out = out.add(name, kind)
    return out


def ready(spark: SparkSession) -> None:
    """Ready for Python in tasks: the package on the workers' path. Settings stay as they are."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        package = Path(__file__).resolve().parents[1]
        context.addPyFile(shutil.make_archive(f"{_temporary()}/{package.name}", "zip", package.parent, package.name))
        _shipped.add(context.applicationId)


def small(batches: Iterator[pa.RecordBatch], text: Callable[[pa.RecordBatch], pa.Array], most: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """Batches of about ``most`` bytes of text, whatever the session's bounds are; a longer text is a batch of its own."""
    for b in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(text(b)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
        lo = 0
        while lo < b.num_rows:
            hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + most, "right")))
            yield b.slice(lo, hi - lo)
            lo = hi


def spanning(batches: Iterator[pa.RecordBatch], most: int = 200_000) -> Iterator[pa.RecordBatch]:
    """Of the edges of a task, those that a forest needs; what it has seen is forgotten after ``most`` kept edges."""
    up: dict[int, int] = {}
    kept: list[tuple[int, int]] = []

    def root(x: int) -> int:
        while (y := up.setdefault(x, x)) != x:
            up[x] = x = up[y] if y in up else y
        return x

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([e[j] for e in kept], pa.int64()) for j in (0, 1)], ["a", "b"])

    for b in batches:
        for x, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            if (p := root(x)) != (q := root(y)):
                up[max(p, q)] = min(p, q)
                kept.append((x, y))
        if len(kept) >= most:
            yield out()
            up, kept = {}, []
    yield out()


def components(scratch: Scratch, edges: DataFrame) -> DataFrame:
    """Connected components of ``edges(a, b)``: a table ``(node, comp)``, comp the smallest node reachable.

    Each round replaces every node's label by the smallest label among itself and its neighbours, then jumps
    once along the labels, so the rounds grow with the logarithm of the longest path. Labels and edges stay
    distributed; each round is written to the shared folder.
    """
    both = scratch.save(
        edges.select(F.col("a").alias("s"), F.col("b").alias("d"))
        .union(edges.select(F.col("b").alias("s"), F.col("a").alias("d")))
        .where("s <> d")
        .distinct()
    )
    labels = scratch.save(
        both.groupBy("s").agg(F.min("d").alias("m")).select(F.col("s").alias("node"), F.least("s", "m").alias("comp"))
    )
    while True:
        near = (
            both.join(labels.select(F.col("node").alias("d"), "comp"), "d")
            .groupBy("s")
            .agg(F.min("comp").alias("m"))
        )
        step = scratch.save(
            labels.join(near, labels.node == near.s)
            .select("node", F.col("comp").alias("was"), F.least("comp", "m").alias("comp"))
        )
        up = step.select(F.col("node").alias("comp"), F.col("comp").alias("up"))
        jumped = scratch.save(step.join(up, "comp", "left").select("node", "was", F.coalesce("up", "comp").alias("comp")))
        changed = jumped.where("comp <> was").limit(1).count()
        scratch.drop(step, labels)
        labels = jumped
        if not changed:
            break
    scratch.drop(both)
    return labels.select("node", "comp")
