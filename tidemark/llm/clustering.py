"""Centroid clustering by kd-tree filtering, in whole numbers.

The vectors of a partition are put into kd-trees once, whose nodes hold counts, sums and boxes. In a round each tree is
walked from its root with all centroids as candidates: those that another one beats everywhere in a node's box are
dropped, a node with one candidate left is assigned as a whole, and leaves are resolved vector by vector.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, ready
from .vectors import matrix, state_batch, tree_reduced, whole

#: Up to here doubles hold all that is computed for up to 1,024 components exactly; beyond, Python's own integers do.
EXACT = 1 << 19


def _floors(x: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale x): doubles where they and what is computed of them are exact, else Python's integers."""
    y = np.floor(scale * x)
    if not len(y) or np.abs(y).max() <= EXACT:
        return y
    big = [[int(v) if abs(v) < 1e300 and np.isfinite(v) else _floor(c, scale) for v, c in zip(r, s, strict=True)] for r, s in zip(y, x, strict=True)]
    out = np.empty(y.shape, object)
    out[:] = big
    return out


def _floor(c: float, scale: int) -> int:
    n, d = float(c).as_integer_ratio()
    return scale * n // d


@dataclass
class Tree:
    """A kd-tree over some vectors: ``points`` in leaf order, ``order`` their places before, and arrays by node."""

    points: np.ndarray
    order: np.ndarray
    start: list[int]
    end: list[int]
    left: list[int]  # the right child is the next one; 0: a leaf
    low: np.ndarray
    high: np.ndarray
    sums: np.ndarray

    @classmethod
    def grow(cls, points: np.ndarray, leaf: int = 64) -> Tree:
        """Halve the longest side's vectors until ``leaf`` are left or all are alike."""
        order = np.arange(len(points))
        start, end, left, low, high, sums = [0], [len(points)], [], [], [], []
        at = 0
        while at < len(start):
            s, e = start[at], end[at]
            some = points[order[s:e]]
            lo, hi = some.min(0), some.max(0)
            low.append(lo)
            high.append(hi)
            sums.append(some.sum(0))
            if e - s > leaf and (hi > lo).any():
                turn = np.argsort(some[:, int((hi - lo).argmax())], kind="stable")
                order[s:e] = order[s:e][turn]
                mid = (s + e) // 2
                left.append(len(start))
                start += [s, mid]
                end += [mid, e]
            else:
                left.append(0)
            at += 1
        return cls(points[order], order, start, end, left, np.array(low), np.array(high), np.array(sums))

    def exact(self, centres: np.ndarray) -> Tree:
        """The same with integers of the kind that the centres are of."""
        kind = object if centres.dtype == object or self.points.dtype == object else np.float64
        if self.points.dtype == kind:
            return self
        turn = (lambda a: a.astype(np.int64).astype(object)) if kind is object else (lambda a: a.astype(kind))
        return Tree(turn(self.points), self.order, self.start, self.end, self.left, turn(self.low), turn(self.high), turn(self.sums))

    def walk(self, centres: np.ndarray) -> Iterator[tuple[int, int, int, int, np.ndarray | None]]:
        """(node, first, last, centre or -1, the vectors' centres or None) for parts that cover all vectors once."""
        square = (centres * centres).sum(1)
        todo = [(0, np.arange(len(centres)))]
        while todo:
            node, among = todo.pop()
            lo, hi = self.low[node], self.high[node]
            if len(among) > 1:
                c = centres[among]
                to_middle = 2 * c - (lo + hi)
                best = c[int((to_middle * to_middle).sum(1).argmin())]
                w = c - best
                # How much farther each is than the best one at the box's corner that favours it.
                margin = (w * (c + best)).sum(1) - 2 * np.maximum(w * lo, w * hi).sum(1)
                among = among[margin <= 0]
            s, e = self.start[node], self.end[node]
            if len(among) == 1:
                yield node, s, e, int(among[0]), None
            elif not self.left[node]:
                p = self.points[s:e]
                # The vector's own square is the same for all of them.
                yield node, s, e, -1, among[(square[among] - 2 * (p @ centres[among].T)).argmin(1)]
            else:
                todo += [(self.left[node], among), (self.left[node] + 1, among)]


@dataclass
class Sums:
    """Counts and sums of vectors by centre, as Python's integers."""

    counts: np.ndarray
    sums: np.ndarray

    def merge(self, other: Sums) -> Sums:
        return Sums(self.counts + other.counts, self.sums + other.sums)


def _merge(a: Sums, b: Sums) -> Sums:
    return a.merge(b)


def _whole_numbers(a: np.ndarray) -> np.ndarray:
    return a if a.dtype == object else a.astype(np.int64).astype(object)


def gathered(tree: Tree, centres: np.ndarray) -> Sums:
    tree = tree.exact(centres)
    k, dim = centres.shape
    counts, sums = np.zeros(k, np.int64), np.zeros((k, dim), tree.points.dtype)
    for node, s, e, one, each in tree.walk(centres):
        if each is None:
            counts[one] += e - s
            sums[one] += tree.sums[node]
        else:
            for c in np.unique(each):
                mine = each == c
                counts[c] += int(mine.sum())
                sums[c] += tree.points[s:e][mine].sum(0)
    return Sums(counts.astype(object), _whole_numbers(sums))


def assigned(tree: Tree, centres: np.ndarray) -> tuple[np.ndarray, list[int | None]]:
    """Each vector's centre and its squared distance (None where a long doesn't hold it), in the order they came."""
    tree = tree.exact(centres)
    of = np.zeros(len(tree.points), np.int32)
    for _, s, e, one, each in tree.walk(centres):
        of[s:e] = one if each is None else each
    far = tree.points - centres[of]
    far = _whole_numbers((far * far).sum(1))
    back = np.empty(len(of), np.int64)
    back[tree.order] = np.arange(len(of))
    return of[back], [v if v < 1 << 63 else None for v in far[back].tolist()]


def _packed(tree: Tree) -> bytes:
    """Vectors and boxes in the fewest bytes a number that hold them."""
    if tree.points.dtype != object:
        small = next(t for t in (np.int16, np.int32) if np.abs(tree.points).max() <= np.iinfo(t).max)
        tree = Tree(tree.points.astype(small), tree.order.astype(np.int32), tree.start, tree.end, tree.left, tree.low.astype(small), tree.high.astype(small), tree.sums.astype(np.int64))
    return pickle.dumps(tree)


def _trees(dim: int, scale: int, most: int, leaf: int):
    """A partition's kd-trees, of at most ``most`` vectors each, so that a task's memory has a bound."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list[int | None] = []
        held: list[np.ndarray] = []

        def tree() -> pa.RecordBatch:
            points = np.concatenate(held)
            out = pa.RecordBatch.from_arrays([pa.array([list(ids)], pa.list_(pa.int64())), pa.array([_packed(Tree.grow(points, leaf))], pa.binary())], ["ids", "tree"])
            ids.clear()
            held.clear()
            return out

        for b in batches:
            for lo in range(0, b.num_rows, most):
                part = b.slice(lo, most)
                at, x = matrix(part.column(1), dim)
                if len(at):
                    ids += part.column(0).take(pa.array(at, pa.int64())).to_pylist()
                    held.append(_floors(x, scale))
                if len(ids) >= most:
                    yield tree()
        if ids:
            yield tree()

    return run


def _round(centres: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = None
        for b in batches:
            for data in b.column(0):
                got = gathered(pickle.loads(data.as_py()), centres)
                state = got if state is None else state.merge(got)
        if state is not None:
            yield state_batch(state)

    return run


def _last(centres: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for ids, data in zip(b.column(0), b.column(1), strict=True):
                of, far = assigned(pickle.loads(data.as_py()), centres)
                yield pa.RecordBatch.from_arrays([pa.array(ids.as_py(), pa.int64()), pa.array(of, pa.int32()), pa.array(far, pa.int64())], ["vec_id", "cluster", "distance"])

    return run


def _of_one_kind(centres: list[list[int]]) -> np.ndarray:
    out = np.array(centres, object)
    return out if max(abs(v) for c in centres for v in c) > EXACT else out.astype(np.float64)


def seeds(spark: SparkSession, rows: DataFrame, k: int, seed: str, scale: int) -> list[list[int]]:
    """The k vectors of the smallest SHA-256 of ``seed`` and id, in its order; ties go by components, null ids come last."""
    turn = F.sha2(F.concat(F.lit(seed), F.col("id").cast("string")), 256)
    first = rows.select(turn.alias("h"), "v").orderBy(F.asc_nulls_last("h"), "v").limit(k).collect()
    return [[_floor(c, scale) for c in r["v"]] for r in first]


def cluster(
    vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", dim: int = 64, k: int = 40, rounds: int = 5, scale: int = 256, seed: str = "2:", tree_rows: int = 8192, leaf: int = 64
) -> DataFrame:
    """Lloyd's rounds in whole numbers: ``(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256)``.

    Vectors with exactly ``dim`` components, none null or non-finite, take part, a component x as floor(scale x).
    The ``k`` seeds are those of the smallest hash of ``seed`` and id. A round assigns every vector to the nearest
    centroid (ties: the smaller number) and replaces every centroid that has vectors by floor(sum / count).

    The trees are written to the shared folder once; a round reads them and sends one state of k times ``dim`` numbers
    to the driver, whatever the number of vectors.

    Other vectors have no row. Null or repeated ids, repeated vectors: each row counts; null ids are seeds last. With
    fewer vectors than ``k`` all are seeds. Distances and sums that a long doesn't hold are null. Empty: empty.
    """
    spark = vectors.sparkSession
    ready(spark)
    scratch = Scratch(spark, "cluster")
    rows = vectors.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{vector_col}`").cast("array<double>").alias("v"))
    rows = rows.where((F.size("v") == dim) & whole(F.col("v")))
    centres = seeds(spark, rows, k, seed, scale)
    if not centres:
        return spark.createDataFrame([], "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
    trees = scratch.save(rows.mapInArrow(_trees(dim, scale, tree_rows, leaf), "ids array<long>, tree binary"))
    for _ in range(rounds):
        got = tree_reduced(trees.select("tree").mapInArrow(_round(_of_one_kind(centres)), "state binary"), _merge)
        centres = [[s // n for s in sums] if n else old for old, n, sums in zip(centres, got.counts.tolist(), got.sums.tolist(), strict=True)]
    found = scratch.save(trees.mapInArrow(_last(_of_one_kind(centres)), "vec_id long, cluster int, distance long"))
    scratch.drop(trees)
    total = F.when(F.count("distance") == F.count(F.lit(1)), F.sum(F.col("distance").cast("decimal(38,0)")))
    by = {r["cluster"]: r["total"] for r in found.groupBy("cluster").agg(total.alias("total")).collect()}  # at most k rows
    long = lambda x: F.lit(int(x) if x is not None and x < 1 << 63 else None).cast("long")
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    every = None if None in by.values() else sum(map(int, by.values()))
    at = F.col("cluster") + 1
    return found.select(
        "vec_id", "cluster", "distance", F.element_at(F.array(*[long(by.get(c, 0)) for c in range(len(centres))]), at).alias("cluster_inertia"), long(every).alias("inertia"),
        F.element_at(F.array(*map(F.lit, sha)), at).alias("centroid_sha256"),
    )
