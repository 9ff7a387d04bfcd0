"""Embedding near-dedup by lattice hashing: projections decoded to E8 points in several tables, neighbouring cells
probed, cosines verified in double precision."""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, ready, components
from .textbytes import mix
from .vectors import whole

_U = np.uint64


def _shortest() -> np.ndarray:
    """The 240 shortest vectors of E8."""
    out = []
    for i, j in itertools.combinations(range(8), 2):
        for a, b in itertools.product((1, -1), repeat=2):
            v = np.zeros(8)
            v[i], v[j] = a, b
            out.append(v)
    return np.array(out + [np.array(s) for s in itertools.product((0.5, -0.5), repeat=8) if sum(x < 0 for x in s) % 2 == 0])


SHORTEST = _shortest()


def _nearest_d8(x: np.ndarray) -> np.ndarray:
    r = np.rint(x)
    d = x - r
    odd = np.flatnonzero(r.sum(1) % 2 != 0)
    j = np.abs(d[odd]).argmax(1)
    r[odd, j] += np.where(d[odd, j] >= 0, 1, -1)
    return r


def nearest_e8(x: np.ndarray) -> np.ndarray:
    """The nearest point of E8, which is D8 and D8 shifted by a half."""
    a, b = _nearest_d8(x), _nearest_d8(x - 0.5) + 0.5
    return np.where((((x - a) ** 2).sum(1) <= ((x - b) ** 2).sum(1))[:, None], a, b)


def _key(points: np.ndarray, salt: int) -> np.ndarray:
    h = np.full(len(points), _U(salt * 2654435761 + 1))
    for c in (points * 2).astype(np.int64).view(_U).T:
        h = mix(h * _U(0xD6E8FEB86659FD93) + c)
    return h


def _joined(keys: list[np.ndarray]) -> np.ndarray:
    h = keys[0]
    for k in keys[1:]:
        h = mix(h ^ (k << _U(1)))
    return h


class Lattice:
    """Tables of some E8 blocks each over random orthogonal projections; a cell is a point of all of a table's blocks."""

    def __init__(self, dim: int, tables: int, width: float, probes: int, blocks: int = 2, seed: int = 8):
        rng = np.random.default_rng([seed, dim])
        self.probes, self.tables = probes, []
        for _ in range(tables):
            block = [np.linalg.qr(rng.normal(size=(max(dim, 8), 8)))[0][:dim] * np.sqrt(max(dim, 8) / 8) / width for _ in range(blocks)]
            self.tables.append([(p, rng.random(8) * 2) for p in block])
        self.planes = rng.normal(size=(dim, 128))

    def cells(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each vector's own cell of each table, and the cells next to it: one block's point moved at a time."""
        own, near = [], []
        for t, blocks in enumerate(self.tables):
            keys, moved = [], []
            for j, (p, shift) in enumerate(blocks):
                y = x @ p + shift
                q = nearest_e8(y)
                salt = len(blocks) * t + j
                keys.append(_key(q, salt))
                top = np.argsort(-(y - q) @ SHORTEST.T, axis=1, kind="stable")[:, : self.probes]
                moved.append([_key(q + SHORTEST[top[:, k]], salt) for k in range(self.probes)])
            own.append(_joined(keys))
            near += [_joined([*keys[:j], m, *keys[j + 1 :]]) for j, ms in enumerate(moved) for m in ms]
        return np.stack(own, 1), np.stack(near, 1)

    def sketch(self, x: np.ndarray) -> np.ndarray:
        """128 signs of projections, as two numbers."""
        return np.packbits(x @ self.planes > 0, axis=1).view(np.int64)


def _lists(col: np.ndarray) -> pa.ListArray:
    n, k = col.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * k), pa.array(np.ascontiguousarray(col).reshape(-1)))


def _unit(v) -> np.ndarray | None:
    """The vector at length 1, or None where it links with nothing."""
    if v is None or not len(v) or any(x is None for x in v):
        return None
    x = np.asarray(v, np.float64)
    if not np.isfinite(x).all() or not x.any():
        return None
    x = x / np.abs(x).max()  # so that no square overflows or vanishes
    return x / np.linalg.norm(x)


def _encode(tables: int, width: float, probes: int, blocks: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: dict[int, Lattice] = {}
        for b in batches:
            ids = b.column(0).to_pylist()
            units = [_unit(v) for v in b.column(1).to_pylist()]
            by_dim: dict[int, list[int]] = {}
            for i, u in enumerate(units):
                if u is not None and ids[i] is not None:
                    by_dim.setdefault(len(u), []).append(i)
            for dim, at in by_dim.items():
                lat = made.setdefault(dim, Lattice(dim, tables, width, probes, blocks))
                x = np.stack([units[i] for i in at])
                own, near = lat.cells(x)
                s = lat.sketch(x)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([ids[i] for i in at], pa.int64()), _lists(x), _lists(own.view(np.int64)), _lists(near.view(np.int64)), pa.array(s[:, 0]), pa.array(s[:, 1])],
                    ["id", "v", "own", "near", "s1", "s2"],
                )

    return run


def _dot(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cosines of the pairs of vectors in the last two columns, which it leaves out."""
    for b in batches:
        k = b.num_columns - 2
        if b.num_rows:
            cos = np.array([float(np.dot(x, y)) if len(x) == len(y) else -2.0 for x, y in zip(b.column(k).to_numpy(zero_copy_only=False), b.column(k + 1).to_numpy(zero_copy_only=False), strict=True)])
            yield pa.RecordBatch.from_arrays([*b.columns[:k], pa.array(cos)], [*b.schema.names[:k], "cos"])


def _block_hits(least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, j, ia, va, ib, vb in zip(*(c.to_pylist() for c in b.columns), strict=True):
                hit = np.array(va) @ np.array(vb).T >= least
                ids, n = np.concatenate([ia, ib]), np.concatenate([hit.sum(1), hit.sum(0)])
                use = n > 0
                m = int(use.sum())
                yield pa.RecordBatch.from_arrays([pa.array(np.full(m, i)), pa.array(np.full(m, j)), pa.array(ids[use].astype(np.int64)), pa.array(n[use].astype(np.int64))], ["i", "j", "id", "hits"])

    return run


def _items(scratch: Scratch, rows: DataFrame, theta: float, tables: int, width: float, probes: int, blocks: int) -> tuple[DataFrame, ...]:
    """Vectors with their cells, the core that each belongs to, cores and single vectors, and their own and near cells."""
    base = scratch.save(rows.mapInArrow(_encode(tables, width, probes, blocks), "id long, v array<double>, own array<long>, near array<long>, s1 long, s2 long"))
    first = base.select(F.col("own")[0].alias("cell"), "id", "v")
    heads = scratch.save(first.groupBy("cell").agg(F.min("id").alias("head"), F.count(F.lit(1)).alias("m")).where("m > 1").select("cell", "head"))
    centres = scratch.save(heads.join(base.select(F.col("id").alias("head"), F.col("v").alias("centre")), "head"))
    turned = first.join(centres, "cell").select("id", "head", "v", "centre").mapInArrow(_dot, "id long, head long, cos double")
    core = scratch.save(
        turned.withColumn("angle", F.when(F.col("id") == F.col("head"), 0.0).otherwise(F.acos(F.least("cos", F.lit(1.0))))).where(F.col("angle") <= theta / 2 - 1e-6).select("id", "head", "angle")
    )
    member = scratch.save(base.select("id").join(core, "id", "left").select("id", F.coalesce("head", "id").alias("item"), F.coalesce("angle", F.lit(0.0)).alias("angle")))
    scratch.drop(heads, centres, core)
    items = scratch.save(member.groupBy("item").agg(F.count(F.lit(1)).alias("size"), F.max("angle").alias("radius")))
    of = base.join(member.select("id", "item"), "id")
    own = scratch.save(of.select("item", F.explode("own").alias("cell")).distinct())
    near = scratch.save(of.select("item", F.explode(F.concat("own", "near")).alias("cell")).distinct())
    return base, member, items, own, near


def _keyed(rows: DataFrame) -> DataFrame:
    """(vec, id, v): each id and vector once, under a key of its own. The first vector of an id, by its hash, has the id
    as its key, others a hash of both; vectors that can't link have none, and are there for their rows alone."""
    counts = whole(F.col("v")) & F.coalesce(F.exists("v", lambda x: x != 0), F.lit(False)) & F.col("id").isNotNull()
    order = Window.partitionBy("id").orderBy("h")
    good = rows.where(counts).withColumn("h", F.xxhash64("v")).withColumns({"_rank": F.row_number().over(order), "_before": F.lag("h").over(order)})
    good = good.where(F.col("_before").isNull() | (F.col("_before") != F.col("h")))
    good = good.select(F.col("id").alias("vec"), F.when(F.col("_rank") == 1, F.col("id")).otherwise(F.xxhash64("id", "h", F.lit("twin"))).alias("id"), "v")
    odd = rows.where(~counts).select(F.col("id").alias("vec"), F.when(F.col("id").isNotNull(), F.xxhash64("v")).alias("h")).distinct()
    none = F.lit(None)
    return good.unionByName(odd.select("vec", none.cast("long").alias("id"), none.cast("array<double>").alias("v")))


def near_vectors(vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", least: float = 0.9, tables: int = 16, width: float = 0.65, probes: int = 4, most_met: int = 20_000, block: int = 256) -> DataFrame:
    """Groups of vectors with a cosine of ``least`` or more to another: ``(vec_id, n_links, component_id, kept)``.

    Vectors of a cell within half the threshold's angle of its smallest id are one core: all of them are linked
    with each other, so their links are counted, not listed. Cores and single vectors are the items that the
    tables pair: an item is found where any of its vectors' own cells is an own or neighbouring cell of another's.
    Pairs of items that are surely linked or surely not, by the angles to the cores' centres, are settled at once;
    the members of the others are compared in blocks, as matrix products that give counts.

    Cells get fuller as a table grows. Where an item would meet more than ``most_met`` others in its cells, cells are
    made of a third lattice block, and there are four times as many tables, which keeps the recall. Nothing is left
    out of a full cell.

    Vectors that are null, empty, zero or hold null or non-finite components link with nothing, nor do vectors of
    different lengths. Rows that share an id and a vector are one row. Different vectors under one id have a row and
    links each, count each other where they are near, and belong to one component, as they are one id. Rows with a null
    id give one row with a null component. Empty input: empty output.
    """
    spark = vectors.sparkSession
    ready(spark)
    scratch = Scratch(spark, "lattice")
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    rows = scratch.save(_keyed(rows))
    listed, rows = rows.select("vec", "id"), rows.where("id is not null").select("id", "v")
    theta = float(np.arccos(least))
    found = _items(scratch, rows, theta, tables, width, probes, 2)
    load = found[3].groupBy("cell").agg(F.count(F.lit(1)).alias("m")).agg((F.sum(F.col("m") * F.col("m")) / F.sum("m")).alias("load")).first()["load"] or 0.0
    if load * tables * (1 + 2 * probes) > most_met:
        scratch.drop(*found)
        found = _items(scratch, rows, theta, 4 * tables, width, probes, 3)
    base, member, items, own, near = found
    facts = scratch.save(items.join(base.select(F.col("id").alias("item"), "s1", "s2"), "item"))
    met = own.withColumnRenamed("item", "a").join(near.withColumnRenamed("item", "b"), "cell").where("a <> b")
    pairs = met.select(F.least("a", "b").alias("i"), F.greatest("a", "b").alias("j")).distinct()

    def named(df: DataFrame, x: str) -> DataFrame:
        return df.select(*[F.col(c).alias(f"{c}_{x}") if c != "item" else F.col(c).alias(x) for c in df.columns])

    # Single vectors whose signs differ too much can't be near: 6 standard deviations beyond what the angle lets expect.
    share = theta / np.pi
    far = int(128 * share + 6 * np.sqrt(128 * share * (1 - share)))
    apart = F.bit_count(F.col("s1_i").bitwiseXOR(F.col("s1_j"))) + F.bit_count(F.col("s2_i").bitwiseXOR(F.col("s2_j")))
    maybe = pairs.join(named(facts, "i"), "i").join(named(facts, "j"), "j").where((F.col("size_i") > 1) | (F.col("size_j") > 1) | (apart <= far))
    vecs = base.select(F.col("id").alias("item"), "v")
    keys = ["i", "j", "size_i", "size_j", "radius_i", "radius_j"]
    dots = (
        maybe.select(*keys).join(named(vecs, "i"), "i").join(named(vecs, "j"), "j").select(*keys, "v_i", "v_j")
        .mapInArrow(_dot, "i long, j long, size_i long, size_j long, radius_i double, radius_j double, cos double")
    )
    radii = F.col("radius_i") + F.col("radius_j")
    angle = F.acos(F.greatest(F.least("cos", F.lit(1.0)), F.lit(-1.0)))
    single = (F.col("size_i") == 1) & (F.col("size_j") == 1)
    kind = F.when(single, F.when(F.col("cos") >= least, "all").otherwise("none")).when(angle + radii <= theta - 1e-6, "all").when(angle - radii > theta + 1e-6, "none").otherwise("some")
    judged = scratch.save(dots.where("cos > -2").withColumn("kind", kind).where("kind <> 'none'").select("i", "j", "size_i", "size_j", "kind"))

    some = judged.where("kind = 'some'").select("i", "j")
    wanted = some.select(F.col("i").alias("item")).union(some.select(F.col("j").alias("item"))).distinct()
    ways = F.ceil(F.col("size") / block)
    cut = (
        member.join(items.select("item", "size"), "item").join(scratch.save(wanted), "item").join(base.select("id", "v"), "id")
        .withColumn("part", F.pmod(F.xxhash64("id"), ways)).groupBy("item", "part").agg(F.collect_list("id").alias("ids"), F.collect_list("v").alias("vs"))
    )
    cut = scratch.save(cut)
    ready(spark)
    hits = scratch.save(
        some.join(named(cut.drop("part"), "i"), "i").join(named(cut.drop("part"), "j"), "j").select("i", "j", "ids_i", "vs_i", "ids_j", "vs_j")
        .mapInArrow(_block_hits(least), "i long, j long, id long, hits long")
    )
    edges = judged.where("kind = 'all'").select(F.col("i").alias("a"), F.col("j").alias("b")).union(hits.select(F.col("i").alias("a"), F.col("j").alias("b"))).distinct()
    # The other vectors of an id are one with the first: these ids are few, unless a table has next to no others.
    twins = listed.where("id <> vec")
    several = bool(twins.limit(1).count())
    if several:
        item = lambda c, x: member.select(F.col("id").alias(c), F.col("item").alias(x))
        edges = edges.union(twins.join(item("id", "a"), "id").join(item("vec", "b"), "vec").select("a", "b")).distinct()
    comps = components(scratch, edges)

    sure = judged.where("kind = 'all'")
    more = sure.select(F.col("i").alias("item"), F.col("size_j").alias("n")).union(sure.select(F.col("j").alias("item"), F.col("size_i").alias("n"))).groupBy("item").agg(F.sum("n").alias("more"))
    known = scratch.save(
        items.join(more, "item", "left").join(comps.withColumnRenamed("node", "item"), "item", "left")
        .select("item", (F.col("size") - 1 + F.coalesce("more", F.lit(0))).alias("links"), F.coalesce("comp", "item").alias("comp"))
    )
    each = hits.groupBy("id").agg(F.sum("hits").alias("hits"))
    found = member.join(known, "item").select("id", "links", "comp").join(each, "id", "left")
    out = listed.join(found, "id", "left")
    if several:
        # A component's smallest key may be that of a second vector, which is no id.
        out = scratch.save(out)
        least = scratch.save(out.groupBy("comp").agg(F.min("vec").alias("least")))
        out = out.join(least, "comp", "left").withColumn("comp", F.col("least")).drop("least")
    comp = F.when(F.col("vec").isNotNull(), F.coalesce("comp", "vec"))
    return out.select(
        F.col("vec").alias("vec_id"), (F.coalesce("links", F.lit(0)) + F.coalesce("hits", F.lit(0))).cast("long").alias("n_links"),
        comp.alias("component_id"), F.coalesce(comp == F.col("vec"), F.lit(True)).alias("kept"),
    )
