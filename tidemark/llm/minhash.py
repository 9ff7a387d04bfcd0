"""MinHash near-dedup: fast similarity sketches, banding, exact verification on whole shingle sets."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, components, ready, spanning
from .textbytes import mix, shingles, words

_U = np.uint64
_GOLD = _U(0x9E3779B97F4A7C15)


def sketch(h: np.ndarray, doc: np.ndarray, n_docs: int, bins: int) -> np.ndarray:
    """Fast similarity sketch of each document's hashes, an array of n_docs x bins.

    In round i < bins every element goes to a hashed bin with value (i, hash); an element of round bins + j goes
    to bin j. Each bin keeps its smallest value. A document stops after the first round that leaves no bin of its
    empty, so large sets need one round and the last rounds fill every bin of the smallest.
    """
    out = np.full(n_docs * bins, np.iinfo(np.uint64).max, _U)
    live = np.bincount(doc, minlength=n_docs) > 0
    for i in range(2 * bins):
        use = live[doc]
        if not use.any():
            break
        if not use.all():
            h, doc = h[use], doc[use]
        x = mix(h ^ _U((i + 1) * int(_GOLD) % 2**64))
        at = doc * bins + ((x % _U(bins)).astype(np.int64) if i < bins else i - bins)
        # 8 bits of round above 56 bits of hash
        np.minimum.at(out, at, (_U(min(i, 254)) << _U(56)) | (mix(x + _GOLD) >> _U(8)))
        live &= (out.reshape(n_docs, bins) == np.iinfo(np.uint64).max).any(1)
    return out.reshape(n_docs, bins)


def _unique(h: np.ndarray, ptr: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes of each document, sorted, and their documents."""
    doc = np.repeat(np.arange(len(ptr) - 1), np.diff(ptr))
    order = np.lexsort((h, doc))
    h, doc = h[order], doc[order]
    keep = np.ones(len(h), bool)
    keep[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    return h[keep], doc[keep]


def _sketches(size: int, bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for w in words(b.column(1)):
                h, doc = _unique(*shingles(w, size))
                n = w.hi - w.lo
                count = np.bincount(doc, minlength=n)
                s1, s2 = np.zeros(n, _U), np.zeros(n, _U)
                np.add.at(s1, doc, mix(h))
                np.add.at(s2, doc, mix(h ^ _GOLD))
                sk = sketch(h, doc, n, bands * rows).reshape(n, bands, rows)
                key = np.full((n, bands), _GOLD) * (np.arange(bands, dtype=_U) + _U(1))
                for r in range(rows):
                    key = mix(key * _U(0xD6E8FEB86659FD93) + sk[:, :, r])
                full = pa.array(key.reshape(-1).view(np.int64))
                lists = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * bands), full)
                yield pa.RecordBatch.from_arrays([b.column(0).slice(w.lo, n), pa.array(count, pa.int64()), pa.array(s1.view(np.int64)), pa.array(s2.view(np.int64)), lists], ["doc_id", "n", "s1", "s2", "bands"])

    return run


def _sets(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for w in words(b.column(1)):
                h, doc = _unique(*shingles(w, size))
                ptr = np.searchsorted(doc, np.arange(w.hi - w.lo + 1)).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ptr), pa.array(h.view(np.int64)))
                yield pa.RecordBatch.from_arrays([b.column(0).slice(w.lo, w.hi - w.lo), lists], ["doc_id", "set"])

    return run


def _similar(both: Column, n: Column, differ: Column, percent: int) -> Column:
    """Whether sets of ``n`` elements together, of which ``differ`` stand in one alone but for twice ``both``, are similar enough."""
    # The overlap x is (n - differ) / 2 + both, and 100 * x >= percent * (n - x) is asked for.
    return (n - differ + 2 * both) * (100 + percent) >= 2 * percent * n


def _near_centres(left: DataFrame, groups: _Groups, sets: DataFrame, percent: int, scratch: Scratch) -> None:
    """Link what is left of rows (key, rep, n, comp), exactly: all pairs that share a key.

    Each key has a centre, its first document in one order for all keys, so a family of near copies has few. What a
    document's set and its centre's don't share is its difference, which tells at once whether the two are similar.
    Two documents a and b with differences A and B of one centre differ in |A| + |B| - 2 |A and B| elements; so
    unless both are linked with the centre, they are similar only if A and B overlap by a certain number, which is
    the more, the more both are changed. That is a set-similarity join of small sets: elements are ordered by how
    few of a centre's differences have them; a pair shares one of the first |A| - c + 1 of both, c being the least
    overlap that any partner asks for, and has room for enough after it. What one document alone has stands first,
    so documents with edits of their own meet nobody. Only documents of different components meet.
    """
    turn = F.xxhash64("rep", F.lit("centre"))
    centres = scratch.save(left.groupBy("key").agg(F.min(F.struct(turn.alias("turn"), "rep", "n")).alias("c")))
    near = left.join(centres, "key").where("rep <> c.rep").select("rep", "n", F.col("c.rep").alias("centre"), F.col("c.n").alias("nc")).distinct()
    near = scratch.save(near)
    own = near.groupBy("rep").agg(F.collect_set("centre").alias("centres"))  # at most one for each band
    both = near.join(own, "rep").join(sets.select(F.col("doc_id").alias("rep"), F.col("set").alias("s")), "rep").join(sets.select(F.col("doc_id").alias("centre"), F.col("set").alias("t")), "centre")
    deltas = scratch.save(both.select("centre", "nc", "rep", "n", "centres", F.concat(F.array_except("s", "t"), F.array_except("t", "s")).alias("delta")))
    linked = deltas.where(_similar(F.lit(0), F.col("n") + F.col("nc"), F.size("delta"), percent)).select("rep", "centre")
    linked = groups.of(groups.of(linked).select(F.col("comp").alias("a"), F.col("centre").alias("rep"))).select("a", F.col("comp").alias("b")).where("a <> b")
    linked = scratch.save(linked.distinct())
    if linked.limit(1).count():
        groups.merge(linked)

    rows = groups.of(deltas.select("centre", "rep", "n", "centres", F.size("delta").alias("d"), "delta"))
    several = scratch.save(rows.groupBy("centre").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi").select("centre"))
    each = scratch.save(rows.join(several, "centre").select("centre", "rep", "n", "centres", "d", "comp", F.explode("delta").alias("e")))
    df = scratch.save(each.groupBy("centre", "e").agg(F.count(F.lit(1)).alias("df")).where("df > 1"))
    place = F.row_number().over(Window.partitionBy("centre", "rep").orderBy(F.coalesce("df", F.lit(1)), "e"))
    # A similar partner has at most 100 / percent times as many elements, and then differs in at most so many.
    most = F.floor((100 - percent) * (F.col("n") + F.floor(F.col("n") * 100 / percent)) / (100 + percent))
    first = each.join(df, ["centre", "e"], "left").withColumn("pos", place).where("df > 1").where(F.col("pos") <= F.col("d") - F.greatest(F.lit(1), F.col("d") - most) + 1)
    first = scratch.save(first.select("centre", "e", "rep", "n", "d", "comp", "pos", "centres"))
    other = first.select("centre", "e", *[F.col(c).alias(f"{c}_b") for c in ("rep", "n", "d", "comp", "pos", "centres")])
    room = F.least(F.col("d") - F.col("pos"), F.col("d_b") - F.col("pos_b")) + 1
    once = F.array_min(F.array_intersect("centres", "centres_b")) == F.col("centre")  # one of the centres that two have in common
    met = first.join(other, ["centre", "e"]).where("comp < comp_b").where(once).where(_similar(room, F.col("n") + F.col("n_b"), F.col("d") + F.col("d_b"), percent))
    pairs = met.select("centre", "rep", "n", "comp", "rep_b", "n_b", "comp_b").distinct()
    a, b = deltas.select("centre", "rep", F.col("delta").alias("x")), deltas.select("centre", F.col("rep").alias("rep_b"), F.col("delta").alias("y"))
    full = pairs.join(a, ["centre", "rep"]).join(b, ["centre", "rep_b"])
    good = full.where(_similar(F.size(F.array_intersect("x", "y")), F.col("n") + F.col("n_b"), F.size("x") + F.size("y"), percent))
    links = scratch.save(good.select(F.col("comp").alias("a"), F.col("comp_b").alias("b")).mapInArrow(spanning, "a long, b long"))
    if links.limit(1).count():
        groups.merge(links)


class _Groups:
    """Components that grow as links are found: ``labels`` (node, comp) of the nodes that aren't their own component.

    Links are kept between components, never between documents, and only until they are merged, so that the tables
    stay as large as the number of documents.
    """

    def __init__(self, scratch: Scratch, none: DataFrame):
        self.scratch, self.labels = scratch, scratch.save(none)

    def merge(self, links: DataFrame) -> None:
        """Join components by ``links(a, b)``."""
        new = components(self.scratch, links)
        moved = self.labels.join(new.withColumnRenamed("node", "was").withColumnRenamed("comp", "now"), F.col("comp") == F.col("was"), "left").select("node", F.coalesce("now", "comp").alias("comp"))
        labels = self.scratch.save(moved.unionByName(new.where("node <> comp")))
        self.scratch.drop(self.labels)
        self.labels = labels

    def of(self, rows: DataFrame) -> DataFrame:
        """Rows (rep, ...) with their component."""
        return rows.join(self.labels.withColumnRenamed("node", "rep"), "rep", "left").withColumn("comp", F.coalesce("comp", "rep"))

    def unsettled(self, rows: DataFrame) -> DataFrame:
        """Of rows (key, rep, n, ...), with components, those of keys that several components share."""
        with_comp = self.of(rows)
        several = with_comp.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi").select("key")
        return self.scratch.save(with_comp.join(self.scratch.save(several), "key"))

    def stars(self, rows: DataFrame, verified, yields: float = 0.1) -> DataFrame:
        """Rounds of pivots over rows (key, rep, n): what is left of them, with components, unsettled.

        In a round the documents have one order for all keys; a key's pivot is its first document, and each other
        document is verified against the first pivot of another component that it meets, so at most once. Rounds go
        on while a share ``yields`` of what they verify is linked.
        """
        step = 0
        names = rows.columns
        while True:
            left = self.unsettled(rows)
            if not left.limit(1).count():
                return left
            turn = F.xxhash64("rep", F.lit(step))
            pivots = self.scratch.save(left.groupBy("key").agg(F.min(F.struct(turn.alias("turn"), "rep", "n", "comp")).alias("p")))
            met = left.join(pivots, "key").where("comp <> p.comp").groupBy("rep", "n", "comp").agg(F.min("p").alias("p"))
            pairs = self.scratch.save(met.select(F.col("rep").alias("a"), F.col("n").alias("na"), F.col("comp").alias("ca"), F.col("p.rep").alias("b"), F.col("p.n").alias("nb"), F.col("p.comp").alias("cb")))
            links = self.scratch.save(verified(pairs))
            tried, found = pairs.count(), links.count()
            if found:
                self.merge(links.select(F.col("ca").alias("a"), F.col("cb").alias("b")))
            self.scratch.drop(pivots, pairs, links)
            rows = left.select(*names)
            step += 1
            if found < yields * tried:
                return self.unsettled(rows)


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", words_per_shingle: int = 5, percent: int = 80, bands: int = 32, rows: int = 4) -> DataFrame:
    """Groups of documents whose shingle sets have a Jaccard similarity of ``percent`` or more, linked in chains.

    Returns ``(doc_id, n_shingles, component_id, kept)`` per document. Similarities are confirmed on the full sets.
    With 32 bands of 4 coordinates a pair at 0.8 shares no band with a chance below 1e-7.

    Documents of equal sets are one class from the start, so copies cost nothing more. In each bucket a pivot is
    verified against the others, in rounds with new pivots, as long as that links. What is then left of buckets of
    several components goes through an exact join on what sets a document apart from its bucket's centre. Links are
    merged into components after each round, and of the last join a task keeps a spanning forest, so a bucket of
    thousands of near copies isn't kept as its pairs, and no link between components is lost.

    Null or empty text, or no words: an empty set, linked with nothing. Rows that share an id are one document: it
    has the links of all of them and the largest of their set sizes. Rows with a null id give one row with that id
    and a null component, linked with nothing. Empty input: empty output.
    """
    spark = docs.sparkSession
    ready(spark)
    scratch = Scratch(spark, "minhash")
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    base = scratch.save(slim.mapInArrow(_sketches(words_per_shingle, bands, rows), "doc_id long, n long, s1 long, s2 long, bands array<long>"))
    some = base.where("n > 0 and doc_id is not null")
    classes = scratch.save(some.groupBy("s1", "s2", "n").agg(F.min("doc_id").alias("rep")))
    # A node is a class of equal sets, named by its smallest id.
    reps = base.join(classes.select(F.col("rep").alias("doc_id"), "s1", "s2"), ["doc_id", "s1", "s2"], "left_semi")
    hits = reps.select(F.col("doc_id").alias("rep"), "n", F.explode("bands").alias("key"))
    shared = scratch.save(hits.groupBy("key").agg(F.count(F.lit(1)).alias("m")).where("m > 1").select("key"))
    buckets = scratch.save(hits.join(shared, "key"))
    ids = buckets.select(F.col("rep").alias("doc_id")).distinct()
    sets = scratch.save(
        slim.join(ids, "doc_id", "left_semi").mapInArrow(_sets(words_per_shingle), "doc_id long, set array<long>")
    )

    def verified(pairs: DataFrame) -> DataFrame:
        """Of pairs (a, na, ca, b, nb, cb), those similar enough: (ca, cb)."""
        may = pairs.where(F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent)
        both = may.join(sets.select(F.col("doc_id").alias("a"), F.col("set").alias("sa")), "a").join(
            sets.select(F.col("doc_id").alias("b"), F.col("set").alias("sb")), "b"
        )
        meet = both.select("ca", "cb", F.size(F.array_intersect("sa", "sb")).alias("x"), (F.size("sa") + F.size("sb")).alias("y"))
        return meet.where(F.col("x") * 100 >= (F.col("y") - F.col("x")) * percent).select("ca", "cb")

    groups = _Groups(scratch, spark.createDataFrame([], "node long, comp long"))
    # The classes of rows that share an id belong together.
    kind = F.struct("s1", "s2", "n")
    several = some.groupBy("doc_id").agg(F.min(kind).alias("lo"), F.max(kind).alias("hi")).where("lo <> hi").select("doc_id")
    same = scratch.save(
        some.join(several, "doc_id").join(classes, ["s1", "s2", "n"]).select(F.col("doc_id").alias("a"), F.col("rep").alias("b")).where("a <> b")
    )
    if same.limit(1).count():
        groups.merge(same)
    left = groups.stars(buckets, verified)
    if left.limit(1).count():
        _near_centres(left, groups, sets, percent, scratch)
    named = scratch.save(
        classes.join(groups.labels.withColumnRenamed("node", "rep"), "rep", "left").select("s1", "s2", "n", F.coalesce("comp", "rep").alias("comp"))
    )
    out = base.join(named, ["s1", "s2", "n"], "left").groupBy("doc_id").agg(F.max("n").alias("n_shingles"), F.min("comp").alias("comp"))
    comp = F.when(F.col("doc_id").isNotNull(), F.coalesce("comp", "doc_id"))
    return out.select("doc_id", "n_shingles", comp.alias("component_id"), F.coalesce(comp == F.col("doc_id"), F.lit(True)).alias("kept"))
