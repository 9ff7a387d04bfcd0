"""Whitening, exact dedup and centroid clustering, against plain numpy and plain Python."""

import hashlib
import math
import random
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm.clustering import Tree, _floors, assigned, cluster, gathered
from tidemark.llm.exact_dedup import OpenTable, deduplicate, exact_duplicates
from tidemark.llm.whitening import Moments, fit, whiten

VEC = "vec_id long, embedding array<float>, label int"


def vectors(spark, rows, schema=VEC):
    return spark.createDataFrame(rows, schema)


ODD = [(900, None, 1), (901, [], 1), (902, [1.0, None, 2.0, 3.0], 1), (903, [1.0, float("nan"), 2.0, 3.0], 1), (904, [float("inf"), 0.0, 0.0, 0.0], 1), (905, [1.0, 2.0], 1)]


# --- whitening -------------------------------------------------------------------------------------------------


def plain_whitening(rows):
    """Exact sums by fractions, covariance by numpy."""
    x = [[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] for _, v in rows]
    n, sums = len(x), [sum(c) for c in zip(*x, strict=True)]
    dev = [sum((n * a - s) ** 2 for a, s in zip(r, sums, strict=True)) for r in x]
    z = np.array([[float(Fraction(a) - Fraction(s, n)) for a, s in zip(r, sums, strict=True)] for r in x])
    value, vector = np.linalg.eigh(z.T @ z / n)
    return n, dev, z, value[::-1], vector[:, ::-1]


@pytest.mark.parametrize("parts", [1, 7])
def test_whitening_against_plain(spark, parts):
    rng = np.random.default_rng(parts)
    rows = [(i, (rng.normal(size=4) * [3, 1, 0.5, 7] + [0, 50, -3, 1]).tolist(), 0) for i in range(90)] + [(7, [0.0, 0.0, 0.0, 0.0], 1), (None, [1.0, 2.0, 3.0, 4.0], 1)]
    got = whiten(vectors(spark, rows + ODD).repartition(parts), keep=["vec_id", "label"]).collect()
    n, dev, z, value, vector = plain_whitening([(r[0], r[1]) for r in rows])
    assert len(got) == 4 * n == 4 * len(rows) and {r.n for r in got} == {n}
    want = Counter((i, d) for (i, _, _), d in zip(rows, dev, strict=True))
    assert Counter((r.row.vec_id, r.deviation) for r in got if r.component == 1) == want
    turned = z @ vector / np.sqrt(value)
    for k in range(4):
        mine = {r.row.vec_id: r.whitened for r in got if r.component == k + 1 and r.row.vec_id not in (None, 7)}
        flip = np.sign(mine[0] * turned[0, k])
        assert all(abs(mine[i] - flip * turned[i, k]) < 1e-9 for i in mine if i < 90)
        share = {r.explained for r in got if r.component == k + 1}
        assert len(share) == 1 and abs(share.pop() - value[k] / value.sum()) < 1e-12
    error = {r.identity_error for r in got}
    assert len(error) == 1 and error.pop() < 1e-10


def test_merged_moments_are_those_of_all():
    rng = np.random.default_rng(3)
    x = (rng.integers(-50, 50, size=(1000, 5)) + [10**6, 0, -(10**9), 5, 10**12]).astype(np.int64)
    parts = [Moments.of(p) for p in np.array_split(x, [1, 2, 40, 700])]
    whole = Moments.of(x)
    merged = parts[0].merge(parts[1]).merge(parts[2].merge(parts[3]).merge(parts[4]))
    assert merged.n == 1000 and merged.sums.tolist() == whole.sums.tolist() == x.sum(0).tolist()
    exact = np.array([[float(Fraction(int(v)) - Fraction(int(s), 1000)) for v, s in zip(r, x.sum(0), strict=True)] for r in x])
    for m in (merged, whole):
        assert np.allclose(m.scatter, exact.T @ exact, rtol=1e-12, atol=1e-6)


def test_whitening_of_little(spark):
    assert whiten(vectors(spark, [])).count() == 0
    assert whiten(vectors(spark, ODD[:5])).count() == 0
    one = whiten(vectors(spark, [(1, [1.0, 2.0], 0)])).collect()
    assert [(r.component, r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in one] == [(k, 1, 0, None, None, 0.0) for k in (1, 2)]
    # The second entry never varies: no whitened value along it, and none of it is explained.
    flat = whiten(vectors(spark, [(i, [float(i % 5), 3.0], 0) for i in range(20)])).collect()
    assert all((r.whitened is None) == (r.component == 2) and r.identity_error < 1e-10 for r in flat)
    assert {r.component: r.explained for r in flat} == {1: 1.0, 2: 0.0}


def test_most_components_and_huge_entries(spark):
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=40).tolist(), 0) for i in range(200)]
    got = whiten(vectors(spark, [*rows, (990, [1e12] * 40, 0), (991, [1e38] * 40, 0)]))
    assert got.count() == 200 * 32 and got.agg(F.max("component")).first()[0] == 32
    # Deviations that a long doesn't hold are null; the others stay exact.
    big = whiten(vectors(spark, [(0, [3e7, 0.0], 0), *[(i, [float(i), 1.0], 0) for i in range(1, 30)]])).where("component = 1").collect()
    assert {r.row.vec_id for r in big if r.deviation is None} == {0} == {r.row.vec_id for r in big} - {r.row.vec_id for r in big if r.deviation is not None}


def test_whitening_takes_clashing_columns(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0], "r", 3), (2, [2.0, 5.0], "s", 4), (3, [0.0, 1.0], None, 5)], "vec_id long, embedding array<double>, row string, n int")
    got = whiten(df, keep=df.columns)
    assert got.select("row.*").columns == df.columns and got.count() == 6 and {r.n for r in got.select("n").collect()} == {3}
    white, error = fit(df)
    assert white.n == 3 and error < 1e-9


# --- clustering ------------------------------------------------------------------------------------------------


def plain_cluster(rows, dim, k, rounds=5, scale=256):
    kept = [(i, [math.floor(Fraction(c) * scale) for c in v]) for i, v in rows if v is not None and len(v) == dim and all(c is not None and math.isfinite(c) for c in v)]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"2:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1]))
    centres = [p for _, p in order[:k]]
    near = lambda p: min((sum((a - b) ** 2 for a, b in zip(p, c, strict=True)), j) for j, c in enumerate(centres))
    for _ in range(rounds):
        groups = defaultdict(list)
        for _, p in kept:
            groups[near(p)[1]].append(p)
        centres = [[sum(x) // len(groups[j]) for x in zip(*groups[j], strict=True)] if j in groups else c for j, c in enumerate(centres)]
    found = [(i, *near(p)[::-1]) for i, p in kept]
    by = Counter()
    for _, j, d in found:
        by[j] += d
    fits = lambda x: x if x < 1 << 63 else None
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return Counter((i, j, fits(d), fits(by[j]), fits(sum(by.values())), sha[j]) for i, j, d in found)


@pytest.mark.parametrize("parts,leaf,tree_rows", [(1, 64, 8192), (5, 4, 30)])
def test_clusters_against_plain(spark, parts, leaf, tree_rows):
    rng = np.random.default_rng(leaf)
    middle = rng.normal(size=(9, 6)) * 4
    rows = [(i, np.float32(middle[i % 9] + rng.normal(size=6) * 0.3).tolist(), 0) for i in range(400)]
    # Ties: a grid of few values, and a third of all rows alike.
    rows += [(1000 + i, [float(x) for x in rng.integers(0, 2, size=6)], 0) for i in range(60)] + [(2000 + i, [1.5] * 6, 0) for i in range(200)]
    rows += [(None, [0.25] * 6, 1), (5, [0.5] * 6, 1), (5, [0.5] * 6, 1), *ODD]
    got = cluster(vectors(spark, rows).repartition(parts), dim=6, k=12, tree_rows=tree_rows, leaf=leaf)
    assert Counter(map(tuple, got.collect())) == plain_cluster([(r[0], r[1]) for r in rows], 6, 12)


def test_clusters_of_little(spark):
    assert cluster(vectors(spark, [])).count() == 0 and cluster(vectors(spark, ODD)).count() == 0
    rows = [(1, [0.0, 1.0], 0), (2, [5.0, 1.0], 0), (3, [5.0, 1.5], 0)]
    assert Counter(map(tuple, cluster(vectors(spark, rows), dim=2, k=40).collect())) == plain_cluster([(r[0], r[1]) for r in rows], 2, 40)


def test_huge_components_stay_exact(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(c) for c in rng.normal(size=3) * 10.0 ** rng.integers(0, 30)]) for i in range(60)] + [(99, [1e308, -1e308, 5e-324])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert Counter(map(tuple, cluster(df, dim=3, k=4).collect())) == plain_cluster(rows, 3, 4)


def test_whole_nodes_are_assigned_and_nothing_is_lost():
    rng = np.random.default_rng(4)
    points = _floors(np.concatenate([rng.normal(size=(2000, 3)) * 0.05 + c for c in ([0, 0, 0], [9, 0, 0], [0, 9, 0])]), 256)
    centres = np.array([[0, 0, 0], [9, 0, 0], [0, 9, 0], [9, 9, 9]]) * 256.0
    tree = Tree.grow(points, 16)
    parts = list(tree.walk(centres))
    assert sorted(i for _, s, e, *_ in parts for i in range(s, e)) == list(range(6000))
    # Clusters that lie apart take few nodes; only those that straddle two are resolved vector by vector.
    assert len(parts) <= 60 and sum(e - s for _, s, e, _, each in parts if each is None) > 5700
    of, far = assigned(tree, centres)
    d = ((points[:, None] - centres) ** 2).sum(2)
    assert (of == d.argmin(1)).all() and far == d.min(1).astype(int).tolist()
    got = gathered(tree, centres)
    assert got.counts.tolist() == [2000, 2000, 2000, 0] and got.sums[1].tolist() == points[of == 1].sum(0).astype(int).tolist()


# --- exact dedup -----------------------------------------------------------------------------------------------


def lower(s):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)


def plain_copies(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[lower(t or "")].append(i)
    out = Counter()
    for t, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        for n, i in enumerate(ids):
            out[i, keep, len(ids), n == ids.index(keep), hashlib.sha256(t.encode()).hexdigest()] += 1
    return out


def copies(df, **options):
    return Counter((r.row.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in exact_duplicates(df, keep=["doc_id"], **options).collect())


DULL = lambda text: len(text) % 3  # noqa: E731  without a name that workers would look for


@pytest.mark.parametrize("options", [{}, {"bucket_bytes": 2000, "table_rows": 7}, {"hashed": DULL, "bucket_bytes": 3000}], ids=["default", "recursive", "collisions"])
def test_copies_against_plain(spark, options):
    rng = random.Random(8)
    pool = ["Hot text", "hot TEXT", "", None, "ÄÖ Straße", "äö straße", "İstanbul", "x" * 700] + [f"text {i}" for i in range(90)]
    rows = [(rng.choice([i, i, i, rng.randrange(50), None]), rng.choice(pool[:2]) if rng.random() < 0.35 else rng.choice(pool)) for i in range(500)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    assert copies(df, **options) == plain_copies(rows)


def test_full_tables_are_partitioned_anew(spark, monkeypatch):
    from tidemark.llm import exact_dedup

    levels = []
    save = exact_dedup.Scratch.save
    monkeypatch.setattr(exact_dedup.Scratch, "save", lambda self, df, *a: levels.append(df.columns) or save(self, df, *a))
    rows = [(i, f"{i % 20} " * 40) for i in range(60)]
    got = copies(spark.createDataFrame(rows, "doc_id long, text string"), bucket_bytes=1000, hashed=DULL)
    assert got == plain_copies(rows) and len(levels) > 3


def test_copies_of_odd_rows(messy, empty):
    rows = [(r.doc_id, r.text) for r in messy.collect()]
    assert copies(messy) == plain_copies(rows)
    out = deduplicate(messy)
    assert out.columns == messy.columns and Counter(lower(r.text or "") for r in out.collect()) == Counter({lower(t or ""): 1 for _, t in rows})
    assert exact_duplicates(empty).count() == 0 and deduplicate(empty).columns == empty.columns


def test_of_copies_under_one_id_one_stays(spark):
    df = spark.createDataFrame([(4, "A")] * 3 + [(2, "a"), (None, "b"), (None, "B")], "doc_id long, text string")
    got = exact_duplicates(df.repartition(3), keep=["doc_id"])
    assert Counter((r.row.doc_id, r.keep_id, r.group_size, r.kept) for r in got.collect()) == {(4, 4, 4, True): 1, (4, 4, 4, False): 2, (2, 4, 4, False): 1, (None, None, 2, True): 1, (None, None, 2, False): 1}


def test_table_compares_whole_texts():
    t = OpenTable(4)
    texts = [f"{i}".encode() for i in range(200)]
    assert [t.find(0, x) for x in texts] == list(range(200)) == [t.find(0, x, insert=False) for x in texts]
    assert t.find(0, b"new", insert=False) == -1 and t.find(1, b"5") == 200
