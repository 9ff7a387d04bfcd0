"""Models and scores: held-out accuracy, brute force, and what odd rows give."""

import itertools
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import fingerprint as fp
from tidemark.llm import hmm, lattice, quality, queries, toxicity
from tidemark.llm.licenses import scan

SF = "/root/testdata/sf0.1"


def auc(score, label):
    order = np.argsort(score, kind="stable")
    rank = np.empty(len(score))
    rank[order] = np.arange(1, len(score) + 1)
    pos = label == 1
    return (rank[pos].sum() - pos.sum() * (pos.sum() + 1) / 2) / (pos.sum() * (~pos).sum())


def held_out(spark, name, label):
    out = queries.QUERIES[name](spark, SF)
    labels = queries.read(spark, SF, "labels").select("doc_id", label)
    return out.where("held_out").join(labels, "doc_id").toPandas()


# --- quality ---------------------------------------------------------------------------------------------------


def test_quality_held_out(spark):
    got = held_out(spark, "op4_quality", "quality")
    assert auc(got.score.to_numpy(), got.quality.to_numpy()) > 0.98
    assert (got.predicted == got.quality).mean() > 0.95


def test_trees_learn_a_rule_and_flat_arrays_agree():
    rng = np.random.default_rng(1)
    x = rng.random((3000, 5))
    y = ((x[:, 1] > 0.4) ^ (x[:, 3] > 0.7)).astype(float)
    t = quality.boost(x, y, trees=30, depth=3)

    def walk(row):
        z = t.base
        for n in t.root:
            while t.left[n] != n:
                n = t.left[n] if row[t.feature[n]] <= t.cut[n] else t.right[n]
            z += t.value[n]
        return 1 / (1 + math.exp(-z))

    s = t.score(x)
    assert ((s > 0.5) == y).mean() > 0.98
    assert np.allclose(s[:50], [walk(r) for r in x[:50]])
    assert len(t.score(x[:0])) == 0


def test_quality_odd_rows(spark, messy, empty, no_labels):
    assert {r.score for r in quality.score(messy, quality.fit(messy, no_labels)).collect()} == {0.5}
    labels = spark.createDataFrame([(i, i % 2) for i in range(10)] + [(None, 1), (4, None)], "doc_id long, quality int")
    out = quality.score(messy, quality.fit(messy, labels))
    assert out.select("row.*").columns == messy.columns and out.count() == messy.count()
    assert out.where("score between 0 and 1").count() == messy.count()
    assert quality.score(empty, quality.fit(empty, labels)).count() == 0


# --- toxicity --------------------------------------------------------------------------------------------------


def test_toxicity_held_out(spark):
    got = held_out(spark, "op6_toxicity", "toxic")
    toxic = got.toxic == 1
    assert (got.predicted[toxic] == 1).mean() > 0.8
    assert (got.predicted[~toxic] == 1).mean() < 0.01


@pytest.fixture(scope="module")
def toxic_model(spark):
    return toxicity.fit(queries.read(spark, SF, "documents"), queries.read(spark, SF, "labels"))


@pytest.mark.parametrize("hidden,word", [
    ("1d10t", "idiot"), ("i d i o t", "idiot"), ("idiooooot", "idiot"), ("st*pid", "stupid"), ("$tup1d", "stupid"), ("l.o.s.e.r", "loser"),
    ("p@thet1c", "pathetic"), ("tr@sh", "trash"), ("m0r0n", "moron"), ("w0rthle55", "worthless"), ("d-i-s-g-u-s-t-i-n-g", "disgusting"), ("cl0wn", "clown"),
])
def test_hidden_words_are_restored(toxic_model, hidden, word):
    read = toxicity.Restorer(toxic_model.chars)(f"and the {hidden} was here")
    assert word in toxicity.tokens(read), read


def test_hidden_toxic_documents_are_found(spark, toxic_model):
    docs = queries.read(spark, SF, "documents").join(queries.read(spark, SF, "labels").where("toxic = 1"), "doc_id").where("lang = 'en'").select("doc_id", "text").limit(200).collect()
    rng = random.Random(2)
    words = [w for w in toxic_model.lexicon if w in ("idiot", "loser", "stupid", "scum", "moron", "trash", "clown", "pathetic", "worthless", "disgusting")]
    assert len(words) == 10

    def hide(m):
        w = m[0].lower()
        how = rng.randrange(3)
        if how == 0:
            return " ".join(w)
        if how == 1:
            return w.translate(str.maketrans("ioeas", "103@$"))
        i = rng.randrange(len(w))
        return w[:i] + w[i] * 4 + w[i + 1 :]

    rows = [(r.doc_id, re.sub("|".join(words), hide, r.text, flags=re.I)) for r in docs]
    got = toxicity.score(spark.createDataFrame(rows, "doc_id long, text string"), toxic_model).collect()
    assert np.mean([r.score >= 0.7 for r in got]) > 0.85


def suspect(text):
    return bool(toxicity.SPACED.search(text) or toxicity.MIXED.search(text))


def test_suspects_miss_nothing(toxic_model):
    import pyarrow as pa

    texts = ["plain words only.", "1d10t", "a b c d", "sooo", "x\ny $ z", "i.d.i.o.t", "", "no!", "café öööl", "q-w-e-r", "A1", "tra$h"]
    raw, offs = toxicity.text_bytes(pa.array(texts))
    flags = toxicity.suspects(raw, offs)
    assert all(f or not suspect(t.lower()) for t, f in zip(texts, flags, strict=True))
    assert not flags[0] and flags[1] and flags[5]


def test_suspects_hold_all_that_the_pattern_finds():
    import pyarrow as pa

    texts = ["i. d. i. o. t", "i  d  i  o  t", "i d. i  o.t", "x a. b c  d", "и д и о т", "é t é s", "“i d i o”", "ÄÄä", "ддд", "kk\u212a", "ii\u0130", "ςςΣ", "\u0130b c d e", "1a", "中中中", "😀a b c d", "𐐀𐐀𐐨"]
    rng = random.Random(9)
    parts = ["a", "b", "ab", "€", "¡", "é", "É", "д", "中", "𐐀", "\u0130", "\u212a", "²", "“", "—", " ", ". ", "- ", "  ", ".", "_", "1", "@", "|", "\n", "\u0307", "\u00a0"]
    texts += ["".join(rng.choices(parts, k=rng.randrange(12))) for _ in range(30_000)]
    want = [suspect(t.lower()) for t in texts]
    for some in (texts, *([t] for t in texts[:17])):
        flags = toxicity.suspects(*toxicity.text_bytes(pa.array(some)))
        assert [t for t, w, f in zip(some, want if some is texts else [suspect(some[0].lower())], flags, strict=True) if w and not f] == []
    plain = ["plain words only.", "a café, öööl", "Das ist — gut", "то и другое"]
    assert toxicity.suspects(*toxicity.text_bytes(pa.array(plain))).tolist() == [False, True, False, False]


def every_reading(span, model):
    """The best score and the readings of a span, by trying every way to read every character."""
    best = {}

    def go(i, before, state, score, read):
        if i == len(span) + 1:
            best.setdefault(round(score, 9), set()).add(read.strip())
            return
        c = (span + " ")[i]
        for x, channel in toxicity.arcs(c, before):
            k = toxicity.letter_code(x) if x else 0
            if not x or (k == 0 and state % toxicity.SYMBOLS == 0):
                go(i + 1, c, state, score + channel, read)
            else:
                go(i + 1, c, (state * toxicity.SYMBOLS + k) % toxicity.SYMBOLS**3, score + channel + model.logp[state, k], read + x)

    go(0, "", 0, 0.0, "")
    top = max(best)
    return top, best[top]


def test_readings_against_enumeration(toxic_model):
    rng = random.Random(5)
    spans = ["".join(rng.choices("abdiot10345@$*. -!|é", k=rng.randrange(1, 8))) for _ in range(400)] + ["****", "1d10t", "a  b  c", "$$$", "üü1"]
    models = [toxic_model.chars, toxicity.CharModel(np.log(np.random.default_rng(0).dirichlet(np.ones(28) * 0.3, 28**3) + 1e-12))]
    for model in models:
        for span in spans:
            assert toxicity.viterbi(span, model) in every_reading(span, model)[1], span


def test_long_texts_without_white_space(spark, toxic_model):
    import time

    run = "".join(chr(0x4E00 + (i * 7919) % 20000) for i in range(500_000))
    restore = toxicity.Restorer(toxic_model.chars)
    t0 = time.time()
    for text in (run + "1d10t" + run, "a" * 1_000_000, "ab0cd1" * 30_000, "x!" * 100_000):
        restore(text)
    assert time.time() - t0 < 120
    assert "idiot" in restore("中文 1d10t " + run)
    rows = spark.createDataFrame([(1, run + " 1d10t"), (2, run)], "doc_id long, text string")
    assert all(0 <= r.score <= 1 for r in toxicity.score(rows, toxic_model).collect())


def test_toxicity_odd_rows(spark, messy, empty, no_labels):
    model = toxicity.fit(messy, no_labels)
    out = toxicity.score(messy, model)
    assert out.select("row.*").columns == messy.columns and out.count() == messy.count()
    assert out.where("score > 0.01").count() == 0
    assert toxicity.score(empty, toxicity.fit(empty, no_labels)).count() == 0


# --- hidden Markov model ---------------------------------------------------------------------------------------


def small_model(rng, s=3, k=5):
    norm = lambda a, ax: a / a.sum(ax, keepdims=True)
    return hmm.Hmm(norm(rng.random(s), 0), norm(rng.random((s, s)), 1), norm(rng.random((k, s)), 0))


def test_likelihood_and_counts_against_enumeration():
    rng = np.random.default_rng(4)
    m = small_model(rng)
    lens = np.array([1, 2, 5, 4])
    obs = rng.integers(0, 5, lens.sum())
    ll, starts, moves, emits = [], np.zeros(3), np.zeros((3, 3)), np.zeros((5, 3))
    at = 0
    for n in lens:
        o, total, parts = obs[at : at + n], 0.0, []
        for path in itertools.product(range(3), repeat=int(n)):
            p = m.start[path[0]] * m.emit[o[0], path[0]]
            for i in range(1, n):
                p *= m.move[path[i - 1], path[i]] * m.emit[o[i], path[i]]
            total += p
            parts.append((path, p))
        for path, p in parts:
            starts[path[0]] += p / total
            for i in range(n):
                emits[o[i], path[i]] += p / total
                if i:
                    moves[path[i - 1], path[i]] += p / total
        ll.append(math.log(total))
        at += n
    assert np.allclose(hmm.log_likelihood(m, obs, lens), ll)
    got = hmm.expect(m, obs, lens)
    assert np.allclose(got[0], starts) and np.allclose(got[1], moves) and np.allclose(got[2], emits)
    assert np.isclose(got[3], sum(ll))


def test_long_sequences_against_plain_recursion():
    rng = np.random.default_rng(5)
    m = small_model(rng, 4, 30)
    lens = np.array([1, 700, 128, 129, 3000, 127])
    obs = rng.integers(0, 30, lens.sum())
    want, at = [], 0
    for n in lens:
        a, ll = m.start * m.emit[obs[at]], 0.0
        for o in obs[at + 1 : at + n]:
            ll, a = ll + math.log(a.sum()), (a / a.sum() @ m.move) * m.emit[o]
        want.append(ll + math.log(a.sum()))
        at += n
    assert np.allclose(hmm.log_likelihood(m, obs, lens), want)
    before = sum(want)
    for _ in range(3):
        m = hmm.improve(*hmm.expect(m, obs, lens)[:3], prior=0.0)
        now = hmm.log_likelihood(m, obs, lens).sum()
        assert now > before
        before = now


def test_language_model_query(spark):
    sf = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in queries.op7_hmm(spark, sf).collect()}
    docs = queries.read(spark, sf, "documents").select("doc_id", "text", (F.crc32(F.col("doc_id").cast("string")) % 7 == 2).alias("held")).collect()
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    toks = {r.doc_id: [w for w in re.split(r"[\x20\x09-\x0D]+", (r.text or "").translate(low)) if w] + [None] for r in docs}
    count = {}
    for r in docs:
        if not r.held:
            for w in toks[r.doc_id]:
                count[w] = count.get(w, 0) + 1
    n, v = sum(count.values()), len(count)
    for r in docs:
        g, t = got[r.doc_id], toks[r.doc_id]
        assert (g.held_out, g.n_tokens, g.n_known, g.train_tokens) == (r.held, len(t), sum(w in count for w in t), n)
        assert math.isclose(g.base_score, sum(math.log10((count.get(w, 0) + 1) / (n + v + 1)) for w in t), rel_tol=1e-9)
    out = [got[r.doc_id] for r in docs if r.held]
    assert sum(r.score for r in out) > sum(r.base_score for r in out)


def test_language_model_does_not_depend_on_partitions(spark, monkeypatch):
    docs = queries.read(spark, "/root/testdata/sf0.01", "documents").where("n_chars < 3000").select("doc_id", "text")
    held = F.crc32(F.col("doc_id").cast("string")) % 7 == 2
    made = []
    real = hmm._score
    monkeypatch.setattr(hmm, "_score", lambda lang: made.append(lang) or real(lang))
    runs = [{r.doc_id: r for r in hmm.score_texts(docs.repartition(n, "text"), held, rounds=2, chunk_bytes=1 << 18).collect()} for n in (2, 7)]
    assert all(math.isclose(runs[0][i].score, runs[1][i].score, rel_tol=1e-6) for i in runs[0]) and runs[0].keys() == runs[1].keys()

    # The score once more, word by word: the forward recursion over classes, and each word's share of its class.
    lang, count = made[1], {}
    rows = docs.withColumn("held", held).collect()
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = {r.doc_id: [w for w in re.split(r"[\x20\x09-\x0D]+", (r.text or "").translate(low)) if w] for r in rows}
    for r in rows:
        if not r.held:
            for w in [*words[r.doc_id], None]:
                count[w] = count.get(w, 0) + 1
    import pyarrow as pa

    distinct = sorted({w for ws in words.values() for w in ws})
    (found,) = hmm.words(pa.array([" ".join(distinct)]), 1 << 30)
    cls = dict(zip(distinct, hmm.word_classes(found, 4096).tolist(), strict=True)) | {None: 0}
    tokens, kinds = np.zeros(4096), np.zeros(4096)
    for w, c in count.items():
        tokens[cls[w]] += c
        kinds[cls[w]] += 1
    for i in sorted(words)[:60]:
        ws, score, a = [*words[i], None], 0.0, None
        for w in ws:
            a = (lang.hmm.start if a is None else a @ lang.hmm.move) * lang.hmm.emit[cls[w]]
            score += math.log10(a.sum()) + math.log10((count.get(w, 0) + 1) / (tokens[cls[w]] + kinds[cls[w]] + 1))
            a = a / a.sum()
        assert math.isclose(score, runs[1][i].score, rel_tol=1e-6)


def test_pairs_of_neighbours_are_modelled():
    rng = np.random.default_rng(3)
    n = np.zeros((8, 8))
    n[:4, 4:], n[4:, :4] = rng.integers(50, 100, (4, 4)), rng.integers(50, 100, (4, 4))  # two kinds that take turns
    joint, e = hmm.pair_model(n, 2)
    p = e @ joint @ e.T
    assert np.isclose(p.sum(), 1) and p[:4, :4].sum() + p[4:, 4:].sum() < 0.01


def test_language_model_odd_rows(messy, empty):
    out = hmm.score_texts(messy, F.col("doc_id") == 7, rounds=1).collect()
    assert len(out) == messy.count() and all(math.isfinite(r.score) and r.score < 0 for r in out)
    assert {r.n_tokens for r in out if r.doc_id == 1} == {1}
    assert all(math.isfinite(r.score) for r in hmm.score_texts(messy, F.lit(True), rounds=1).collect())
    assert hmm.score_texts(empty, F.lit(False)).count() == 0


# --- embeddings ------------------------------------------------------------------------------------------------


def test_nearest_lattice_point():
    rng = np.random.default_rng(6)
    x = rng.normal(size=(300, 8)) * 2
    q = lattice.nearest_e8(x)
    assert ((q * 2) % 1 == 0).all() and (q.sum(1) % 2 == 0).all()
    d = ((x - q) ** 2).sum(1)
    assert d.max() <= 1 + 1e-9  # the covering radius is 1
    assert all((((x - q - m) ** 2).sum(1) >= d - 1e-9).all() for m in lattice.SHORTEST)


def test_near_vectors_against_plain(spark):
    rng = np.random.default_rng(7)
    rows = []
    for c in rng.normal(size=(12, 24)):
        for s in rng.choice([0.0, 0.05, 0.3, 0.45], size=rng.choice([1, 5, 60])):
            rows.append((c + s * rng.normal(size=24)).tolist())
    rows += [None, [], [0.0] * 24, [1.0, None] + [0.0] * 22, [float("nan")] * 24, [float("inf")] * 24, [1e-200] * 24, [1e200] * 24, [1.0] * 12, [2.0] * 12]
    ids = rng.permutation(len(rows)).tolist()
    got = {r.vec_id: r for r in lattice.near_vectors(spark.createDataFrame(list(zip(ids, rows, strict=True)) + [(None, [1.0] * 24)], "vec_id long, embedding array<double>"), tables=40, block=16).collect()}
    unit = {i: lattice._unit(v) for i, v in zip(ids, rows, strict=True)}
    links = {i: [j for j in ids if j != i and unit[i] is not None and unit[j] is not None and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= 0.9] for i in ids}
    want, found = sum(map(len, links.values())), sum(got[i].n_links for i in ids)
    assert want > 500 and 0.995 * want <= found <= want and all(got[i].n_links <= len(links[i]) for i in ids)
    assert all(got[i].component_id <= i and got[i].kept == (got[i].component_id == i) for i in ids)
    if found == want:
        for i in ids:
            assert all(got[j].component_id == got[i].component_id for j in links[i])
    assert got[None].component_id is None and got[None].n_links == 0


@pytest.mark.parametrize("most_met", [20_000, 1])  # the second asks for narrower cells
def test_planted_links_are_found_at_the_defaults(spark, most_met):
    rng = np.random.default_rng(9)
    a = rng.normal(size=(1500, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    side = rng.normal(size=a.shape)
    side -= (side * a).sum(1, keepdims=True) * a
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    b = 0.901 * a + np.sqrt(1 - 0.901**2) * side
    rows = [(2 * i, a[i].tolist()) for i in range(1500)] + [(2 * i + 1, b[i].tolist()) for i in range(1500)]
    out = lattice.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), most_met=most_met).collect()
    assert sum(r.n_links for r in out) >= 0.99 * 3000
    assert all(r.component_id in (r.vec_id, r.vec_id - 1) and r.n_links <= 1 for r in out)


def test_vectors_odd_rows(spark):
    """Repeated ids, ties, and columns whose names are those used inside."""
    v, w = [1.0] * 12, [1.0] * 6 + [-1.0] * 6
    rows = [(1, v, 5, "x"), (1, v, 6, "y"), (2, v, 5, None), (3, w, 5, "z"), (None, v, 1, "q"), (4, None, 2, "r"), (2, v, 5, None)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, id long, item string").withColumn("cell", F.lit(1)).withColumn("v", F.lit(0.5))
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in lattice.near_vectors(df).collect()}
    assert got == {1: (1, 1, True), 2: (1, 1, False), 3: (0, 3, True), 4: (0, 4, True), None: (0, None, True)}


def test_all_vectors_of_an_id_link(spark):
    rng = np.random.default_rng(6)
    v, w = rng.normal(size=8), rng.normal(size=8)
    rows = [(1, v.tolist()), (1, w.tolist()), (2, (v * 2).tolist()), (3, (w * 3).tolist()), (1, v.tolist()), (0, None), (5, (-v).tolist()), (5, [0.0] * 8)]
    got = lattice.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in got) == [(0, 0, 0, True), (1, 1, 1, True), (1, 1, 1, True), (2, 1, 1, False), (3, 1, 1, False), (5, 0, 5, True), (5, 0, 5, True)]


def test_ids_that_repeat_against_plain(spark):
    """A third of the ids have several vectors, some of them near each other."""
    rng = np.random.default_rng(9)
    middle = rng.normal(size=(12, 16))
    rows = [(int(rng.integers(60)) if i % 3 == 0 else 100 + i, (middle[i % 12] + rng.normal(size=16) * 0.15).tolist()) for i in range(150)]
    got = lattice.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    x = np.array([v for _, v in rows])
    x /= np.linalg.norm(x, axis=1)[:, None]
    near = (x @ x.T >= 0.9) & ~np.eye(len(x), dtype=bool)
    comp = {i: i for i, _ in rows}
    for _ in range(len(rows)):
        for a, b in zip(*np.nonzero(near), strict=True):
            comp[rows[a][0]] = comp[rows[b][0]] = min(comp[rows[a][0]], comp[rows[b][0]])
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in got) == sorted((i, int(n), comp[i]) for (i, _), n in zip(rows, near.sum(1), strict=True))


def test_vectors_empty(spark):
    assert lattice.near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


# --- fingerprints ----------------------------------------------------------------------------------------------


def test_fingerprints(spark):
    base = " ".join(f"tok{i}" for i in range(400))
    swap = " ".join(f"tok{i}" for i in [*range(200, 400), *range(200)])
    edit = base.replace("tok7 ", "new ").replace("tok300", "other")
    rows = [(1, base), (2, base), (3, swap), (4, edit), (5, "entirely other text of a few words"), (6, ""), (7, None), (8, "word " * 500), (9, "word " * 501)]
    df = spark.createDataFrame(rows, "i int, t string").select("i", fp.signature(F.coalesce("t", F.lit(""))).alias("s"))
    pairs = df.alias("a").crossJoin(df.alias("b")).select(F.col("a.i").alias("i"), F.col("b.i").alias("j"), fp.likeness(F.col("a.s"), F.col("b.s")).alias("x"), F.size("a.s").alias("n"))
    like = {(r.i, r.j): r.x for r in pairs.collect()}
    assert like[1, 2] == 1.0 and like[6, 7] == 1.0 and like[1, 5] == 0.0
    assert 0.8 < like[1, 4] < 1.0
    # The same k-mers in another order: minhash would see nothing, order does.
    assert 0.2 < like[1, 3] < 0.8
    assert 0.5 < like[8, 9] and like[1, 6] == 0.0


def plain_signature(text):
    """The same in plain Python: k-mers chosen by their hash, numbered, the smallest of each bin in text order."""
    import xxhash

    sign = lambda h: h - (1 << 64) if h >> 63 else h

    def h(*parts):
        seed = 42
        for x in parts:
            if x is not None:
                data = x.encode() if isinstance(x, str) else int(x).to_bytes(4, "little") if isinstance(x, np.int32) else (x & (2**64 - 1)).to_bytes(8, "little")
                seed = xxhash.xxh64_intdigest(data, seed=seed)
        return sign(seed)

    every = [h(text[i : i + fp.SIZE]) for i in range(max(len(text) - fp.SIZE + 1, min(len(text), 1)))]
    kmers = [x for i, x in enumerate(every) if i == 0 or x % fp.EVERY == 0]
    seen, bins = {}, {}
    for i, k in enumerate(kmers):
        n = seen.get(k >> 32, 0)
        seen[k >> 32] = n + 1
        g = h(k >> 32, np.int32(n)) >> 32
        bins.setdefault(g >> 26, []).append((g, i))
    out = []
    for b, items in sorted(bins.items()):
        two = sorted(sorted(items)[:2], key=lambda x: x[1])
        out.append((b + 32) * 65536 + h(*(x for g, i in two for x in (kmers[i], g))) % 65536)
    return out


def test_signature_against_plain(spark):
    rng = random.Random(8)
    run = lambda n: "".join(chr(0x4E00 + rng.randrange(3000)) for _ in range(n))
    texts = ["", " ", "one", "a b c  d\n", "word " * 40, run(300), "x" * 60, "ab" * 40, "abc", "😀" * 9 + "é😀x😀", "mixed " + run(50) + " text\t\tand " + run(32), "é" * 33 + " a a a a", " ".join(rng.choices(["to", "be", "or"], k=80))]
    got = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", fp.signature(F.col("t")).alias("s")).collect()
    for r in got:
        assert r.s == plain_signature(texts[r.i]), texts[r.i]


def test_every_window_counts(spark):
    """Texts that differ in their last k-mer alone have different signatures, whatever that k-mer's hash."""
    texts = ["abcd" + c for c in "abcdefghijklmnopqrstuvwxyz"]
    got = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", fp.signature(F.col("t")).alias("s")).collect()
    assert len({tuple(r.s) for r in got}) == len(texts)
    # Blocks and the shortened search for a bin's first two change nothing, whatever the length.
    rng = random.Random(3)
    texts = ["".join(rng.choices("abcdeé 中😀", k=n)) for n in (3, 4, 15, 16, 17, 18, 19, 20, 35, 760, 775, 3000)] + ["word " * 700, "ab" * 900]
    got = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", fp.signature(F.col("t")).alias("s")).collect()
    assert all(r.s == plain_signature(texts[r.i]) for r in got)


def test_signatures_of_both_texts(spark):
    """Steps in projections of their own, and k-mers shared by both texts, give what plain Python gives."""
    rng = random.Random(5)
    texts = ["", "a", "abc", "abcd", "abcdefg", "abcdefgh", "😀" * 9 + "é😀x", "word " * 300, "ab" * 400, "\n" * 5, "".join(rng.choices("abé 中😀", k=2500)), " ".join(rng.choices(["to", "be", "or"], k=500))]
    rows = [(i, t, t[: len(t) - len(t) // 2] + u[: len(t) // 2], len(t) - len(t) // 2) for i, (t, u) in enumerate(itertools.product(texts, texts))]
    df = spark.createDataFrame(rows, "i int, t string, e string, kept int")
    out = fp.signatures(df, "t", "e", F.col("kept"), "a", "b")
    for r in out.collect():
        assert r.a == plain_signature(rows[r.i][1]) and r.b == plain_signature(rows[r.i][2]), rows[r.i]
    # Arrays that can't hold nulls are sorted as plain longs, in compiled projections that Spark hasn't merged.
    steps = df.select(fp._placed(fp._kmers(F.col("t"))).alias("s")).select("s", fp._numbered(F.col("s")).alias("w"))
    assert all(not x.dataType.containsNull for x in steps.schema)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate inline") == 4


@pytest.mark.parametrize("many, longest", [(12, 21), (2, 21), (12, 4)])
def test_signatures_number_repeats_in_rows(spark, monkeypatch, many, longest):
    """Repeats are numbered in compiled rows; bins that a low bound empties, and long texts, get their signatures all the same."""
    monkeypatch.setattr(fp, "MANY", many)
    monkeypatch.setattr(fp, "LONGEST", longest)
    rng = random.Random(9)
    texts = ["", "abc", "x" * 4000, "word " * 700, " ".join(rng.choices(["to", "be", "or"], k=900)), "".join(rng.choices("abé 中😀", k=3000))]
    rows = [(t, u, min(len(t), len(u), 3), None) for t, u in itertools.product(texts, texts)]
    rows = [(t, t[:kept] + u[kept:], kept, x) for t, u, kept, x in rows]
    df = spark.createDataFrame([(r[0], r[1], r[2], "same") for r in rows for _ in range(2)], "t string, e string, kept int, other string")
    out = fp.signatures(df, "t", "e", F.col("kept"), "a", "b").collect()
    want = sorted(("same", tuple(plain_signature(t)), tuple(plain_signature(e))) for t, e, *_ in rows for _ in range(2))
    assert sorted((r.other, tuple(r.a), tuple(r.b)) for r in out) == want
    plan = fp.signatures(df, "t", "e", F.col("kept"), "a", "b")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate explode") == 2


def test_edits_in_unspaced_and_spaced_text_stay_near(spark):
    rng = random.Random(4)
    run = "".join(chr(0x4E00 + rng.randrange(3000)) for _ in range(3000))
    spaced = " ".join(f"t{rng.randrange(900)}" for _ in range(600))
    rows = [(0, run), (1, "中" + run), (2, run[:1500] + "文" + run[1500:]), (3, run[:700] + run[701:]), (4, spaced), (5, "new " + spaced), (6, spaced.replace(" ", "  ", 3)), (7, run[::-1])]
    df = spark.createDataFrame(rows, "i int, t string").select("i", fp.signature(F.col("t")).alias("s"))
    like = {(r.i, r.j): r.x for r in df.alias("a").crossJoin(df.alias("b")).select(F.col("a.i").alias("i"), F.col("b.i").alias("j"), fp.likeness(F.col("a.s"), F.col("b.s")).alias("x")).collect()}
    assert all(like[0, j] > 0.8 for j in (1, 2, 3)) and like[4, 5] > 0.8 and like[0, 7] < 0.1
    assert 0.7 < like[4, 6] < 1.0  # white space counts


def test_likeness_follows_edit_distance(spark):
    """A letter changed in every third word (near 5 % of the letters), in every sixth, doubled spaces, other words."""
    rng = random.Random(6)
    letters = "abcdefghijklmnopqrstuvwxyz"
    vocabulary = ["".join(rng.choices(letters, k=rng.randint(3, 9))) for _ in range(3000)]

    def changed(words, every):
        out = list(words)
        for i in range(0, len(out), every):
            j = rng.randrange(len(out[i]))
            out[i] = out[i][:j] + rng.choice(letters.replace(out[i][j], "")) + out[i][j + 1 :]
        return out

    rows = []
    for i in range(30):
        words, other = rng.choices(vocabulary, k=300), rng.choices(vocabulary, k=300)
        rows.append((i, *(" ".join(x) for x in (words, changed(words, 3), changed(words, 6), changed(words, 24), other)), "  ".join(words)))
    df = spark.createDataFrame(rows, "i int, a string, third string, sixth string, few string, other string, wide string")
    sig = lambda c: fp.signature(F.col(c))
    got = df.select(*[fp.likeness(sig("a"), sig(c)).alias(c) for c in ("third", "sixth", "few", "other", "wide")]).toPandas()
    mean = got.mean()
    assert 0.4 < mean.third < mean.sixth < mean.few < 1.0 and mean.sixth > 0.6 and mean.few > 0.85, mean
    assert got.other.max() < 0.1 and mean.wide > 0.15, got.describe()


def test_repeats_are_numbered(spark):
    """Every numbered k-mer is counted once, so repeats fill bins of their own."""
    df = spark.createDataFrame([(i, "word " * i) for i in (3, 30, 300)], "i int, t string")
    n = {r.i: r.n for r in df.select("i", F.size(fp.signature(F.col("t"))).alias("n")).collect()}
    assert n[3] <= n[30] <= n[300] and n[300] > 50


def test_edited_texts(spark):
    import hashlib

    rows = [(10, "abcdefg"), (5, "äöüß"), (7, None), (2, "x" * 50), (1, "")]
    got = {r.doc_id: r for r in fp.fingerprints(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    order = sorted(rows, key=lambda r: -r[0])
    for (i, t), (_, nxt) in zip(order, order[1:] + order[:1], strict=True):
        t, nxt = t or "", nxt or ""
        edited = t[: len(t) - len(t) // 2] + nxt[: len(t) // 2]
        assert got[i].n_chars == len(t) and got[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= got[i].near_edited <= 1 and 0 <= got[i].near_next <= 1


def test_fingerprints_odd_rows(messy, empty):
    out = fp.fingerprints(messy).collect()
    assert len(out) == messy.count() and all(0 <= r.near_edited <= 1 for r in out)
    assert fp.fingerprints(empty).count() == 0
    one = fp.fingerprints(messy.where("doc_id = 9")).collect()
    assert len(one) == 1 and one[0].near_next == 1.0


# --- licenses --------------------------------------------------------------------------------------------------


def test_licenses(spark, messy, empty):
    rows = [
        (1, "Licensed under CC BY-NC 4.0.\nsome text"), (2, "CC-BY cc.by; cc bys"), (3, "GNU General Public\nLicense, version 3 All RIGHTS reserved all rights reserved"),
        (4, "x " * 500 + "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal with it"), (5, None), (6, "licensed apache"),
    ]
    got = {r.doc_id: r for r in scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert (got[1].labels, got[1].base_labels, got[1].first_word) == ("cc-by,cc-by-nc-4.0", "cc-by", 2)
    assert (got[2].n_base, got[2].first_word, got[2].last_word, got[2].n_words) == (2, 0, 2, 6)
    assert (got[3].base_labels, got[3].n_base, got[3].first_word, got[3].last_word) == ("gpl,reserved", 3, 1, 9)
    assert got[4].labels == "mit-text" and got[4].n_base == 0 and got[4].first_word is None and 0.8 <= got[4].score < 1
    assert (got[5].n_words, got[5].labels, got[5].score) == (0, "", 0.0)
    assert got[6].labels == ""
    assert scan(messy).count() == messy.count() and scan(empty).count() == 0


def plain_scan(text, freq):
    from tidemark.llm import licenses as lic

    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    ws = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(low))
    out = set()
    for label, t in lic.template_words(lic.TEMPLATES).items():
        for b in range(0, max(len(ws), 1), len(t)):
            block = ws[b : b + 2 * len(t)]
            share = len(set(block) & set(t)) / len(set(t))
            if share >= 0.8 - 1e-12 and all(f" {x} " in f" {' '.join(block)} " for x in lic.TELLING.get(label, [])):
                out.add((label, b, min(b + 2 * len(t), len(ws)), round(share, 9)))
    return out


def test_license_blocks_against_plain(spark):
    from tidemark.llm import licenses as lic

    rng = random.Random(2)
    texts = list(lic.TEMPLATES.values())
    vocabulary = sorted({w for t in texts for w in t.split()}) + [f"w{i}" for i in range(60)]
    rows = []
    for i in range(300):
        parts = []
        for _ in range(rng.randrange(4)):
            w = rng.choice(texts).split()
            for _ in range(rng.randrange(5)):
                w[rng.randrange(len(w))] = rng.choice(vocabulary)
            parts += rng.choices(vocabulary, k=rng.randrange(30)) + w
        rows.append((i if i % 50 else 7, " ".join(parts).title() if i % 3 else ", ".join(parts)))
    rows += [(7, rows[1][1]), (None, rows[2][1]), (None, None)]
    from collections import Counter

    got = Counter((r.doc_id, frozenset((m.label, m.start, m.end, round(m.share, 9)) for m in r.matches)) for r in scan(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == Counter((i, frozenset(plain_scan(t, None))) for i, t in rows)
    assert sum(len(k[1]) for k in got) > 200


def test_license_blocks_of_odd_rows(spark, messy):
    from collections import Counter

    clash = messy.withColumn("k", F.lit(1)).withColumn("h", F.lit("h")).withColumn("words", F.lit("w")).withColumn("matches", F.lit(0))
    got = Counter((r.doc_id, r.n_words, frozenset((m.label, m.start, m.end, round(m.share, 9)) for m in r.matches)) for r in scan(clash).collect())
    words = lambda t: len(re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t or ""))
    assert got == Counter((r.doc_id, words(r.text), frozenset(plain_scan(r.text, None))) for r in messy.collect())


def test_licenses_are_told_apart(spark):
    rows = {
        "Released under the Apache License": "", "The software was released by the team under a license": "", "Licensed under CC BY 4.0": "cc-by",
        "You can redistribute it under the terms of the GNU General Public License, version 2, as published by the Free Software Foundation.": "gpl",
        "This work is licensed under the GNU General Public License, version 2.": "gpl", "Released under the MIT License.": "mit", "Licensed under the Apache License, Version 2.0.": "apache-2.0",
        "This work is licensed under the GNU General Public License, version 3.": "gpl,gpl-3.0",
    }
    got = {r.text: r for r in scan(spark.createDataFrame([(t,) for t in rows], "text string"), id_col="text").withColumnRenamed("doc_id", "text").collect()}
    assert {t: r.labels for t, r in got.items()} == rows


def test_scan_without_templates_or_phrases(spark):
    df = spark.createDataFrame([(1, "cc by and released under the mit license")], "doc_id long, text string")
    assert [r.labels for r in scan(df, templates={}).collect()] == ["cc-by"]
    assert [(r.labels, r.n_base) for r in scan(df, phrases={}).collect()] == [("mit", 0)]


def test_samples_are_the_smallest_hashes(spark):
    from tidemark.llm.common import first_by_hash

    df = spark.range(5000).toDF("id")
    want = [r.id for r in df.orderBy(F.xxhash64("id", F.lit("s")), "id").limit(300).collect()]
    assert [r.id for r in first_by_hash(df, "id", 300, "s").collect()] == want
    assert first_by_hash(df.limit(10), "id", 300, "s").count() == 10
