"""Operators that rewrite, group or pack texts, against plain Python."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import queries
from tidemark.llm.line_dedup import LineRuns, line_dedup
from tidemark.llm.minhash import near_duplicates, sketch
from tidemark.llm.mixing import mix, poisson
from tidemark.llm.packing import best_fit, encode, pack, solve_configs


def lower(s):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)


# --- lines -----------------------------------------------------------------------------------------------------


def plain_lines(rows, least=10):
    key = lambda x: lower(x.strip(" \t\n\x0b\x0c\r"))
    last = 1 << 63
    owner = {}
    for i, t in rows:
        for x in (t or "").split("\n"):
            if len(k := key(x)) >= least:
                owner[k] = min(owner.get(k, last), last if i is None else i)
    out = Counter()
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if owner.get(key(x), last if i is None else i) == (last if i is None else i)]
        out[i, "\n".join(kept), len(lines), len(lines) - len(kept)] += 1
    return out


@pytest.mark.parametrize("batches,fan_in", [(1, 2), (4, 2), (5, 3)])
def test_lines_against_plain(spark, batches, fan_in):
    rng = random.Random(batches)
    pool = ["short", "  A line of SOME length ", "a line of some length", "éclair àéîõü ß", "123456789", "1234567890", "\tTab line here\r", ""]
    rows = [(rng.choice([i, i, i, rng.randrange(40), None]), None if rng.random() < 0.05 else "\n".join(rng.choices([*pool, f"only in {i} here"], k=rng.randrange(6)))) for i in range(60)]
    got = line_dedup(spark.createDataFrame(rows, "doc_id long, text string"), batches=batches, fan_in=fan_in)
    assert Counter((r.row.doc_id, r.kept_text, r.n_lines, r.n_dropped) for r in got.collect()) == plain_lines(rows)


def test_lines_messy(messy, empty):
    rows = [(r.doc_id, r.text) for r in messy.collect()]
    got = line_dedup(messy)
    assert got.select("row.*").columns == messy.columns
    assert Counter((r.row.doc_id, r.kept_text, r.n_lines, r.n_dropped) for r in got.collect()) == plain_lines(rows)
    assert line_dedup(empty).count() == 0


def test_a_failure_leaves_no_names(spark, monkeypatch):
    docs = spark.createDataFrame([(i, "a line that all hold\n" + f"a line of {i} alone") for i in range(20)], "doc_id long, text string")
    before = {t.name for t in spark.catalog.listTables()}

    def dies(self, keys):
        raise OSError("disk")

    monkeypatch.setattr(LineRuns, "drops", dies)
    with pytest.raises(OSError):
        line_dedup(docs)
    assert {t.name for t in spark.catalog.listTables()} == before


def test_runs_last(spark, tmp_path):
    rng = random.Random(11)
    rows = [(i, "\n".join(rng.choices([f"a line with number {j}" for j in range(40)] + ["short", ""], k=6))) for i in range(90)]
    schema = "doc_id long, text string"
    got = Counter()
    for lo in (0, 30, 60):  # each batch by a store of its own, as in a new session
        runs = LineRuns(spark, f"{tmp_path}/runs", buckets=3)
        out = runs.add_batch(spark.createDataFrame(rows[lo : lo + 30], schema))
        got.update((r.row.doc_id, r.kept_text, r.n_lines, r.n_dropped) for r in out.collect())
        runs.close()
    assert got == plain_lines(rows)
    assert sorted(level for level, _ in LineRuns(spark, f"{tmp_path}/runs").runs) == [0, 1]
    assert len(list((tmp_path / "runs").glob("run-*"))) == 2  # merged runs are gone
    late = LineRuns(spark, f"{tmp_path}/runs")
    (r,) = late.add_batch(spark.createDataFrame([(-5, rows[0][1])], schema)).collect()
    assert [x for x in r.kept_text.split("\n") if len(x) >= 10] == []  # an earlier batch has them, whatever the ids
    late.close()


def test_runs_are_not_shuffled(spark, tmp_path):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        runs = LineRuns(spark, f"{tmp_path}/runs", buckets=4)
        keys = spark.range(1000).selectExpr("id as doc", "id % 70 as k1", "id % 7 as k2")
        runs.add(keys.where("doc < 500"))
        plan = runs.new_keys(runs.sort_batch(keys.where("doc >= 500")))._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "LeftAnti" in plan and "Bucketed: true" in plan, plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize(("partitions", "broadcast"), [(4, "-1"), (4, "10MB"), (7, "-1"), (7, "10MB"), (3, "10MB")])
def test_runs_are_merged_as_they_lie(spark, tmp_path, partitions, broadcast):
    """Whatever the session's settings are, neither batch nor runs are shuffled, sorted or broadcast in the join."""
    names = {"spark.sql.shuffle.partitions": str(partitions), "spark.sql.autoBroadcastJoinThreshold": broadcast}
    before = {n: spark.conf.get(n) for n in names}
    order = spark.conf.get("spark.sql.legacy.bucketedTableScan.outputOrdering")
    runs = LineRuns(spark, f"{tmp_path}/runs", buckets=4, fan_in=3)
    try:
        for n, v in names.items():
            spark.conf.set(n, v)
        keys = spark.range(3000).selectExpr("id as doc", "id % 700 + cast(id / 1000 as int) * 400 as k1", "id % 7 as k2")
        runs.add(keys.where("doc < 1000"))
        runs.add(keys.where("doc between 1000 and 1999"))
        last = keys.where("doc >= 2000")
        with runs.as_stored():
            new = runs.new_keys(runs.sort_batch(last))
            plan = new._jdf.queryExecution().executedPlan().toString()
            got = sorted((r.k1, r.k2, r.owner) for r in new.collect())
        assert spark.conf.get("spark.sql.legacy.bucketedTableScan.outputOrdering") == order
    finally:
        runs.close()
        for n, v in before.items():
            spark.conf.set(n, v)
    assert plan.count("SortMergeJoin") == 2 and "Broadcast" not in plan and plan.count("Bucketed: true") == 3, plan
    assert "Exchange" not in plan and "Sort [" not in plan, plan
    key = lambda i: (i % 700 + i // 1000 * 400, i % 7)
    old, want = {key(i) for i in range(2000)}, {}
    for i in range(2000, 3000):
        if key(i) not in old:
            want.setdefault(key(i), i)
    assert got == sorted((*k, i) for k, i in want.items()) and got


# --- near duplicates -------------------------------------------------------------------------------------------


def shingle_set(text, size):
    w = [x for x in lower(text or "").replace("\t", " ").replace("\n", " ").replace("\x0b", " ").replace("\x0c", " ").replace("\r", " ").split(" ") if x]
    return {tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()


def plain_components(rows, size, percent):
    sets = [shingle_set(t, size) for _, t in rows]
    comp = {i: i for i, _ in rows if i is not None}

    def find(x):
        while comp[x] != x:
            x = comp[x]
        return x

    for a, (i, _) in enumerate(rows):
        for b, (j, _) in enumerate(rows[:a]):
            if i is not None and j is not None and sets[a] and sets[b]:
                x = len(sets[a] & sets[b])
                if 100 * x >= percent * (len(sets[a]) + len(sets[b]) - x):
                    p, q = sorted((find(i), find(j)))
                    comp[q] = p
    return {i: find(i) for i in comp}, {i: max(len(s) for (k, _), s in zip(rows, sets, strict=True) if k == i) for i, _ in rows}


@pytest.mark.parametrize("size,percent", [(3, 85), (5, 80)])
def test_near_duplicates_against_plain(spark, size, percent):
    rng = random.Random(size)
    word = lambda: "".join(rng.choices("abcde", k=3))
    rows, bases = [], [[word() for _ in range(rng.choice([4, 30, 120, 120]))] for _ in range(12)]
    for i in range(400):  # families of near copies at every distance from their base, copies of copies among them
        w = list(rng.choice(bases))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 5, 8])):
            w[rng.randrange(len(w))] = word()
        if rng.random() < 0.2:
            bases.append(w)
        rows.append((1000 - 2 * i, " ".join(w)))
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), words_per_shingle=size, percent=percent).collect()
    comp, n = plain_components(rows, size, percent)
    assert {r.doc_id: r.component_id for r in got} == comp and len(got) == len(rows)
    assert {r.doc_id: r.n_shingles for r in got} == n
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)
    assert 20 < sum(r.kept for r in got) < 390


def test_links_stay_linear_in_a_large_family(spark, monkeypatch):
    """Near copies of one text: the edges that are kept grow with the documents, not with their pairs."""
    from tidemark.llm import minhash

    kept, real = [], minhash.components
    monkeypatch.setattr(minhash, "components", lambda scratch, edges: kept.append(edges.count()) or real(scratch, edges))
    base = [f"w{i}" for i in range(200)]

    def run(n, edits):
        rng = random.Random(n)
        rows = []
        for i in range(n):
            w = list(base)
            for _ in range(edits):
                w[rng.randrange(200)] = f"e{rng.randrange(10**9)}"
            rows.append((i, " ".join(w)))
        kept.clear()
        got = {r.doc_id: r.component_id for r in near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), words_per_shingle=3, percent=85).collect()}
        return rows, got, sum(kept)

    one, two = run(400, 2)[2], run(800, 2)[2]  # nearly all pairs are links
    assert two < 2.2 * one and two < 2 * 800
    rows, got, edges = run(400, 3)  # around the threshold: few links, each of which may be the only one
    assert got == plain_components(rows, 3, 85)[0]
    assert edges < 4 * 400  # a forest for each of four tasks


def test_near_duplicates_messy(messy, empty):
    rows = [(r.doc_id, r.text) for r in messy.collect()]
    comp, n = plain_components(rows, 5, 80)
    got = {r.doc_id: r for r in near_duplicates(messy).collect()}
    assert {i: r.component_id for i, r in got.items() if i is not None} == comp
    assert {i: r.n_shingles for i, r in got.items()} == n
    assert got[None].component_id is None and got[None].kept
    assert near_duplicates(empty).count() == 0


def test_sketch_estimates_similarity():
    rng = np.random.default_rng(3)
    for n in (1, 3, 40, 2000):
        a = rng.integers(0, 2**63, n, dtype=np.uint64)
        b = a.copy()
        b[: n // 4] = rng.integers(0, 2**63, n // 4, dtype=np.uint64)
        s = sketch(np.concatenate([a, b]), np.repeat([0, 1], n), 2, 512)
        assert (s != np.iinfo(np.uint64).max).all()
        same = len(set(a) & set(b)) / len(set(a) | set(b))
        assert abs((s[0] == s[1]).mean() - same) < 0.12


# --- mixing ----------------------------------------------------------------------------------------------------


def plain_poisson(mean, u):
    k, p = 0, np.exp(-mean)
    cdf = p
    while u >= cdf and k < 200:
        k += 1
        p *= mean / k
        cdf += p
    return k


def test_poisson_inversion(spark):
    rows = [(float(m), float(u)) for m in (0.0, 1e-9, 0.3, 1.0, 7.5, 16.0) for u in (1e-16, 0.01, 0.37, 0.5, 0.9, 0.9999, 1 - 2**-50)]
    got = spark.createDataFrame(rows, "m double, u double").select("m", "u", poisson(F.col("m"), F.col("u")).alias("k")).collect()
    assert all(r.k == plain_poisson(r.m, r.u) for r in got)


def test_mixing_rates_and_shares(spark):
    docs = spark.range(6000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 6 == 0, "rare").when(F.col("id") % 60 == 1, None).otherwise("hot").alias("source"), F.lit("t").alias("text"))
    got = mix(docs, {"rare": 2.0, "hot": 1.0, "": 1.0, "absent": 4.0}).groupBy("source").agg(F.count("*").alias("n"), F.first("rate").alias("rate")).collect()
    by = {r.source: r for r in got}
    # A source without documents takes no part: its weight isn't among those shared out.
    for s, share in (("rare", 0.5), ("hot", 0.25), ("", 0.25)):
        assert abs(by[s].n / 6000 - share) < 0.03
    big = mix(docs.where("doc_id < 10"), total=5000.0).groupBy("doc_id" if False else "row.doc_id").count().collect()
    assert {r.doc_id for r in big} == set(range(10)) and all(100 < r["count"] < 4000 for r in big)


def test_mixing_messy(messy, empty):
    out = mix(messy, total=40.0)
    assert out.select("row.*").columns == messy.columns
    rows = out.collect()
    assert rows == mix(messy, total=40.0).collect()
    per = defaultdict(list)
    for r in rows:
        per[r.row].append(r.copy)
    assert all(sorted(Counter(c)) == list(range(r_copies)) for r_copies, c in ((max(c) + 1, c) for c in per.values()))
    assert mix(empty).count() == 0


# --- packing ---------------------------------------------------------------------------------------------------


def check_packed(rows, docs, size=2048):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(queries.tokenizer_path())
    want = Counter()
    for i, t in docs:
        ids = [*tok.encode(t or "", add_special_tokens=False).ids, 0]
        for p in range(0, len(ids), size):
            part = ids[p : p + size]
            want[i, p // size, p, len(part), zlib.crc32(np.array(part, "<u4").tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    seqs = defaultdict(list)
    for r in rows:
        seqs[r.sequence_id].append((r.offset, r.length))
    for s in seqs.values():
        at = 0
        for off, n in sorted(s):
            assert off == at
            at += n
        assert at <= size
    return len(seqs), -(-sum(r.length for r in rows) // size)


def test_packing(spark):
    docs = [(r.doc_id, r.text) for r in queries.read(spark, "/root/testdata/sf0.001", "documents").select("doc_id", "text").collect()]
    rows = queries.op3_packing(spark, "/root/testdata/sf0.001").collect()
    used, least = check_packed(rows, docs)
    assert used <= least + 1


def test_packing_messy(messy, empty):
    got = pack(messy, queries.tokenizer_path(), shard_rows=2)
    check_packed(got.collect(), [(r.doc_id, r.text) for r in messy.collect()])
    assert pack(empty, queries.tokenizer_path()).collect() == []


def test_packed_sequences_hold_the_ids(spark):
    from tokenizers import Tokenizer

    docs = [(i, f"word{i} is here, " * (i * 40)) for i in range(12)] + [(None, "no id"), (3, None)]
    tok = Tokenizer.from_file(queries.tokenizer_path())
    want = Counter((i, *tok.encode(t or "", add_special_tokens=False).ids, 7) for i, t in docs)
    rows = pack(spark.createDataFrame(docs, "doc_id long, text string"), queries.tokenizer_path(), size=64, end_id=7).collect()
    sequences = defaultdict(list)
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert len(sequences[r.sequence_id]) == r.offset and len(r.ids) == r.length
        assert zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32
        sequences[r.sequence_id] += r.ids
    assert all(len(s) <= 64 for s in sequences.values())
    texts, at = Counter(), {(r.doc_id, r.start, r.ids_crc32): r.ids for r in rows if r.doc_id not in (None, 3)}
    for i in range(12):
        if i != 3:
            texts[i, *(x for k in sorted(k for k in at if k[0] == i) for x in at[k])] += 1
    assert texts == Counter({k: n for k, n in want.items() if k[0] not in (None, 3)})


def test_plan_holds_the_histogram():
    rng = random.Random(5)
    for _ in range(30):
        size = rng.choice([16, 100])
        hist = Counter(rng.randrange(1, size + 1) for _ in range(rng.choice([1, 5, 300, 3000])))
        for plan in (solve_configs(dict(hist), size, 60), best_fit(dict(hist), size)):
            held = Counter()
            for config, times in plan:
                assert times > 0 and sum(a * k for a, k in config.items()) <= size
                for a, k in config.items():
                    held[a] += k * times
            assert held == hist


def test_program_covers_every_length():
    """As many lengths as real tables have: the program covers them all, near the least, and places most tokens."""
    from tidemark.llm.packing import cover_program, program_configs

    rng, size = random.Random(8), 2048
    hist = Counter(1 + int(rng.lognormvariate(6, 1)) % (size - 1) for _ in range(9000))
    total = sum(a * n for a, n in hist.items())
    plan, cover = cover_program(dict(hist), size), Counter()
    for key, x in plan.items():
        assert x > 0 and sum(a * k for a, k in key) <= size
        for a, k in key:
            cover[a] += k * x
    assert len(hist) > 1000 and all(cover[a] >= 0.998 * n for a, n in hist.items())
    assert sum(plan.values()) <= 1.01 * total / size
    taken, left = program_configs(dict(hist), size)
    placed = sum(a * k * times for config, times in taken for a, k in config.items())
    assert placed + sum(a * n for a, n in left.items()) == total and placed > 0.9 * total
    assert sum(program_configs({1500: 40, 700: 3}, size)[1].values()) <= 2  # nothing that fills a sequence


def test_odd_code_points_get_the_tokenizers_ids():
    """Words that end in U+0130 before a sign, marks that compose once a letter is lower-cased, and others of their kind."""
    from array import array

    from tokenizers import Tokenizer

    path = queries.tokenizer_path()
    ranges = [(0x80, 0x250), (0x300, 0x600), (0xE00, 0xE60), (0x1100, 0x1180), (0x1E00, 0x2000), (0x2028, 0x2030), (0x3000, 0x3100)]
    odd = [chr(c) for lo, hi in ranges for c in range(lo, hi)] + list("\u0130\u0131\u03a3\u212b\ufb01\u200d\ufeff\U0001f600\uac00")
    rng = random.Random(1)
    texts = ["ALK\u0130, x", "ALK\u0130. x", "IY\u030a, W\u030a.", "\u03a3, \u03a3\u03a3."]
    for _ in range(20_000):
        word = lambda: "".join(rng.choice(odd if rng.random() < 0.35 else "abcXYZIi") for _ in range(rng.randint(1, 5)))
        texts.append(" ".join(word() + rng.choice(["", ".", ",", "..", ",.", "!"]) for _ in range(3)))
    want = Tokenizer.from_file(path).encode_batch_fast(texts, add_special_tokens=False)
    assert [t for t, g, w in zip(texts, encode(texts, path), want, strict=True) if g != array("I", w.ids).tobytes()] == []


@pytest.mark.parametrize("seed", range(3))
def test_no_more_sequences_than_the_tokens_fill(seed):
    """Where many lengths are at hand the plan reaches the bound, through the program."""
    rng = random.Random(seed)
    hist = Counter(min(256, max(1, int(rng.lognormvariate(3, 1)))) for _ in range(4000))
    plan = solve_configs(dict(hist), 256)
    assert sum(n for _, n in plan) == -(-sum(a * n for a, n in hist.items()) // 256)


def test_encoding_by_words():
    from tokenizers import Tokenizer

    path = queries.tokenizer_path()
    tok = Tokenizer.from_file(path)
    odd = ["", " ", "It's a test.", "a,b c, d. e.. f., g", "x\x85y z　w", "<|endoftext|> <|startoftext|>x", "ΑΣ ΣΑΣ. İstanbul", "é ́e", "\x1c\x1d 1234 5,6.", "ﬁ ẞ. ß, Ω."]
    for t, ids in zip(odd, encode(odd, path), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == tok.encode(t, add_special_tokens=False).ids, t


def test_special_tokens_keep_their_case():
    """The tokenizer tells its special tokens by case, so a text is not lower-cased around one."""
    from tokenizers import Tokenizer

    path = queries.tokenizer_path()
    tok = Tokenizer.from_file(path)
    odd = ["<|ENDOFTEXT|> A", "x<|EndOfText|>y <|endoftext|>.", "<|startoftext|>Word, <|", "a<|b 1<|2"]
    for t, ids in zip(odd, encode(odd, path), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == tok.encode(t, add_special_tokens=False).ids, t


def test_plain_words_ask_the_model_alone(monkeypatch):
    """New words of small Latin-1 letters, digits and signs need no whole tokenizer, and get its ids."""
    from tokenizers import Tokenizer

    from tidemark.llm import packing

    path = queries.tokenizer_path()
    rng = random.Random(7)
    signs = [chr(c) for c in range(33, 65)] + [chr(c) for c in range(91, 127)] + [chr(c) for c in range(0xDF, 0x100) if c != 0xF7] + ["'s", "'ll", "'re", "<", "|"]
    texts = [" ".join("".join(rng.choices(signs, k=rng.randint(1, 9))) for _ in range(40)) for _ in range(500)]
    texts = [t for t in texts if "<|" not in t]
    tok = Tokenizer.from_file(path)
    monkeypatch.setattr(packing, "_words", {})
    encode(["\u3042"], path)
    packing._words[path].tokenizer = None  # asking it fails
    got = encode(texts, path)
    assert [np.frombuffer(x, "<u4").tolist() for x in got] == [e.ids for e in tok.encode_batch_fast(texts, add_special_tokens=False)]


# --- the queries and their SQL -----------------------------------------------------------------------------------


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_queries_match_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "embeddings", "labels"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('/root/testdata/sf0.001/{t}.parquet')")
    got = queries.QUERIES[name](spark, "/root/testdata/sf0.001")
    cols = sorted(got.columns)
    want = con.sql(queries.ORACLES[name])
    show = lambda v: f"{v:.9g}" if isinstance(v, float) else str(v)
    a = sorted(tuple(show(r[c]) for c in cols) for r in got.collect())
    b = sorted(tuple(show(r[want.columns.index(c)]) for c in cols) for r in want.fetchall())
    assert sorted(want.columns) == cols and a == b


def test_sha_of_nothing(spark):
    assert hashlib.sha256(b"").hexdigest() == spark.range(1).select(F.sha2(F.lit(""), 256)).first()[0]
