"""The corpus pipeline, each stage against plain Python on the smallest tables."""

from collections import Counter

import pytest
from test_text_operators import check_packed, plain_components, plain_lines, plain_poisson

import corpus_pipeline
from tidemark.llm import queries

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """What goes into and comes out of each stage, written and read again."""
    out, docs = {}, queries.read(spark, SF, "documents")
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("pipeline") / name)
        stage(spark, docs, SF).write.parquet(path)
        out[name] = docs.collect(), spark.read.parquet(path)
        docs = out[name][1]
    return out


def test_stages_keep_the_columns(stages):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "line_dedup", "minhash", "mixing", "packing"]
    assert all(stages[n][1].columns == COLUMNS for n in names[:-1])


def test_toxic_documents_go(stages, spark):
    before, after = stages["toxicity"]
    kept = {r.doc_id for r in after.collect()}
    assert set(after.collect()) <= set(before) and len(kept) > 0.8 * len(before)
    labels = {r.doc_id: r.toxic for r in queries.read(spark, SF, "labels").collect()}
    clean = [i for i, toxic in labels.items() if not toxic]
    assert sum(i in kept for i in clean) > 0.98 * len(clean)


def test_line_dedup_stage(stages):
    before, after = stages["line_dedup"]
    want = Counter((i, t) for (i, t, _, _), n in plain_lines([(r.doc_id, r.text) for r in before]).items() for _ in range(n))
    rows = after.collect()
    assert Counter((r.doc_id, r.text) for r in rows) == want
    assert all(r.n_chars == len(r.text) for r in rows)


def test_minhash_stage(stages):
    before, after = stages["minhash"]
    comp, _ = plain_components([(r.doc_id, r.text) for r in before], 5, 80)
    assert sorted(after.collect()) == sorted(r for r in before if comp[r.doc_id] == r.doc_id)


def test_mixing_stage(stages):
    import hashlib
    import math

    before, after = stages["mixing"]
    n = Counter(r.source for r in before)
    want = Counter()
    for r in before:
        rate = len(before) / (len(n) * n[r.source])
        parts = max(1, math.ceil(rate / 16))
        for j in range(1, parts + 1):
            h = int(hashlib.sha256(f"mix|{r.doc_id}|{j}".encode()).hexdigest()[:13], 16)
            want[r] += plain_poisson(rate / parts, (h + 0.5) / 2**52)
    assert Counter(after.collect()) == +want


def test_packing_stage(stages):
    before, after = stages["packing"]
    used, least = check_packed(after.collect(), [(r.doc_id, r.text) for r in before])
    assert used <= least + 1


def test_run_is_the_stages(stages, spark):
    show = lambda df: Counter((r.doc_id, r.piece, r.length, r.ids_crc32) for r in df.collect())
    assert show(corpus_pipeline.run(spark, SF)) == show(stages["packing"][1])


def test_scratch_tables_can_be_cleared(spark):
    from pathlib import Path

    from tidemark.llm.common import Scratch, clear_scratch, work_dir

    s = Scratch(spark, "x")
    t = s.save(spark.range(3).toDF("k"))
    folder = Path(s.base)
    assert t.count() == 3 and folder.parent == Path(work_dir(spark)) and folder.exists()
    s.drop(t)
    assert not list(folder.rglob("*.parquet"))
    s.save(spark.range(3).toDF("k"))
    clear_scratch(spark)
    assert not folder.exists()


def test_run_leaves_settings_and_folders_as_they_were(spark, tmp_path):
    from pathlib import Path

    from tidemark.llm import queries
    from tidemark.llm.common import clear_scratch, work_dir

    clear_scratch(spark)
    settings = lambda: {r.key: r.value for r in spark.sql("SET").collect()}
    before, there = settings(), set(Path(work_dir(spark)).iterdir())
    corpus_pipeline.run(spark, SF).write.parquet(f"{tmp_path}/out")
    clear_scratch(spark)
    assert set(Path(work_dir(spark)).iterdir()) <= there  # the folder may hold what others left
    for name in ("op2_lattice", "op4_quality", "op7_hmm", "op10_line_dedup"):
        queries.QUERIES[name](spark, SF)
    assert settings() == before
    clear_scratch(spark)


def test_a_cluster_needs_a_shared_folder(monkeypatch):
    from types import SimpleNamespace

    from tidemark.llm import common

    class Conf(dict):
        pass

    context = SimpleNamespace(getConf=lambda: Conf(), applicationId="app-x", master="spark://host:7077")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        common.work_dir(SimpleNamespace(sparkContext=context, conf=Conf()))


def test_stages_take_odd_rows(spark, messy, empty):
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF).count() == 0, name
        out = stage(spark, messy, SF)
        rows = out.count()
        if name != "packing":
            assert out.columns == messy.columns, name
        if name in ("toxicity", "line_dedup"):
            assert rows == messy.count(), name
        if name == "minhash":
            comp, _ = plain_components([(r.doc_id, r.text) for r in messy.collect()], 5, 80)
            want = Counter(r.doc_id for r in messy.collect() if r.doc_id is None or comp[r.doc_id] == r.doc_id)
            assert Counter(r.doc_id for r in out.collect()) == want
        if name == "packing":
            check_packed(out.collect(), [(r.doc_id, r.text) for r in messy.collect()])
        if name == "mixing":
            per = Counter((r.doc_id, r.text) for r in out.collect())
            assert set(per) <= {(r.doc_id, r.text) for r in messy.collect()}
            assert per[5, "one two three four five six"] == 2 * per[5, "another text under the same id as before"]  # two rows and one, copied alike
