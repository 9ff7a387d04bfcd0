"""Levelled runs, pruning by known ranges, gates within the write, calendars that grow."""

import random
from collections import Counter
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.operators import calendar as cal
from tidemark.operators.quality import Gate, QualityError, bar_gate, bar_rules, financial_gate, financial_rules, master_gate, master_rules
from tidemark.operators.versions import ingested_order, latest_version
from tidemark.plans.store import Store

ROW = "trade_date date, stock_code string, close double, _ingested_at string"
KEYS = ["trade_date", "stock_code"]


def batch(spark, rng, i, n=12, days=20):
    stamp = lambda: f"2026-01-{rng.randint(1, 28):02d}T00:00:00.{i:06d}+00:00"  # noqa: E731  later runs may hold older rows
    rows = [(None if rng.random() < 0.05 else date(2026, 1, 1) + timedelta(rng.randrange(days)), rng.choice(["A", "B", "C", None]), None if rng.random() < 0.2 else float(i), stamp()) for _ in range(n)]
    return spark.createDataFrame(rows, ROW)


def content(df):
    return Counter(tuple(r[c] for c in ("trade_date", "stock_code", "close", "_ingested_at")) for r in df.collect())


def plain(store, where=None):
    return content(latest_version(store.read("raw", "x"), KEYS, ingested_order(), F.expr(where) if where else None))


@pytest.mark.parametrize("where", [None, "close is not null"])
def test_merged_runs_show_the_same(spark, tmp_path, where):
    rng, s = random.Random(3), Store(spark, str(tmp_path))
    for i in range(9):
        s.publish("raw", "x", batch(spark, rng, i), date="trade_date", ranges=["stock_code"])
    want, rows = plain(s, where), s.load("raw", "x").rows
    assert content(s.latest("raw", "x", KEYS, where)) == want
    m = s.compact("raw", "x", KEYS, where, fan_in=3)
    assert [r.level for r in m.runs] == [2] and m.runs[0].unique == KEYS and m.rows < rows == 108
    assert len(m.tombstones) == 12  # nine runs and the three that they became first
    assert content(s.latest("raw", "x", KEYS, where)) == want == plain(s, where)
    for i in range(9, 11):  # newer runs, with older rows among them, over a merged one
        s.publish("raw", "x", batch(spark, rng, i), date="trade_date", ranges=["stock_code"])
    got = s.latest("raw", "x", KEYS, where)
    assert content(got) == plain(s, where)
    assert s.compact("raw", "x", KEYS, where, fan_in=3) is None
    assert content(s.latest("raw", "x", KEYS, where)) == plain(s, where)
    for key_range in ({"trade_date": ("2026-01-05", "2026-01-09")}, {"stock_code": ("B", None), "trade_date": (None, "2026-01-03")}):
        bounded = content(s.latest("raw", "x", KEYS, where, within=key_range))
        day, code = key_range.get("trade_date", (None, None)), key_range.get("stock_code", (None, None))
        inside = lambda v, b: b == (None, None) or (v is not None and (b[0] is None or v >= b[0]) and (b[1] is None or v <= b[1]))
        assert bounded == Counter({k: n for k, n in plain(s, where).items() if inside(k[0] and str(k[0]), day) and inside(k[1], code)})
    with pytest.raises(ValueError, match="no keys"):
        s.latest("raw", "x", KEYS, within={"close": ("1", "2")})


def test_only_newer_runs_are_put_in_order(spark, tmp_path):
    rng, s = random.Random(4), Store(spark, str(tmp_path))
    for i in range(4):
        s.publish("raw", "x", batch(spark, rng, i), date="trade_date")
    s.compact("raw", "x", KEYS, everything=True)
    plan = s.latest("raw", "x", KEYS)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Exchange" not in plan  # what is merged is read as it is
    assert s.compact("raw", "x", KEYS, everything=True) is None


def test_many_runs_are_one_scan(spark, tmp_path):
    s = Store(spark, str(tmp_path))
    one = spark.createDataFrame([(date(2026, 1, 1), "A", 1.0, "2026-01-01T00:00:00+00:00")], ROW)
    s.publish("raw", "x", one, date="trade_date")
    m, first = s.load("raw", "x"), s.load("raw", "x").runs[0]
    from dataclasses import replace

    m.runs = [replace(first) for _ in range(200)]  # 200 folders in the manifest; that they are the same one doesn't matter to the plan
    s._activate(m)
    plan = s.read("raw", "x")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation") == 1 and "Union" not in plan
    s.publish("raw", "x", one.withColumn("more", F.lit(1)), date="trade_date")
    plan = s.read("raw", "x")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation") == 2


def test_bounds_choose_runs_and_files(spark, tmp_path):
    s = Store(spark, str(tmp_path))
    day = lambda i: date(2026, 1, 1) + timedelta(i)
    for i in range(6):
        s.publish("raw", "x", spark.createDataFrame([(day(10 * i + j), "AB"[j % 2], float(j), None) for j in range(10)], ROW).coalesce(1), date="trade_date", ranges=["stock_code"])
    within = {"trade_date": ("2026-01-11", "2026-01-25")}
    full, part = s.read("raw", "x"), s.read("raw", "x", within)
    assert len(full.inputFiles()) == 6 and len(part.inputFiles()) == 2 and part.count() == 15
    assert s.read("raw", "x", {"trade_date": ("2030-01-01", None)}).count() == 0 == len(s.read("raw", "x", {"stock_code": ("C", None)}).collect())
    before = content(full)
    m = s.compact("raw", "x", everything=True, file_rows=10)
    assert content(s.read("raw", "x")) == before and m.runs[0].unique is None
    part = s.read("raw", "x", within)
    assert 1 <= len(part.inputFiles()) < len(s.read("raw", "x").inputFiles()) and part.count() == 15
    assert s.read("raw", "x", {"trade_date": ("2030-01-01", None)}).count() == 0
    with pytest.raises(ValueError, match="close"):
        s.publish("raw", "x", full, ranges=["close"])


def test_a_merge_that_fails_changes_nothing(spark, tmp_path, monkeypatch):
    rng, s = random.Random(5), Store(spark, str(tmp_path))
    for i in range(3):
        s.publish("raw", "x", batch(spark, rng, i), date="trade_date")
    before, m = content(s.latest("raw", "x", KEYS)), s.load("raw", "x")

    def dies(_):
        raise OSError("power")

    with monkeypatch.context() as patched:
        patched.setattr(s, "_activate", dies)
        with pytest.raises(OSError):
            s.compact("raw", "x", KEYS, everything=True)
    assert s.load("raw", "x") == m and content(s.latest("raw", "x", KEYS)) == before
    left = [p for p in (tmp_path / "raw/x").iterdir()]
    assert len(left) == 4 and len(s.vacuum("raw", "x")) == 1
    s.compact("raw", "x", KEYS, everything=True)
    used = s.used()
    assert len(s.vacuum("raw", "x")) == 3 and s.used() < used and s.load("raw", "x").tombstones == []
    assert content(s.latest("raw", "x", KEYS)) == before and len(list((tmp_path / "raw/x").iterdir())) == 1


def test_older_manifests_are_read(spark, tmp_path):
    import json

    s = Store(spark, str(tmp_path))
    s.publish("raw", "x", batch(spark, random.Random(1), 1), date="trade_date")
    before = content(s.read("raw", "x"))
    path = tmp_path / "metadata/raw/x/active.json"
    m = json.loads(path.read_text())
    m["folders"] = [r["folder"] for r in m.pop("runs")]
    for new in ("schema_version", "tombstones"):
        m.pop(new)
    s.files_.write(str(path), json.dumps(m))
    assert content(s.read("raw", "x")) == before == content(s.read("raw", "x", {"trade_date": (None, None)}))
    assert s.publish("raw", "x", batch(spark, random.Random(2), 2)).schema_version == "1.0" and len(s.load("raw", "x").runs) == 2


def bar_rows(spark, n=40):
    rng = random.Random(n)
    rows = [(date(2026, 1, rng.randint(1, 28)) if rng.random() > 0.05 else None, rng.choice(["A", "B", None]), *(rng.choice([None, 0.0, 1.0, 2.0, 5.0]) for _ in range(4)), rng.choice([None, -1.0, 3.0]), rng.choice([-2.0, 1.0])) for _ in range(n)]
    return spark.createDataFrame(rows, "trade_date date, stock_code string, open double, high double, low double, close double, volume double, amount double")


def observed(rows, gate):
    got = rows.agg(*[c.alias(r) for r, (_, c) in gate.rules.items()]).first().asDict()
    return {r: got[r] for r in gate.rules}


def test_gates_count_as_rules_do(spark):
    report = lambda df: {r.rule: r["count"] for r in df.collect()}
    bars = bar_rows(spark).dropDuplicates(KEYS)
    twice = bars.unionByName(bars.limit(5))
    assert observed(*bar_gate(bars)) == report(bar_rules(bars))
    assert observed(*bar_gate(twice))["business_key_unique"] == report(bar_rules(twice))["business_key_unique"] == 5
    master = spark.createDataFrame([("A", date(2020, 1, 1), date(2019, 1, 1), "X"), ("A", None, None, "INVALID_SENTINEL_IGNORED"), (None, None, None, None), (None, None, None, None)], "stock_code string, list_date date, delist_date date, delist_date_quality string")
    assert observed(*master_gate(master)) == report(master_rules(master))
    fin = spark.createDataFrame([("A", "p", date(2020, 1, 1), date(2020, 1, 1)), ("A", "p", None, None)], "stock_code string, report_period string, announce_date date, available_date date")
    assert observed(*financial_gate(fin)) == report(financial_rules(fin))


def test_a_broken_batch_leaves_the_manifest(spark, tmp_path):
    s = Store(spark, str(tmp_path))
    good = spark.createDataFrame([(date(2026, 1, 5), "A", 1.0, 2.0, 1.0, 1.5, 3.0)], "trade_date date, stock_code string, open double, high double, low double, close double, volume double")
    rows, gate = bar_gate(good)
    s.publish("processed", "stock_daily", rows, date="trade_date", gate=gate)
    m = s.load("processed", "stock_daily")
    assert not {"_again", "_extreme"} & set(spark.read.parquet(m.folders[0]).columns)
    rows, gate = bar_gate(good.unionByName(good.withColumn("high", F.lit(0.5))))
    with pytest.raises(QualityError, match="business_key_unique=1; ohlc_bounds=1"):
        s.publish("processed", "stock_daily", rows, date="trade_date", gate=gate)
    assert s.load("processed", "stock_daily") == m and len(list((tmp_path / "processed/stock_daily").iterdir())) == 1


def test_a_gate_reads_its_rows_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    df = spark.range(1000).withColumn("k", F.lit("A")).mapInArrow(count, "id long, k string")
    Store(spark, str(tmp_path)).publish("raw", "x", df, ranges=["k"], gate=Gate({"odd": ("WARN", F.count_if(F.col("id") % 2 == 1)), "negative": ("ERROR", F.count_if(F.col("id") < 0))}))
    assert seen.value == 1000


@pytest.mark.parametrize("seed", range(3))
def test_a_calendar_in_parts_is_that_of_all_days(spark, tmp_path, seed):
    from tidemark.plans.pipeline import Builder

    rng = random.Random(seed)
    days = [date(2026, 1, 1) + timedelta(i) for i in range(60) if rng.random() < 0.6]
    cut = {0: [days[:20], days[20:]], 1: [days[30:], days[:30]], 2: [days[::3], days[1::3], days[2::3]]}[seed]
    b = Builder(Store(spark, str(tmp_path)))
    frame = lambda ds: spark.createDataFrame([(d,) for d in ds], "trade_date date")
    b.calendar(frame([date(2020, 1, 1)]), "OTHER")
    for part in cut:
        b.calendar(frame(part), "SH")
    assert _keyed(b.latest("trade_calendar")) == _keyed(cal.trade_calendar(frame(days), "SH"))
    runs = len(b.store.load("processed", "trade_calendar").runs)
    b.calendar(frame(days[5:9]), "SH")  # nothing new
    assert len(b.store.load("processed", "trade_calendar").runs) == runs


def _keyed(df):
    return sorted(((r.trade_date, r.previous_trade_date, r.next_trade_date) for r in df.where("market = 'SH'").collect()), key=lambda t: t[0])
