"""Bounded subscriptions, watchers of queries, sessions and late events, in running streams; ranks and pairs by hand."""

import random
from collections import Counter
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.operators.futures import nearest_strikes, option_pairs
from tidemark.operators.liquidity import market_beta
from tidemark.operators.ranks import rank_in_history
from tidemark.streaming.sessions import sessions, split_late
from tidemark.streaming.subscription import StatusWatcher, subscribe, watching

EVENT = "at timestamp, k string, v double"


def put(spark, path, *rows):
    spark.createDataFrame(list(rows), EVENT).coalesce(1).write.mode("append").parquet(path)


def stream(spark, path, files=1):
    return spark.readStream.schema(EVENT).option("maxFilesPerTrigger", files).parquet(path)


def test_a_subscription_ends_at_the_first_fresh_event(spark, tmp_path):
    now = datetime.now()
    put(spark, f"{tmp_path}/in", (now - timedelta(hours=1), "old", 1.0), (now, "new", 2.0), (now + timedelta(seconds=30), "later", 3.0), (None, "none", 4.0))
    got = subscribe(stream(spark, f"{tmp_path}/in"), "at", timeout_s=60, tolerance_s=600)
    assert (got.status, got.accepted, got.stopped, got.received, got.fresh, got.sample.k) == ("PASS", True, True, 4, 2, "new")
    assert not spark.streams.active


def test_a_subscription_ends_at_its_time(spark, tmp_path):
    put(spark, f"{tmp_path}/in", (datetime(2020, 1, 1), "old", 1.0), (datetime(2100, 1, 1), "ahead", 1.0))
    got = subscribe(stream(spark, f"{tmp_path}/in"), "at", timeout_s=8, checkpoint=f"{tmp_path}/check")
    assert (got.status, got.received, got.fresh, got.sample.k, got.last_event.year, got.stopped) == ("STALE", 2, 0, "old", 2100, True)
    again = subscribe(stream(spark, f"{tmp_path}/in"), "at", timeout_s=2, checkpoint=f"{tmp_path}/check")  # nothing new since
    assert (again.status, again.received, again.sample, again.stopped) == ("EMPTY", 0, None, True) and not spark.streams.active


def test_a_subscription_that_fails_stops_too(spark, tmp_path):
    put(spark, f"{tmp_path}/in", (datetime.now(), "x", 1.0))
    broken = stream(spark, f"{tmp_path}/in").withColumn("v", F.raise_error("no feed").cast("double"))
    with pytest.raises(Exception, match="no feed"):
        subscribe(broken.where("v > 0"), "at", timeout_s=60, tolerance_s=600)
    assert not spark.streams.active


def test_queries_are_watched(spark, tmp_path):
    put(spark, f"{tmp_path}/in", (datetime(2026, 1, 1), "x", 1.0), (datetime(2026, 1, 2), "y", 1.0))
    with watching(spark, names={"seen"}) as w:
        assert w.status == "EMPTY" and not w.wait("started", 0.1)
        for name in ("seen", "other"):
            stream(spark, f"{tmp_path}/in").withWatermark("at", "1 hour").writeStream.trigger(availableNow=True).format("memory").queryName(name).start().awaitTermination()
        assert w.wait("ended", 20) and w.status == "PASS"
        rows = w.table(spark).collect()
    assert {r.query for r in rows} == {"seen"} and [r.kind for r in rows][0] == "started" and {"progressed", "ended"} <= {r.kind for r in rows}
    assert sum(r.rows or 0 for r in rows) == 2 and all(r.error is None for r in rows) and len({r.run for r in rows}) == 1
    few = StatusWatcher(most=2)
    for i in range(5):
        few._add("r", "progressed", i)
    assert [r.batch for r in few.table(spark).collect()] == [3, 4]


def test_failures_are_told(spark, tmp_path):
    put(spark, f"{tmp_path}/in", (datetime(2026, 1, 1), "x", 1.0))
    with watching(spark) as w:
        q = stream(spark, f"{tmp_path}/in").select(F.raise_error("bad row").cast("string").alias("x")).writeStream.format("memory").queryName("fails").start()
        with pytest.raises(Exception, match="bad row"):
            q.awaitTermination()
        assert w.wait("ended", 20)
        assert any("bad row" in (r.error or "") for r in w.table(spark).collect())


def plain_sessions(rows, gap):
    out, by = [], {}
    for at, k, _ in sorted((r for r in rows if r[0]), key=lambda r: r[0]):
        if k in by and at - by[k][1] <= gap:
            by[k][1], by[k][2] = at, by[k][2] + 1
        else:
            by[k] = [at, at, 1]
            out.append((k, by[k]))
    return Counter((k, s, e, n) for k, (s, e, n) in out)


def test_sessions_of_a_batch(spark):
    rng = random.Random(2)
    rows = [(datetime(2026, 1, 1) + timedelta(minutes=rng.randrange(600)) if rng.random() > 0.05 else None, rng.choice(["a", "b", None]), 1.0) for _ in range(120)]
    got = sessions(spark.createDataFrame(rows, EVENT), ["k"], "at", "10 minutes", total=F.sum("v")).collect()
    assert Counter((r.k, r.started, r["last"], r.n) for r in got) == plain_sessions(rows, timedelta(minutes=10))
    assert all(r.total == r.n for r in got)


def test_late_events_are_kept_beside_the_sessions(spark, tmp_path):
    import time

    t = lambda h, m=0: datetime(2026, 1, 1, h, m)
    batches = [
        [(t(10), "a", 1.0), (t(10, 5), "a", 2.0), (t(10), "b", 1.0)],
        [(t(12), "a", 3.0), (t(9, 30), "b", 9.0)],  # half an hour back: within the delay
        [(t(14), "b", 4.0), (t(10, 20), "a", 7.0), (None, "a", 8.0)],  # its session has ended: late
        [(t(18), "c", 5.0), (t(13, 30), "b", 6.0)],
        [(t(23), "z", 0.0), (t(9), "c", 1.0)],
    ]
    for b in batches:
        put(spark, f"{tmp_path}/in", *b)
        time.sleep(1.1)  # files are taken by age
    late, folder = [], f"{tmp_path}/on-time"

    def on_time(df, _):
        df.coalesce(1).write.mode("append").parquet(folder)

    split = split_late(spark, f"{tmp_path}/state", "at", 3600, 600, on_time, lambda df, _: late.extend(map(tuple, df.collect())))
    stream(spark, f"{tmp_path}/in").writeStream.trigger(availableNow=True).foreachBatch(split).start().awaitTermination()
    assert sorted(late, key=str) == sorted([(t(10, 20), "a", 7.0), (None, "a", 8.0), (t(9), "c", 1.0)], key=str)
    kept = [tuple(r) for r in spark.read.parquet(folder).collect()]
    told = sessions(stream(spark, folder), ["k"], "at", "10 minutes", late="1 hour")
    told.writeStream.trigger(availableNow=True).format("memory").queryName("told").outputMode("append").start().awaitTermination()
    ended = Counter((r.k, r.started, r["last"], r.n) for r in spark.table("told").collect())
    want = plain_sessions(kept, timedelta(minutes=10))
    assert ended == Counter({k: n for k, n in want.items() if k[0] != "z"})  # the last one is still open
    assert len(kept) + len(late) == sum(map(len, batches))


def test_a_batch_that_is_done_again_is_split_alike(spark, tmp_path):
    out = []
    split = split_late(spark, str(tmp_path), "at", 60, 60, lambda df, n: out.append((n, df.count())), lambda df, n: out.append((n, df.count())))
    frame = lambda *rows: spark.createDataFrame(list(rows), EVENT)
    first, second = frame((datetime(2026, 1, 1, 12), "a", 1.0)), frame((datetime(2026, 1, 1, 20), "a", 1.0), (datetime(2026, 1, 1, 9), "a", 1.0))
    split(first, 0)
    for _ in range(3):
        split(second, 1)
    assert out == [(0, 1), (0, 0)] + [(1, 1), (1, 1)] * 3


@pytest.mark.parametrize("n", [1, 3, 40])
def test_ranks_against_plain(spark, n):
    rng = random.Random(n)
    rows = [(k, date(2026, 1, 1) + timedelta(d), rng.choice([None, float("nan"), 1.0, 2.0, rng.random()])) for k in ("a", "b", None) for d in range(60)]
    got = rank_in_history(spark.createDataFrame(rows, "stock_code string, trade_date date, x double").repartition(5), "x", n)
    want = {}
    for i, (k, d, x) in enumerate(rows):
        h = [v for kk, _, v in rows[max(0, i - n + 1) : i + 1] if kk == k and v is not None and v == v]
        want[k, d] = None if x is None or x != x else sum(v <= x for v in h) / len(h)
    assert {(r.stock_code, r.trade_date): r.ts_percentile for r in got.collect()} == want
    assert rank_in_history(spark.createDataFrame([], "stock_code string, trade_date date, x double"), "x", n).count() == 0


def test_a_constant_market_has_no_slope(spark):
    import numpy as np

    day = lambda i: date(2026, 1, 1) + timedelta(i)
    flat = [(day(i), c, 10.0 * 1.001**i, 10.0) for i in range(60) for c in ("a", "b")]
    got = market_beta(spark.createDataFrame(flat, "trade_date date, stock_code string, close double, amount double"), 30).collect()
    assert {r.beta for r in got} == {None} and {r.residual for r in got} == {None}
    rng = np.random.default_rng(1)
    m = rng.normal(size=80) * 0.01
    price = {c: 100 * np.cumprod(1 + s * m + rng.normal(size=80) * e) for c, s, e in (("a", 0.5, 1e-4), ("b", 1.5, 1e-4))}
    rows = [(day(i), c, float(p[i]), 5.0) for c, p in price.items() for i in range(80)]
    got = {(r.stock_code, r.trade_date): r for r in market_beta(spark.createDataFrame(rows, "trade_date date, stock_code string, close double, amount double"), 40).collect()}
    ret = {c: np.concatenate([[np.nan], p[1:] / p[:-1] - 1]) for c, p in price.items()}
    market = (ret["a"] + ret["b"]) / 2
    for c in "ab":
        assert got[c, day(10)].beta is None  # too few pairs
        slope, level = np.polyfit(market[40:80], ret[c][40:80], 1)
        last = got[c, day(79)]
        assert abs(last.beta - slope) < 1e-9 and abs(last.residual - (ret[c][79] - level - slope * market[79])) < 1e-12 and abs(last.residual_amihud - abs(last.residual) / 5) < 1e-15


def test_futures_and_options_are_paired(spark):
    fut = spark.createDataFrame([("S", "cu", None, 5.0, False), ("S", "al", date(2026, 6, 1), 1.0, True), ("S", "zn", date(2020, 1, 1), 99.0, True), ("D", "m", None, None, None), ("D", "n", None, 3.0, False), ("E", "x", date(2020, 1, 1), 1.0, True)], "market string, code string, expire_date date, volume double, is_main boolean")
    opt = spark.createDataFrame([("S", "cuC1", "cu", None, 7.0), ("S", "cuC2", "cu", None, 7.0), ("S", "alC1", "al", date(2020, 1, 1), 9.0), ("S", "znC1", "zn", None, 9.0)], "market string, code string, underlying string, expire_date date, volume double")
    pairs = lambda o: {r.market: (r.future, r.option) for r in option_pairs(fut, o, "2026-01-05").collect()}
    assert pairs(opt) == {"S": ("cu", "cuC1"), "D": ("n", None)}  # the main contract's only option has expired
    assert pairs(opt.limit(0)) == {"S": ("al", None), "D": ("n", None)}


def test_the_nearest_strike_is_taken(spark):
    bars = spark.createDataFrame([(date(2026, 1, 5), "f", 10.0), (date(2026, 3, 5), "f", 10.0), (date(2026, 1, 5), "g", 1.0), (date(2026, 1, 6), "f", None)], "trade_date date, contract_code string, close double")
    chain = [("lo", "f", "C", 9.0, None, date(2026, 2, 1)), ("hi", "f", "C", 11.0, None, None), ("soon", "f", "C", 9.0, None, date(2026, 1, 20)), ("exact", "f", "C", 10.0, date(2026, 1, 6), date(2026, 2, 1)), ("put", "f", "P", 50.0, None, date(2026, 1, 5)), ("none", "f", "C", None, None, None)]
    got = nearest_strikes(bars, spark.createDataFrame(chain, "code string, underlying string, kind string, strike double, list_date date, expire_date date"))
    assert sorted((r.trade_date.month, r.kind, r.option, r.gap) for r in got.collect()) == [(1, "C", "soon", 1.0), (1, "P", "put", 40.0), (3, "C", "hi", 1.0)]


def test_details_are_asked_in_batches(spark, tmp_path):
    from tidemark.sources.feed import instrument_details

    def fetch(codes):
        if len(codes) > 3:
            raise ValueError("too many at once")
        if "bad" in codes:
            raise RuntimeError("no such code")
        return {c: {"Name": c.upper(), "Volume": 3, "Expire": None} if c != "empty" else {} for c in codes if c != "unknown"}

    codes = spark.createDataFrame([(c,) for c in ["a", "b", "a", None, "bad", "empty", "unknown", "c"]], "code string").coalesce(1)
    for size in (1, 2, 100):
        got = {r.code: (r.detail, r.error) for r in instrument_details(codes, fetch, batch=size).collect()}
        assert got == {c: ({"Name": c.upper(), "Volume": "3", "Expire": None}, None) for c in "abc"} | {"bad": (None, "RuntimeError: no such code")}
    assert instrument_details(codes.limit(0), fetch).count() == 0
