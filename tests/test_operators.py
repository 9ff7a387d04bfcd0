"""Operators on literal frames: exact values, ties, nulls, boundaries."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tidemark.functions import epoch_or_text_date, number
from tidemark.operators import calendar as cal
from tidemark.operators import futures as fut
from tidemark.operators import liquidity as liq
from tidemark.operators import normalize, pit, quality, research, universe
from tidemark.operators.versions import duplicate_count, latest_version
from tidemark.sources import feed
from tidemark.sources.parquet import read_by_name


def d(text):
    return date.fromisoformat(text)


@pytest.fixture(scope="module")
def market(spark):
    futures = spark.createDataFrame(
        [(d("2026-08-20"), c, "IF", close, close - 5, 100.0, v) for c, close, v in (("IF2609.IF", 4010.0, 200.0), ("IF2612.IF", 4020.0, 300.0))],
        "trade_date date, contract_code string, product string, close double, settlement double, open_interest double, volume double",
    )
    master = spark.createDataFrame([("IF2609.IF", d("2026-09-18")), ("IF2612.IF", d("2026-12-18"))], "contract_code string, expire_date date")
    calendar = spark.createDataFrame([(d("2026-08-20"), d("2026-08-21"), True), (d("2026-08-21"), None, True)], "trade_date date, next_trade_date date, is_open boolean")
    index = spark.createDataFrame([(d("2026-08-20"), "SPOT", 4000.0)], "trade_date date, index_code string, close double")
    return futures, master, calendar, index


def test_main_contract_tie_goes_to_the_earlier_expiry(market):
    futures, master, calendar, _ = market
    eod = fut.main_contracts(futures, master)
    (r,) = eod.collect()
    assert (r.contract_code, r.selection_method, r.eligible_contract_count, r.mapping_type) == ("IF2609.IF", "MAX_OPEN_INTEREST", 2, "EOD_OBSERVED")
    (n,) = fut.next_day_mapping(eod, calendar).collect()
    assert (n.effective_trade_date, n.observation_trade_date, n.mapping_type) == (d("2026-08-21"), d("2026-08-20"), "NEXT_TRADE_DAY")


@pytest.mark.parametrize("oi,volume,winner,method", [((None, -1.0), (5.0, 7.0), "IF2612.IF", "MAX_VOLUME_FALLBACK"), ((0.0, None), (5.0, 7.0), "IF2609.IF", "MAX_OPEN_INTEREST"), ((None, -2.0), (None, -1.0), None, None)])
def test_main_contract_fallbacks(spark, market, oi, volume, winner, method):
    rows = [(d("2026-08-20"), c, "IF", o, v) for c, o, v in zip(("IF2609.IF", "IF2612.IF"), oi, volume, strict=True)]
    got = fut.main_contracts(spark.createDataFrame(rows, "trade_date date, contract_code string, product string, open_interest double, volume double"), market[1]).collect()
    assert [(r.contract_code, r.selection_method) for r in got] == ([(winner, method)] if winner else [])


def test_expired_contracts_are_no_candidates(spark, market):
    rows = [(d("2026-09-18"), "IF2609.IF", "IF", 9.0, 9.0), (d("2026-09-18"), "IF2612.IF", "IF", 1.0, 1.0)]
    (r,) = fut.main_contracts(spark.createDataFrame(rows, "trade_date date, contract_code string, product string, open_interest double, volume double"), market[1]).collect()
    assert (r.contract_code, r.eligible_contract_count) == ("IF2612.IF", 1)


def test_basis(market):
    futures, master, calendar, index = market
    eod = fut.main_contracts(futures, master)
    mapping = eod.unionByName(fut.next_day_mapping(eod, calendar))
    rows = {r.contract_code: r for r in fut.basis(futures, index, master, mapping, {"IF": "SPOT"}).collect()}
    r = rows["IF2609.IF"]
    assert (r.basis_close, r.basis_settlement, r.basis_pct, r.days_to_expiry) == (10.0, 5.0, 0.0025, 29)
    assert r.annualized_basis == pytest.approx(0.0025 * 365 / 29) and r.is_eod_main and not r.is_tradable_main
    assert not rows["IF2612.IF"].is_eod_main
    none = fut.basis(futures.withColumn("settlement", F.lit(None).cast("double")), index.withColumn("close", F.lit(0.0)), master, mapping, {"IF": "SPOT"}).collect()
    assert all(r.basis_close is None and r.basis_settlement is None and r.basis_pct is None and r.annualized_basis is None for r in none)
    late = fut.basis(futures, index, master.withColumn("expire_date", F.lit("2026-08-20").cast("date")), mapping, {"XX": "SPOT"}).collect()
    assert all(r.days_to_expiry == 0 and r.annualized_basis is None and r.spot_code is None for r in late)


def test_active_contracts_include_both_ends(spark):
    m = spark.createDataFrame([("A", "IF", d("2026-01-01"), d("2026-01-10")), ("B", "IC", None, None)], "contract_code string, product string, list_date date, expire_date date")
    on = lambda day, p=None: {r.contract_code for r in fut.active_contracts(m, p, day).collect()}
    assert on("2026-01-10") == on("2026-01-01") == {"A", "B"} and on("2026-01-11") == {"B"} and on("2026-01-05", ["IC"]) == {"B"} and on(None, []) == {"A", "B"}


def test_dates(spark):
    rows = [("1787414400000",), ("20260105",), ("20260105.0",), ("2026-01-05",), ("20260230",), ("",), (None,)]
    got = [r[0] for r in spark.createDataFrame(rows, "x string").select(epoch_or_text_date(F.col("x"))).collect()]
    assert got == [d("2026-08-23"), d("2026-01-05"), d("2026-01-05"), d("2026-01-05"), None, None, None]
    assert [r[0] for r in spark.createDataFrame([("1.5",), ("nan",), ("x",)], "x string").select(number(F.col("x"))).collect()] == [1.5, None, None]


def test_bars(spark):
    bar = "time: bigint, open: double, high: double, low: double, close: double, preClose: double, volume: double, amount: double, suspendFlag: double"
    raw = spark.createDataFrame([({"000001.SZ": [(1787414400000, 10.0, 12.0, 9.0, 11.0, 9.5, 100.0, 1000.0, 0.0)], "000002.SZ": []},)], f"m map<string, array<struct<{bar}>>>")
    (r,) = normalize.normalize_bars(normalize.flatten_codes(raw, "m", "stock_code"), "stock").collect()
    assert (r.trade_date, r.stock_code, r.pre_close, r.suspend_flag) == (d("2026-08-23"), "000001.SZ", 9.5, 0.0)
    f = spark.createDataFrame([("1787241600000", "if2608.IF", 1.0, 2.0, 1.0, 2.0, 5.0, float("nan"), 4003.0)], "time string, contract_code string, open double, high double, low double, close double, volume double, openInterest double, settelementPrice double")
    (r,) = normalize.normalize_bars(f, "future").collect()
    assert (r.settlement, r.open_interest, r["product"]) == (4003.0, None, "IF")
    with pytest.raises(ValueError, match="settlement"):
        normalize.normalize_bars(f.drop("settelementPrice"), "future")


@pytest.mark.parametrize("sentinel", normalize.SENTINELS)
def test_sentinels_are_no_dates(spark, sentinel):
    df = spark.createDataFrame([("688001.SH", "n", "20190722", "", sentinel), ("600000.SH", "n", "", "20200101", "20191231")], "code string, InstrumentName string, OpenDate string, CreateDate string, ExpireDate string")
    master = normalize.normalize_instruments(df)
    by = {r.stock_code: r for r in master.collect()}
    assert (by["688001.SH"].delist_date, by["688001.SH"].delist_date_quality, by["688001.SH"].list_date) == (None, "INVALID_SENTINEL_IGNORED", d("2019-07-22"))
    assert by["600000.SH"].list_date == d("2020-01-01") and by["600000.SH"].delist_date_quality == "SOURCE"
    with pytest.raises(quality.QualityError, match="listing_interval=1"):
        quality.enforce(quality.master_rules(master))


def test_contract_master(spark):
    df = spark.createDataFrame([("IF2609.IF", "0", "20260101", "20260918", "300")], "code string, CreateDate string, OpenDate string, ExpireDate string, VolumeMultiple string")
    (r,) = normalize.normalize_instruments(df, "future").collect()
    assert (r["product"], r.exchange, r.list_date, r.expire_date, r.multiplier) == ("IF", "IF", d("2026-01-01"), d("2026-09-18"), 300.0)


def test_bad_bars_are_stopped(spark):
    bars = spark.createDataFrame([(d("2026-01-05"), "A", 10.0, 9.0, 8.0, 11.0, -1.0)] * 2, "trade_date date, stock_code string, open double, high double, low double, close double, volume double")
    with pytest.raises(quality.QualityError, match="business_key_unique=1; ohlc_bounds=2; non_negative_volume=2"):
        quality.enforce(quality.bar_rules(bars))
    with pytest.raises(quality.QualityError, match="required_columns"):
        quality.bar_rules(bars.drop("open"))
    ok = spark.createDataFrame([(d("2026-01-05"), "A", None, None, None, 0.0, 1.0), (d("2026-01-06"), "A", 1.0, 1.0, 1.0, 1.0, None)], bars.schema)
    report = {r["rule"]: r["count"] for r in quality.bar_rules(ok).collect()}
    assert report == {"business_key_unique": 0, "ohlc_bounds": 0, "non_negative_volume": 0, "extreme_close_return": 1}
    quality.enforce(quality.bar_rules(ok))


def test_null_keys_count_as_keys(spark):
    df = spark.createDataFrame([(None, 1), (None, 1), (1, None), (1, 1)], "a int, b int")
    assert df.agg(duplicate_count(["a", "b"])).first()[0] == 1


def test_next_open_day(spark):
    days = spark.createDataFrame([(d("2026-04-30"),), (d("2026-05-06"),)], "trade_date date")
    rows = spark.createDataFrame([(d(x) if x else None,) for x in ("2026-04-30", "2026-04-29", "2025-01-01", "2026-05-05", "2026-05-06", "2027-01-01", None)], "a date")
    got = {r.a: r.available_date for r in cal.next_open_day(rows, days, "a").collect()}
    assert got == {d("2026-04-30"): d("2026-05-06"), d("2026-04-29"): d("2026-04-30"), d("2025-01-01"): d("2026-04-30"), d("2026-05-05"): d("2026-05-06"), d("2026-05-06"): None, d("2027-01-01"): None, None: None}
    assert cal.next_open_day(rows, days.limit(0), "a").where("available_date is not null").count() == 0


def test_universe_bounds(spark):
    s = spark.createDataFrame([("OLD.SH", d("2020-01-02"), d("2020-01-03")), ("OPEN.SH", None, None)], "stock_code string, list_date date, delist_date date")
    days = spark.createDataFrame([(d(f"2020-01-0{i}"), i != 4) for i in (1, 2, 3, 4, 6)], "trade_date date, is_open boolean")
    got = {(r.stock_code, r.trade_date.day) for r in universe.historical_universe(s, days).collect()}
    assert got == {("OLD.SH", 2), ("OLD.SH", 3)} | {("OPEN.SH", i) for i in (1, 2, 3, 6)}
    u = universe.historical_universe(s, days)
    assert research.universe_on(u, "ALL_A", "2020-01-02").count() == 2 and research.universe_on(u, "X", "2020-01-02").count() == 0


def test_adjustment_follows_the_date(spark):
    bars = spark.createDataFrame([(d(f"2026-01-0{i}"), "A", 10.0) for i in (4, 2, 3, 1)], "trade_date date, stock_code string, close double")
    factors = spark.createDataFrame([(d("2026-01-02"), "A", 2.0), (d("2026-01-04"), "A", 3.0)], "trade_date date, stock_code string, factor double")
    got = {r.trade_date.day: r.close_adjusted for r in universe.adjust_prices(bars, factors).collect()}
    assert got == {1: None, 2: 20.0, 3: 20.0, 4: 30.0}


FIN = "stock_code string, table_name string, report_period string, announce_date date, rank long, quantity double"


def test_snapshots_replace_whole_announcements(spark):
    rows = [("S", "Top10FlowHolder", "20251231", d("2026-03-01"), 1, 100.0), ("S", "Top10FlowHolder", "20251231", d("2026-03-01"), 2, 80.0), ("S", "Top10FlowHolder", "20251231", d("2026-04-01"), 1, 110.0)]
    days = spark.createDataFrame([(d("2026-03-02"),), (d("2026-04-02"),)], "trade_date date")
    fin = pit.assign_availability(spark.createDataFrame(rows, FIN), days)
    assert fin.select("logical_record_key").distinct().count() == 2 and fin.select("source_record_key").distinct().count() == 3 and fin.select("snapshot_version_key").distinct().count() == 2
    view = pit.pit_view(fin, [F.col("quantity")])
    known = lambda day: {(r["rank"], r.quantity) for r in pit.known_as_of(view, ["S"], day).collect()}
    assert known("2026-03-31") == {(1, 100.0), (2, 80.0)} and known("2026-04-30") == {(1, 110.0)} and known("2026-03-01") == set()
    assert pit.known_as_of(view, [], "2026-04-30").count() == 0 and pit.known_as_of(view, ["S"], "2026-04-30", ["Income"]).count() == 0


def test_revisions_and_missing_dates(spark):
    rows = [("S", "Income", "20251231", d("2026-03-01"), None, 1.0), ("S", "Income", "20251231", d("2026-04-01"), None, 2.0), ("S", "Income", "20251231", None, None, 3.0), ("S", "Income", "20240331", d("2026-04-01"), None, 4.0)]
    days = spark.createDataFrame([(d("2026-03-02"),), (d("2026-04-02"),)], "trade_date date")
    fin = pit.assign_availability(spark.createDataFrame(rows, FIN), days)
    assert {r.quantity: r.pit_quality for r in fin.collect()}[3.0] == "MISSING_ANNOUNCE_DATE"
    view = pit.pit_view(fin, [F.col("quantity")])
    assert sorted(r.quantity for r in pit.known_as_of(view, ["S"], "2026-03-31").collect()) == [1.0]
    assert sorted(r.quantity for r in pit.known_as_of(view, ["S"], "2026-12-31").collect()) == [2.0, 4.0]
    quality.enforce(quality.financial_rules(fin))
    assert {r["rule"]: r["count"] for r in quality.financial_rules(fin).collect()} == {"announce_date_present": 1, "pit_availability": 0}


def test_an_older_valid_version_comes_back(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 2, None), (None, 1, "b"), (None, 2, "c")], "k int, v int, x string")
    assert {(r.k, r.x) for r in latest_version(df, ["k"], [F.col("v")], F.col("x").isNotNull()).collect()} == {(1, "a"), (None, "c")}


def test_filters(spark):
    df = spark.createDataFrame([(d("2026-01-05"), "A"), (d("2026-01-06"), "B")], "trade_date date, stock_code string")
    assert research.daily_bars(df, []).count() == 0 and research.daily_bars(df, []).columns == df.columns
    assert research.dated(df, "2026-01-06", "2026-01-06", stock_code="B").count() == 1 and research.dated(df).count() == 2
    with pytest.raises(ValueError):
        research.main_contract_of(df, ["IF"], "OTHER")


def test_discovery(spark):
    codes = lambda *c: spark.createDataFrame([(x,) for x in c], "code string")
    details = spark.createDataFrame([("600001.SH", "gone"), ("600002.SH", "")], "code string, InstrumentName string")
    assert [r.code for r in feed.delisted_candidates(codes("600000.SH", "600001.SH", "600002.SH", "60000.SH"), codes("600000.SH"), details).collect()] == ["600001.SH"]
    assert [r.code for r in feed.contracts_of(codes("IF2609.IF", "if2612.IF", "IF26.IF", "IH2609.IF"), ["IF"]).collect()] == ["IF2609.IF", "if2612.IF"]
    members = spark.createDataFrame([("s1", "B.SH"), ("s1", "A.SH"), ("s2", "A.SH"), ("s3", "C.SH"), ("s1", "D.XX")], "sector string, code string")
    assert [r.code for r in feed.discover_codes(members, ["s1", "s2"], [".SH"]).collect()] == ["A.SH", "B.SH"]
    c = spark.createDataFrame([("IF", "A", d("2026-01-01"), 5.0), ("IF", "B", d("2027-01-01"), 3.0), ("IF", "C", d("2027-01-01"), 3.0), ("IC", "D", d("2027-01-01"), None)], "product string, contract_code string, expire_date date, volume double")
    assert {(r["product"], r.contract_code) for r in feed.most_liquid_active(c, "2026-06-01").collect()} == {("IF", "B"), ("IC", "D")}


def test_drifting_files(spark, tmp_path):
    spark.sql("select 1 as k, cast(null as int) as day, 2 as x").write.parquet(f"{tmp_path}/a")
    spark.sql("select 2 as k, date'2026-01-05' as day, 2.5d as x, 'extra' as more").write.parquet(f"{tmp_path}/b")
    from pyspark.sql.types import StructType

    schema = StructType.fromDDL("k long, day date, x double, missing string")
    got = {r.k: (r.day, r.x, r.missing) for r in read_by_name(spark, [[f"{tmp_path}/a"], [f"{tmp_path}/b"]], schema).collect()}
    assert got == {1: (None, 2.0, None), 2: (d("2026-01-05"), 2.5, None)}
    assert read_by_name(spark, [], schema).columns == ["k", "day", "x", "missing"]


def test_liquidity_edges(spark):
    bars = spark.createDataFrame([(d(f"2026-01-0{i}"), "A", 10.0, 10.0, 10.0, c, 1.0, a, cap) for i, (c, a, cap) in enumerate([(10.0, 0.0, 5.0), (9.0, 10.0, 0.0), (8.0, 10.0, 5.0), (None, 10.0, 5.0)], 1)], "trade_date date, stock_code string, open double, high double, low double, close double, volume double, amount double, ff_cap double")
    a = {r.trade_date.day: r.amihud for r in liq.amihud(bars).collect()}
    assert a[1] is None and a[2] == pytest.approx(0.01) and a[4] is None
    t = {r.trade_date.day: (r.turnover, r.turnover_z) for r in liq.turnover_z(bars).collect()}
    assert t[2][0] is None and t[1] == (0.0, None) and t[3] == (2.0, None)
    f = {r.trade_date.day: r for r in liq.trade_flags(bars).collect()}
    assert f[1].zero_amount and f[2].one_price_down and f[3].down_streak == 2 and f[4].down_streak == 0
    assert {r.trade_date.day: r.tradability for r in liq.tradability(liq.trade_flags(bars)).collect()} == {1: 0.0, 2: 0.25, 3: 0.25, 4: 1.0}
    (h,) = liq.concentration(bars.where("trade_date = '2026-01-02'"), ["trade_date"]).collect()
    assert h.hhi == 1.0 and h.hhi_normalised is None and h.top10_share == 1.0


def test_fresh_events(spark):
    from tidemark.streaming.freshness import evidence

    at = lambda s: datetime(2026, 1, 5, 10, 0, s)
    df = spark.createDataFrame([("a", at(0)), ("a", at(20)), ("a", None), ("b", at(5))], "k string, t timestamp_ntz")
    got = {r.k: (r.received, r.fresh, r.stale, r.first_fresh) for r in evidence(df, "t", F.lit("2026-01-05 10:00:10"), F.lit("2026-01-05 10:00:15"), ["k"]).collect()}
    assert got == {"a": (3, 1, 2, at(20)), "b": (1, 1, 0, at(5))}


def test_known_as_of_by_code(spark):
    from datetime import date

    from tidemark.operators import pit

    rows = [(c, t, "20251231", date(2026, 1, 5), date(2026, 1, 6), 1) for c in ("A", "B", "C") for t in ("Income", "Top10Holder")]
    df = spark.createDataFrame(rows, "stock_code string, table_name string, report_period string, announce_date date, available_date date, rank int")
    known = lambda codes: sorted((r.stock_code, r.table_name) for r in pit.known_as_of(pit.financial_keys(df), codes, "2026-01-31").collect())
    assert known(None) == sorted((r[0], r[1]) for r in rows)
    assert known(["B"]) == [("B", "Income"), ("B", "Top10Holder")] and known([]) == []


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_universe_days_come_to_dealt_securities(spark):
    """No task holds a year's members: nothing is shuffled by year, and no distinct holds members before a semi-join."""
    from tidemark.plans import queries

    plan = _plan(queries.QUERIES["q_bars_in_universe"](spark, "/root/testdata/sf0.001"))
    assert "hashpartitioning(_year" not in plan and "LeftSemi" in plan
    assert not [x for x in plan.splitlines() if "HashAggregate(keys=[trade_date" in x and "stock_code" in x.split("functions")[0]], plan


def test_rolling_median_against_plain(spark):
    import statistics

    from pyspark.sql import Window

    from tidemark.functions import rolling_median

    vals = [3.0, None, 1.0, 1.0, None, None, None, 7.5, -2.0, 4.0, 4.5, 1e300]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, v double")
    w = Window.partitionBy(F.lit(1)).orderBy("i").rowsBetween(-3, 0)
    got = [r.m for r in df.select("i", rolling_median(F.col("v"), w).alias("m")).orderBy("i").collect()]
    for i, m in enumerate(got):
        some = [v for v in vals[max(0, i - 3) : i + 1] if v is not None]
        assert m == (statistics.median(some) if some else None), i


def test_dates_are_parsed_by_their_signs(spark):
    from tidemark.functions import epoch_or_text_date

    rows = ["20240115", "2024-01-15", "2024/01/15", "2024-01-15.0", "1705276800000", "20240230", "2024-02-30", "1-2", "2024/01-15", "n/a", "", None, "1e13", "-20240115", "2024-1-5"]
    got = [r.d for r in spark.createDataFrame([(i, t) for i, t in enumerate(rows)], "i int, t string").select("i", epoch_or_text_date(F.col("t")).cast("string").alias("d")).orderBy("i").collect()]
    text = F.regexp_replace(F.trim("t"), r"\.0$", "")
    plain = F.coalesce(*[F.try_to_date(text, f) for f in ("yyyyMMdd", "yyyy-MM-dd", "yyyy/MM/dd")])
    want = [r.d for r in spark.createDataFrame([(i, t) for i, t in enumerate(rows)], "i int, t string").select("i", plain.cast("string").alias("d")).orderBy("i").collect()]
    same = [i for i, t in enumerate(rows) if t not in ("1705276800000", "1e13")]
    assert [got[i] for i in same] == [want[i] for i in same] and got[4] == "2024-01-15" and got[12] is not None


def test_lines_travel_once_to_their_stock(spark):
    """Bars, and what goes on by stock, need one shuffle of lines as they are; no sliding percentile is left."""
    from tidemark.plans import queries

    for name in ("q_adv20_adv60", "q_amihud20_60"):
        plan = _plan(queries.QUERIES[name](spark, "/root/testdata/sf0.001"))
        assert plan.count("Exchange") == 1 and "percentile" not in plan, plan


def test_contract_days_stay_with_their_contracts(spark):
    """The index and the mapping come to the contract days, which no join by day shuffles."""
    from tidemark.plans import queries

    for name in ("q_basis", "q_basis_stress"):
        plan = _plan(queries.QUERIES[name](spark, "/root/testdata/sf0.001"))
        assert "SortMergeJoin [trade_date" not in plan and "ShuffledHashJoin [trade_date" not in plan, plan
