"""The library's queries over the star-schema tables, each beside the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import detail_date, epoch_or_text_date, event_time, record_key, redact, streak_length
from ..operators import calendar as cal
from ..operators import futures as fut
from ..operators import liquidity as liq
from ..operators import flows, normalize, pit, quality, ranks, research, universe
from ..operators.versions import duplicate_count, latest_version
from ..sources import feed
from ..sources.parquet import union_by_name
from ..streaming.freshness import evidence, fresh
from ..streaming.sessions import sessions
from . import bindings as b

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql.strip()
        return f

    return add


def _r(*cols: str, digits: int = 8) -> list:
    return [F.round(c, digits).alias(c) for c in cols]


# --- versions, bars, calendars ---------------------------------------------------------------------------------

VERSION_ORDER = ("l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_discount", "l_tax", "l_returnflag", "l_linestatus")
_VERSION_SQL = ", ".join(f"{c} DESC" for c in VERSION_ORDER)
_KEPT = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, CAST(l_shipdate AS DATE) AS ship_day"


def _lines(spark: SparkSession, sf_dir: str, where=None) -> DataFrame:
    df = latest_version(b.table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], [F.col(c) for c in VERSION_ORDER], where)
    return df.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", F.col("l_shipdate").cast("date").alias("ship_day"))


@query(f"SELECT {_KEPT} FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {_VERSION_SQL}) = 1")
def q_latest_version(spark, sf_dir):
    return _lines(spark, sf_dir)


@query(f"SELECT {_KEPT} FROM lineitem WHERE l_quantity >= 10 QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {_VERSION_SQL}) = 1")
def q_view_filter_before_dedup(spark, sf_dir):
    return _lines(spark, sf_dir, F.col("l_quantity") >= 10)


@query("SELECT count(*) - count(DISTINCT (l_orderkey, l_linenumber)) AS duplicates, count(*) AS n FROM lineitem")
def q_dup_counts(spark, sf_dir):
    return b.table(spark, sf_dir, "lineitem").agg(duplicate_count(["l_orderkey", "l_linenumber"]).alias("duplicates"), F.count(F.lit(1)).alias("n"))


@query(f"WITH {b.BARS} SELECT trade_date, stock_code, round(open, 8) AS open, round(high, 8) AS high, round(low, 8) AS low, round(close, 8) AS close, volume, amount FROM bars")
def q_bars_from_ticks(spark, sf_dir):
    return b.bars(spark, sf_dir).select("trade_date", "stock_code", *_r("open", "high", "low", "close"), "volume", "amount")


@query(f"WITH {b.BARS} SELECT trade_date, stock_code, round(close, 8) AS close, volume FROM bars WHERE stock_code IN ('1', '2', '3', '5', '8') AND trade_date BETWEEN DATE '1995-01-01' AND DATE '1996-12-31'")
def q_bars_range_filter(spark, sf_dir):
    return research.daily_bars(b.bars(spark, sf_dir), ["1", "2", "3", "5", "8"], "1995-01-01", "1996-12-31").select("trade_date", "stock_code", *_r("close"), "volume")


@query(f"WITH {b.DAYS} SELECT 'X' AS market, trade_date, true AS is_open, lag(trade_date) OVER (ORDER BY trade_date) AS previous_trade_date, lead(trade_date) OVER (ORDER BY trade_date) AS next_trade_date FROM days")
def q_calendar_prev_next(spark, sf_dir):
    return cal.trade_calendar(b.open_days(spark, sf_dir), "X")


@query(f"""WITH {b.DAYS}, l AS (SELECT l_orderkey, l_linenumber, l_partkey, CAST(l_shipdate AS DATE) AS announced FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, announced, d.trade_date AS available_date FROM l ASOF LEFT JOIN days d ON l.announced < d.trade_date""")
def q_next_open_day(spark, sf_dir):
    lines = b.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.col("l_shipdate").cast("date").alias("announced"))
    return cal.next_open_day(lines, b.open_days(spark, sf_dir), "announced")


# --- universe, masters, codes ----------------------------------------------------------------------------------

@query(f"""WITH {b.DAYS}, {b.SECURITIES} SELECT 'ALL' AS universe_name, trade_date, stock_code, true AS eligible_flag FROM securities JOIN days
ON (list_date IS NULL OR list_date <= trade_date) AND (delist_date IS NULL OR delist_date >= trade_date)""")
def q_universe_range(spark, sf_dir):
    days = b.open_days(spark, sf_dir).withColumn("is_open", F.lit(True))
    return universe.historical_universe(b.securities(spark, sf_dir), days, "ALL").select("universe_name", "trade_date", "stock_code", "eligible_flag")


@query(f"""WITH {b.DAYS}, {b.SECURITIES} SELECT trade_date, stock_code FROM securities JOIN days
ON list_date <= trade_date AND (delist_date IS NULL OR delist_date >= trade_date) WHERE trade_date BETWEEN DATE '1995-06-14' AND DATE '1995-06-16'""")
def q_universe_on_date(spark, sf_dir):
    days = research.dated(b.open_days(spark, sf_dir), "1995-06-14", "1995-06-16").withColumn("is_open", F.lit(True))
    u = universe.historical_universe(b.securities(spark, sf_dir), days, "ALL")
    return research.dated(u, universe_name="ALL").where("eligible_flag").select("trade_date", "stock_code")


def _details(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("s_suppkey").cast("int")
    digits = F.date_format(F.date_add(F.lit("1990-01-01").cast("date"), k * 29 % 9000), "yyyyMMdd")
    sentinels = F.array(*[F.lit(s) for s in normalize.SENTINELS])
    return b.table(spark, sf_dir, "supplier").select(
        F.concat(F.lpad(k.cast("string"), 6, "0"), F.when(k % 2 == 0, ".SH").otherwise(".SZ")).alias("code"), F.col("s_name").alias("InstrumentName"),
        F.when(k % 5 != 0, digits).otherwise("0").alias("OpenDate"), F.concat(digits, F.lit(".0")).alias("CreateDate"),
        F.when(k % 7 == 0, F.get(sentinels, k % 5)).when(k % 3 == 0, "20260230").when(k % 4 == 0, F.lit("20011231")).alias("ExpireDate"),
    )


@query("""SELECT printf('%06d', s_suppkey) || CASE WHEN s_suppkey % 2 = 0 THEN '.SH' ELSE '.SZ' END AS stock_code, s_name AS stock_name,
  CASE WHEN s_suppkey % 2 = 0 THEN 'SH' ELSE 'SZ' END AS exchange, DATE '1990-01-01' + CAST(s_suppkey * 29 % 9000 AS INT) AS list_date,
  CASE WHEN s_suppkey % 7 = 0 OR s_suppkey % 3 = 0 THEN NULL WHEN s_suppkey % 4 = 0 THEN DATE '2001-12-31' END AS delist_date,
  CASE WHEN s_suppkey % 7 = 0 THEN 'INVALID_SENTINEL_IGNORED' WHEN s_suppkey % 3 = 0 OR s_suppkey % 4 <> 0 THEN 'MISSING_OR_ACTIVE' ELSE 'SOURCE' END AS delist_date_quality
FROM supplier""")
def q_security_master_norm(spark, sf_dir):
    return normalize.normalize_instruments(_details(spark, sf_dir))


@query("""SELECT 'stock_code_unique' AS rule, 'ERROR' AS severity, 0::BIGINT AS "count" UNION ALL
SELECT 'listing_interval', 'ERROR', count(*) FILTER (WHERE s_suppkey % 7 <> 0 AND s_suppkey % 3 <> 0 AND s_suppkey % 4 = 0 AND DATE '1990-01-01' + CAST(s_suppkey * 29 % 9000 AS INT) > DATE '2001-12-31') FROM supplier UNION ALL
SELECT 'invalid_delist_sentinel_ignored', 'WARN', count(*) FILTER (WHERE s_suppkey % 7 = 0) FROM supplier""")
def q_quality_master(spark, sf_dir):
    return quality.master_rules(normalize.normalize_instruments(_details(spark, sf_dir)))


@query("""WITH c AS (SELECT s_suppkey, (['IF', 'ih', 'IC', ''])[s_suppkey % 4 + 1] || printf('%04d', s_suppkey % 10000) || '.IF' AS code FROM supplier)
SELECT s_suppkey, code, upper(nullif(regexp_extract(code, '^([A-Za-z]+)', 1), '')) AS product, regexp_matches(code, '(?i)^(IF|IH)[0-9]{4}\\.IF$') AS wanted FROM c""")
def q_code_regex_product(spark, sf_dir):
    k = F.col("s_suppkey").cast("int")
    code = F.concat(F.get(F.array(*map(F.lit, ("IF", "ih", "IC", ""))), k % 4), F.lpad((k % 10000).cast("string"), 4, "0"), F.lit(".IF"))
    rows = b.table(spark, sf_dir, "supplier").select("s_suppkey", code.alias("code"))
    wanted = feed.contracts_of(rows, ["IF", "IH"]).withColumn("wanted", F.lit(True))
    return rows.join(wanted, "code", "left").select("s_suppkey", "code", normalize.product(F.col("code")).alias("product"), F.coalesce("wanted", F.lit(False)).alias("wanted"))


@query("""WITH c AS (SELECT DISTINCT l_suppkey FROM lineitem WHERE l_shipdate >= TIMESTAMP '2001-11-03'), s AS (SELECT printf('%06d', s_suppkey) || '.SH' AS code, s_suppkey, s_name FROM supplier)
SELECT code FROM s WHERE s_suppkey NOT IN (SELECT l_suppkey FROM c) AND s_name <> '' AND s_suppkey % 10 <> 0""")
def q_anti_delisted(spark, sf_dir):
    def code(c):
        return F.concat(F.lpad(F.col(c).cast("string"), 6, "0"), F.lit(".SH")).alias("code")

    stocks = b.table(spark, sf_dir, "supplier")
    current = b.table(spark, sf_dir, "lineitem").where(F.col("l_shipdate") >= F.lit("2001-11-03").cast("timestamp_ntz")).select(code("l_suppkey")).distinct()
    details = stocks.where("s_suppkey % 10 <> 0").select(code("s_suppkey"), F.col("s_name").alias("InstrumentName"))
    return feed.delisted_candidates(stocks.select(code("s_suppkey")), current, details)


@query("""WITH v AS (SELECT event_id, CASE event_id % 5 WHEN 0 THEN '20240115' WHEN 1 THEN '2024-02-03.0' WHEN 2 THEN CAST(1704067200000 + event_id * 3600000 AS VARCHAR) WHEN 3 THEN '20240230' ELSE 'n/a' END AS raw FROM events)
SELECT event_id, CASE event_id % 5 WHEN 0 THEN DATE '2024-01-15' WHEN 1 THEN DATE '2024-02-03' WHEN 2 THEN CAST(make_timestamp((1704067200000 + event_id * 3600000 + 28800000) * 1000) AS DATE) END AS parsed,
  CASE event_id % 5 WHEN 0 THEN DATE '2024-01-15' END AS eight FROM v""")
def q_parse_dates(spark, sf_dir):
    k = F.col("event_id")
    raw = F.when(k % 5 == 0, "20240115").when(k % 5 == 1, "2024-02-03.0").when(k % 5 == 2, (F.lit(1704067200000) + k * 3600000).cast("string")).when(k % 5 == 3, "20240230").otherwise("n/a")
    rows = b.table(spark, sf_dir, "events").select("event_id", raw.alias("raw"))
    return rows.select("event_id", epoch_or_text_date(F.col("raw")).alias("parsed"), F.when(k % 5 == 0, detail_date(F.concat(F.lit("d"), "raw"))).alias("eight"))


# --- futures ---------------------------------------------------------------------------------------------------

@query(f"WITH {b.CONTRACTS} SELECT * FROM contracts WHERE (list_date IS NULL OR list_date <= DATE '1994-06-30') AND (expire_date IS NULL OR expire_date >= DATE '1994-06-30')")
def q_contracts_active_on(spark, sf_dir):
    return fut.active_contracts(b.contracts(spark, sf_dir), None, "1994-06-30")


_MAIN = b.FUTURES + """, cand AS (
  SELECT f.*, expire_date, bool_or(coalesce(open_interest >= 0, false)) OVER g AS any_oi, count(*) OVER g AS n
  FROM futures f JOIN contracts c USING (contract_code) WHERE expire_date > trade_date WINDOW g AS (PARTITION BY trade_date, f.product)
), eod AS (
  SELECT 'EOD_OBSERVED' AS mapping_type, trade_date AS observation_trade_date, trade_date AS effective_trade_date, product, contract_code,
    CASE WHEN any_oi THEN 'MAX_OPEN_INTEREST' ELSE 'MAX_VOLUME_FALLBACK' END AS selection_method, 'v1' AS rule_version, n AS eligible_contract_count
  FROM cand WHERE CASE WHEN any_oi THEN open_interest >= 0 ELSE volume >= 0 END
  QUALIFY row_number() OVER (PARTITION BY trade_date, product ORDER BY CASE WHEN any_oi THEN open_interest ELSE volume END DESC, expire_date, contract_code) = 1
)"""
_NEXT = b.DAYS + """, nxt AS (SELECT trade_date, lead(trade_date) OVER (ORDER BY trade_date) AS n FROM days),
next_day AS (SELECT 'NEXT_TRADE_DAY' AS mapping_type, observation_trade_date, n.n AS effective_trade_date, product, contract_code, selection_method, rule_version, eligible_contract_count
  FROM eod JOIN nxt n ON observation_trade_date = n.trade_date WHERE n.n IS NOT NULL)"""


def _eod(spark, sf_dir) -> DataFrame:
    return fut.main_contracts(b.futures(spark, sf_dir), b.contracts(spark, sf_dir).drop("product"))


def _mapping(spark, sf_dir) -> DataFrame:
    eod = _eod(spark, sf_dir)
    return eod.unionByName(fut.next_day_mapping(eod, cal.trade_calendar(b.open_days(spark, sf_dir))))


@query(f"WITH {_MAIN} SELECT * FROM eod")
def q_main_contract_eod(spark, sf_dir):
    return _eod(spark, sf_dir)


@query(f"WITH {_MAIN}, {_NEXT} SELECT * FROM next_day WHERE product IN ('1', '2', '7')")
def q_main_contract_next_day(spark, sf_dir):
    return research.main_contract_of(_mapping(spark, sf_dir), ["1", "2", "7"], "NEXT_TRADE_DAY")


@query(f"WITH {_MAIN}, {_NEXT} SELECT * FROM next_day")
def q_main_contract_next_day_all(spark, sf_dir):
    return _mapping(spark, sf_dir).where("mapping_type = 'NEXT_TRADE_DAY'")


@query(f"WITH {_MAIN} SELECT product, count(*) AS days FROM eod WHERE selection_method = 'MAX_VOLUME_FALLBACK' GROUP BY product")
def q_main_fallback_volume(spark, sf_dir):
    return _eod(spark, sf_dir).where("selection_method = 'MAX_VOLUME_FALLBACK'").groupBy("product").agg(F.count(F.lit(1)).alias("days"))


@query(f"""WITH {_MAIN}, {_NEXT} SELECT trade_date, contract_code, (trade_date, contract_code) IN (SELECT (effective_trade_date, contract_code) FROM eod) AS is_eod_main,
  (trade_date, contract_code) IN (SELECT (effective_trade_date, contract_code) FROM next_day) AS is_tradable_main FROM futures""")
def q_main_flags(spark, sf_dir):
    m = _mapping(spark, sf_dir)
    rows = fut.with_main_flag(b.futures(spark, sf_dir).select("trade_date", "contract_code"), m, fut.EOD, "is_eod_main")
    return fut.with_main_flag(rows, m, "NEXT_TRADE_DAY", "is_tradable_main")


@query("SELECT s_suppkey, CASE WHEN s_nationkey % 4 <> 3 THEN 'IDX' || s_nationkey END AS spot_code FROM supplier")
def q_spot_lookup(spark, sf_dir):
    return b.table(spark, sf_dir, "supplier").select("s_suppkey", fut.spot_code(F.col("s_nationkey").cast("string"), b.SPOTS).alias("spot_code"))


@query(f"""WITH {_MAIN}, {_NEXT}, {b.INDEX}, j AS (
  SELECT f.trade_date, f.product, f.contract_code, CASE WHEN CAST(f.product AS INT) % 4 <> 3 THEN 'IDX' || f.product END AS spot_code, f.close AS future_close, f.settlement, expire_date
  FROM futures f LEFT JOIN contracts c ON f.contract_code = c.contract_code
), k AS (SELECT j.*, i.close AS spot_close, expire_date - j.trade_date AS days_to_expiry FROM j LEFT JOIN idx i ON j.trade_date = i.trade_date AND j.spot_code = i.index_code),
p AS (SELECT *, CASE WHEN spot_close > 0 THEN (future_close - spot_close) / spot_close END AS pct FROM k)
SELECT trade_date, product, contract_code, spot_code, round(future_close, 8) AS future_close, round(settlement, 8) AS settlement, round(spot_close, 8) AS spot_close,
  round(CASE WHEN spot_close > 0 THEN future_close - spot_close END, 8) AS basis_close, round(CASE WHEN spot_close > 0 THEN settlement - spot_close END, 8) AS basis_settlement,
  round(pct, 8) AS basis_pct, CAST(days_to_expiry AS INT) AS days_to_expiry, round(CASE WHEN days_to_expiry > 0 THEN pct * 365 / days_to_expiry END, 8) AS annualized_basis,
  (trade_date, contract_code) IN (SELECT (effective_trade_date, contract_code) FROM eod) AS is_eod_main,
  (trade_date, contract_code) IN (SELECT (effective_trade_date, contract_code) FROM next_day) AS is_tradable_main, 'v1' AS rule_version FROM p""")
def q_basis(spark, sf_dir):
    out = fut.basis(b.futures(spark, sf_dir), b.index_days(spark, sf_dir), b.contracts(spark, sf_dir), _mapping(spark, sf_dir), b.SPOTS)
    money = ["future_close", "settlement", "spot_close", "basis_close", "basis_settlement", "basis_pct", "annualized_basis"]
    return out.select(*[F.round(c, 8).alias(c) if c in money else F.col(c) for c in out.columns])


@query(f"""WITH {b.BARS}, {b.CONTRACTS}, d AS (SELECT max(trade_date) AS last FROM bars), v AS (SELECT stock_code, sum(amount) AS volume FROM bars GROUP BY stock_code)
SELECT product, contract_code, round(volume, 2) AS volume FROM contracts JOIN v ON contract_code = stock_code WHERE expire_date >= DATE '1995-01-01'
QUALIFY row_number() OVER (PARTITION BY product ORDER BY round(volume, 2) DESC, contract_code) = 1""")
def q_most_liquid_active(spark, sf_dir):
    volume = b.bars(spark, sf_dir).groupBy(F.col("stock_code").alias("contract_code")).agg(F.round(F.sum("amount"), 2).alias("volume"))
    return feed.most_liquid_active(b.contracts(spark, sf_dir).join(volume, "contract_code"), "1995-01-01")


# --- adjustment, keys, financial records -----------------------------------------------------------------------

@query(f"""WITH {b.BARS}, x AS (SELECT *, CASE WHEN day(trade_date) % 10 = 0 THEN 1 + day(trade_date) / 100.0::DOUBLE END AS raw FROM bars),
y AS (SELECT *, last_value(raw IGNORE NULLS) OVER (PARTITION BY stock_code ORDER BY trade_date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS factor FROM x)
SELECT trade_date, stock_code, factor, round(open * factor, 8) AS open_adjusted, round(close * factor, 8) AS close_adjusted FROM y""")
def q_adjust_ffill(spark, sf_dir):
    bars = b.bars(spark, sf_dir)
    factors = bars.where(F.dayofmonth("trade_date") % 10 == 0).select("trade_date", "stock_code", (1 + F.dayofmonth("trade_date") / 100.0).alias("factor"))
    return universe.adjust_prices(bars, factors).select("trade_date", "stock_code", "factor", *_r("open_adjusted", "close_adjusted"))


@query("SELECT o_orderkey, sha256(concat_ws(chr(31), CAST(o_custkey AS VARCHAR), coalesce(CASE WHEN o_orderkey % 3 <> 0 THEN o_orderpriority END, '<NULL>'), CAST(CAST(o_orderdate AS DATE) AS VARCHAR))) AS record_key FROM orders")
def q_record_keys_sha256(spark, sf_dir):
    return b.table(spark, sf_dir, "orders").select("o_orderkey", record_key(F.col("o_custkey"), F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderpriority")), F.col("o_orderdate").cast("date")).alias("record_key"))


_CODES = [str(i) for i in range(0, 200, 3)]
_IN = ", ".join(f"'{c}'" for c in _CODES)
_VIEW = f"""{b.FINANCIALS}, v AS (SELECT * FROM fin_keyed WHERE announce_date IS NOT NULL AND available_date IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY source_record_key ORDER BY order_key DESC) = 1),
elig AS (SELECT * FROM v WHERE available_date <= DATE '1996-06-30' AND stock_code IN ({_IN})),
shots AS (SELECT DISTINCT stock_code, table_name, report_period, snapshot_version_key, available_date, announce_date FROM elig WHERE table_name LIKE 'Top10%'),
newest AS (SELECT * FROM shots QUALIFY row_number() OVER (PARTITION BY stock_code, table_name, report_period ORDER BY available_date DESC, announce_date DESC, snapshot_version_key DESC) = 1),
snap AS (SELECT e.* FROM elig e JOIN newest n USING (stock_code, table_name, report_period, snapshot_version_key)),
single AS (SELECT * FROM elig WHERE table_name NOT LIKE 'Top10%' QUALIFY row_number() OVER (PARTITION BY logical_record_key ORDER BY available_date DESC, announce_date DESC, order_key DESC) = 1)"""
_FIN_COLS = "stock_code, table_name, report_period, announce_date, available_date, rank, order_key, value, logical_record_key, source_record_key, snapshot_version_key"


#: The same over every stock.
_VIEW_ALL = _VIEW.replace(f" AND stock_code IN ({_IN})", "")


def _known(spark, sf_dir, tables=None, codes=_CODES) -> DataFrame:
    dated = pit.assign_availability(b.financials(spark, sf_dir), b.open_days(spark, sf_dir))
    view = pit.pit_view(dated, [F.col("order_key")])
    return pit.known_as_of(view, codes, "1996-06-30", tables, [F.col("order_key")]).select(*_FIN_COLS.split(", "))


@query(f"WITH {_VIEW} SELECT {_FIN_COLS} FROM single")
def q_pit_single(spark, sf_dir):
    return _known(spark, sf_dir, ["Income", "Balance"])


@query(f"WITH {_VIEW} SELECT {_FIN_COLS} FROM snap")
def q_pit_snapshot(spark, sf_dir):
    return _known(spark, sf_dir, list(pit.SNAPSHOT_TABLES))


@query(f"WITH {_VIEW} SELECT {_FIN_COLS} FROM snap UNION ALL SELECT {_FIN_COLS} FROM single")
def q_pit_union(spark, sf_dir):
    return _known(spark, sf_dir)


@query(f"WITH {_VIEW_ALL} SELECT {_FIN_COLS} FROM single")
def q_pit_single_all(spark, sf_dir):
    return _known(spark, sf_dir, ["Income", "Balance"], None)


@query(f"WITH {_VIEW_ALL} SELECT {_FIN_COLS} FROM snap")
def q_pit_snapshot_all(spark, sf_dir):
    return _known(spark, sf_dir, list(pit.SNAPSHOT_TABLES), None)


@query(f"WITH {_VIEW_ALL} SELECT {_FIN_COLS} FROM snap UNION ALL SELECT {_FIN_COLS} FROM single")
def q_pit_union_all(spark, sf_dir):
    return _known(spark, sf_dir, codes=None)


# --- quality, reports ------------------------------------------------------------------------------------------

_PREV = "lag(close) OVER (PARTITION BY stock_code ORDER BY trade_date)"


@query(f"""WITH {b.BARS}, x AS (SELECT *, {_PREV} AS prev FROM bars)
SELECT 'business_key_unique' AS rule, 'ERROR' AS severity, count(*) - count(DISTINCT (trade_date, stock_code)) AS "count" FROM bars UNION ALL
SELECT 'ohlc_bounds', 'ERROR', count(*) FILTER (WHERE high < greatest(open, close, low) OR low > least(open, close, high)) FROM bars UNION ALL
SELECT 'non_negative_volume', 'ERROR', count(*) FILTER (WHERE volume < 0) FROM bars UNION ALL
SELECT 'non_negative_amount', 'ERROR', count(*) FILTER (WHERE amount < 0) FROM bars UNION ALL
SELECT 'extreme_close_return', 'WARN', count(*) FILTER (WHERE abs(close / nullif(prev, 0) - 1) > 0.5 OR (prev = 0 AND close <> 0)) FROM x""")
def q_quality_bars(spark, sf_dir):
    return quality.bar_rules(b.bars(spark, sf_dir))


@query(f"""WITH {b.FINANCIALS} SELECT 'announce_date_present' AS rule, 'WARN' AS severity, count(*) FILTER (WHERE announce_date IS NULL) AS "count" FROM fin_dated UNION ALL
SELECT 'pit_availability', 'ERROR', count(*) FILTER (WHERE available_date <= announce_date) FROM fin_dated""")
def q_quality_financial(spark, sf_dir):
    return quality.financial_rules(pit.assign_availability(b.financials(spark, sf_dir), b.open_days(spark, sf_dir)))


@query(f"WITH {b.BARS}, x AS (SELECT *, {_PREV} AS prev FROM bars) SELECT trade_date, stock_code, round(close, 8) AS close FROM x WHERE abs(close / nullif(prev, 0) - 1) > 0.5 OR (prev = 0 AND close <> 0)")
def q_extreme_return(spark, sf_dir):
    return b.bars(spark, sf_dir).withColumn("x", quality.extreme_move("stock_code")).where("x").select("trade_date", "stock_code", *_r("close"))


@query("""SELECT 'lineitem' AS dataset, count(*) AS n_rows, min(CAST(l_shipdate AS DATE)) AS min_date, max(CAST(l_shipdate AS DATE)) AS max_date FROM lineitem UNION ALL
SELECT 'orders', count(*), min(CAST(o_orderdate AS DATE)), max(CAST(o_orderdate AS DATE)) FROM orders""")
def q_manifest_stats(spark, sf_dir):
    def stats(name: str, day: str) -> DataFrame:
        d = F.col(day).cast("date")
        return b.table(spark, sf_dir, name).agg(F.lit(name).alias("dataset"), F.count(F.lit(1)).alias("n_rows"), F.min(d).alias("min_date"), F.max(d).alias("max_date"))

    return stats("lineitem", "l_shipdate").unionByName(stats("orders", "o_orderdate"))


@query("SELECT o_orderpriority, count(*) FILTER (WHERE o_orderstatus = 'F') AS f, count(*) FILTER (WHERE o_orderstatus = 'O') AS o, count(*) FILTER (WHERE o_orderstatus = 'P') AS p FROM orders GROUP BY o_orderpriority")
def q_status_pivot(spark, sf_dir):
    out = b.table(spark, sf_dir, "orders").groupBy("o_orderpriority").pivot("o_orderstatus", ["F", "O", "P"]).count()
    return out.select("o_orderpriority", *[F.coalesce(s, F.lit(0)).alias(s.lower()) for s in ("F", "O", "P")])


@query("SELECT p_partkey, p_retailprice FROM part ORDER BY p_retailprice DESC, p_partkey LIMIT 20")
def q_top20(spark, sf_dir):
    return b.table(spark, sf_dir, "part").select("p_partkey", "p_retailprice").orderBy(F.desc("p_retailprice"), "p_partkey").limit(20)


@query("SELECT c_custkey AS k, c_acctbal AS bal, c_mktsegment AS segment, NULL::VARCHAR AS name FROM customer UNION ALL SELECT s_suppkey, s_acctbal, NULL, s_name FROM supplier")
def q_union_by_name(spark, sf_dir):
    one = b.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), F.col("c_acctbal").alias("bal"), F.col("c_mktsegment").alias("segment"))
    two = b.table(spark, sf_dir, "supplier").select(F.col("s_name").alias("name"), F.col("s_suppkey").alias("k"), F.col("s_acctbal").alias("bal"))
    return union_by_name(one, two)


# --- liquidity -------------------------------------------------------------------------------------------------

_W = "(PARTITION BY stock_code ORDER BY trade_date ROWS BETWEEN {} PRECEDING AND CURRENT ROW)"
_W20, _W60 = _W.format(19), _W.format(59)
_RET = b.CAPPED + f""", r AS (SELECT *, close / nullif({_PREV.replace("bars", "capped")}, 0) - 1 AS ret, {_PREV} AS pre_close, amount / nullif(ff_cap, 0) AS turnover FROM capped),
a AS (SELECT *, abs(ret) / nullif(amount, 0) AS amihud FROM r)"""
#: Illiquidity is small: it is shown in units of 1e-9.
_TINY = 1e9


def _tiny(*cols: str) -> list:
    return [F.round(F.col(c) * _TINY, 6).alias(c) for c in cols]


def _base(spark, sf_dir) -> DataFrame:
    bars = b.capped(spark, sf_dir)
    out = liq.with_turnover(liq.with_returns(bars))
    return out.withColumn("amihud", F.try_divide(F.abs("ret"), F.nullif(F.col("amount"), F.lit(0.0))))


@query(f"WITH {b.BARS} SELECT trade_date, stock_code, amount, round(avg(amount) OVER {_W20}, 7) AS adv20, round(avg(amount) OVER {_W60}, 7) AS adv60, round(quantile_cont(amount, 0.5) OVER {_W20}, 7) AS median_amount20, round(quantile_cont(amount, 0.5) OVER {_W60}, 7) AS median_amount60 FROM bars")
def q_adv20_adv60(spark, sf_dir):
    out = liq.average_amount(b.bars(spark, sf_dir))
    return out.select("trade_date", "stock_code", "amount", *_r("adv20", "adv60", "median_amount20", "median_amount60", digits=7))


@query(f"WITH {_RET} SELECT trade_date, stock_code, round(amihud * 1e9::DOUBLE, 6) AS amihud, round(quantile_cont(amihud, 0.5) OVER {_W20} * 1e9::DOUBLE, 6) AS amihud20, round(quantile_cont(amihud, 0.5) OVER {_W60} * 1e9::DOUBLE, 6) AS amihud60 FROM a")
def q_amihud20_60(spark, sf_dir):
    return liq.amihud(b.bars(spark, sf_dir)).select("trade_date", "stock_code", *_tiny("amihud", "amihud20", "amihud60"))


@query(f"WITH {_RET}, i AS (SELECT *, ret - avg(ret) OVER (PARTITION BY trade_date) AS idio FROM a) SELECT trade_date, stock_code, round(idio, 8) AS idio, round(abs(idio) / nullif(amount, 0) * 1e9::DOUBLE, 4) AS idio_amihud FROM i")
def q_idiosyncratic_amihud(spark, sf_dir):
    return liq.idiosyncratic_amihud(b.bars(spark, sf_dir)).select("trade_date", "stock_code", *_r("idio"), F.round(F.col("idio_amihud") * _TINY, 4).alias("idio_amihud"))


@query(f"WITH {_RET}, t AS (SELECT *, CASE WHEN turnover > 0 THEN ln(turnover) END AS x FROM a) SELECT trade_date, stock_code, turnover, round((x - avg(x) OVER {_W60}) / nullif(stddev_samp(x) OVER {_W60}, 0), 6) AS turnover_z FROM t")
def q_turnover_z60(spark, sf_dir):
    return liq.turnover_z(b.capped(spark, sf_dir)).select("trade_date", "stock_code", "turnover", *_r("turnover_z", digits=6))


@query(f"WITH {_RET}, t AS (SELECT *, (high - low) / nullif(pre_close, 0) / nullif(turnover, 0) AS x FROM a) SELECT trade_date, stock_code, round(x, 6) AS range_impact, round(quantile_cont(x, 0.5) OVER {_W20}, 6) AS range_impact_median FROM t")
def q_range_impact20(spark, sf_dir):
    return liq.range_impact(b.capped(spark, sf_dir)).select("trade_date", "stock_code", *_r("range_impact", "range_impact_median", digits=6))


@query(f"""WITH {_RET}, s AS (SELECT *, quantile_cont(CASE WHEN ret < 0 THEN amihud END, 0.5) OVER {_W20} AS d, quantile_cont(CASE WHEN ret > 0 THEN amihud END, 0.5) OVER {_W20} AS u FROM a)
SELECT trade_date, stock_code, round(d * 1e9::DOUBLE, 6) AS downside, round(u * 1e9::DOUBLE, 6) AS upside, round(d / nullif(u, 0), 6) AS ratio FROM s""")
def q_downside_ratio20(spark, sf_dir):
    return liq.sided_illiquidity(b.bars(spark, sf_dir)).select("trade_date", "stock_code", *_tiny("downside", "upside"), *_r("ratio", digits=6))


@query(f"WITH {_RET} SELECT trade_date, stock_code, round(CASE WHEN turnover IS NOT NULL THEN percent_rank() OVER (PARTITION BY trade_date, turnover IS NULL ORDER BY turnover) END, 8) AS xs_percentile FROM a")
def q_xs_percentile(spark, sf_dir):
    return liq.cross_section_rank(_base(spark, sf_dir), "turnover").select("trade_date", "stock_code", *_r("xs_percentile"))


@query(f"WITH {_RET}, t AS (SELECT *, list(amihud) OVER {_W60} AS h FROM a) SELECT trade_date, stock_code, round(CASE WHEN amihud IS NOT NULL THEN len(list_filter(h, lambda x: x <= amihud))::DOUBLE / len(list_filter(h, lambda x: x IS NOT NULL)) END, 8) AS ts_percentile FROM t")
def q_ts_percentile(spark, sf_dir):
    return liq.own_history_rank(_base(spark, sf_dir), "amihud").select("trade_date", "stock_code", *_r("ts_percentile"))


@query(f"""WITH {_RET}, f AS (SELECT *, coalesce(ret < 0, false) AS down FROM r), g AS (SELECT *, sum(CASE WHEN down THEN 0 ELSE 1 END) OVER (PARTITION BY stock_code ORDER BY trade_date ROWS UNBOUNDED PRECEDING) AS run FROM f)
SELECT trade_date, stock_code, CAST(sum(CASE WHEN down THEN 1 ELSE 0 END) OVER (PARTITION BY stock_code, run ORDER BY trade_date ROWS UNBOUNDED PRECEDING) AS BIGINT) AS streak FROM g""")
def q_streak(spark, sf_dir):
    rows = _base(spark, sf_dir).select("trade_date", "stock_code", F.coalesce(F.col("ret") < 0, F.lit(False)).alias("down"))
    return streak_length(rows, "down", ["stock_code"], "trade_date").select("trade_date", "stock_code", "streak")


@query(f"""WITH {_RET}, f AS (SELECT *, coalesce(high = low AND ret >= 0.098, false) AS up, coalesce(high = low AND ret <= -0.098, false) AS down FROM r)
SELECT trade_date, stock_code, greatest(0.0::DOUBLE, 1 - (CASE WHEN amount <= 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END + CASE WHEN up THEN 0.5::DOUBLE ELSE 0.0::DOUBLE END + CASE WHEN down THEN 0.75::DOUBLE ELSE 0.0::DOUBLE END)) AS tradability FROM f""")
def q_tradability(spark, sf_dir):
    return liq.tradability(liq.trade_flags(b.bars(spark, sf_dir)))


_MARKET = """m AS (SELECT trade_date, sum(amount) AS total_amount, sum(amount) / nullif(sum(ff_cap), 0) AS market_turnover, median(turnover) AS median_turnover,
  median(amihud) AS median_amihud, median(CASE WHEN ret < 0 THEN amihud END) AS median_downside FROM a GROUP BY trade_date)"""


@query(f"WITH {_RET}, {_MARKET} SELECT trade_date, round(total_amount, 2) AS total_amount, round(market_turnover, 8) AS market_turnover, round(median_turnover, 8) AS median_turnover, round(median_amihud * 1e9::DOUBLE, 6) AS median_amihud, round(median_downside * 1e9::DOUBLE, 6) AS median_downside FROM m")
def q_market_totals_medians(spark, sf_dir):
    return liq.market_day(_base(spark, sf_dir)).select("trade_date", F.round("total_amount", 2).alias("total_amount"), *_r("market_turnover", "median_turnover"), *_tiny("median_amihud", "median_downside"))


@query(f"WITH {_RET}, o AS (SELECT *, quantile_cont(turnover, 0.5) OVER {_W60} AS own FROM a) SELECT trade_date, round(avg(CASE WHEN turnover > own THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 8) AS breadth, count(*) AS stocks FROM o WHERE turnover IS NOT NULL AND own IS NOT NULL GROUP BY trade_date")
def q_breadth(spark, sf_dir):
    return liq.breadth(_base(spark, sf_dir), "turnover").select("trade_date", *_r("breadth"), "stocks")


_HHI = """round(sum(s * s), 8) AS hhi, round((sum(s * s) - 1.0::DOUBLE / max(n)) / nullif(1 - 1.0::DOUBLE / max(n), 0), 8) AS hhi_normalised, round(sum(CASE WHEN rk <= 10 THEN s ELSE 0 END), 8) AS top10_share,
  round(sum(CASE WHEN rk <= 50 THEN s ELSE 0 END), 8) AS top50_share, round(sum(CASE WHEN rk <= ceil(n * 0.05) THEN s ELSE 0 END), 8) AS top5pct_share"""


@query(f"""WITH {b.BARS}, c AS (SELECT trade_date, amount / sum(amount) OVER (PARTITION BY trade_date) AS s, count(*) OVER (PARTITION BY trade_date) AS n,
  row_number() OVER (PARTITION BY trade_date ORDER BY amount DESC, stock_code) AS rk FROM bars WHERE amount > 0) SELECT trade_date, {_HHI} FROM c GROUP BY trade_date""")
def q_hhi_topn(spark, sf_dir):
    out = liq.concentration(b.bars(spark, sf_dir), ["trade_date"])
    return out.select("trade_date", *_r(*[c for c in out.columns if c != "trade_date"]))


@query(f"""WITH {_RET}, t AS (SELECT *, CASE WHEN turnover > 0 THEN ln(turnover) END AS x FROM a), z AS (SELECT trade_date, amount, (x - avg(x) OVER {_W60}) / nullif(stddev_samp(x) OVER {_W60}, 0) AS z FROM t)
SELECT trade_date, round(sum(CASE WHEN z > 1.5 THEN amount ELSE 0 END) / nullif(sum(amount), 0), 8) AS hot_share FROM z GROUP BY trade_date""")
def q_hot_share(spark, sf_dir):
    bars = b.capped(spark, sf_dir)
    z = liq.turnover_z(bars).join(bars.select("trade_date", "stock_code", "amount"), ["trade_date", "stock_code"])
    return liq.hot_share(z).select("trade_date", *_r("hot_share"))


_MZ = "(ORDER BY trade_date ROWS BETWEEN 59 PRECEDING AND CURRENT ROW)"


@query(f"""WITH {_RET}, {_MARKET}, t AS (SELECT trade_date, round(total_amount, 2) AS x, median_turnover AS y FROM m), z AS (SELECT trade_date, (x - avg(x) OVER {_MZ}) / nullif(stddev_samp(x) OVER {_MZ}, 0) AS zx, (y - avg(y) OVER {_MZ}) / nullif(stddev_samp(y) OVER {_MZ}, 0) AS zy FROM t)
SELECT trade_date, round(zx, 6) AS z_total, round(zy, 6) AS z_median, round(zx - zy, 6) AS divergence FROM z""")
def q_divergence(spark, sf_dir):
    market = liq.market_day(_base(spark, sf_dir)).withColumn("total_amount", F.round("total_amount", 2))
    return liq.divergence(market).select("trade_date", *_r("z_total", "z_median", "divergence", digits=6))


@query(f"""WITH {_RET}, {_MARKET}, p AS (SELECT trade_date, 1 - percent_rank() OVER (ORDER BY median_amihud) AS health, percent_rank() OVER (ORDER BY round(total_amount, 2)) AS crowding FROM m WHERE median_amihud IS NOT NULL)
SELECT trade_date, round(health, 8) AS health, round(crowding, 8) AS crowding, CASE WHEN health >= 0.5 AND crowding < 0.5 THEN 'HEALTHY' WHEN health >= 0.5 THEN 'HEALTHY_CROWDED' WHEN crowding >= 0.5 THEN 'FRAGILE_CROWDED' ELSE 'WEAK' END AS regime FROM p""")
def q_regime_matrix(spark, sf_dir):
    market = liq.market_day(_base(spark, sf_dir)).where("median_amihud is not null").withColumn("total_amount", F.round("total_amount", 2))
    ranked = market.select("trade_date", (1 - F.percent_rank().over(Window.orderBy("median_amihud"))).alias("health"), F.percent_rank().over(Window.orderBy("total_amount")).alias("crowding"))  # a row a day
    return liq.regime(ranked, "health", "crowding").select("trade_date", *_r("health", "crowding"), "regime")


@query(f"WITH {b.BARS}, w AS (SELECT *, quantile_cont(volume, 0.01) OVER g AS lo, quantile_cont(volume, 0.99) OVER g AS hi FROM bars WINDOW g AS (PARTITION BY trade_date)) SELECT trade_date, stock_code, round(greatest(least(volume, hi), lo), 8) AS volume FROM w")
def q_winsorise(spark, sf_dir):
    return liq.winsorise(b.bars(spark, sf_dir).select("trade_date", "stock_code", "volume"), "volume", ["trade_date"]).select("trade_date", "stock_code", *_r("volume"))


@query(f"""WITH {_RET}, s AS (SELECT a.*, n_regionkey AS sector FROM a JOIN supplier ON stock_code = CAST(s_suppkey AS VARCHAR) JOIN nation ON s_nationkey = n_nationkey),
p AS (SELECT trade_date, sector, sum(amount) AS amount, sum(ff_cap) AS cap, median(amihud) AS ma, count(*) AS stocks FROM s GROUP BY ALL),
q AS (SELECT *, amount / sum(amount) OVER (PARTITION BY trade_date) AS amount_share, cap / sum(cap) OVER (PARTITION BY trade_date) AS cap_share FROM p)
SELECT trade_date, sector, round(amount, 2) AS amount, round(ma * 1e9::DOUBLE, 6) AS median_amihud, stocks, round(amount_share, 8) AS amount_share, round(cap_share, 8) AS cap_share, round(amount_share / nullif(cap_share, 0), 8) AS rta FROM q""")
def q_sector_rta(spark, sf_dir):
    nations = b.table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_regionkey").alias("sector"))
    sectors = b.table(spark, sf_dir, "supplier").join(nations, "s_nationkey").select(F.col("s_suppkey").cast("string").alias("stock_code"), "sector")
    out = liq.sector_day(_base(spark, sf_dir).join(sectors, "stock_code"))
    return out.select("trade_date", "sector", F.round("amount", 2).alias("amount"), *_tiny("median_amihud"), "stocks", *_r("amount_share", "cap_share", "rta"))


# --- flows -----------------------------------------------------------------------------------------------------

_LAG = "lag({}) OVER (PARTITION BY stock_code ORDER BY trade_date)"


def _funds(spark, sf_dir) -> DataFrame:
    return b.capped(spark, sf_dir).select("trade_date", F.col("stock_code").alias("code"), F.col("volume").alias("shares"), F.col("low").alias("nav"), "close", "amount", F.col("ff_cap").alias("balance"))


@query(f"""WITH {b.CAPPED}, x AS (SELECT *, (volume - {_LAG.format("volume")}) * low AS c FROM capped)
SELECT trade_date, stock_code AS code, round(c, 8) AS net_creation, round(c / nullif(volume * low, 0), 8) AS creation_share, round(close / nullif(low, 0) - 1, 8) AS premium FROM x""")
def q_etf_creation(spark, sf_dir):
    return flows.etf_creation(_funds(spark, sf_dir)).select("trade_date", "code", *_r("net_creation"), *_r("creation_share", "premium"))


@query(f"WITH {b.CAPPED} SELECT trade_date, stock_code AS code, volume - 25 AS margin_flow, round((volume - 25) / ff_cap * 1e6::DOUBLE, 6) AS margin_intensity, round(volume / nullif(amount, 0) * 1e6::DOUBLE, 6) AS buy_share FROM capped")
def q_margin_flow(spark, sf_dir):
    rows = _funds(spark, sf_dir).withColumn("buy", F.col("shares")).withColumn("repay", F.lit(25.0))
    return flows.margin_flow(rows).select("trade_date", "code", "margin_flow", *[F.round(F.col(c) * 1e6, 6).alias(c) for c in ("margin_intensity", "buy_share")])


@query(f"""WITH {b.BARS}, x AS (SELECT *, close / nullif({_LAG.format("close")}, 0) - 1 AS ret, {_LAG.format("amount")} AS was FROM bars)
SELECT trade_date, stock_code AS code, round(amount - was * (1 + ret), 7) + 0.0::DOUBLE AS flow FROM x""")
def q_fund_flow(spark, sf_dir):
    rows = liq.with_returns(b.bars(spark, sf_dir)).select("trade_date", F.col("stock_code").alias("code"), F.col("amount").alias("aum"), "ret")
    return flows.fund_flow(rows).select("trade_date", "code", (F.round("flow", 7) + 0.0).alias("flow"))


@query(f"""WITH {b.FUTURES} SELECT trade_date, contract_code, open_interest - lag(open_interest) OVER (PARTITION BY contract_code ORDER BY trade_date) AS oi_change,
  round(volume / nullif(open_interest, 0), 8) AS volume_to_oi FROM futures""")
def q_open_interest(spark, sf_dir):
    return flows.open_interest_pressure(b.futures(spark, sf_dir)).select("trade_date", "contract_code", "oi_change", *_r("volume_to_oi"))


@query(f"""WITH {b.BARS}, d AS (SELECT trade_date, max(close) AS a, min(close) AS m, median(close) AS c FROM bars GROUP BY trade_date),
z AS (SELECT trade_date, a - c AS wide, c - m AS low, (a - c - avg(a - c) OVER {_MZ}) / nullif(stddev_samp(a - c) OVER {_MZ}, 0) AS z1, (c - m - avg(c - m) OVER {_MZ}) / nullif(stddev_samp(c - m) OVER {_MZ}, 0) AS z2 FROM d)
SELECT trade_date, round(wide, 8) AS wide, round(low, 8) AS low, round((coalesce(z1, 0) + coalesce(z2, 0)) / nullif((z1 IS NOT NULL)::INT + (z2 IS NOT NULL)::INT, 0), 6) AS stress FROM z""")
def q_funding_stress(spark, sf_dir):
    rates = b.bars(spark, sf_dir).groupBy("trade_date").agg(F.max("close").alias("a"), F.min("close").alias("m"), F.median("close").alias("c"))
    return flows.funding_stress(rates, {"wide": ("a", "c"), "low": ("c", "m")}).select("trade_date", *_r("wide", "low"), *_r("stress", digits=6))


@query(f"WITH {b.BARS} SELECT trade_date, round(sum(amount - volume), 2) AS net_liquidity FROM bars GROUP BY trade_date")
def q_net_liquidity(spark, sf_dir):
    return flows.net_liquidity(b.bars(spark, sf_dir), ["amount"], ["volume"]).select("trade_date", F.round("net_liquidity", 2).alias("net_liquidity"))


# --- events ----------------------------------------------------------------------------------------------------

_FROM, _TO = "2024-01-10 00:00:00", "2024-01-12 00:00:00"


@query(f"SELECT event_id FROM events WHERE ts >= TIMESTAMP '{_FROM}' - INTERVAL 5 SECOND AND ts <= TIMESTAMP '{_TO}' + INTERVAL 60 SECOND")
def q_freshness_filter(spark, sf_dir):
    events = b.table(spark, sf_dir, "events")
    return events.where(fresh(F.col("ts"), F.lit(_FROM), F.lit(_TO))).select("event_id")


@query(f"""WITH e AS (SELECT *, ts >= TIMESTAMP '{_FROM}' - INTERVAL 5 SECOND AND ts <= TIMESTAMP '{_TO}' + INTERVAL 60 SECOND AS ok FROM events)
SELECT event_type, count(*) AS received, count(*) FILTER (WHERE ok) AS fresh, count(*) FILTER (WHERE NOT ok) AS stale, CAST(epoch_us(min(ts) FILTER (WHERE ok)) AS BIGINT) AS first_fresh_us FROM e GROUP BY event_type""")
def q_first_fresh_event(spark, sf_dir):
    out = evidence(b.table(spark, sf_dir, "events"), "ts", F.lit(_FROM), F.lit(_TO), ["event_type"])
    return out.select("event_type", "received", "fresh", "stale", F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', first_fresh)").alias("first_fresh_us"))


@query("""SELECT event_id, CASE event_id % 5 WHEN 0 THEN (1704067200 + event_id * 60) * 1000000 WHEN 1 THEN (1704067200000 + event_id * 1001) * 1000
  WHEN 2 THEN epoch_us(TIMESTAMP '2024-01-05 09:31:00') + event_id % 60 * 1000000 WHEN 3 THEN epoch_us(TIMESTAMP '2024-01-05 09:31:59') + event_id % 900 * 1000 END AS at_us FROM events""")
def q_event_time(spark, sf_dir):
    k = F.col("event_id")
    raw = (
        F.when(k % 5 == 0, (F.lit(1704067200) + k * 60).cast("string")).when(k % 5 == 1, (F.lit(1704067200000) + k * 1001).cast("string"))
        .when(k % 5 == 2, F.concat(F.lit("202401050931"), F.lpad((k % 60).cast("string"), 2, "0"))).when(k % 5 == 3, F.concat(F.lit("20240105093159"), F.lpad((k % 900).cast("string"), 3, "0"))).otherwise("20241305")
    )
    rows = b.table(spark, sf_dir, "events").select("event_id", event_time(raw).alias("t"))
    return rows.select("event_id", F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', t)").alias("at_us"))


# --- getters, discovery and normalisation over whole tables ------------------------------------------------------

@query(f"WITH {b.FUTURES}, {b.INDEX} SELECT trade_date, index_code, round(close, 8) AS close FROM idx WHERE trade_date BETWEEN DATE '1993-01-01' AND DATE '1997-12-31'")
def q_index_range(spark, sf_dir):
    codes = list(b.SPOTS.values()) + [f"IDX{n}" for n in range(3, 25, 4)]
    return research.index_bars(b.index_days(spark, sf_dir), codes, "1993-01-01", "1997-12-31").select("trade_date", "index_code", *_r("close"))


@query(f"WITH {b.FUTURES} SELECT trade_date, contract_code, round(close, 8) AS close, volume FROM futures WHERE contract_code IN ('1', '2', '4') AND trade_date >= DATE '1995-06-01'")
def q_future_range(spark, sf_dir):
    return research.future_bars(b.futures(spark, sf_dir), ["1", "2", "4"], "1995-06-01").select("trade_date", "contract_code", *_r("close"), "volume")


@query(f"""WITH {b.FUTURES}, {b.INDEX} SELECT f.trade_date, contract_code, product, round(f.close - i.close, 8) AS basis_close FROM futures f
JOIN idx i ON f.trade_date = i.trade_date AND i.index_code = 'IDX' || product WHERE product IN ('0', '1', '2') AND f.trade_date <= DATE '1996-12-31'""")
def q_basis_range(spark, sf_dir):
    none = b.contracts(spark, sf_dir).select(F.lit("").alias("mapping_type"), F.lit(None).cast("date").alias("effective_trade_date"), "contract_code").limit(0)
    rows = fut.basis(b.futures(spark, sf_dir), b.index_days(spark, sf_dir), b.contracts(spark, sf_dir), none, b.SPOTS)
    return research.basis_of(rows, ["0", "1", "2"], None, "1996-12-31").where("basis_close is not null").select("trade_date", "contract_code", "product", *_r("basis_close"))


@query(f"""WITH {b.BARS}, {b.SECURITIES} SELECT trade_date, b.stock_code, round(close, 8) AS close FROM bars b JOIN securities s ON b.stock_code = s.stock_code
WHERE list_date <= trade_date AND (delist_date IS NULL OR delist_date >= trade_date) AND trade_date IN (SELECT CAST(o_orderdate AS DATE) FROM orders)""")
def q_bars_in_universe(spark, sf_dir):
    days = b.open_days(spark, sf_dir).withColumn("is_open", F.lit(True))
    members = universe.historical_universe(b.securities(spark, sf_dir), days, "ALL")
    return research.eligible_bars(b.bars(spark, sf_dir), members, "ALL").select("trade_date", "stock_code", *_r("close"))


@query(f"WITH {b.MEMBERS} SELECT DISTINCT code FROM members WHERE sector IN (0, 2) AND (code LIKE '%1' OR code LIKE '%6')")
def q_discover_codes(spark, sf_dir):
    return feed.discover_codes(b.members(spark, sf_dir), [0, 2], ["1", "6"])


@query(f"WITH {b.MEMBERS} SELECT DISTINCT sector, code FROM members WHERE sector IN (1, 3, 4) AND (in_date IS NULL OR in_date <= DATE '1996-01-01') AND (out_date IS NULL OR out_date > DATE '1996-01-01')")
def q_sectors_as_of(spark, sf_dir):
    return feed.members_on(b.members(spark, sf_dir), [1, 3, 4], "1996-01-01")


@query("SELECT CAST(s_suppkey AS VARCHAR) AS code, DATE '1992-01-01' + CAST(s_suppkey * 53 % 2600 AS INT) AS expire_date FROM supplier WHERE s_suppkey % 11 <> 0 AND s_suppkey * 53 % 2600 < 1461")
def q_expired_candidates(spark, sf_dir):
    contracts = b.contracts(spark, sf_dir).select(F.col("contract_code").alias("code"), F.coalesce(F.date_format("expire_date", "yyyyMMdd"), F.lit("0")).alias("ExpireDate"))
    return feed.expired_candidates(contracts.select("code"), contracts, "1996-01-01")


@query("""SELECT CAST(l_suppkey AS VARCHAR) AS stock_code, l_orderkey, l_linenumber, l_partkey, CAST(l_shipdate AS DATE) AS trade_date, l_extendedprice AS close, CASE WHEN l_quantity > 1 THEN l_quantity END AS volume FROM lineitem""")
def q_flatten_market(spark, sf_dir):
    lines = b.table(spark, sf_dir, "lineitem").groupBy(F.col("l_suppkey").cast("string").alias("code")).agg(F.collect_list(F.struct(
        "l_orderkey", "l_linenumber", "l_partkey", F.date_format("l_shipdate", "yyyyMMdd").alias("time"), F.col("l_extendedprice").alias("close"), F.when(F.col("l_quantity") > 1, F.col("l_quantity")).alias("volume")
    )).alias("rows"))
    flat = normalize.flatten_codes(lines.select(F.create_map("code", "rows").alias("m")), "m", "stock_code")
    return flat.select("stock_code", "l_orderkey", "l_linenumber", "l_partkey", epoch_or_text_date(F.col("time")).alias("trade_date"), "close", "volume")


@query(f"WITH {b.BARS} SELECT trade_date, stock_code, round(open, 8) AS open, round(high, 8) AS high, round(low, 8) AS low, round(close, 8) AS close, round(low, 8) AS pre_close, volume, amount, 0.0::DOUBLE AS suspend_flag FROM bars")
def q_normalize_bars(spark, sf_dir):
    rows = b.bars(spark, sf_dir)
    raw = rows.select(F.date_format("trade_date", "yyyy-MM-dd").alias("stime"), "stock_code", "open", "high", "low", "close", F.col("low").alias("preClose"), F.col("volume").cast("decimal(18,2)").alias("volume"), "amount", F.lit("0").alias("suspendFlag"))
    odd = raw.where("stock_code = '1'").withColumn("stime", F.lit("20261399"))  # no date: these rows go
    prices = ("open", "high", "low", "close", "pre_close")
    out = normalize.normalize_bars(raw.unionByName(odd), "stock")
    return out.select(*[F.round(c, 8).alias(c) if c in prices else F.col(c) for c in out.columns])


@query("""SELECT CAST(o_custkey % 200 AS VARCHAR) AS stock_code, CASE WHEN o_orderstatus = 'F' THEN 'UNKNOWN' ELSE o_orderstatus END AS table_name, o_orderkey, o_totalprice,
  sha256(concat_ws(chr(31), CAST(o_custkey % 200 AS VARCHAR), CASE WHEN o_orderstatus = 'F' THEN 'UNKNOWN' ELSE o_orderstatus END)) AS source_record_key FROM orders""")
def q_flatten_financial(spark, sf_dir):
    per = b.table(spark, sf_dir, "orders").select((F.col("o_custkey") % 200).cast("string").alias("code"), F.when(F.col("o_orderstatus") != "F", F.col("o_orderstatus")).otherwise("UNKNOWN").alias("t"), F.struct("o_orderkey", "o_totalprice").alias("r"))
    tables = per.groupBy("code", "t").agg(F.collect_list("r").alias("rows")).groupBy("code").agg(F.map_from_entries(F.collect_list(F.struct("t", "rows"))).alias("tables"))
    flat = normalize.flatten_financial(tables.select(F.create_map("code", "tables").alias("m")), "m")
    return normalize.provisional_key(flat)


@query(f"""WITH {b.FINANCIALS} SELECT stock_code, table_name, report_period, announce_date, available_date, order_key, source_record_key FROM fin_keyed
WHERE announce_date IS NOT NULL AND available_date IS NOT NULL QUALIFY row_number() OVER (PARTITION BY source_record_key ORDER BY order_key DESC) = 1""")
def q_financial_pit_view(spark, sf_dir):
    dated = pit.assign_availability(b.financials(spark, sf_dir), b.open_days(spark, sf_dir))
    return pit.pit_view(dated, [F.col("order_key")]).select("stock_code", "table_name", "report_period", "announce_date", "available_date", "order_key", "source_record_key")


@query(f"WITH {b.BARS} SELECT trade_date, stock_code, volume FROM bars WHERE day(trade_date) % 4 <> 0")
def q_real_bars(spark, sf_dir):
    padded = b.bars(spark, sf_dir)
    gone = F.dayofmonth("trade_date") % 4 == 0
    padded = padded.select("trade_date", "stock_code", "volume", *[F.when(gone, F.lit(0.0) if c != "low" else None).otherwise(F.col(c)).alias(c) for c in ("open", "high", "low", "close")])
    return feed.real_bars(padded).select("trade_date", "stock_code", "volume")


@query("""SELECT 'o_orderkey' AS field, 'bigint' AS kind, count(o_orderkey) AS filled, count(*) - count(o_orderkey) AS empty FROM orders UNION ALL
SELECT 'urgent', 'string', count(*) FILTER (WHERE o_orderpriority LIKE '1%'), count(*) FILTER (WHERE o_orderpriority NOT LIKE '1%') FROM orders UNION ALL
SELECT 'o_totalprice', 'double', count(o_totalprice), count(*) - count(o_totalprice) FROM orders""")
def q_field_inventory(spark, sf_dir):
    orders = b.table(spark, sf_dir, "orders")
    return quality.inventory(orders.select("o_orderkey", F.when(F.col("o_orderpriority").startswith("1"), F.col("o_orderpriority")).alias("urgent"), "o_totalprice"))


@query("""SELECT event_id, '{"a": {"token": "***", "n": 1}, "account": "***", "b": ["***", ' || event_id || ']}' AS shown FROM events""")
def q_redact(spark, sf_dir):
    e = b.table(spark, sf_dir, "events").select("event_id", F.col("event_id").cast("string").alias("i"))
    text = F.concat(F.lit('{"a": {"token": "x,}\\"y'), F.col("i"), F.lit('", "n": 1}, "account": '), F.col("i"), F.lit('.5, "b": ["***", '), F.col("i"), F.lit("]}"))
    return e.select("event_id", redact(text, ["token", "account"]).alias("shown"))


@query("""SELECT event_type, time_bucket(INTERVAL 1 HOUR, ts) AS hour, count(*) AS n, round(max(value), 8) AS high, round(min(value), 8) AS low FROM events GROUP BY ALL""")
def q_event_windows(spark, sf_dir):
    per = b.table(spark, sf_dir, "events").groupBy("event_type", F.window("ts", "1 hour").alias("w")).agg(F.count(F.lit(1)).alias("n"), F.round(F.max("value"), 8).alias("high"), F.round(F.min("value"), 8).alias("low"))
    return per.select("event_type", F.col("w.start").alias("hour"), "n", "high", "low")


# --- breadths, sectors as they were, composites ------------------------------------------------------------------

_IMPROVING = f"i AS (SELECT *, quantile_cont(amihud, 0.5) OVER {_W20} AS med FROM a), d AS (SELECT *, med - lag(med, 20) OVER (PARTITION BY stock_code ORDER BY trade_date) AS delta FROM i)"
_SHARE = "round(avg(CASE WHEN {} THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 8) AS breadth, count(*) AS stocks"


@query(f"WITH {_RET}, o AS (SELECT *, quantile_cont(amihud, 0.5) OVER {_W60} AS own FROM a) SELECT trade_date, {_SHARE.format('amihud < own')} FROM o WHERE amihud IS NOT NULL AND own IS NOT NULL GROUP BY trade_date")
def q_breadth_illiquidity(spark, sf_dir):
    return liq.breadth(_base(spark, sf_dir), "amihud", above=False).select("trade_date", *_r("breadth"), "stocks")


@query(f"WITH {_RET}, {_IMPROVING} SELECT trade_date, {_SHARE.format('delta < 0')} FROM d WHERE delta IS NOT NULL GROUP BY trade_date")
def q_breadth_improving(spark, sf_dir):
    return liq.share_of(liq.improving(_base(spark, sf_dir)), F.col("improving")).select("trade_date", *_r("breadth"), "stocks")


@query(f"""WITH {_RET} SELECT trade_date, {_SHARE.format('amount > 0 AND NOT coalesce(high = low AND abs(ret) >= 0.098, false)')} FROM a GROUP BY trade_date""")
def q_breadth_tradable(spark, sf_dir):
    return liq.share_of(liq.tradability(liq.trade_flags(b.bars(spark, sf_dir))), F.col("tradability") >= 1).select("trade_date", *_r("breadth"), "stocks")


@query(f"WITH {_RET} SELECT trade_date, {_SHARE.format('ret <= -0.098')} FROM a WHERE ret IS NOT NULL GROUP BY trade_date")
def q_breadth_limit_down(spark, sf_dir):
    return liq.share_of(_base(spark, sf_dir), F.col("ret") <= -0.098).select("trade_date", *_r("breadth"), "stocks")


@query(f"""WITH {b.BARS}, c AS (SELECT trade_date, amount / sum(amount) OVER (PARTITION BY trade_date) AS s, count(*) OVER (PARTITION BY trade_date) AS n,
  row_number() OVER (PARTITION BY trade_date ORDER BY amount DESC, stock_code) AS rk FROM bars WHERE amount > 0)
SELECT trade_date, round(sum(CASE WHEN rk <= 100 THEN s ELSE 0 END), 8) AS top100_share, round(sum(CASE WHEN rk <= ceil(n * 0.01) THEN s ELSE 0 END), 8) AS top1pct_share FROM c GROUP BY trade_date""")
def q_top100_top1pct(spark, sf_dir):
    return liq.concentration(b.bars(spark, sf_dir), ["trade_date"], (100,), (0.01,)).select("trade_date", *_r("top100_share", "top1pct_share"))


def _sectors(spark, sf_dir) -> DataFrame:
    return liq.with_sector(_base(spark, sf_dir), b.members(spark, sf_dir))


_SECT = b.MEMBERS + ", s AS (SELECT {0}.*, sector FROM {0} JOIN members ON {0}.stock_code = code AND (in_date IS NULL OR in_date <= {0}.trade_date) AND (out_date IS NULL OR out_date > {0}.trade_date))"


@query(f"""WITH {_RET}, {_SECT.format('a')}, p AS (SELECT trade_date, sector, sum(amount) AS amount, sum(ff_cap) AS cap, median(amihud) AS ma, median(CASE WHEN ret < 0 THEN amihud END) AS md, count(*) AS stocks FROM s GROUP BY ALL),
q AS (SELECT *, amount / sum(amount) OVER (PARTITION BY trade_date) AS amount_share, cap / sum(cap) OVER (PARTITION BY trade_date) AS cap_share FROM p)
SELECT trade_date, sector, round(amount, 2) AS amount, round(amount / nullif(cap, 0), 8) AS turnover, round(ma * 1e9::DOUBLE, 6) AS median_amihud, round(md * 1e9::DOUBLE, 6) AS median_downside, stocks,
  round(amount_share, 8) AS amount_share, round(cap_share, 8) AS cap_share, round(amount_share / nullif(cap_share, 0), 8) AS rta FROM q""")
def q_sector_pit(spark, sf_dir):
    out = liq.sector_day(_sectors(spark, sf_dir))
    return out.select("trade_date", "sector", F.round("amount", 2).alias("amount"), *_r("turnover"), *_tiny("median_amihud", "median_downside"), "stocks", *_r("amount_share", "cap_share", "rta"))


@query(f"WITH {_RET}, {_IMPROVING}, {_SECT.format('d')} SELECT trade_date, sector, {_SHARE.format('delta < 0')} FROM s WHERE delta IS NOT NULL GROUP BY ALL")
def q_sector_breadth(spark, sf_dir):
    rows = liq.with_sector(liq.improving(_base(spark, sf_dir)), b.members(spark, sf_dir))
    return liq.share_of(rows, F.col("improving"), ("trade_date", "sector")).select("trade_date", "sector", *_r("breadth"), "stocks")


@query(f"""WITH {_RET}, {_SECT.format('a')}, c AS (SELECT trade_date, sector, amount / sum(amount) OVER g AS x, count(*) OVER g AS n, row_number() OVER (PARTITION BY trade_date, sector ORDER BY amount DESC, stock_code) AS rk
  FROM s WHERE amount > 0 WINDOW g AS (PARTITION BY trade_date, sector))
SELECT trade_date, sector, round(sum(x * x), 8) AS hhi, round(sum(CASE WHEN rk <= 3 THEN x ELSE 0 END), 8) AS top3_share FROM c GROUP BY ALL""")
def q_sector_concentration(spark, sf_dir):
    return liq.concentration(_sectors(spark, sf_dir), ["trade_date", "sector"], (3,), ()).select("trade_date", "sector", *_r("hhi", "top3_share"))


@query(f"""WITH {_RET}, t AS (SELECT *, CASE WHEN turnover > 0 THEN ln(turnover) END AS x FROM a), z AS (SELECT *, (x - avg(x) OVER {_W60}) / nullif(stddev_samp(x) OVER {_W60}, 0) AS z FROM t), {_SECT.format('z')}
SELECT trade_date, sector, round(sum(CASE WHEN z > 1.5 THEN amount ELSE 0 END) / nullif(sum(amount), 0), 8) AS hot_share FROM s GROUP BY ALL""")
def q_sector_hot_share(spark, sf_dir):
    z = liq.turnover_z(b.capped(spark, sf_dir)).select("trade_date", "stock_code", "turnover_z")
    rows = liq.with_sector(b.capped(spark, sf_dir).join(z, ["trade_date", "stock_code"]), b.members(spark, sf_dir))
    return liq.hot_share(rows, by=("trade_date", "sector")).select("trade_date", "sector", *_r("hot_share"))


@query(f"""WITH {_RET}, {_SECT.format('a')}, p AS (SELECT trade_date, sector, median(amihud) AS ma, round(sum(amount) / nullif(sum(ff_cap), 0), 8) AS tu, round(sum(amount), 2) AS am FROM s GROUP BY ALL),
ranks AS (SELECT *, percent_rank() OVER (PARTITION BY trade_date ORDER BY ma) AS r1, percent_rank() OVER (PARTITION BY trade_date ORDER BY tu) AS r2, percent_rank() OVER (PARTITION BY trade_date ORDER BY am) AS r3 FROM p WHERE ma IS NOT NULL)
SELECT trade_date, sector, round((1 - r1 + r2) / 2, 8) AS health, round((r2 + r3) / 2, 8) AS crowding FROM ranks""")
def q_sector_health_crowding(spark, sf_dir):
    per = liq.sector_day(_sectors(spark, sf_dir)).where("median_amihud is not null").select("trade_date", "sector", "median_amihud", F.round("turnover", 8).alias("turnover"), F.round("amount", 2).alias("amount"))
    for c in ("median_amihud", "turnover", "amount"):
        per = liq.cross_section_rank(per, c, f"r_{c}")
    return per.select("trade_date", "sector", F.round((1 - F.col("r_median_amihud") + F.col("r_turnover")) / 2, 8).alias("health"), F.round((F.col("r_turnover") + F.col("r_amount")) / 2, 8).alias("crowding"))


@query(f"""WITH {_RET}, {_SECT.format('a')}, i AS (SELECT *, ret - avg(ret) OVER (PARTITION BY trade_date, sector) AS idio FROM s)
SELECT trade_date, stock_code, round(idio, 8) AS idio, round(abs(idio) / nullif(amount, 0) * 1e9::DOUBLE, 4) AS idio_amihud FROM i""")
def q_idiosyncratic_amihud_sector(spark, sf_dir):
    return liq.idiosyncratic_amihud(_sectors(spark, sf_dir), ("sector",)).select("trade_date", "stock_code", *_r("idio"), F.round(F.col("idio_amihud") * _TINY, 4).alias("idio_amihud"))


@query(f"""WITH {b.BARS}, w AS (SELECT *, quantile_cont(volume, 0.01) OVER g AS lo, quantile_cont(volume, 0.99) OVER g AS hi FROM bars WINDOW g AS (PARTITION BY trade_date)),
l AS (SELECT trade_date, stock_code, ln(greatest(least(volume, hi), lo)) AS x FROM w), z AS (SELECT *, round((x - avg(x) OVER g) / nullif(stddev_samp(x) OVER g, 0), 6) AS z FROM l WINDOW g AS (PARTITION BY trade_date))
SELECT trade_date, stock_code, z AS feature, round(CASE WHEN z IS NOT NULL THEN percent_rank() OVER (PARTITION BY trade_date, z IS NULL ORDER BY z) END, 8) AS percentile FROM z""")
def q_feature_chain(spark, sf_dir):
    rows = liq.winsorise(b.bars(spark, sf_dir).select("trade_date", "stock_code", "volume"), "volume", ["trade_date"]).withColumn("volume", F.ln("volume"))
    rows = liq.standardise(rows, "volume", ["trade_date"]).select("trade_date", "stock_code", (F.round("volume", 6) + 0.0).alias("feature"))
    return liq.cross_section_rank(rows, "feature", "percentile").select("trade_date", "stock_code", "feature", *_r("percentile"))


def _history(n: int) -> str:
    def rank(x: str) -> str:
        h = f"list({x}) OVER (ORDER BY trade_date ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
        return f"CASE WHEN {x} IS NOT NULL THEN len(list_filter({h}, lambda v: v <= {x}))::DOUBLE / len(list_filter({h}, lambda v: v IS NOT NULL)) END"

    return f"""WITH {_RET}, {_MARKET}, c AS (SELECT trade_date, amount / sum(amount) OVER (PARTITION BY trade_date) AS s FROM a WHERE amount > 0), hhi AS (SELECT trade_date, round(sum(s * s), 10) AS hhi FROM c GROUP BY trade_date),
x AS (SELECT m.trade_date, round(market_turnover, 10) AS tu, median_amihud AS ma, median_downside AS md, hhi, round(total_amount, 2) AS am FROM m JOIN hhi USING (trade_date)),
ranks AS (SELECT trade_date, {rank("tu")} AS r1, 1 - {rank("ma")} AS r2, 1 - {rank("md")} AS r3, {rank("hhi")} AS r4, {rank("am")} AS r5 FROM x),
h AS (SELECT trade_date, list_avg([r1, r2, r3]) AS health, list_avg([r4, r5]) AS crowding FROM ranks)
SELECT trade_date, round(health, 8) AS health, round(crowding, 8) AS crowding, CASE WHEN health >= 0.5 AND crowding < 0.5 THEN 'HEALTHY' WHEN health >= 0.5 THEN 'HEALTHY_CROWDED' WHEN crowding >= 0.5 THEN 'FRAGILE_CROWDED' ELSE 'WEAK' END AS regime FROM h"""


def _composites(spark, sf_dir, n: int) -> DataFrame:
    base = _base(spark, sf_dir)
    market = liq.market_day(base).select("trade_date", F.round("market_turnover", 10).alias("market_turnover"), "median_amihud", "median_downside", F.round("total_amount", 2).alias("total_amount"))
    rows = market.join(liq.concentration(base, ["trade_date"], (), ()).select("trade_date", F.round("hhi", 10).alias("hhi")), "trade_date")
    rows = liq.composite(rows, {"market_turnover": True, "median_amihud": False, "median_downside": False}, n, "health")
    rows = liq.composite(rows, {"hhi": True, "total_amount": True}, n, "crowding")
    return liq.regime(rows, "health", "crowding").select("trade_date", *_r("health", "crowding"), "regime")


@query(_history(252))
def q_composite_rank252(spark, sf_dir):
    return _composites(spark, sf_dir, 252)


@query(_history(756))
def q_composite_rank756(spark, sf_dir):
    return _composites(spark, sf_dir, 756)


# --- sessions, regressions, long histories, options ---------------------------------------------------------------


@query("""WITH g AS (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) <= INTERVAL 6 HOUR THEN 0 ELSE 1 END AS new FROM events),
s AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS k FROM g)
SELECT user_id, min(ts) AS started, max(ts) AS last, count(*) AS n, count(DISTINCT event_type) AS types, round(max(value), 8) AS most FROM s GROUP BY user_id, k""")
def q_event_sessions(spark, sf_dir):
    out = sessions(b.table(spark, sf_dir, "events"), ["user_id"], "ts", "6 hours", types=F.size(F.collect_set("event_type")).cast("bigint"), most=F.max("value"))
    return out.select("user_id", "started", "last", "n", "types", *_r("most"))


@query(f"""WITH {_RET}, m AS (SELECT *, avg(ret) OVER (PARTITION BY trade_date) AS market FROM a), p AS (SELECT *, CASE WHEN ret IS NOT NULL THEN market END AS x FROM m),
c AS (SELECT *, ret - avg(ret) OVER (PARTITION BY stock_code) AS yc, x - avg(x) OVER (PARTITION BY stock_code) AS xc FROM p),
s AS (SELECT *, count(xc) OVER w AS n, sum(xc) OVER w AS sx, sum(yc) OVER w AS sy, sum(xc * xc) OVER w AS sxx, sum(xc * yc) OVER w AS sxy, sum(x * x) OVER w AS raw FROM c WINDOW w AS (PARTITION BY stock_code ORDER BY trade_date ROWS BETWEEN 59 PRECEDING AND CURRENT ROW)),
k AS (SELECT *, CASE WHEN n >= 20 AND n * sxx - sx * sx > 1e-12 * n * sxx AND n * sxx - sx * sx > 1e-18 * n * raw THEN (n * sxy - sx * sy) / (n * sxx - sx * sx) END AS beta FROM s)
SELECT trade_date, stock_code, round(beta, 6) AS beta, round(yc - (sy - beta * sx) / nullif(n, 0) - beta * xc, 6) AS residual FROM k""")
def q_market_beta60(spark, sf_dir):
    out = liq.market_beta(b.bars(spark, sf_dir))
    return out.select("trade_date", "stock_code", (F.round("beta", 6) + 0.0).alias("beta"), (F.round("residual", 6) + 0.0).alias("residual"))


def _long_rank(n: int) -> str:
    h = f"list(amihud) OVER (PARTITION BY stock_code ORDER BY trade_date ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
    return f"""WITH {_RET}, h AS (SELECT trade_date, stock_code, amihud, {h} AS l FROM a)
SELECT trade_date, stock_code, round(CASE WHEN amihud IS NOT NULL THEN len(list_filter(l, lambda v: v <= amihud))::DOUBLE / len(list_filter(l, lambda v: v IS NOT NULL)) END, 8) AS ts_percentile FROM h"""


@query(_long_rank(252))
def q_history_rank252(spark, sf_dir):
    return ranks.rank_in_history(_base(spark, sf_dir).select("trade_date", "stock_code", "amihud"), "amihud", 252).select("trade_date", "stock_code", *_r("ts_percentile"))


@query(_long_rank(756))
def q_history_rank756(spark, sf_dir):
    return ranks.rank_in_history(_base(spark, sf_dir).select("trade_date", "stock_code", "amihud"), "amihud", 756).select("trade_date", "stock_code", *_r("ts_percentile"))


@query(f"""WITH {b.CONTRACTS}, {b.OPTIONS}, lots AS (SELECT CAST(l_suppkey AS VARCHAR) AS contract_code, sum(l_quantity) AS v FROM lineitem GROUP BY 1),
f AS (SELECT product AS market, contract_code AS future, coalesce(v, 0) + CASE WHEN CAST(contract_code AS BIGINT) % 9 = 0 THEN 1e9::DOUBLE ELSE 0 END AS w FROM contracts LEFT JOIN lots USING (contract_code) WHERE expire_date IS NULL OR expire_date >= DATE '1996-01-01'),
o AS (SELECT product AS market, underlying AS future, code FROM options JOIN contracts ON underlying = contract_code WHERE options.expire_date IS NULL OR options.expire_date >= DATE '1996-01-01'
  QUALIFY row_number() OVER (PARTITION BY underlying ORDER BY volume DESC, code) = 1)
SELECT market, future, code AS option FROM f LEFT JOIN o USING (market, future) QUALIFY row_number() OVER (PARTITION BY market ORDER BY code IS NULL, w DESC, future) = 1""")
def q_option_pairs(spark, sf_dir):
    contracts = b.contracts(spark, sf_dir)
    lots = b.table(spark, sf_dir, "lineitem").groupBy(F.col("l_suppkey").cast("string").alias("contract_code")).agg(F.sum("l_quantity").alias("volume"))
    futures = contracts.join(lots, "contract_code", "left").select(F.col("product").alias("market"), F.col("contract_code").alias("code"), "expire_date", "volume", (F.col("contract_code").cast("bigint") % 9 == 0).alias("is_main"))
    options = b.option_chain(spark, sf_dir).join(contracts.select(F.col("contract_code").alias("underlying"), F.col("product").alias("market")), "underlying")
    return fut.option_pairs(futures, options, "1996-01-01")


@query(f"""WITH {b.FUTURES}, {b.OPTIONS} SELECT trade_date, contract_code, kind, round(close, 8) AS close, code AS option, strike FROM futures JOIN options ON contract_code = underlying
  AND (options.list_date IS NULL OR options.list_date <= trade_date) AND (options.expire_date IS NULL OR options.expire_date >= trade_date)
QUALIFY row_number() OVER (PARTITION BY trade_date, contract_code, kind ORDER BY abs(strike - close), strike, options.expire_date NULLS LAST, code) = 1""")
def q_option_nearest_strike(spark, sf_dir):
    out = fut.nearest_strikes(b.futures(spark, sf_dir), b.option_chain(spark, sf_dir))
    return out.select("trade_date", "contract_code", "kind", *_r("close"), "option", "strike")


# --- the rest of fund, futures and option flows -------------------------------------------------------------------

_KIND = "CASE CAST(stock_code AS BIGINT) % 3 WHEN 0 THEN 'broad' WHEN 1 THEN 'sector' ELSE 'theme' END"


@query(f"""WITH {b.CAPPED}, x AS (SELECT *, sign(close - {_LAG.format("close")}) AS up, sign(volume - {_LAG.format("volume")}) AS more FROM capped)
SELECT trade_date, stock_code AS code, round(amount / nullif(volume * low, 0), 8) AS etf_turnover, CASE WHEN up * more = 0 THEN 'FLAT' WHEN up > 0 AND more > 0 THEN 'UP_CREATION' WHEN up > 0 THEN 'UP_REDEMPTION'
  WHEN more > 0 THEN 'DOWN_CREATION' WHEN more < 0 THEN 'DOWN_REDEMPTION' END AS price_share_state FROM x""")
def q_etf_activity(spark, sf_dir):
    return flows.etf_activity(_funds(spark, sf_dir)).select("trade_date", "code", *_r("etf_turnover"), "price_share_state")


@query(f"""WITH {b.CAPPED}, x AS (SELECT *, (volume - {_LAG.format("volume")}) * low AS f, volume * low AS a, {_KIND} AS kind FROM capped)
SELECT trade_date, {", ".join(f"round(sum(f) FILTER (WHERE kind = '{k}'), 6) + 0.0::DOUBLE AS {k}_flow, round(sum(f) FILTER (WHERE kind = '{k}') / nullif(sum(a) FILTER (WHERE kind = '{k}'), 0), 8) + 0.0::DOUBLE AS {k}_flow_share" for k in ("broad", "sector", "theme"))}
FROM x GROUP BY trade_date""")
def q_etf_flow_kinds(spark, sf_dir):
    rows = _funds(spark, sf_dir).withColumn("kind", F.element_at(F.array(F.lit("broad"), F.lit("sector"), F.lit("theme")), (F.col("code").cast("bigint") % 3 + 1).cast("int")))
    out = flows.etf_flow_by_kind(rows, ["broad", "sector", "theme"])
    return out.select("trade_date", *[(F.round(c, 8 if c.endswith("share") else 6) + 0.0).alias(c) for c in out.columns[1:]])


@query(f"""WITH {b.FUTURES}, {b.INDEX}, x AS (SELECT f.trade_date, contract_code, CASE WHEN i.close > 0 THEN (f.close - i.close) / i.close END AS pct, open_interest,
    open_interest - lag(open_interest) OVER (PARTITION BY contract_code ORDER BY f.trade_date) AS more FROM futures f LEFT JOIN idx i ON f.trade_date = i.trade_date AND i.index_code = 'IDX' || product AND CAST(product AS INT) % 4 <> 3),
z AS (SELECT *, (pct - avg(pct) OVER w) / nullif(stddev_samp(pct) OVER w, 0) AS z FROM x WINDOW w AS (PARTITION BY contract_code ORDER BY trade_date ROWS BETWEEN 59 PRECEDING AND CURRENT ROW))
SELECT trade_date, contract_code, 0.0::DOUBLE - round(z, 6) AS stress, CASE WHEN pct IS NULL OR more IS NULL THEN NULL WHEN more = 0 THEN 'STEADY' WHEN pct >= 0 AND more > 0 THEN 'PREMIUM_BUILDING' WHEN pct >= 0 THEN 'PREMIUM_UNWINDING'
  WHEN more > 0 THEN 'DISCOUNT_BUILDING' ELSE 'DISCOUNT_UNWINDING' END AS leverage_regime FROM z""")
def q_basis_stress(spark, sf_dir):
    none = b.contracts(spark, sf_dir).select(F.lit("").alias("mapping_type"), F.lit(None).cast("date").alias("effective_trade_date"), "contract_code").limit(0)
    rows = fut.basis(b.futures(spark, sf_dir), b.index_days(spark, sf_dir), b.contracts(spark, sf_dir), none, b.SPOTS, keep=("open_interest",))
    out = flows.basis_stress(rows.select("trade_date", "contract_code", "basis_pct", "open_interest"))
    return out.select("trade_date", "contract_code", (F.lit(0.0) + F.round("stress", 6)).alias("stress"), "leverage_regime")


@query(f"""WITH {b.OPTIONS} SELECT underlying, round(sum(volume) FILTER (WHERE kind = 'P') / nullif(sum(volume) FILTER (WHERE kind = 'C'), 0), 8) AS put_call,
  round(sum(volume * volume) FILTER (WHERE kind = 'P') / nullif(sum(volume) FILTER (WHERE kind = 'P') * sum(volume) FILTER (WHERE kind = 'P'), 0), 8) AS put_concentration FROM options GROUP BY underlying""")
def q_put_call(spark, sf_dir):
    return flows.put_call(b.option_chain(spark, sf_dir)).select("underlying", *_r("put_call", "put_concentration"))
