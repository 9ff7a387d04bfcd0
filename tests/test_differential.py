"""Operators against DuckDB on small random frames full of nulls and ties."""

import random
from datetime import date, timedelta

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark.operators import calendar as cal
from tidemark.operators import futures as fut
from tidemark.operators import liquidity as liq
from tidemark.operators import universe
from tidemark.operators.versions import latest_version

DAY = date(2026, 1, 1)


def rows_of(result):
    return sorted(tuple("null" if v is None or v != v else f"{v:.9g}" if isinstance(v, float) else str(v) for v in r) for r in result)


def same(got, want):
    assert rows_of(got.select(*want.columns).collect()) == rows_of(want.fetchall())


def maybe(rng, v, p=0.2):
    return None if rng.random() < p else v


@pytest.fixture(params=[1, 2, 3])
def case(request, spark):
    rng, con = random.Random(request.param), duckdb.connect()

    def table(name, rows, schema):
        df = spark.createDataFrame(rows, schema)
        kinds = [c.split(" ")[1] for c in schema.split(", ")]
        names = [c.split(" ")[0] for c in schema.split(", ")]
        con.register(f"_{name}", pd.DataFrame({n: pd.Series([r[i] for r in rows], dtype=object) for i, n in enumerate(names)}))
        sql = {"long": "BIGINT", "double": "DOUBLE", "date": "DATE", "string": "VARCHAR", "int": "INT"}
        con.sql(f"CREATE TABLE {name} AS SELECT " + ", ".join(f"CAST({n} AS {sql[k]}) AS {n}" for n, k in zip(names, kinds, strict=True)) + f" FROM _{name}")
        return df

    return rng, con, table


def test_latest_version(case):
    rng, con, table = case
    df = table("t", [(maybe(rng, rng.randrange(5)), maybe(rng, rng.randrange(3)), rng.randrange(4), i) for i in range(80)], "a long, b long, v long, i long")
    same(latest_version(df, ["a", "b"], [F.col("v"), F.col("i")], F.col("v") > 0), con.sql("SELECT a, b, v, i FROM t WHERE v > 0 QUALIFY row_number() OVER (PARTITION BY a, b ORDER BY v DESC, i DESC) = 1"))


def test_next_open_day(case):
    rng, con, table = case
    days = table("days", [(DAY + timedelta(d),) for d in sorted(rng.sample(range(60), 15))], "trade_date date")
    rows = table("r", [(i, maybe(rng, DAY + timedelta(rng.randrange(-10, 70)))) for i in range(120)], "i long, a date")
    same(cal.next_open_day(rows, days, "a", "n"), con.sql("SELECT i, a, trade_date AS n FROM r ASOF LEFT JOIN days ON r.a < trade_date"))


def test_main_contract_and_basis(case):
    rng, con, table = case
    codes = [f"C{i}" for i in range(8)]
    master = table("m", [(c, maybe(rng, DAY + timedelta(rng.randrange(5, 40)))) for c in codes], "contract_code string, expire_date date")
    bars = [(DAY + timedelta(d), c, f"P{i % 2}", maybe(rng, float(rng.randrange(90, 99))), maybe(rng, 95.0), maybe(rng, float(rng.randrange(-1, 3)), 0.5), maybe(rng, float(rng.randrange(-1, 4)))) for d in range(30) for i, c in enumerate(codes)]
    f = table("f", bars, "trade_date date, contract_code string, product string, close double, settlement double, open_interest double, volume double")
    eod = fut.main_contracts(f, master)
    con.sql("""CREATE TABLE eod AS WITH c AS (SELECT f.*, expire_date, bool_or(coalesce(open_interest >= 0, false)) OVER g AS oi, count(*) OVER g AS n FROM f JOIN m USING (contract_code) WHERE expire_date > trade_date WINDOW g AS (PARTITION BY trade_date, product))
      SELECT trade_date, product, contract_code, n, CASE WHEN oi THEN 'MAX_OPEN_INTEREST' ELSE 'MAX_VOLUME_FALLBACK' END AS how FROM c WHERE CASE WHEN oi THEN open_interest ELSE volume END >= 0
      QUALIFY row_number() OVER (PARTITION BY trade_date, product ORDER BY CASE WHEN oi THEN open_interest ELSE volume END DESC, expire_date, contract_code) = 1""")
    same(eod.select(F.col("effective_trade_date").alias("trade_date"), "product", "contract_code", F.col("eligible_contract_count").alias("n"), F.col("selection_method").alias("how")), con.sql("FROM eod"))
    index = table("x", [(DAY + timedelta(d), "S0", maybe(rng, float(rng.randrange(0, 3) * 50))) for d in range(0, 30, 2)], "trade_date date, index_code string, close double")
    same(
        fut.basis(f, index, master, eod, {"P0": "S0"}).select("trade_date", "contract_code", "basis_close", "basis_settlement", "basis_pct", "days_to_expiry", "annualized_basis", "is_eod_main"),
        con.sql("""SELECT f.trade_date, f.contract_code, CASE WHEN x.close > 0 THEN f.close - x.close END AS basis_close, CASE WHEN x.close > 0 THEN settlement - x.close END AS basis_settlement,
          CASE WHEN x.close > 0 THEN (f.close - x.close) / x.close END AS basis_pct, expire_date - f.trade_date AS days_to_expiry,
          CASE WHEN x.close > 0 AND expire_date > f.trade_date THEN (f.close - x.close) / x.close * 365 / (expire_date - f.trade_date) END AS annualized_basis,
          EXISTS (FROM eod e WHERE e.trade_date = f.trade_date AND e.contract_code = f.contract_code) AS is_eod_main
        FROM f LEFT JOIN m USING (contract_code) LEFT JOIN x ON x.trade_date = f.trade_date AND x.index_code = CASE WHEN f.product = 'P0' THEN 'S0' END"""),
    )


def test_universe(case):
    rng, con, table = case
    s = table("s", [(f"S{i}", maybe(rng, DAY + timedelta(rng.randrange(20))), maybe(rng, DAY + timedelta(rng.randrange(20)))) for i in range(20)], "stock_code string, list_date date, delist_date date")
    days = table("d", [(DAY + timedelta(i),) for i in range(0, 20, 3)], "trade_date date").withColumn("is_open", F.lit(True))
    same(universe.historical_universe(s, days), con.sql("SELECT trade_date, stock_code FROM s JOIN d ON (list_date IS NULL OR list_date <= trade_date) AND (delist_date IS NULL OR delist_date >= trade_date)"))


def test_rolling_illiquidity(case):
    rng, con, table = case
    rows = [(DAY + timedelta(d), f"S{i}", maybe(rng, float(rng.randrange(0, 4))), maybe(rng, float(rng.randrange(0, 5) * 1000))) for i in range(4) for d in rng.sample(range(50), 30)]
    bars = table("b", rows, "trade_date date, stock_code string, close double, amount double")
    same(
        liq.amihud(bars, (5,)).select("trade_date", "stock_code", "amihud", "amihud5"),
        con.sql("""WITH r AS (SELECT *, close / nullif(lag(close) OVER (PARTITION BY stock_code ORDER BY trade_date), 0) - 1 AS ret FROM b), a AS (SELECT *, abs(ret) / nullif(amount, 0) AS amihud FROM r)
          SELECT trade_date, stock_code, amihud, quantile_cont(amihud, 0.5) OVER (PARTITION BY stock_code ORDER BY trade_date ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS amihud5 FROM a"""),
    )
