"""The market's roles played by the star-schema tables; each has the same definition in SQL.

Money has two decimals, so sums of it are rounded to two; prices and ratios are never rounded on the way.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SPOTS = {str(n): f"IDX{n}" for n in range(0, 25) if n % 4 != 3}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily bars of lines. Few lines share a stock and a day, so lines travel as they are, once, to their stock.

    Each stock is sorted by day there; what goes on by stock and day needs no further shuffle or sort, and all that
    asks for the same columns of lines reads the same shuffle.
    """
    raw = ("l_shipdate", "l_suppkey", "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_quantity")
    order = F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_quantity")
    price = F.col("l_extendedprice") / F.col("l_quantity")
    lines = table(spark, sf_dir, "lineitem").select(*raw).withColumn("stock_code", F.col("l_suppkey").cast("string")).repartition("stock_code")
    lines = lines.select("stock_code", F.col("l_shipdate").cast("date").alias("trade_date"), price.alias("p"), order.alias("o"), "l_quantity", "l_extendedprice")
    return lines.groupBy("stock_code", "trade_date").agg(
        F.min_by("p", "o").alias("open"), F.max("p").alias("high"), F.min("p").alias("low"), F.max_by("p", "o").alias("close"),
        F.sum("l_quantity").alias("volume"), F.round(F.sum("l_extendedprice"), 2).alias("amount"),
    ).select("trade_date", "stock_code", "open", "high", "low", "close", "volume", "amount")


BARS = """bars AS (
  SELECT CAST(l_shipdate AS DATE) AS trade_date, CAST(l_suppkey AS VARCHAR) AS stock_code,
    first(l_extendedprice / l_quantity ORDER BY l_orderkey, l_linenumber, l_partkey, l_extendedprice, l_quantity) AS open,
    max(l_extendedprice / l_quantity) AS high, min(l_extendedprice / l_quantity) AS low,
    last(l_extendedprice / l_quantity ORDER BY l_orderkey, l_linenumber, l_partkey, l_extendedprice, l_quantity) AS close,
    sum(l_quantity) AS volume, round(sum(l_extendedprice), 2) AS amount
  FROM lineitem GROUP BY ALL)"""


def capped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars with a free-float cap: a figure for each stock."""
    cap = (F.col("stock_code").cast("bigint") * 7919 % 1000 + 1) * 1e5
    return bars(spark, sf_dir).withColumn("ff_cap", cap)


CAPPED = BARS + """, capped AS (SELECT *, (CAST(stock_code AS BIGINT) * 7919 % 1000 + 1) * 1e5::DOUBLE AS ff_cap FROM bars)"""


def open_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("trade_date")).distinct()


DAYS = "days AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS trade_date FROM orders)"


def securities(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("s_suppkey").cast("int")
    listed = F.date_add(F.lit("1992-01-01").cast("date"), k * 37 % 1000)
    return table(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("string").alias("stock_code"), listed.alias("list_date"), F.when(k % 3 != 0, F.date_add(listed, k * 91 % 1500)).alias("delist_date"))


SECURITIES = """securities AS (
  SELECT CAST(s_suppkey AS VARCHAR) AS stock_code, DATE '1992-01-01' + CAST(s_suppkey * 37 % 1000 AS INT) AS list_date,
    CASE WHEN s_suppkey % 3 <> 0 THEN DATE '1992-01-01' + CAST(s_suppkey * 37 % 1000 + s_suppkey * 91 % 1500 AS INT) END AS delist_date
  FROM supplier)"""


def members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sectors: each stock is in its region's until a day, then in the next one's."""
    nations = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_regionkey").alias("r"))
    k = F.col("s_suppkey").cast("int")
    moved, never = F.date_add(F.lit("1994-01-01").cast("date"), k * 23 % 1500), F.lit(None).cast("date")
    rows = table(spark, sf_dir, "supplier").join(nations, "s_nationkey")
    code = F.col("s_suppkey").cast("string").alias("code")
    return rows.select(F.col("r").alias("sector"), code, never.alias("in_date"), moved.alias("out_date")).unionByName(
        rows.select(((F.col("r") + 1) % 5).alias("sector"), code, moved.alias("in_date"), never.alias("out_date"))
    )


MEMBERS = """members AS (
  SELECT n_regionkey AS sector, CAST(s_suppkey AS VARCHAR) AS code, NULL::DATE AS in_date, DATE '1994-01-01' + CAST(s_suppkey * 23 % 1500 AS INT) AS out_date
  FROM supplier JOIN nation ON s_nationkey = n_nationkey UNION ALL
  SELECT (n_regionkey + 1) % 5, CAST(s_suppkey AS VARCHAR), DATE '1994-01-01' + CAST(s_suppkey * 23 % 1500 AS INT), NULL
  FROM supplier JOIN nation ON s_nationkey = n_nationkey)"""


def contracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("s_suppkey").cast("int")
    start = F.lit("1992-01-01").cast("date")
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").cast("string").alias("contract_code"), F.col("s_nationkey").cast("string").alias("product"),
        F.when(k % 13 != 0, F.date_add(start, k * 17 % 900)).alias("list_date"), F.when(k % 11 != 0, F.date_add(start, k * 53 % 2600)).alias("expire_date"),
    )


CONTRACTS = """contracts AS (
  SELECT CAST(s_suppkey AS VARCHAR) AS contract_code, CAST(s_nationkey AS VARCHAR) AS product,
    CASE WHEN s_suppkey % 13 <> 0 THEN DATE '1992-01-01' + CAST(s_suppkey * 17 % 900 AS INT) END AS list_date,
    CASE WHEN s_suppkey % 11 <> 0 THEN DATE '1992-01-01' + CAST(s_suppkey * 53 % 2600 AS INT) END AS expire_date
  FROM supplier)"""


def futures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract days; open interest is missing on every fifth day of the month and invalid on every seventh."""
    day = F.dayofmonth("trade_date")
    products = contracts(spark, sf_dir).select("contract_code", "product")
    b = bars(spark, sf_dir).withColumnRenamed("stock_code", "contract_code").join(products, "contract_code")
    return b.select(
        "trade_date", "contract_code", "product", "close", F.when(day % 4 != 0, F.col("low")).alias("settlement"),
        F.when(day % 5 == 0, None).when(day % 7 == 0, -1.0).otherwise(F.col("volume")).alias("open_interest"), F.col("amount").alias("volume"),
    )


FUTURES = BARS + ", " + CONTRACTS + """, futures AS (
  SELECT trade_date, contract_code, product, close, CASE WHEN day(trade_date) % 4 <> 0 THEN low END AS settlement,
    CASE WHEN day(trade_date) % 5 = 0 THEN NULL WHEN day(trade_date) % 7 = 0 THEN -1.0 ELSE volume END AS open_interest, amount AS volume
  FROM bars JOIN contracts ON stock_code = contract_code)"""


def option_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as options on the suppliers' contracts: calls and puts, struck at the retail price."""
    k = F.col("p_partkey").cast("int")
    count = table(spark, sf_dir, "supplier").agg(F.max("s_suppkey")).scalar()
    start = F.lit("1992-01-01").cast("date")
    return table(spark, sf_dir, "part").select(
        F.concat(F.lit("O"), F.col("p_partkey").cast("string")).alias("code"), (k % count + 1).cast("string").alias("underlying"), F.when(k % 2 == 0, "C").otherwise("P").alias("kind"), F.col("p_retailprice").alias("strike"),
        F.when(k % 5 != 0, F.date_add(start, k * 29 % 1200)).alias("list_date"), F.when(k % 7 != 0, F.date_add(start, k * 29 % 1200 + k * 13 % 1500)).alias("expire_date"), F.col("p_size").cast("double").alias("volume"),
    )


OPTIONS = """options AS (
  SELECT 'O' || p_partkey AS code, CAST(p_partkey % (SELECT max(s_suppkey) FROM supplier) + 1 AS VARCHAR) AS underlying, CASE WHEN p_partkey % 2 = 0 THEN 'C' ELSE 'P' END AS kind, p_retailprice AS strike,
    CASE WHEN p_partkey % 5 <> 0 THEN DATE '1992-01-01' + CAST(p_partkey * 29 % 1200 AS INT) END AS list_date,
    CASE WHEN p_partkey % 7 <> 0 THEN DATE '1992-01-01' + CAST(p_partkey * 29 % 1200 + p_partkey * 13 % 1500 AS INT) END AS expire_date, p_size::DOUBLE AS volume
  FROM part)"""


def index_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A spot index for each product: the day's greatest low; nothing on days that are a multiple of nine."""
    f = futures(spark, sf_dir).where(F.dayofmonth("trade_date") % 9 != 0)
    return f.groupBy("trade_date", F.concat(F.lit("IDX"), "product").alias("index_code")).agg(F.max("close").alias("close"))


INDEX = """idx AS (SELECT trade_date, 'IDX' || product AS index_code, max(close) AS close FROM futures WHERE day(trade_date) % 9 <> 0 GROUP BY ALL)"""


def financials(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as financial records: the table by priority, two of them snapshot tables; the period a quarter's end."""
    o = table(spark, sf_dir, "orders")
    day = F.col("o_orderdate").cast("date")
    name = F.when(F.col("o_orderpriority").startswith("1"), "Top10Holder").when(F.col("o_orderpriority").startswith("2"), "Top10FlowHolder").when(F.col("o_orderpriority").startswith("3"), "Income").otherwise("Balance")
    return o.select(
        (F.col("o_custkey") % 200).cast("string").alias("stock_code"), name.alias("table_name"), F.date_format(F.trunc(day, "year"), "yyyy1231").alias("report_period"),
        F.when(F.col("o_orderkey") % 17 != 0, day).alias("announce_date"), (F.col("o_orderkey") % 10 + 1).alias("rank"), F.col("o_orderkey").alias("order_key"), F.col("o_totalprice").alias("value"),
    )


FINANCIALS = """fin AS (
  SELECT CAST(o_custkey % 200 AS VARCHAR) AS stock_code,
    CASE WHEN o_orderpriority LIKE '1%' THEN 'Top10Holder' WHEN o_orderpriority LIKE '2%' THEN 'Top10FlowHolder' WHEN o_orderpriority LIKE '3%' THEN 'Income' ELSE 'Balance' END AS table_name,
    strftime(CAST(o_orderdate AS DATE), '%Y1231') AS report_period, CASE WHEN o_orderkey % 17 <> 0 THEN CAST(o_orderdate AS DATE) END AS announce_date,
    o_orderkey % 10 + 1 AS rank, o_orderkey AS order_key, o_totalprice AS value
  FROM orders), """ + DAYS + """, fin_dated AS (
  SELECT fin.*, d.trade_date AS available_date FROM fin ASOF LEFT JOIN days d ON fin.announce_date < d.trade_date),
fin_keyed AS (
  SELECT *, sha256(logical || chr(31) || coalesce(CAST(announce_date AS VARCHAR), '<NULL>')) AS source_record_key, logical AS logical_record_key,
    sha256(concat_ws(chr(31), stock_code, table_name, report_period, coalesce(CAST(announce_date AS VARCHAR), '<NULL>'))) AS snapshot_version_key
  FROM (SELECT *, CASE WHEN table_name LIKE 'Top10%' THEN sha256(concat_ws(chr(31), stock_code, table_name, report_period, CAST(rank AS VARCHAR)))
    ELSE sha256(concat_ws(chr(31), stock_code, table_name, report_period)) END AS logical FROM fin_dated))"""
