"""Upstream frames in typed columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import detail_date, epoch_or_text_date, number, record_key

# Upstream names and ours, one misspelt upstream.
RENAMES = {
    "time": "trade_date",
    "stime": "trade_date",
    "preClose": "pre_close",
    "suspendFlag": "suspend_flag",
    "openInterest": "open_interest",
    "settlementPrice": "settlement",
    "settelementPrice": "settlement",
}
# Expiry dates that mean "none".
SENTINELS = ("10001011", "10001111", "10011011", "10011111", "10111111")

ASSETS = {
    "stock": ("stock_code", ("open", "high", "low", "close", "volume", "amount")),
    "index": ("index_code", ("open", "high", "low", "close")),
    "future": ("contract_code", ("open", "high", "low", "close", "volume", "open_interest", "settlement")),
}
NUMERIC = ("open", "high", "low", "close", "pre_close", "volume", "amount", "settlement", "open_interest", "suspend_flag")


def flatten_codes(df: DataFrame, column: str, code: str) -> DataFrame:
    """A map of code to an array of rows, as one row each."""
    per_code = df.select(F.explode(column).alias(code, "_rows"))
    return per_code.select(code, F.explode("_rows").alias("_row")).select(code, "_row.*")


def product(code: Column) -> Column:
    """The letters that a contract code starts with, in upper case; null without."""
    return F.upper(F.nullif(F.regexp_extract(code, "^([A-Za-z]+)", 1), F.lit("")))


def normalize_bars(raw: DataFrame, asset: str) -> DataFrame:
    """Daily bars with our names and types; rows without a date go. Missing required columns are an error."""
    code, required = ASSETS[asset]
    names: dict[str, str] = {}
    for c in raw.columns:
        names.setdefault(RENAMES.get(c, c), c)
    if missing := [c for c in ("trade_date", code, *required) if c not in names]:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    cols = [epoch_or_text_date(F.col(names["trade_date"])).alias("trade_date"), F.col(names[code]).cast("string").alias(code)]
    cols += [number(F.col(names[c])).alias(c) for c in NUMERIC if c in names]
    if asset == "future":
        cols.append(product(F.col(names[code])).alias("product"))
    return raw.select(*cols).where(F.col("trade_date").isNotNull())


def _first_given(*cols: Column) -> Column:
    return F.coalesce(*[F.nullif(F.nullif(c.cast("string"), F.lit("")), F.lit("0")) for c in cols])


def normalize_instruments(details: DataFrame, asset: str = "stock") -> DataFrame:
    """Security or contract master from upstream details (code, InstrumentName, CreateDate, OpenDate, ExpireDate, ...).

    Expiry sentinels become null, marked as such. Stocks list on OpenDate, else CreateDate; futures the other way.
    """
    exchange = F.substring_index("code", ".", -1).alias("exchange")
    if asset == "future":
        return details.select(
            F.col("code").alias("contract_code"), product(F.col("code")).alias("product"), exchange,
            detail_date(_first_given(F.col("CreateDate"), F.col("OpenDate"))).alias("list_date"),
            detail_date(F.col("ExpireDate")).alias("expire_date"), number(F.col("VolumeMultiple")).alias("multiplier"),
        )
    expiry = F.substring(F.regexp_replace(F.col("ExpireDate").cast("string"), r"\D", ""), 1, 8)
    bad = F.coalesce(expiry.isin(*SENTINELS), F.lit(False))
    ends = F.when(~bad, detail_date(F.col("ExpireDate")))
    return details.select(
        F.col("code").alias("stock_code"), F.col("InstrumentName").alias("stock_name"), exchange,
        detail_date(_first_given(F.col("OpenDate"), F.col("CreateDate"))).alias("list_date"), ends.alias("delist_date"),
        F.when(bad, "INVALID_SENTINEL_IGNORED").when(ends.isNull(), "MISSING_OR_ACTIVE").otherwise("SOURCE").alias("delist_date_quality"),
    )


def flatten_financial(df: DataFrame, column: str) -> DataFrame:
    """A map of code to a map of table to an array of rows, as one row each; a null table is UNKNOWN."""
    codes = df.select(F.explode(column).alias("stock_code", "_tables"))
    tables = codes.select("stock_code", F.explode("_tables").alias("table_name", "_rows"))
    return tables.select("stock_code", F.coalesce("table_name", F.lit("UNKNOWN")).alias("table_name"), F.explode("_rows").alias("_row")).select("stock_code", "table_name", "_row.*")


def provisional_key(df: DataFrame, candidates: tuple[str, ...] = ("stock_code", "table_name", "report_period", "announce_date", "rank")) -> DataFrame:
    return df.withColumn("source_record_key", record_key(*[F.col(c) for c in candidates if c in df.columns]))
