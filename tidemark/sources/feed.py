"""What a market-data feed has to offer, and discovery over it."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date
from typing import Protocol

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import detail_date

#: Forms of codes.
STOCK_CODE = r"^\d{6}\.(SH|SZ|BJ)$"
CONTRACT_SUFFIX = ".IF"


class MarketDataSource(Protocol):
    """Tables of a feed as DataFrames; bars are unadjusted and may be padded."""

    def bars(self, codes: Sequence[str], start: date | None, end: date | None) -> DataFrame: ...  # pragma: no cover
    def members(self) -> DataFrame: ...  # sector, code, in_date, out_date  # pragma: no cover
    def details(self) -> DataFrame: ...  # code, InstrumentName, OpenDate, ...  # pragma: no cover
    def financials(self, codes: Sequence[str], tables: Sequence[str]) -> DataFrame: ...  # pragma: no cover
    def trading_days(self, market: str, start: date | None, end: date | None) -> DataFrame: ...  # trade_date  # pragma: no cover
    def dividend_factors(self, codes: Sequence[str], start: date | None, end: date | None) -> DataFrame: ...  # stock_code, time, ...  # pragma: no cover


def discover_codes(members: DataFrame, sectors: Sequence[str], suffixes: Sequence[str]) -> DataFrame:
    """Distinct codes of the sectors that end in one of the suffixes, in order."""
    ends = F.lit(False)
    for s in suffixes:
        ends = ends | F.col("code").endswith(s)
    return members.where(F.col("sector").isin(*sectors)).where(ends).select("code").distinct().orderBy("code")


def members_on(members: DataFrame, sectors: Sequence[str] | None = None, day=None) -> DataFrame:
    """(sector, code) of a day: from in_date on, until before out_date, null ends open; without a day today's, whose out_date is null."""
    if sectors is not None:
        members = members.where(F.col("sector").isin(*sectors))
    if day is None:
        return members.where("out_date is null").select("sector", "code").distinct()
    on = F.lit(day).cast("date")
    since, until = F.col("in_date").isNull() | (F.col("in_date") <= on), F.col("out_date").isNull() | (F.col("out_date") > on)
    return members.where(since & until).select("sector", "code").distinct()


def expired_candidates(contracts: DataFrame, details: DataFrame, today) -> DataFrame:
    """Contracts whose expiry, as described, lies before a day; without a description or an expiry they are none."""
    ends = details.select("code", detail_date(F.col("ExpireDate")).alias("expire_date"))
    return contracts.join(ends, "code").where(F.col("expire_date") < F.lit(today).cast("date")).select("code", "expire_date").distinct()


def real_bars(bars: DataFrame) -> DataFrame:
    """Bars of a padded feed without its placeholders: rows with no price at all, or none and nothing traded."""
    prices = [F.coalesce(F.col(c), F.lit(0.0)) for c in ("open", "high", "low", "close")]
    return bars.where(F.greatest(*prices) > 0)


def delisted_candidates(historical: DataFrame, current: DataFrame, details: DataFrame) -> DataFrame:
    """Stocks that were, are no more, and are still described."""
    described = details.where(F.coalesce(F.col("InstrumentName"), F.lit("")) != "").select("code").distinct()
    gone = historical.select("code").where(F.col("code").rlike(STOCK_CODE)).distinct().join(current.select("code"), "code", "left_anti")
    return gone.join(described, "code", "left_semi")


def contracts_of(codes: DataFrame, products: Sequence[str]) -> DataFrame:
    """Futures of the products among codes, with four digits, whatever their case."""
    one_of = "|".join(products)
    return codes.where(F.col("code").rlike(rf"(?i)^({one_of})\d{{4}}\{CONTRACT_SUFFIX}$")).select("code").distinct().orderBy("code")


def most_liquid_active(contracts: DataFrame, today, by: Sequence[str] = ("product",)) -> DataFrame:
    """Of each product's contracts that haven't expired, the one of the largest volume, then the least code."""
    alive = contracts.where(F.col("expire_date") >= F.lit(today).cast("date"))
    best = F.min(F.struct((-F.coalesce("volume", F.lit(0.0))).alias("v"), "contract_code")).alias("best")
    return alive.groupBy(*by).agg(best).select(*by, F.col("best.contract_code").alias("contract_code"), (-F.col("best.v")).alias("volume"))


def instrument_details(codes: DataFrame, fetch: Callable[[list[str]], dict[str, dict | None]], batch: int = 100, tries: int = 3, code_col: str = "code") -> DataFrame:
    """(code, detail, error): what a feed knows of each code, asked by tasks in batches of distinct codes.

    ``fetch`` runs on the executors and gives a code's fields, or nothing: codes without fields have no row. A batch that
    fails is asked again, ``tries`` times in all, then code by code, so that one bad code costs no other; a code that still
    fails has its error and a null detail. Values come as text, nulls as they are.
    """
    distinct = codes.select(F.col(f"`{code_col}`").cast("string").alias("code")).where("code is not null").distinct()

    def run(batches):
        import pyarrow as pa

        def ask(some: list[str], times: int) -> tuple[dict[str, dict | None] | None, str | None]:
            told = None
            for _ in range(times):
                try:
                    return fetch(some), None
                except Exception as e:  # noqa: BLE001  whatever a feed raises is that batch's answer
                    told = f"{type(e).__name__}: {e}"
            return None, told

        for b in batches:
            every = b.column(0).to_pylist()
            for lo in range(0, len(every), batch):
                some = every[lo : lo + batch]
                got, _ = ask(some, tries)
                rows = [(c, got.get(c), None) for c in some] if got is not None else [(c, (one or {}).get(c), e) for c in some for one, e in [ask([c], 1)]]
                rows = [(c, None if e else [(str(k), None if v is None else str(v)) for k, v in d.items()], e) for c, d, e in rows if d or e]
                cols = [[r[i] for r in rows] for i in range(3)]
                yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.map_(pa.string(), pa.string())), pa.array(cols[2], pa.string())], ["code", "detail", "error"])

    return distinct.mapInArrow(run, "code string, detail map<string,string>, error string")
