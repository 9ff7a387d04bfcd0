"""Getters for dated tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .futures import EOD, NEXT_DAY

MAPPING_TYPES = (EOD, NEXT_DAY)


def dated(df: DataFrame, start=None, end=None, day: str = "trade_date", **filters) -> DataFrame:
    """Rows from start to end, both included. A filter is a value, or a list of values; an empty list finds nothing."""
    if start is not None:
        df = df.where(F.col(day) >= F.lit(start).cast("date"))
    if end is not None:
        df = df.where(F.col(day) <= F.lit(end).cast("date"))
    for c, v in filters.items():
        if v is None:
            continue
        if isinstance(v, Sequence) and not isinstance(v, str):
            df = df.where(F.col(c).isin(*v)) if v else df.where(F.lit(False))
        else:
            df = df.where(F.col(c) == v)
    return df


def daily_bars(bars: DataFrame, codes: Sequence[str], start=None, end=None) -> DataFrame:
    return dated(bars, start, end, stock_code=list(codes))


def index_bars(index: DataFrame, codes: Sequence[str], start=None, end=None) -> DataFrame:
    return dated(index, start, end, index_code=list(codes))


def future_bars(futures: DataFrame, codes: Sequence[str], start=None, end=None) -> DataFrame:
    return dated(futures, start, end, contract_code=list(codes))


def basis_of(basis: DataFrame, products: Sequence[str], start=None, end=None) -> DataFrame:
    return dated(basis, start, end, product=list(products))


def eligible_bars(bars: DataFrame, universe: DataFrame, name: str) -> DataFrame:
    """Bars of the stocks that were in a universe on their day; a semi-join takes a bar once, however often it is in."""
    members = dated(universe, universe_name=name).where("eligible_flag").select("trade_date", "stock_code")
    return bars.join(members, ["trade_date", "stock_code"], "left_semi")


def universe_on(universe: DataFrame, name: str, day) -> DataFrame:
    return dated(universe, day, day, universe_name=name).where("eligible_flag")


def main_contract_of(mapping: DataFrame, products: Sequence[str], mapping_type: str, start=None, end=None) -> DataFrame:
    if mapping_type not in MAPPING_TYPES:
        raise ValueError(f"mapping_type must be one of {MAPPING_TYPES}")
    return dated(mapping, start, end, "effective_trade_date", product=list(products), mapping_type=mapping_type)
