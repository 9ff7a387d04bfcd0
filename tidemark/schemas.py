"""Pinned schemas of the published datasets; what a run lacks is read as null, whatever its files say."""

from __future__ import annotations

from pyspark.sql.types import StructType

AUDIT = "source_run_id string, _ingested_at string"
_BAR = "open double, high double, low double, close double, pre_close double, volume double, amount double"

DDL = {
    "stock_daily": f"trade_date date, stock_code string, {_BAR}, suspend_flag double",
    "index_daily": f"trade_date date, index_code string, {_BAR}",
    "future_daily": f"trade_date date, contract_code string, {_BAR}, settlement double, open_interest double, product string",
    "security_master": "stock_code string, stock_name string, exchange string, list_date date, delist_date date, delist_date_quality string",
    "future_contract_master": "contract_code string, product string, exchange string, list_date date, expire_date date, multiplier double",
    "trade_calendar": "market string, trade_date date, is_open boolean, previous_trade_date date, next_trade_date date",
    "historical_universe": "universe_name string, trade_date date, stock_code string, eligible_flag boolean, exclusion_reasons string, rule_version string",
    "future_main_mapping": "mapping_type string, observation_trade_date date, effective_trade_date date, product string, contract_code string, selection_method string, rule_version string, eligible_contract_count bigint",
    "future_basis_daily": "trade_date date, product string, contract_code string, spot_code string, future_close double, settlement double, spot_close double, basis_close double, basis_settlement double, basis_pct double, days_to_expiry int, annualized_basis double, is_eod_main boolean, is_tradable_main boolean, rule_version string",
}


def schema(dataset: str) -> StructType | None:
    """The pinned schema, or None for open ones (raw rows, financial records, corporate actions)."""
    return StructType.fromDDL(f"{DDL[dataset]}, {AUDIT}") if dataset in DDL else None
