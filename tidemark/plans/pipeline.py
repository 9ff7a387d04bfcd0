"""Building the published datasets from a feed: each step is one or two Spark jobs and one publication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import epoch_or_text_date
from ..operators import calendar as cal
from ..operators import futures as fut
from ..operators import normalize, pit, quality, universe
from .store import Checkpoint, Manifest, Store

#: Views over versions, by layer, dataset and key; the last, where given, is what a row must meet.
VIEWS = {
    "daily_bar": ("processed", "stock_daily", ["trade_date", "stock_code"]),
    "index_daily": ("processed", "index_daily", ["trade_date", "index_code"]),
    "future_daily": ("processed", "future_daily", ["trade_date", "contract_code"]),
    "security_master": ("processed", "security_master", ["stock_code"]),
    "future_contracts": ("processed", "future_contract_master", ["contract_code"]),
    "trade_calendar": ("processed", "trade_calendar", ["market", "trade_date"]),
    "financial_pit": ("processed", "financial", ["source_record_key"], "announce_date is not null and available_date is not null"),
    "historical_universe": ("derived", "historical_universe", ["universe_name", "trade_date", "stock_code"]),
    "future_main_mapping": ("derived", "future_main_mapping", ["mapping_type", "effective_trade_date", "product"]),
    "future_basis_daily": ("derived", "future_basis_daily", ["trade_date", "contract_code"]),
}
# What a history covers, and what is known of corporate actions.
FULL_HISTORY, SURVIVORS = "FULL_HISTORY", "CURRENT_UNIVERSE_ONLY"


class Builder:
    def __init__(self, store: Store, checkpoint: Checkpoint | None = None, scope: str = FULL_HISTORY):
        self.store, self.checkpoint, self.scope = store, checkpoint, scope

    def latest(self, view: str) -> DataFrame:
        layer, dataset, keys, *where = VIEWS[view]
        return self.store.latest(layer, dataset, keys, *where)

    def compact(self, view: str, **options) -> Manifest | None:
        """Merge the runs of a view's dataset; what the view shows stays as it is. See ``Store.compact``."""
        layer, dataset, keys, *where = VIEWS[view]
        return self.store.compact(layer, dataset, keys, *where, **options)

    def _request(self, raw: DataFrame, asset: str, period: str) -> dict:
        """What a batch is made from: dataset, first and last day, period, and its rows in any order, as one sum of hashes."""
        names = sorted(raw.columns)
        day = epoch_or_text_date(F.col("trade_date" if "trade_date" in names else "time"))
        content = F.xxhash64(F.to_json(F.struct(*[F.col(f"`{c}`") for c in names])))
        got = raw.agg(
            F.min(day).cast("string").alias("start"), F.max(day).cast("string").alias("end"),
            F.count(F.lit(1)).alias("rows"), F.sum(content.cast("decimal(38,0)")).cast("string").alias("content"),
        ).first()
        return {"dataset": f"{asset}_daily", "period": period, "columns": names, **got.asDict()}

    def bars(self, raw: DataFrame, asset: str, batch: str | None = None, period: str = "1d") -> Manifest | None:
        """Raw bars, then normalised ones that pass the gate; a batch that is done isn't done again, unless codes, days or rows differ."""
        what = self._request(raw, asset, period) if batch and self.checkpoint else None
        if what and self.checkpoint.done(batch, what):
            return None
        code = normalize.ASSETS[asset][0]
        first = self.store.publish("raw", f"{asset}_daily", raw)
        rows, gate = quality.bar_gate(normalize.normalize_bars(raw, asset), code, () if asset == "index" else ("volume",))
        done = self.store.publish("processed", f"{asset}_daily", rows, date="trade_date", ranges=[code], gate=gate, inputs=[first.run_id])
        if what:
            self.checkpoint.mark(batch, what)
        return done

    def corporate_actions(self, factors: DataFrame) -> Manifest | None:
        """Dividend factors (stock_code, time, ...) as they come; codes without any have no rows. Nothing: no run."""
        quality.require(factors, "stock_code")
        return None if factors.isEmpty() else self.store.publish("raw", "corporate_action", factors)

    def calendar(self, days: DataFrame, market: str) -> Manifest:
        """Open days of a market; with what is stored, the days at the seam get their new neighbours."""
        if self.store.load("processed", "trade_calendar") is None:
            return self.store.publish("processed", "trade_calendar", cal.trade_calendar(days, market), date="trade_date")
        rows = cal.extend_calendar(self.latest("trade_calendar"), days, market)
        return self.store.load("processed", "trade_calendar") if rows.isEmpty() else self.store.publish("processed", "trade_calendar", rows, date="trade_date")

    def masters(self, details: DataFrame, asset: str) -> Manifest:
        master = normalize.normalize_instruments(details, asset)
        rows, gate = quality.master_gate(master) if asset == "stock" else (master, None)
        return self.store.publish("processed", "future_contract_master" if asset == "future" else "security_master", rows, gate=gate)

    def financial(self, rows: DataFrame) -> Manifest:
        dated, gate = quality.financial_gate(pit.assign_availability(rows, self.latest("trade_calendar")))
        return self.store.publish("processed", "financial", dated, date="announce_date", gate=gate)

    def universe(self, name: str) -> Manifest:
        """A universe of survivors may not be published as all stocks."""
        if self.scope != FULL_HISTORY and name == "ALL_A":
            raise ValueError("a universe of survivors can't be published as ALL_A")
        rows = universe.historical_universe(self.latest("security_master"), self.latest("trade_calendar"), name)
        return self.store.publish("derived", "historical_universe", rows, mode="replace", date="trade_date")

    def futures(self, spots: dict[str, str]) -> tuple[Manifest, Manifest]:
        """Main contracts, then the basis that reads them."""
        bars, master = self.latest("future_daily"), self.latest("future_contracts")
        eod = fut.main_contracts(bars, master)
        mapping = eod.unionByName(fut.next_day_mapping(eod, self.latest("trade_calendar")))
        one = self.store.publish("derived", "future_main_mapping", mapping, mode="replace", date="effective_trade_date")
        basis = fut.basis(bars, self.latest("index_daily"), master, self.latest("future_main_mapping"), spots)
        return one, self.store.publish("derived", "future_basis_daily", basis, mode="replace", date="trade_date", inputs=[one.run_id])

    def refresh(self, codes: Sequence[str] | None = None) -> list[str]:
        return self.store.refresh({k: v for k, v in VIEWS.items() if codes is None or k in codes})
