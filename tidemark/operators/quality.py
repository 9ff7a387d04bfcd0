"""Quality gates: rules counted in one aggregation a dataset."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .versions import duplicate_count


class QualityError(ValueError):
    """A dataset breaks a rule of severity ERROR."""


@dataclass
class Gate:
    """Rules as aggregates that can be observed while rows are written, by name with their severity.

    They may use ``helpers``, columns that are dropped before the write.
    """

    rules: dict[str, tuple[str, Column]]
    helpers: tuple[str, ...] = ()

    def enforce(self, counts: Mapping[str, int]) -> None:
        """Raise if a rule of severity ERROR is broken."""
        if broken := [f"{r}={counts[r]}" for r, (severity, _) in self.rules.items() if severity == "ERROR" and counts[r]]:
            raise QualityError("; ".join(broken))


def _counts(df: DataFrame, rules: dict[str, tuple[str, Column]]) -> DataFrame:
    one = df.agg(*[c.cast("bigint").alias(r) for r, (_, c) in rules.items()])
    pairs = F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(s).alias("severity"), F.coalesce(F.col(r), F.lit(0)).alias("count")) for r, (s, _) in rules.items()])
    return one.select(F.explode(pairs).alias("x")).select("x.*")


def require(df: DataFrame, *columns: str) -> None:
    if missing := [c for c in columns if c not in df.columns]:
        raise QualityError(f"required_columns={len(missing)}: {', '.join(missing)}")


def extreme_move(code: str, limit: float = 0.5) -> Column:
    """Whether the close moved by more than the limit; from zero to anything counts."""
    prev = F.lag("close").over(Window.partitionBy(code).orderBy("trade_date"))
    return (F.abs(F.try_divide(F.col("close"), prev) - 1) > limit) | ((prev == 0) & (F.col("close") != 0))


def _bar_bounds(bars: DataFrame) -> dict[str, tuple[str, Column]]:
    """The rules of a bar by itself."""
    ohlc = (F.col("high") < F.greatest("open", "close", "low")) | (F.col("low") > F.least("open", "close", "high"))
    rules = {"ohlc_bounds": ("ERROR", F.count_if(ohlc))}
    return rules | {f"non_negative_{c}": ("ERROR", F.count_if(F.col(c) < 0)) for c in ("volume", "amount", "open_interest") if c in bars.columns}


def bar_gate(bars: DataFrame, code: str = "stock_code", required: tuple[str, ...] = ("volume",)) -> tuple[DataFrame, Gate]:
    """The bars with helper columns, and the rules of ``bar_rules`` over them; one window serves the two that need order."""
    require(bars, "trade_date", code, "open", "high", "low", "close", *required)
    w = Window.partitionBy(code).orderBy("trade_date")
    again = (F.row_number().over(w) > 1) & F.lag("trade_date").over(w).eqNullSafe(F.col("trade_date"))
    rows = bars.withColumns({"_again": again, "_extreme": extreme_move(code)})
    rules = {"business_key_unique": ("ERROR", F.count_if("_again"))} | _bar_bounds(bars) | {"extreme_close_return": ("WARN", F.count_if("_extreme"))}
    return rows, Gate(rules, ("_again", "_extreme"))


def bar_rules(bars: DataFrame, code: str = "stock_code") -> DataFrame:
    """(rule, severity, count) of daily bars; what is null breaks no rule."""
    require(bars, "trade_date", code, "open", "high", "low", "close", "volume")
    rows = bars.withColumn("_extreme", extreme_move(code))
    rules = {"business_key_unique": ("ERROR", duplicate_count(["trade_date", code]))} | _bar_bounds(bars)
    return _counts(rows, rules | {"extreme_close_return": ("WARN", F.count_if("_extreme"))})


def master_rules(master: DataFrame) -> DataFrame:
    require(master, "stock_code", "list_date", "delist_date")
    return _counts(master, {"stock_code_unique": ("ERROR", duplicate_count(["stock_code"]))} | _master_bounds())


def master_gate(master: DataFrame) -> tuple[DataFrame, Gate]:
    """As ``master_rules``, observed while the rows are written."""
    require(master, "stock_code", "list_date", "delist_date")
    rows = master.withColumn("_again", F.row_number().over(Window.partitionBy("stock_code").orderBy("list_date")) > 1)
    return rows, Gate({"stock_code_unique": ("ERROR", F.count_if("_again"))} | _master_bounds(), ("_again",))


def _master_bounds() -> dict[str, tuple[str, Column]]:
    return {
        "listing_interval": ("ERROR", F.count_if(F.col("delist_date") < F.col("list_date"))),
        "invalid_delist_sentinel_ignored": ("WARN", F.count_if(F.col("delist_date_quality") == "INVALID_SENTINEL_IGNORED")),
    }


def _announcements() -> dict[str, tuple[str, Column]]:
    return {
        "announce_date_present": ("WARN", F.count_if(F.col("announce_date").isNull())),
        "pit_availability": ("ERROR", F.count_if(F.col("available_date") <= F.col("announce_date"))),
    }


def financial_gate(financial: DataFrame) -> tuple[DataFrame, Gate]:
    """As ``financial_rules``, observed while the rows are written."""
    require(financial, "stock_code", "report_period", "announce_date", "available_date")
    return financial, Gate(_announcements())


def financial_rules(financial: DataFrame) -> DataFrame:
    require(financial, "stock_code", "report_period", "announce_date", "available_date")
    return _counts(financial, _announcements())


def inventory(df: DataFrame) -> DataFrame:
    """(field, kind, filled, empty): each column's type and how many of its values aren't null, in one aggregation."""
    one = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count(F.col(f"`{c}`")).alias(f"_c{i}") for i, c in enumerate(df.columns)])
    fields = F.array(*[F.struct(F.lit(c).alias("field"), F.lit(k).alias("kind"), F.col(f"_c{i}").alias("filled"), (F.col("_n") - F.col(f"_c{i}")).alias("empty")) for i, (c, k) in enumerate(df.dtypes)])
    return one.select(F.explode(fields).alias("x")).select("x.*")


def enforce(report: DataFrame) -> None:
    """Raise if a rule of severity ERROR is broken; a report has a row for each rule."""
    broken = [f"{r['rule']}={r['count']}" for r in report.where("severity = 'ERROR' and count > 0").collect()]
    if broken:
        raise QualityError("; ".join(broken))
