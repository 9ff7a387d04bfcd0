"""Money that comes and goes: fund shares, margin, funding rates, open interest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import rolling_z


def _before(c: str, by: list[str]) -> Column:
    return F.lag(c).over(Window.partitionBy(*by).orderBy("trade_date"))


def _share(a: Column, b: Column) -> Column:
    return F.try_divide(a, F.nullif(b, F.lit(0.0)))


def etf_creation(df: DataFrame) -> DataFrame:
    """Net creation, its share of assets, and the premium of the price over the net value (code, shares, nav, close)."""
    change = F.col("shares") - _before("shares", ["code"])
    out = df.withColumn("net_creation", change * F.col("nav"))
    return out.select("trade_date", "code", "net_creation", _share(F.col("net_creation"), F.col("shares") * F.col("nav")).alias("creation_share"), (_share(F.col("close"), F.col("nav")) - 1).alias("premium"))


def etf_activity(df: DataFrame) -> DataFrame:
    """Turnover by assets, and how price and shares moved together (code, shares, nav, close, amount).

    A day on which one of them stands still is FLAT, the first day of a fund has no state.
    """
    up, more = F.signum(F.col("close") - _before("close", ["code"])), F.signum(F.col("shares") - _before("shares", ["code"]))
    state = F.when(up * more == 0, "FLAT").when((up > 0) & (more > 0), "UP_CREATION").when(up > 0, "UP_REDEMPTION").when(more > 0, "DOWN_CREATION").when(more < 0, "DOWN_REDEMPTION")
    return df.select("trade_date", "code", _share(F.col("amount"), F.col("shares") * F.col("nav")).alias("etf_turnover"), state.alias("price_share_state"))


def etf_flow_by_kind(df: DataFrame, kinds: list[str]) -> DataFrame:
    """A day's net creation and assets of each kind of fund, as columns (code, kind, shares, nav, close): broad, sector, theme."""
    rows = etf_creation(df).join(df.select("trade_date", "code", "kind", (F.col("shares") * F.col("nav")).alias("aum")), ["trade_date", "code"])
    flows = [f(c).alias(f"{k}_{name}") for k in kinds for name, c, f in (("flow", F.when(F.col("kind") == k, F.col("net_creation")), F.sum), ("aum", F.when(F.col("kind") == k, F.col("aum")), F.sum))]
    out = rows.groupBy("trade_date").agg(*flows)
    return out.select("trade_date", *[F.col(f"{k}_flow") for k in kinds], *[_share(F.col(f"{k}_flow"), F.col(f"{k}_aum")).alias(f"{k}_flow_share") for k in kinds])


def margin_flow(df: DataFrame) -> DataFrame:
    """Net margin buying of a day, by the balance, and purchases by the market's amount (code, buy, repay, balance, amount)."""
    net = F.col("buy") - F.col("repay")
    return df.select("trade_date", "code", net.alias("margin_flow"), _share(net, F.col("balance")).alias("margin_intensity"), _share(F.col("buy"), F.col("amount")).alias("buy_share"))


def fund_flow(df: DataFrame) -> DataFrame:
    """Assets less what the assets before would have become by their return (code, aum, ret)."""
    return df.select("trade_date", "code", (F.col("aum") - _before("aum", ["code"]) * (1 + F.col("ret"))).alias("flow"))


def open_interest_pressure(df: DataFrame) -> DataFrame:
    """Change of open interest, and volume by open interest (contract_code, open_interest, volume)."""
    return df.select("trade_date", "contract_code", (F.col("open_interest") - _before("open_interest", ["contract_code"])).alias("oi_change"), _share(F.col("volume"), F.col("open_interest")).alias("volume_to_oi"))


def basis_stress(basis: DataFrame, n: int = 60) -> DataFrame:
    """How far a contract's basis lies below its own last ``n`` days, in standard deviations, and what leverage does with it
    (contract_code, basis_pct, open_interest): open interest that grows against a discount, or goes with it."""
    w = Window.partitionBy("contract_code").orderBy("trade_date").rowsBetween(1 - n, 0)
    more = F.col("open_interest") - _before("open_interest", ["contract_code"])
    regime = F.when(F.col("basis_pct").isNull() | more.isNull(), None).when(more == 0, "STEADY")
    regime = regime.when((F.col("basis_pct") >= 0) & (more > 0), "PREMIUM_BUILDING").when(F.col("basis_pct") >= 0, "PREMIUM_UNWINDING").when(more > 0, "DISCOUNT_BUILDING").otherwise("DISCOUNT_UNWINDING")
    return basis.select("trade_date", "contract_code", (-rolling_z(F.col("basis_pct"), w)).alias("stress"), regime.alias("leverage_regime"))


def put_call(options: DataFrame) -> DataFrame:
    """Of each underlying: volumes of puts by those of calls, and how few puts most volume lies in, as the sum of squared
    shares (underlying, kind P or C, volume); null where there is nothing to divide by."""
    puts, calls = F.when(F.col("kind") == "P", F.col("volume")), F.when(F.col("kind") == "C", F.col("volume"))
    one = options.groupBy("underlying").agg(F.sum(puts).alias("p"), F.sum(calls).alias("c"), F.sum(puts * puts).alias("pp"))
    return one.select("underlying", _share(F.col("p"), F.col("c")).alias("put_call"), _share(F.col("pp"), F.col("p") * F.col("p")).alias("put_concentration"))


def funding_stress(rates: DataFrame, pairs: dict[str, tuple[str, str]], n: int = 60) -> DataFrame:
    """Spreads between rates, a row a day, and the mean of their z-scores."""
    w = Window.orderBy("trade_date").rowsBetween(1 - n, 0)  # a row a day
    out = rates.select("trade_date", *[(F.col(a) - F.col(b)).alias(k) for k, (a, b) in pairs.items()])
    z = [rolling_z(F.col(k), w) for k in pairs]
    given = sum((F.when(x.isNotNull(), 1).otherwise(0) for x in z), F.lit(0))
    return out.withColumn("stress", F.try_divide(sum((F.coalesce(x, F.lit(0.0)) for x in z), F.lit(0.0)), F.nullif(given, F.lit(0))))


def net_liquidity(df: DataFrame, inflows: list[str], supplies: list[str]) -> DataFrame:
    """A day's inflows less its supply of shares; what is null counts as none."""
    total = sum((F.coalesce(F.col(c), F.lit(0.0)) for c in inflows), F.lit(0.0)) - sum((F.coalesce(F.col(c), F.lit(0.0)) for c in supplies), F.lit(0.0))
    return df.groupBy("trade_date").agg(F.sum(total).alias("net_liquidity"))
