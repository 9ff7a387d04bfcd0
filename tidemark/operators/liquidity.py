"""Liquidity and crowding indicators of stocks, the market and sectors.

Bars need trade_date, stock_code, open, high, low, close, pre_close, volume, amount; a turnover needs ff_cap.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import history_rank, rolling, rolling_median, rolling_z, streak_length


def over(n: int):
    return rolling("stock_code", "trade_date", n)


def with_returns(bars: DataFrame) -> DataFrame:
    """The close before as pre_close, where bars have none, and the return on it."""
    w = Window.partitionBy("stock_code").orderBy("trade_date")
    if "pre_close" not in bars.columns:
        bars = bars.withColumn("pre_close", F.lag("close").over(w))
    return bars.withColumn("ret", F.try_divide(F.col("close"), F.col("pre_close")) - 1)


def average_amount(bars: DataFrame, windows: tuple[int, ...] = (20, 60)) -> DataFrame:
    return bars.select("trade_date", "stock_code", "amount", *[F.avg("amount").over(over(n)).alias(f"adv{n}") for n in windows], *[rolling_median(F.col("amount"), over(n)).alias(f"median_amount{n}") for n in windows])


def amihud(bars: DataFrame, windows: tuple[int, ...] = (20, 60)) -> DataFrame:
    """Absolute return by amount, and its rolling medians."""
    out = with_returns(bars).withColumn("amihud", F.try_divide(F.abs("ret"), F.nullif(F.col("amount"), F.lit(0.0))))
    return out.select("trade_date", "stock_code", "ret", "amount", "amihud", *[rolling_median(F.col("amihud"), over(n)).alias(f"amihud{n}") for n in windows])


def idiosyncratic_amihud(bars: DataFrame, within: tuple[str, ...] = ()) -> DataFrame:
    """The same of what the return has beyond the mean return of the day, or of the day's sector, say."""
    day = Window.partitionBy("trade_date", *within)
    out = with_returns(bars).withColumn("idio", F.col("ret") - F.avg("ret").over(day))
    return out.select("trade_date", "stock_code", "idio", F.try_divide(F.abs("idio"), F.nullif(F.col("amount"), F.lit(0.0))).alias("idio_amihud"))


def market_beta(bars: DataFrame, n: int = 60, least: int = 20) -> DataFrame:
    """Each return against the day's mean return over a stock's last ``n`` days: slope, residual, and its illiquidity.

    The regression comes from windowed sums and cross products of returns less the stock's overall means, which keep
    their digits where returns lie far from zero. Null with fewer than ``least`` pairs, and where the market's return
    doesn't vary within the window beyond rounding.
    """
    out = with_returns(bars).withColumn("market", F.avg("ret").over(Window.partitionBy("trade_date")))
    every = Window.partitionBy("stock_code")
    pair = F.col("ret").isNotNull() & F.col("market").isNotNull()
    out = out.withColumns({"_y": F.when(pair, F.col("ret")), "_x": F.when(pair, F.col("market"))})
    w = over(n)
    out = out.withColumn("_raw", F.sum(F.col("_x") * F.col("_x")).over(w))
    out = out.withColumns({"_y": F.col("_y") - F.avg("_y").over(every), "_x": F.col("_x") - F.avg("_x").over(every)})
    total = lambda c: F.sum(c).over(w)
    out = out.withColumns({"_n": F.count("_x").over(w), "_sx": total(F.col("_x")), "_sy": total(F.col("_y")), "_sxx": total(F.col("_x") * F.col("_x")), "_sxy": total(F.col("_x") * F.col("_y"))})
    spread = F.col("_n") * F.col("_sxx") - F.col("_sx") * F.col("_sx")
    # Beyond what cancelling leaves of a window's sums, and of the returns themselves.
    varies = (F.col("_n") >= least) & (spread > 1e-12 * F.col("_n") * F.col("_sxx")) & (spread > 1e-18 * F.col("_n") * F.col("_raw"))
    out = out.withColumn("beta", F.when(varies, F.try_divide(F.col("_n") * F.col("_sxy") - F.col("_sx") * F.col("_sy"), spread)))
    level = F.try_divide(F.col("_sy") - F.col("beta") * F.col("_sx"), F.nullif(F.col("_n"), F.lit(0)))
    out = out.withColumn("residual", F.col("_y") - level - F.col("beta") * F.col("_x"))
    return out.select("trade_date", "stock_code", "beta", "residual", F.try_divide(F.abs("residual"), F.nullif(F.col("amount"), F.lit(0.0))).alias("residual_amihud"))


def with_turnover(bars: DataFrame) -> DataFrame:
    return bars.withColumn("turnover", F.try_divide(F.col("amount"), F.nullif(F.col("ff_cap"), F.lit(0.0))))


def turnover_z(bars: DataFrame, n: int = 60) -> DataFrame:
    x = F.when(F.col("turnover") > 0, F.ln("turnover"))
    return with_turnover(bars).withColumn("log_turnover", x).select("trade_date", "stock_code", "turnover", rolling_z(F.col("log_turnover"), over(n)).alias("turnover_z"))


def range_impact(bars: DataFrame, n: int = 20) -> DataFrame:
    """The day's range, as a share of the close before, by turnover, and its rolling median."""
    out = with_turnover(with_returns(bars))
    out = out.withColumn("range_impact", F.try_divide(F.try_divide(F.col("high") - F.col("low"), F.col("pre_close")), F.nullif(F.col("turnover"), F.lit(0.0))))
    return out.select("trade_date", "stock_code", "range_impact", rolling_median(F.col("range_impact"), over(n)).alias("range_impact_median"))


def sided_illiquidity(bars: DataFrame, n: int = 20) -> DataFrame:
    """Rolling medians of illiquidity on falling and on rising days, and their ratio."""
    a = amihud(bars, ())
    a = a.withColumn("downside", rolling_median(F.col("amihud"), over(n), F.col("ret") < 0)).withColumn("upside", rolling_median(F.col("amihud"), over(n), F.col("ret") > 0))
    return a.select("trade_date", "stock_code", "downside", "upside", F.try_divide(F.col("downside"), F.nullif(F.col("upside"), F.lit(0.0))).alias("ratio"))


def cross_section_rank(df: DataFrame, value: str, name: str = "xs_percentile") -> DataFrame:
    """Percent rank among the day's values; null values have none."""
    w = Window.partitionBy("trade_date", F.col(value).isNull()).orderBy(value)
    return df.withColumn(name, F.when(F.col(value).isNotNull(), F.percent_rank().over(w)))


def own_history_rank(df: DataFrame, value: str, n: int = 60, name: str = "ts_percentile") -> DataFrame:
    return df.withColumn(name, F.when(F.col(value).isNotNull(), history_rank(F.col(value), over(n))))


def trade_flags(bars: DataFrame, limit: float = 0.098) -> DataFrame:
    """Suspended, traded nothing, one price at the upper or the lower limit; days in a row at the lower."""
    out = with_returns(bars)
    one = (F.col("high") == F.col("low")) & F.col("ret").isNotNull()
    flags = {
        "suspended": F.coalesce(F.col("suspend_flag") != 0, F.lit(False)) if "suspend_flag" in bars.columns else F.lit(False),
        "zero_amount": F.coalesce(F.col("amount") <= 0, F.lit(True)),
        "one_price_up": F.coalesce(one & (F.col("ret") >= limit), F.lit(False)),
        "one_price_down": F.coalesce(one & (F.col("ret") <= -limit), F.lit(False)),
    }
    out = out.select("trade_date", "stock_code", "ret", *[c.alias(n) for n, c in flags.items()])
    return streak_length(out, "one_price_down", ["stock_code"], "trade_date", "down_streak")


def tradability(flags: DataFrame, weights: dict[str, float] | None = None) -> DataFrame:
    """One less the weighted flags, at least 0."""
    weights = weights or {"suspended": 1.0, "zero_amount": 1.0, "one_price_up": 0.5, "one_price_down": 0.75}
    lost = sum((F.when(F.col(k), v).otherwise(0.0) for k, v in weights.items()), F.lit(0.0))
    return flags.select("trade_date", "stock_code", F.greatest(F.lit(0.0), 1 - lost).alias("tradability"))


def market_day(df: DataFrame) -> DataFrame:
    """A day's totals and medians over stocks; df has amount, ff_cap, turnover, amihud and ret."""
    return df.groupBy("trade_date").agg(
        F.sum("amount").alias("total_amount"), F.try_divide(F.sum("amount"), F.nullif(F.sum("ff_cap"), F.lit(0.0))).alias("market_turnover"),
        F.median("turnover").alias("median_turnover"), F.median("amihud").alias("median_amihud"), F.median(F.when(F.col("ret") < 0, F.col("amihud"))).alias("median_downside"),
    )


def breadth(df: DataFrame, value: str, n: int = 60, above: bool = True) -> DataFrame:
    """The share of stocks above (below) their own rolling median, of those that have both."""
    own = df.withColumn("_own", rolling_median(F.col(value), over(n)))
    hit = F.col(value) > F.col("_own") if above else F.col(value) < F.col("_own")
    return own.where(F.col(value).isNotNull() & F.col("_own").isNotNull()).groupBy("trade_date").agg(F.avg(F.when(hit, 1.0).otherwise(0.0)).alias("breadth"), F.count(F.lit(1)).alias("stocks"))


def improving(df: DataFrame, value: str = "amihud", n: int = 20) -> DataFrame:
    """Whether a stock's rolling median of illiquidity fell within n rows; null where there is nothing to compare."""
    out = df.withColumn("_median", rolling_median(F.col(value), over(n)))
    before = F.lag("_median", n).over(Window.partitionBy("stock_code").orderBy("trade_date"))
    return out.withColumn("improving", F.col("_median") < before).drop("_median")


def share_of(df: DataFrame, flag: Column, by: tuple[str, ...] = ("trade_date",), name: str = "breadth") -> DataFrame:
    """The share of stocks for which a flag holds, of those for which it isn't null, and their number."""
    return df.where(flag.isNotNull()).groupBy(*by).agg(F.avg(F.when(flag, 1.0).otherwise(0.0)).alias(name), F.count(F.lit(1)).alias("stocks"))


def concentration(df: DataFrame, by: list[str], tops: tuple[int, ...] = (10, 50), shares: tuple[float, ...] = (0.05,)) -> DataFrame:
    """Herfindahl index of amounts, plain and normalised, and the share of the largest."""
    day = Window.partitionBy(*by)
    ranked = df.where("amount > 0").select(
        *by, "amount", F.sum("amount").over(day).alias("_all"), F.count(F.lit(1)).over(day).alias("_n"), F.row_number().over(day.orderBy(F.desc("amount"), "stock_code")).alias("_rank")
    )
    share = F.col("amount") / F.col("_all")
    n = F.max("_n")
    hhi = F.sum(share * share)
    aggs = [hhi.alias("hhi"), F.try_divide(hhi - 1 / n, F.nullif(1 - 1 / n, F.lit(0.0))).alias("hhi_normalised")]
    aggs += [F.sum(F.when(F.col("_rank") <= k, share).otherwise(0.0)).alias(f"top{k}_share") for k in tops]
    aggs += [F.sum(F.when(F.col("_rank") <= F.ceil(F.col("_n") * p), share).otherwise(0.0)).alias(f"top{round(p * 100)}pct_share") for p in shares]
    return ranked.groupBy(*by).agg(*aggs)


def hot_share(df: DataFrame, above: float = 1.5, by: tuple[str, ...] = ("trade_date",)) -> DataFrame:
    """The share of the day's amount in stocks whose turnover z-score is above a bound."""
    return df.groupBy(*by).agg(F.try_divide(F.sum(F.when(F.col("turnover_z") > above, F.col("amount")).otherwise(0.0)), F.nullif(F.sum("amount"), F.lit(0.0))).alias("hot_share"))


def day_z(df: DataFrame, value: str, n: int) -> Column:
    """z-score over a series of days; a market has one row a day."""
    return rolling_z(F.col(value), Window.orderBy("trade_date").rowsBetween(1 - n, 0))


def divergence(market: DataFrame, n: int = 60) -> DataFrame:
    """z of the total amount less z of the median turnover."""
    out = market.withColumn("z_total", day_z(market, "total_amount", n)).withColumn("z_median", day_z(market, "median_turnover", n))
    return out.select("trade_date", "z_total", "z_median", (F.col("z_total") - F.col("z_median")).alias("divergence"))


def winsorise(df: DataFrame, value: str, by: list[str], low: float = 0.01, high: float = 0.99) -> DataFrame:
    w = Window.partitionBy(*by)
    lo, hi = F.percentile(value, F.lit(low)).over(w), F.percentile(value, F.lit(high)).over(w)
    return df.withColumn(value, F.when(F.col(value).isNotNull(), F.greatest(F.least(F.col(value), hi), lo)))


def regime(df: DataFrame, health: str, crowding: str, middle: float = 0.5) -> DataFrame:
    h, c = F.col(health) >= middle, F.col(crowding) >= middle
    name = F.when(h & ~c, "HEALTHY").when(h & c, "HEALTHY_CROWDED").when(~h & c, "FRAGILE_CROWDED").when(~h & ~c, "WEAK")
    return df.withColumn("regime", name)


def with_sector(df: DataFrame, members: DataFrame) -> DataFrame:
    """Rows with the sectors that a stock belonged to on its day: from in_date on, until before out_date; null ends are open."""
    m = members.select(F.col("code").alias("stock_code"), "sector", "in_date", "out_date")
    since = F.col("in_date").isNull() | (F.col("in_date") <= F.col("trade_date"))
    until = F.col("out_date").isNull() | (F.col("out_date") > F.col("trade_date"))
    return df.join(m, "stock_code").where(since & until).drop("in_date", "out_date")


def composite(df: DataFrame, parts: dict[str, bool], n: int, name: str) -> DataFrame:
    """The mean of each part's rank in its last n days, turned round where less is more; null parts are left out.

    ``parts`` tells for each column whether more of it counts for more. A market has one row a day.
    """
    w = Window.orderBy("trade_date").rowsBetween(1 - n, 0)
    ranks = [F.when(F.col(c).isNotNull(), r if up else 1 - r) for c, up in parts.items() for r in [history_rank(F.col(c), w)]]
    given = F.filter(F.array(*ranks), lambda x: x.isNotNull())
    mean = F.try_divide(F.aggregate(given, F.lit(0.0), lambda a, x: a + x), F.nullif(F.size(given), F.lit(0)))
    return df.withColumn(name, mean)


def standardise(df: DataFrame, value: str, by: list[str]) -> DataFrame:
    """z-scores among the rows of a group; null where they don't differ."""
    return df.withColumn(value, rolling_z(F.col(value), Window.partitionBy(*by)))


def sector_day(df: DataFrame) -> DataFrame:
    """A day's sectors: amount, turnover, shares of the market's amount and cap, their ratio, median illiquidity, also on falling days."""
    per = df.groupBy("trade_date", "sector").agg(
        F.sum("amount").alias("amount"), F.sum("ff_cap").alias("cap"), F.median("amihud").alias("median_amihud"),
        F.median(F.when(F.col("ret") < 0, F.col("amihud"))).alias("median_downside"), F.count(F.lit(1)).alias("stocks"),
    ).withColumn("turnover", F.try_divide(F.col("amount"), F.nullif(F.col("cap"), F.lit(0.0))))
    day = Window.partitionBy("trade_date")
    out = per.withColumn("amount_share", F.try_divide(F.col("amount"), F.sum("amount").over(day))).withColumn("cap_share", F.try_divide(F.col("cap"), F.sum("cap").over(day)))
    return out.withColumn("rta", F.try_divide(F.col("amount_share"), F.nullif(F.col("cap_share"), F.lit(0.0))))
