"""Main contracts of a product, and the basis of futures against their spot index."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Kinds of mappings, and how a main contract was found.
EOD, NEXT_DAY = "EOD_OBSERVED", "NEXT_TRADE_DAY"
BY_OPEN_INTEREST, BY_VOLUME = "MAX_OPEN_INTEREST", "MAX_VOLUME_FALLBACK"


def main_contracts(futures: DataFrame, master: DataFrame, rule: str = "v1") -> DataFrame:
    """The main contract of each day and product, by the end of the day: ``EOD_OBSERVED`` rows.

    Candidates expire after the day. The largest open interest wins, if any is valid (not null, not negative), else
    the largest volume; ties go to the earlier expiry, then the code. No valid one: no row. One aggregation, whose
    state is one row a group.
    """
    alive = futures.join(master.select("contract_code", "expire_date"), "contract_code").where(F.col("expire_date") > F.col("trade_date"))

    def best(c: str) -> Column:
        return F.min(F.when(F.col(c) >= 0, F.struct((-F.col(c)).alias("v"), "expire_date", "contract_code")))

    per = alive.groupBy("trade_date", "product").agg(best("open_interest").alias("oi"), best("volume").alias("vol"), F.count(F.lit(1)).alias("n"))
    return per.where("oi is not null or vol is not null").select(
        F.lit(EOD).alias("mapping_type"), F.col("trade_date").alias("observation_trade_date"), F.col("trade_date").alias("effective_trade_date"), "product",
        F.coalesce("oi.contract_code", "vol.contract_code").alias("contract_code"),
        F.when(F.col("oi").isNotNull(), BY_OPEN_INTEREST).otherwise(BY_VOLUME).alias("selection_method"), F.lit(rule).alias("rule_version"), F.col("n").alias("eligible_contract_count"),
    )


def next_day_mapping(eod: DataFrame, calendar: DataFrame) -> DataFrame:
    """The same contracts as they can be used: on the open day after the one they were seen on."""
    days = calendar.where("next_trade_date is not null").select(F.col("trade_date").alias("observation_trade_date"), F.col("next_trade_date").alias("_next")).dropDuplicates(["observation_trade_date"])
    return eod.join(days, "observation_trade_date").select(*[F.lit(NEXT_DAY).alias(c) if c == "mapping_type" else F.col("_next").alias(c) if c == "effective_trade_date" else F.col(c) for c in eod.columns])


def with_main_flag(df: DataFrame, mapping: DataFrame, mapping_type: str, name: str) -> DataFrame:
    """Whether a day's contract is its product's main one; no row is added or lost.

    A mapping has at most a row for each day and product, however many contracts trade, so it comes to the rows.
    """
    keys = mapping.where(F.col("mapping_type") == mapping_type).select(F.col("effective_trade_date").alias("trade_date"), "contract_code").distinct().withColumn("_main", F.lit(True))
    return df.join(F.broadcast(keys), ["trade_date", "contract_code"], "left").withColumn(name, F.coalesce("_main", F.lit(False))).drop("_main")


def spot_code(product: Column, spots: dict[str, str]) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in spots.items() for x in kv]), product)


def basis(futures: DataFrame, index: DataFrame, master: DataFrame, mapping: DataFrame, spots: dict[str, str], rule: str = "v1", keep: tuple[str, ...] = ()) -> DataFrame:
    """Basis of every contract day; null without a positive spot, annualised only before expiry. ``keep``: columns of futures to go along.

    An index has a row for each day and product, however many contracts trade, so it comes to the contract days, which
    stay where their contracts are.
    """
    spot = index.select("trade_date", F.col("index_code").alias("spot_code"), F.col("close").alias("spot_close"))
    rows = futures.join(master.select("contract_code", "expire_date"), "contract_code", "left").withColumn("spot_code", spot_code(F.col("product"), spots))
    rows = rows.join(F.broadcast(spot), ["trade_date", "spot_code"], "left")
    good = F.col("spot_close") > 0
    rows = (
        rows.withColumn("future_close", F.col("close"))
        .withColumn("basis_close", F.when(good, F.col("close") - F.col("spot_close")))
        .withColumn("basis_settlement", F.when(good, F.col("settlement") - F.col("spot_close")))
        .withColumn("basis_pct", F.when(good, F.try_divide(F.col("basis_close"), F.col("spot_close"))))
        .withColumn("days_to_expiry", F.datediff("expire_date", "trade_date"))
        .withColumn("annualized_basis", F.when(F.col("days_to_expiry") > 0, F.col("basis_pct") * 365 / F.col("days_to_expiry")))
        .withColumn("rule_version", F.lit(rule))
    )
    rows = with_main_flag(with_main_flag(rows, mapping, EOD, "is_eod_main"), mapping, NEXT_DAY, "is_tradable_main")
    return rows.select(
        "trade_date", "product", "contract_code", "spot_code", "future_close", "settlement", "spot_close", "basis_close", "basis_settlement",
        "basis_pct", "days_to_expiry", "annualized_basis", "is_eod_main", "is_tradable_main", "rule_version", *keep,
    )


def active_contracts(master: DataFrame, products: list[str] | None = None, active_on=None) -> DataFrame:
    """Contracts of the products (none given: all) that trade on a day, both ends included; null ends are open."""
    out = master.where(F.col("product").isin(*products)) if products else master
    if active_on is not None:
        day = F.lit(active_on).cast("date")
        out = out.where((F.col("list_date").isNull() | (F.col("list_date") <= day)) & (F.col("expire_date").isNull() | (F.col("expire_date") >= day)))
    return out


# Fixed value: what a main contract counts for beside its volume.
MAIN_BONUS = 1e9


def option_pairs(futures: DataFrame, options: DataFrame, as_of: str) -> DataFrame:
    """A market's future and option that are checked together: (market, future, option).

    ``futures`` (market, code, expire_date, volume, is_main) and ``options`` (market, code, underlying, expire_date,
    volume), an underlying being a future's code. Of the futures that haven't expired the most liquid one with an option
    that hasn't, main contracts before others, and the most liquid of its options; where no future has one, the most
    liquid future alone. Equals go by code. Null dates never expire, null volumes are none.
    """
    live = lambda df: df.where(F.col("expire_date").isNull() | (F.col("expire_date") >= F.lit(as_of).cast("date")))
    volume = F.coalesce(F.col("volume"), F.lit(0.0))
    best = live(options).groupBy("market", "underlying").agg(F.min_by("code", F.struct(-volume, "code")).alias("option"))
    weight = volume + F.when(F.col("is_main"), MAIN_BONUS).otherwise(0.0)
    rows = live(futures).select("market", F.col("code").alias("future"), weight.alias("weight")).join(best.withColumnRenamed("underlying", "future"), ["market", "future"], "left")
    first = F.min_by(F.struct("future", "option"), F.struct(F.col("option").isNull(), -F.col("weight"), F.col("future")))
    return rows.groupBy("market").agg(first.alias("p")).select("market", "p.future", "p.option")


def nearest_strikes(bars: DataFrame, options: DataFrame) -> DataFrame:
    """For each bar of a future, and kind of option, the option as-of that day whose strike is nearest to the close.

    ``bars`` (trade_date, contract_code, close); ``options`` (code, underlying, kind, strike, list_date, expire_date).
    Only options that are listed and not expired count; of equally near strikes the lower one, then the earlier expiry,
    then the code. A future's options come to its bars as one list, sorted once, so that no pair of a bar and an option
    becomes a row.
    """
    entry = F.struct(F.col("strike"), F.col("expire_date"), F.col("list_date"), F.col("code"))
    chain = options.where("strike is not null").groupBy(F.col("underlying").alias("contract_code"), "kind").agg(F.sort_array(F.collect_list(entry)).alias("_chain"))
    day = F.col("trade_date")
    live = F.filter("_chain", lambda o: (o["list_date"].isNull() | (o["list_date"] <= day)) & (o["expire_date"].isNull() | (o["expire_date"] >= day)))
    far = F.transform(live, lambda o: F.struct(F.abs(o["strike"] - F.col("close")).alias("gap"), o["strike"].alias("strike"), F.coalesce(o["expire_date"], F.lit("9999-12-31").cast("date")).alias("until"), o["code"].alias("code")))
    rows = bars.where("close is not null").join(chain, "contract_code").withColumn("_near", F.array_min(far)).where("_near is not null")
    return rows.select("trade_date", "contract_code", "kind", "close", F.col("_near.code").alias("option"), F.col("_near.strike").alias("strike"), F.col("_near.gap").alias("gap"))
