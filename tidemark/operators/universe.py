"""Which securities could be traded on which day; adjustment factors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import forward_fill


def historical_universe(securities: DataFrame, calendar: DataFrame, name: str = "ALL_A", rule: str = "v1") -> DataFrame:
    """A row for each security and open day from its listing to its delisting, both included; null ends are open.

    A security is opened into the years it was listed in, and finds their days by an equi-join. Securities are dealt
    out first and the days, at most one a date, come to them: by the year alone all would meet in a task for each year.
    """
    days = calendar.where("is_open").select("trade_date").distinct().withColumn("_year", F.year("trade_date"))
    first, last = days.agg(F.min("_year")).scalar(), days.agg(F.max("_year")).scalar()
    start, stop = F.greatest(F.year("list_date"), first), F.least(F.year("delist_date"), last)
    tasks = int(securities.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    years = securities.repartition(tasks, "stock_code").where(start <= stop).withColumn("_year", F.explode(F.sequence(start, stop)))
    fits = (F.col("list_date").isNull() | (F.col("list_date") <= F.col("trade_date"))) & (F.col("delist_date").isNull() | (F.col("delist_date") >= F.col("trade_date")))
    return years.join(F.broadcast(days), "_year").where(fits).select(
        F.lit(name).alias("universe_name"), "trade_date", "stock_code", F.lit(True).alias("eligible_flag"), F.lit("").alias("exclusion_reasons"), F.lit(rule).alias("rule_version")
    )


def adjust_prices(bars: DataFrame, factors: DataFrame, prices: tuple[str, ...] = ("open", "high", "low", "close")) -> DataFrame:
    """Prices times the last factor known on the day; before the first factor null."""
    out = bars.join(factors.select("trade_date", "stock_code", "factor"), ["trade_date", "stock_code"], "left")
    out = out.withColumn("factor", forward_fill(F.col("factor"), "stock_code", "trade_date"))
    return out.select("*", *[(F.col(p) * F.col("factor")).alias(f"{p}_adjusted") for p in prices if p in bars.columns])
