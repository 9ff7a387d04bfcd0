"""Trading calendars and what follows from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def trade_calendar(days: DataFrame, market: str = "ALL", day: str = "trade_date") -> DataFrame:
    """Open days with the open days before and after; a calendar has some thousand rows a market."""
    w = Window.partitionBy("market").orderBy("trade_date")
    one = days.select(F.lit(market).alias("market"), F.col(day).cast("date").alias("trade_date")).where("trade_date is not null").distinct()
    return one.select("market", "trade_date", F.lit(True).alias("is_open"), F.lag("trade_date").over(w).alias("previous_trade_date"), F.lead("trade_date").over(w).alias("next_trade_date"))


def extend_calendar(stored: DataFrame, days: DataFrame, market: str = "ALL", day: str = "trade_date") -> DataFrame:
    """New open days and the stored ones whose neighbours they change, as rows of ``trade_calendar``.

    ``stored`` is the calendar as it stands (market, trade_date, previous_trade_date, next_trade_date). Only its days
    from the last one before the new range to the first one after it are looked at; the outer neighbours of these two
    stay as they are. The result with the untouched rest is the calendar of all days at once, in whatever order they came.
    """
    new = days.select(F.col(day).cast("date").alias("trade_date")).where("trade_date is not null").distinct()
    lo, hi = new.agg(F.min("trade_date")).scalar(), new.agg(F.max("trade_date")).scalar()
    own = stored.where(F.col("market") == market).select("trade_date", "previous_trade_date", "next_trade_date")
    before = own.where(F.col("trade_date") < lo).agg(F.max("trade_date")).scalar()
    after = own.where(F.col("trade_date") > hi).agg(F.min("trade_date")).scalar()
    seam = own.where((F.col("trade_date") >= F.coalesce(before, lo)) & (F.col("trade_date") <= F.coalesce(after, hi)))
    every = new.join(seam.select("trade_date", F.col("previous_trade_date").alias("_p"), F.col("next_trade_date").alias("_n"), F.lit(True).alias("_stored")), "trade_date", "full")
    w = Window.orderBy("trade_date")  # days of one market within the range
    both = every.withColumns({"_lag": F.lag("trade_date").over(w), "_lead": F.lead("trade_date").over(w)})
    previous, following = F.coalesce("_lag", "_p"), F.coalesce("_lead", "_n")
    changed = F.col("_stored").isNull() | ~previous.eqNullSafe(F.col("_p")) | ~following.eqNullSafe(F.col("_n"))
    return both.where(changed).select(F.lit(market).alias("market"), "trade_date", F.lit(True).alias("is_open"), previous.alias("previous_trade_date"), following.alias("next_trade_date"))


def next_open_day(df: DataFrame, calendar: DataFrame, announced: str, name: str = "available_date") -> DataFrame:
    """The first open day strictly after a date: null after the last, the first open day for all dates before it.

    The calendar is opened into one row for each civil day, so that a date finds its day by an equi-join; the rows
    are as many as days between the calendar's ends, and Spark broadcasts them if they are small.
    """
    days = calendar.select(F.col("trade_date").alias("_open")).distinct()
    w = Window.orderBy("_open")
    spans = days.select("_open", F.lag("_open").over(w).alias("_before"))
    civil = spans.where("_before is not null").select(
        F.explode(F.sequence(F.col("_before"), F.date_sub("_open", 1))).alias("_day"), F.col("_open").alias(name)
    )
    first = days.agg(F.min("_open")).scalar()
    found = df.join(civil, F.col(announced) == F.col("_day"), "left")
    early: Column = F.when(F.col(announced) < first, first)
    return found.withColumn(name, F.coalesce(F.col(name), early)).drop("_day")
