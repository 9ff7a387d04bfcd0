"""Dates and numbers as feeds write them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Numbers above this are milliseconds since 1970, not dates written as digits.
EPOCH_FROM = 1e10


def number(c: Column) -> Column:
    """A double, or null for what is no number and for NaN."""
    return F.nullif(c.try_cast("double"), F.lit(float("nan")))


def epoch_or_text_date(c: Column, zone: str = "Asia/Shanghai") -> Column:
    """Epoch milliseconds as the date in ``zone``; else text such as 20260105 or 2026-01-05, with or without ``.0``.

    A text is parsed only as what its signs let it be: a failed parse costs many times a good one.
    """
    text = F.regexp_replace(F.trim(c.cast("string")), r"\.0$", "")
    n = F.when(text.rlike(r"^\d{4}[-/]\d"), F.lit(None).cast("double")).otherwise(number(c))
    # Wall clocks without a zone, so that the session's own time zone plays no part.
    since = F.make_dt_interval(secs=(n / 1000).try_cast("decimal(18,6)"))
    millis = F.convert_timezone(F.lit("UTC"), F.lit(zone), F.lit("1970-01-01").cast("timestamp_ntz") + since).cast("date")
    dash = F.locate("-", text, 2) > 0  # a first one may be a sign
    plain = F.when(text.contains("/"), F.try_to_date(text, "yyyy/MM/dd")).when(dash, F.try_to_date(text, "yyyy-MM-dd")).otherwise(F.try_to_date(text, "yyyyMMdd"))
    return F.when(n > EPOCH_FROM, millis).otherwise(plain)


def detail_date(c: Column) -> Column:
    """The first eight digits as a date; null where they are none."""
    return F.try_to_date(F.substring(F.regexp_replace(c.cast("string"), r"\D", ""), 1, 8), "yyyyMMdd")


def event_time(c: Column) -> Column:
    """A wall clock without zone from seconds or milliseconds since 1970, or from 14 or 17 digits; else null."""
    t = F.regexp_replace(F.trim(c.cast("string")), r"\.0$", "")
    digits = F.when(t.rlike(r"^\d+$"), t)
    n = F.length(digits)
    since = F.lit("1970-01-01").cast("timestamp_ntz")

    def part(at: int, size: int, kind: str = "int") -> Column:
        return F.substring(digits, at, size).try_cast(kind)

    written = F.try_make_timestamp_ntz(
        part(1, 4), part(5, 2), part(7, 2), part(9, 2), part(11, 2),
        (part(13, 2) + F.when(n == 17, part(15, 3)).otherwise(0) / 1000).cast("decimal(8,6)"),
    )
    epoch = F.when(n == 10, part(1, 10, "decimal(18,6)")).when(n == 13, (part(1, 13, "decimal(18,0)") / 1000).cast("decimal(18,6)"))
    return F.when(n.isin(14, 17), written).when(epoch.isNotNull(), since + F.make_dt_interval(secs=epoch))
