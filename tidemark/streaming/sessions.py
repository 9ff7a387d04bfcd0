"""Sessions of events that follow one another, and the events that come too late for theirs."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.files import Files


def sessions(events: DataFrame, by: Sequence[str], at: str, gap: str, late: str | None = None, **aggregates: Column) -> DataFrame:
    """(by, started, last, n, ...): events of a key no further apart than ``gap``.

    For batches and streams alike. In a stream ``late`` bounds the state: a session ends once the watermark has passed it
    by the gap, and events that are later than that are left out; ``split_late`` keeps them.
    """
    rows = events if late is None else events.withWatermark(at, late)
    told = rows.groupBy(*by, F.session_window(at, gap).alias("_w")).agg(F.count(F.lit(1)).alias("n"), F.max(at).alias("last"), *[c.alias(k) for k, c in aggregates.items()])
    return told.select(*by, F.col("_w.start").alias("started"), "last", "n", *aggregates)


def split_late(spark: SparkSession, path: str, at: str, delay_s: float, gap_s: float, on_time: Callable[[DataFrame, int], None], late: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """For ``foreachBatch``: give a batch's rows to ``on_time`` or ``late``, by the watermark that ruled when it began.

    The watermark is the latest event of all batches before, less ``delay_s``; an event is late if its session would
    have ended by then, ``gap_s`` after it. A session stream leaves events out by the same bound or an older one, so
    that one which reads what was on time, with the same delay and gap, leaves out none of it. Under ``path`` each
    batch leaves the latest event so far, so that a batch that is done again after a failure is split alike. Events
    without a time are late.
    """
    files = Files(spark, path)

    def run(batch: DataFrame, number: int) -> None:
        known = json.loads(files.read(f"{path}/{number - 1}.json") or "{}") if number else {}
        latest = known.get("latest_us")
        time = F.col(at).cast("timestamp")
        gone = time.isNull() if latest is None else time.isNull() | (F.unix_micros(time) + int(gap_s * 1e6) <= latest - int(delay_s * 1e6))
        batch = batch.persist()  # a batch is read three times here, and its source once
        try:
            on_time(batch.where(~gone), number)
            late(batch.where(gone), number)
            newest = batch.agg(F.max(F.unix_micros(time)).alias("m")).first()["m"]
        finally:
            batch.unpersist()
        files.write(f"{path}/{number}.json", json.dumps({"latest_us": max(filter(lambda x: x is not None, (newest, latest)), default=None)}))
        if number > 1:
            files.delete(f"{path}/{number - 2}.json")

    return run
