"""Which events of a subscription are fresh, and loads that pick up where they stopped."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def fresh(event_time: Column, started: Column, now: Column, tolerance_s: float = 5.0, ahead_s: float = 60.0) -> Column:
    """Not before the start less a tolerance, not after now and a minute."""
    t, a, b = (x.cast("timestamp").cast("double") for x in (event_time, started, now))
    return (t >= a - tolerance_s) & (t <= b + ahead_s)


def evidence(events: DataFrame, event_time: str, started: Column, now: Column, by: list[str]) -> DataFrame:
    """Received, fresh and stale events of each group, and the first fresh one's time."""
    ok = F.coalesce(fresh(F.col(event_time), started, now), F.lit(False))
    return events.groupBy(*by).agg(
        F.count(F.lit(1)).alias("received"), F.count_if(ok).alias("fresh"), F.count_if(~ok).alias("stale"), F.min(F.when(ok, F.col(event_time))).alias("first_fresh")
    )


def load_new(spark: SparkSession, path: str, schema: T.StructType, checkpoint: str, publish: Callable[[DataFrame, int], None]) -> None:
    """Give files that no run has seen to ``publish``, batch by batch; the checkpoint remembers them."""
    stream = spark.readStream.schema(schema).parquet(path)
    stream.writeStream.trigger(availableNow=True).option("checkpointLocation", checkpoint).foreachBatch(publish).start().awaitTermination()


def bar_stream(ticks: DataFrame, minutes: int = 5, late: str = "10 minutes") -> DataFrame:
    """Open, high, low, close and volume of each code and window of a tick stream (time, code, price, volume)."""
    w = F.window("time", f"{minutes} minutes")
    return ticks.withWatermark("time", late).groupBy("code", w).agg(
        F.min_by("price", "time").alias("open"), F.max("price").alias("high"), F.min("price").alias("low"), F.max_by("price", "time").alias("close"), F.sum("volume").alias("volume")
    )
