"""Subscriptions that end by themselves, and what a running query tells of its state."""

from __future__ import annotations

import threading
import time
from collections import deque
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from .freshness import fresh


@dataclass
class Subscription:
    """What a bounded subscription saw. Accepted, received and fresh are three different things."""

    started: datetime
    accepted: bool = False
    received: int = 0
    fresh: int = 0
    last_event: datetime | None = None
    sample: Row | None = None  # the earliest fresh event, else the earliest of all
    stopped: bool = False

    @property
    def status(self) -> str:
        return "PASS" if self.fresh else "STALE" if self.received else "EMPTY"


def subscribe(events: DataFrame, event_time: str, *, timeout_s: float = 3.0, tolerance_s: float = 5.0, ahead_s: float = 60.0, checkpoint: str | None = None) -> Subscription:
    """Follow a stream until its first fresh event, at most ``timeout_s``; the query is stopped in any case.

    An event is fresh if its time isn't before the start less ``tolerance_s`` nor after now and ``ahead_s``. A batch is
    counted where it lies, and one row of it comes to the driver. A stream that fails raises what it failed of. With a
    ``checkpoint`` the next subscription goes on where this one ended.
    """
    seen = Subscription(datetime.now().astimezone())
    found = threading.Event()
    begun = F.timestamp_micros(F.lit(int(seen.started.timestamp() * 1e6)))

    def look(batch: DataFrame, _: int) -> None:
        now = F.timestamp_micros(F.lit(int(time.time() * 1e6)))
        ok = F.coalesce(fresh(F.col(event_time), begun, now, tolerance_s, ahead_s), F.lit(False))
        row, at = F.struct(*[F.col(f"`{c}`") for c in batch.columns]), F.col(event_time)
        got = batch.agg(
            F.count(F.lit(1)).alias("received"), F.count_if(ok).alias("fresh"), F.max(at).alias("last"),
            F.min_by(F.when(ok, row), F.when(ok, at)).alias("first_fresh"), F.min_by(row, at).alias("first"),
        ).first()
        if not got["received"]:
            return
        if (got["fresh"] and not seen.fresh) or seen.sample is None:
            seen.sample = got["first_fresh"] or got["first"] or seen.sample
        seen.received, seen.fresh, seen.last_event = seen.received + got["received"], seen.fresh + got["fresh"], got["last"] or seen.last_event
        if seen.fresh:
            found.set()

    writer = events.writeStream.foreachBatch(look)
    query = (writer.option("checkpointLocation", checkpoint) if checkpoint else writer).start()
    seen.accepted = True
    try:
        end = time.monotonic() + max(timeout_s, 0.0)
        while not found.is_set() and time.monotonic() < end:
            if query.awaitTermination(0.05):  # raises if the stream has failed
                break
    finally:
        query.stop()
        seen.stopped = not query.isActive
    return seen


STATUS = "at timestamp, query string, run string, kind string, batch long, rows long, rows_per_second double, watermark string, error string"


@dataclass(eq=False)
class StatusWatcher(StreamingQueryListener):
    """A listener that turns what queries tell into rows: started, progressed, idle, ended.

    The last ``most`` rows are kept, as a query that runs for months tells without end.
    """

    most: int = 10_000
    names: set[str] | None = None  # of the queries that are watched; None: all
    _rows: deque = field(init=False, repr=False)

    def __post_init__(self) -> None:
        self._rows, self._of, self._told = deque(maxlen=self.most), {}, threading.Condition()

    def _add(self, run, kind: str, batch=None, rows=None, speed=None, watermark=None, error=None) -> None:
        name = self._of.get(str(run))
        if self.names is not None and name not in self.names:
            return
        with self._told:
            self._rows.append((datetime.now(), name, str(run), kind, batch, rows, speed, watermark, error))
            self._told.notify_all()

    def onQueryStarted(self, event) -> None:
        self._of[str(event.runId)] = event.name
        self._add(event.runId, "started")

    def onQueryProgress(self, event) -> None:
        p = event.progress
        self._of.setdefault(str(p.runId), p.name)
        speed = p.processedRowsPerSecond
        self._add(p.runId, "progressed", p.batchId, p.numInputRows, speed if speed == speed else None, p.eventTime.get("watermark"))

    def onQueryIdle(self, event) -> None:
        self._add(event.runId, "idle")

    def onQueryTerminated(self, event) -> None:
        self._add(event.runId, "ended", error=event.exception)
        self._of.pop(str(event.runId), None)

    def wait(self, kind: str, timeout_s: float = 1.0) -> bool:
        """Whether a row of the kind is there, or comes within the time."""
        with self._told:
            return self._told.wait_for(lambda: any(r[3] == kind for r in self._rows), timeout_s)

    def table(self, spark: SparkSession) -> DataFrame:
        with self._told:
            return spark.createDataFrame(list(self._rows), STATUS)

    @property
    def status(self) -> str:
        """PASS once anything was told, EMPTY as long as no state has changed."""
        return "PASS" if self._rows else "EMPTY"


class watching:
    """Register a watcher for the time of a block: ``with watching(spark) as watcher``."""

    def __init__(self, spark: SparkSession, **options):
        self.spark, self.watcher = spark, StatusWatcher(**options)

    def __enter__(self) -> StatusWatcher:
        self.spark.streams.addListener(self.watcher)
        return self.watcher

    def __exit__(self, *_) -> None:
        self.spark.streams.removeListener(self.watcher)
