"""Financial records as they were known on a day."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import record_key
from .calendar import next_open_day
from .versions import ingested_order, latest_version

#: Tables of which an announcement replaces the whole one before.
SNAPSHOT_TABLES = ("Top10Holder", "Top10FlowHolder")


def financial_keys(df: DataFrame) -> DataFrame:
    """Logical, source and snapshot keys. Rows of snapshot tables are an error where there is no ``rank`` column, as
    all holders of an announcement would share a key."""
    ranked = F.col("table_name").isin(*SNAPSHOT_TABLES)
    rank: Column = F.col("rank").cast("bigint") if "rank" in df.columns else F.raise_error("rows of a snapshot table need a rank").cast("bigint")
    core = [F.col("stock_code"), F.col("table_name"), F.col("report_period")]
    logical = F.when(ranked, record_key(*core, rank)).otherwise(record_key(*core))
    out = df.withColumn("logical_record_key", logical)
    return out.withColumn("source_record_key", record_key(F.col("logical_record_key"), F.col("announce_date"))).withColumn(
        "snapshot_version_key", record_key(*core, F.col("announce_date"))
    )


def assign_availability(financial: DataFrame, calendar: DataFrame) -> DataFrame:
    """A record may be used from the first open day after its announcement on."""
    out = next_open_day(financial, calendar, "announce_date")
    quality = F.when(F.col("announce_date").isNull(), "MISSING_ANNOUNCE_DATE").otherwise("VALID")
    return financial_keys(out.withColumn("pit_quality", quality))


def pit_view(financial: DataFrame, newest: Sequence[Column]) -> DataFrame:
    """The newest version of each dated source record."""
    return latest_version(financial, ["source_record_key"], newest, F.col("announce_date").isNotNull() & F.col("available_date").isNotNull())


def known_as_of(view: DataFrame, codes: Sequence[str] | None, as_of, tables: Sequence[str] | None = None, newest: Sequence[Column] | None = None) -> DataFrame:
    """What was known of the codes on a day, every report period.

    None for codes: all; no codes: nothing; no tables: all. Of snapshot tables the newest whole announcement of each code, table and
    period; of others the newest row of each logical record. Of rows that were available and announced on the same
    days, ``newest`` decides; by default the later ingestion, where the view tells it.
    """
    if newest is None:
        newest = ingested_order() if {"_ingested_at", "source_run_id"} <= set(view.columns) else []
    among = F.lit(True) if codes is None else F.col("stock_code").isin(*codes) if codes else F.lit(False)
    eligible = view.where(among).where(F.col("available_date") <= F.lit(as_of).cast("date"))
    if tables:
        eligible = eligible.where(F.col("table_name").isin(*tables))
    snapshot = F.col("table_name").isin(*SNAPSHOT_TABLES)
    version = ["stock_code", "table_name", "report_period", "snapshot_version_key"]
    shots = latest_version(
        eligible.where(snapshot).select(*version, "available_date", "announce_date").distinct(),
        ["stock_code", "table_name", "report_period"], [F.col("available_date"), F.col("announce_date"), F.col("snapshot_version_key")],
    )
    whole = eligible.where(snapshot).join(shots.select(*version), version).select(*view.columns)
    single = latest_version(eligible.where(~snapshot), ["logical_record_key"], [F.col("available_date"), F.col("announce_date"), *newest])
    return whole.unionByName(single, allowMissingColumns=True)
