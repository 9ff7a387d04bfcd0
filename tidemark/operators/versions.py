"""Which version of a row counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_version(df: DataFrame, keys: Sequence[str], newest: Sequence[Column], where: Column | None = None) -> DataFrame:
    """The newest row of each key, by ``newest`` descending; ``where`` is applied before, so that an older valid
    version comes back where a newer one fails it. Null keys are keys of their own."""
    if where is not None:
        df = df.where(where)
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*[c.desc() for c in newest]))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def ingested_order() -> list[Column]:
    """Newest first: by ingestion instant, then by run."""
    return [F.col("_ingested_at").cast("timestamp"), F.col("source_run_id")]


def duplicate_count(keys: Sequence[str]) -> Column:
    """Rows beyond the first of each key; null parts count as values."""
    return F.count(F.lit(1)) - F.count_distinct(F.struct(*keys))
