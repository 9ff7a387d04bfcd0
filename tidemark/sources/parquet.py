"""Parquet files of one dataset whose schemas drifted apart."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of a pinned schema, by name; what is missing is null, what the schema doesn't know goes."""
    have = set(df.columns)

    def column(f: T.StructField):
        if f.name not in have or isinstance(df.schema[f.name].dataType, T.NullType):
            return F.lit(None).cast(f.dataType)
        if isinstance(f.dataType, T.DateType) and isinstance(df.schema[f.name].dataType, T.IntegralType):
            return F.lit(None).cast(f.dataType)  # an all-null column that Parquet shows as int
        return F.col(f.name).try_cast(f.dataType)

    return df.select(*[column(f).alias(f.name) for f in schema.fields])


def read_by_name(spark: SparkSession, groups: Sequence[Sequence[str]], schema: T.StructType) -> DataFrame:
    """Files as one dataset. A group of files shares a physical schema; each is read with its own and conformed."""
    out = None
    for files in groups:
        part = conform(spark.read.parquet(*files), schema)
        out = part if out is None else out.unionByName(part)
    return out if out is not None else spark.createDataFrame([], schema)


def union_by_name(*frames: DataFrame) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out
