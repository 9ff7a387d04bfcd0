"""Spark sessions with the settings that the operators' semantics rest on."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(app: str = "tidemark", master: str | None = None, **conf: str) -> SparkSession:
    """A session in UTC with ANSI casts and adaptive execution; ``conf`` overrides."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.parquet.compression.codec": "zstd",
    } | {k.replace("__", "."): v for k, v in conf.items()}
    for k, v in settings.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()
