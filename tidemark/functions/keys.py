"""Stable record keys, and texts without what is nobody's business."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def record_key(*parts: Column) -> Column:
    """SHA-256 over the parts as text, joined by the unit separator; null is written ``<NULL>``."""
    return F.sha2(F.concat_ws("\u001f", *[F.coalesce(p.cast("string"), F.lit("<NULL>")) for p in parts]), 256)


def redact(text: Column, keys: list[str], mask: str = "***") -> Column:
    """A JSON text with the values of some keys, at any depth, masked: strings, numbers, true, false, null and flat lists."""
    names = "|".join(keys)
    value = r'"(?:[^"\\]|\\.)*"|\[[^\[\]]*\]|[^,}\]\s{\[]+'
    return F.regexp_replace(text, f'("(?:{names})"\\s*:\\s*)(?:{value})', f'$1"{mask}"')
