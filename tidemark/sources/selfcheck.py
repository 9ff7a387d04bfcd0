"""What a feed can do, found out by asking it for a little, and what may be built on that."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PASS, EMPTY, NO_PERMISSION, UNSUPPORTED, ERROR, SKIP = "PASS", "EMPTY", "NO_PERMISSION", "UNSUPPORTED", "ERROR", "SKIP"
#: What a full history and a history of today's survivors need.
FULL = ("stock_bars", "delisted_stocks", "index_bars", "future_bars", "expired_contracts")
REDUCED = ("stock_bars", "index_bars", "future_bars")
FUTURE_FIELDS = ("settlement", "open_interest", "volume")


class CapabilityError(RuntimeError):
    """A feed lacks what a build needs."""


def probe(ask: Callable[[], DataFrame | None], required: tuple[str, ...] = ()) -> tuple[str, str]:
    """Status and detail of one question; one row decides whether there is data."""
    try:
        df = ask()
        if df is None:
            return SKIP, "not asked"
        if missing := [c for c in required if c not in df.columns]:
            return UNSUPPORTED, "no " + ", ".join(missing)
        return (EMPTY, "no row") if df.limit(1).isEmpty() else (PASS, "")
    except PermissionError as e:
        return NO_PERMISSION, str(e)
    except (AttributeError, NotImplementedError) as e:
        return UNSUPPORTED, str(e)
    except Exception as e:  # noqa: BLE001  a probe reports whatever happens
        return ERROR, f"{type(e).__name__}: {e}"[:200]


def check(spark: SparkSession, questions: dict[str, Callable[[], DataFrame | None]]) -> DataFrame:
    """(capability, status, detail), a row for each question."""
    rows = [(k, *probe(f, FUTURE_FIELDS if k == "future_bars" else ())) for k, f in questions.items()]
    return spark.createDataFrame(rows, "capability string, status string, detail string")


def gate(report: DataFrame, needs: tuple[str, ...] = FULL) -> None:
    """Raise unless everything that a build needs has passed."""
    passed = {r["capability"] for r in report.where(F.col("status") == PASS).select("capability").collect()}
    if missing := [n for n in needs if n not in passed]:
        raise CapabilityError("not passed: " + ", ".join(missing))
