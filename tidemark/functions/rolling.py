"""Statistics over the last n rows of an ordered group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F


def rolling(by: list[str] | str, order: list[str] | str, n: int) -> WindowSpec:
    """The current row and the n - 1 before it."""
    return Window.partitionBy(by).orderBy(order).rowsBetween(1 - n, 0)


def rolling_median(c: Column, w: WindowSpec, when: Column | None = None) -> Column:
    """The exact median of a window's values that aren't null; of an even number the mean of the middle two.

    The window's few values are sorted as an array of doubles, which takes a fraction of a percentile's counting table.
    """
    values = F.collect_list((c if when is None else F.when(when, c)).cast("double")).over(w)

    def middle(v: Column) -> Column:
        low, high = F.get(v, F.shiftright(F.size(v) - 1, 1)), F.get(v, F.shiftright(F.size(v), 1))
        return F.when(low == high, low).otherwise(low * 0.5 + high * 0.5)

    # The window is named once: each mention of it would be collected anew.
    return F.get(F.transform(F.array(F.sort_array(values)), middle), 0)


def rolling_z(c: Column, w: WindowSpec) -> Column:
    """How many sample standard deviations from the window's mean; null where there is no deviation."""
    return F.try_divide(c - F.avg(c).over(w), F.nullif(F.stddev_samp(c).over(w), F.lit(0.0)))


def history_rank(c: Column, w: WindowSpec) -> Column:
    """The share of the window's values that are not above the current one."""
    return F.size(F.filter(F.collect_list(c).over(w), lambda x: x <= c)) / F.nullif(F.count(c).over(w), F.lit(0))


def forward_fill(c: Column, by: list[str] | str, order: list[str] | str) -> Column:
    return F.last(c, ignorenulls=True).over(Window.partitionBy(by).orderBy(order).rowsBetween(Window.unboundedPreceding, 0))


def streak_length(df: DataFrame, flag: str, by: list[str], order: str, name: str = "streak") -> DataFrame:
    """Rows in a row, up to this one, on which ``flag`` holds; 0 where it doesn't."""
    w = Window.partitionBy(*by).orderBy(order)
    off = F.sum(F.when(F.col(flag), 0).otherwise(1)).over(w.rowsBetween(Window.unboundedPreceding, 0))
    runs = df.withColumn("_run", off)
    inside = Window.partitionBy(*by, "_run").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return runs.withColumn(name, F.sum(F.when(F.col(flag), 1).otherwise(0)).over(inside)).drop("_run")
