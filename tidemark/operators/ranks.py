"""Ranks in long histories."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T


def rank_in_history(df: DataFrame, value: str, n: int = 252, by: str = "stock_code", order: str = "trade_date", name: str = "ts_percentile") -> DataFrame:
    """The share of a key's last ``n`` values, this one among them, that are not above this one.

    Each key's rows pass once, in order, by a sorted list of the window's values: a value is put in and one taken out by
    halving, where a list for each row would cost the window's length. What a task keeps is one window, however long a
    key's history is. Null and NaN values have no rank and don't count, but their rows take a place in the window. Rows
    with the same key and time are ordered by value.
    """
    schema = T.StructType([*df.schema.fields, T.StructField(name, T.DoubleType())])
    key, val = df.columns.index(by), df.columns.index(value)

    def run(batches):
        from bisect import bisect_left, bisect_right, insort
        from collections import deque

        import pyarrow as pa

        current, window, ordered = object(), deque(), []
        for b in batches:
            out = []
            for k, v in zip(b.column(key).to_pylist(), b.column(val).to_pylist(), strict=True):
                if k != current:
                    current, window, ordered = k, deque(), []
                v = None if v is None or v != v else v
                window.append(v)
                if v is not None:
                    insort(ordered, v)
                if len(window) > n and (old := window.popleft()) is not None:
                    del ordered[bisect_left(ordered, old)]
                out.append(None if v is None else bisect_right(ordered, v) / len(ordered))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, pa.float64())], schema.names)

    return df.repartition(by).sortWithinPartitions(by, order, value).mapInArrow(run, schema)
