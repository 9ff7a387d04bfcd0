"""What operators over vectors share: batches as matrices, bounded states merged pairwise over all partitions."""

from __future__ import annotations

import pickle
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def whole(vector: Column) -> Column:
    """True for vectors that aren't null and hold neither null nor non-finite components."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return vector.isNotNull() & ~F.coalesce(F.exists(vector, bad), F.lit(False))


def matrix(col: pa.Array, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Of a column of lists: the places of those with ``dim`` finite components, and these as rows of doubles."""
    at = np.flatnonzero(pc.fill_null(pc.equal(pc.list_value_length(col), dim), False).to_numpy(zero_copy_only=False))
    flat = pc.list_flatten(col.take(pa.array(at, pa.int64()))).cast(pa.float64())
    x = pc.fill_null(flat, float("nan")).to_numpy(zero_copy_only=False).reshape(len(at), dim)
    use = np.isfinite(x).all(1)
    return at[use], x[use]


def tree_reduced(states: DataFrame, merge: Callable):
    """One state out of the pickled states in the only column; at least one is there, and their size has a bound."""
    return states.rdd.map(_state).treeReduce(merge, depth=2)


def _state(row):
    return pickle.loads(row[0])


def state_batch(state) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([pickle.dumps(state)], pa.binary())], ["state"])
