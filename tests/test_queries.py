"""Every query over the star schema against its SQL, on the smallest tables."""

from pathlib import Path

import duckdb
import pytest

from tidemark.plans import queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for f in Path(SF).glob("*.parquet"):
        c.sql(f"CREATE VIEW {f.stem} AS SELECT * FROM read_parquet('{f}')")
    return c


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_matches_sql(spark, con, name):
    got, want = queries.QUERIES[name](spark, SF), con.sql(queries.ORACLES[name])
    cols = sorted(got.columns)
    assert sorted(want.columns) == cols
    show = lambda r: tuple("null" if v is None else str(v) for v in r)
    assert sorted(show(r[c] for c in cols) for r in got.collect()) == sorted(show(r[want.columns.index(c)] for c in cols) for r in want.fetchall())


def test_entry_points():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(queries.QUERIES) <= set(entry.queries())
