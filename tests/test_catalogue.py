"""Every core query against its oracle, over the smallest tables."""

import duckdb
import pandas as pd
import pytest

from sluice.plans import catalog
from sluice.session import TABLES

ORACLES = catalog.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def rows(df: pd.DataFrame) -> list:
    def plain(v):
        if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and v != v):
            return "null"
        return repr(round(float(v), 6)) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)

    df = df[sorted(df.columns)]
    for c in df.columns:
        if pd.api.types.is_numeric_dtype(df[c]) and not pd.api.types.is_bool_dtype(df[c]):
            df[c] = df[c].astype(float)
    return sorted(tuple(map(plain, r)) for r in df.itertuples(index=False))


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query(spark, sf, duck, name):
    found = catalog.queries()[name](spark, sf).toPandas()
    if name in ORACLES:
        expected = duck.execute(ORACLES[name]).df()
        assert sorted(found.columns) == sorted(expected.columns)
        assert rows(found) == rows(expected)
    else:
        assert len(found) > 0


def test_every_oracle_has_a_query():
    assert ORACLES.keys() <= catalog.queries().keys()
