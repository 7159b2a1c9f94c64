"""Every registered query equals its DuckDB oracle on the sf0.001 tables."""

from __future__ import annotations

import datetime
import decimal
import math
import os

import duckdb
import pandas as pd
import pytest

from conftest import SF_SMALL
from mercato.plans import oracle, queries

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_SMALL), reason="driver tables missing")


def _entry():
    import __spark_entry__ as entry
    return entry


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        path = os.path.join(SF_SMALL, f"{t}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, datetime.date) and not isinstance(v, datetime.datetime):
        return datetime.datetime(v.year, v.month, v.day)
    if isinstance(v, pd.Timestamp):
        return v.to_pydatetime().replace(tzinfo=None)
    if isinstance(v, (float, decimal.Decimal)):
        return float(f"{float(v):.10g}")
    if hasattr(v, "item"):
        return v.item()
    return v


def _rows(df: pd.DataFrame):
    recs = [tuple(_norm(x) for x in r) for r in df.itertuples(index=False, name=None)]
    return sorted(recs, key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0)
                                            for x in r))


ORACLE_KEYS = sorted(oracle.oracle_sql())


def test_every_query_has_an_oracle():
    q, o = set(queries.queries()), set(ORACLE_KEYS)
    assert o == q
    assert q <= set(_entry().queries()) and o <= set(_entry().oracle_sql())


@pytest.mark.parametrize("key", ORACLE_KEYS)
def test_query_matches_oracle(spark, duck, key):
    entry = _entry()
    sdf = entry.queries()[key](spark, SF_SMALL).toPandas()
    # as a view, so that the columns cannot depend on the rows
    duck.execute(f"CREATE OR REPLACE VIEW checked AS {entry.oracle_sql()[key]}")
    odf = duck.execute("SELECT * FROM checked").df()
    assert sorted(sdf.columns) == sorted(odf.columns)
    cols = sorted(sdf.columns)
    assert len(sdf) == len(odf)
    assert _rows(sdf[cols]) == _rows(odf[cols])


def test_entry_smoke(spark):
    df = _entry().entry(spark)
    assert df.count() > 0
    assert "total_revenue" in df.columns
