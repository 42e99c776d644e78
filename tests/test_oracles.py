"""Every registered query against its DuckDB oracle on the smallest test scale."""

import datetime as dt
import decimal
import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry
from tallyframe.plans import catalog
from tallyframe.plans.catalog.portable import kinds
from tallyframe.plans.catalog.portable_spec import SPEC

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def _norm(v):
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return str(v)
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    return v


def _bag(tbl):
    names = sorted(tbl.column_names)
    cols = [tbl.column(n).to_pylist() for n in names]
    return Counter(tuple(_norm(c[i]) for c in cols) for i in range(tbl.num_rows))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"create view {t} as select * from read_parquet('{p}')")
    return c


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_query_matches_oracle(spark, con, name):
    """Typed results: exact Arrow types and values."""
    got = catalog.QUERIES[name](spark, SF).toArrow()
    want = con.sql(catalog.ORACLES[name]).to_arrow_table()
    assert sorted(got.column_names) == sorted(want.column_names)
    assert {f.name: str(f.type) for f in got.schema} == {f.name: str(f.type) for f in want.schema}
    assert got.num_rows == want.num_rows
    assert _bag(got) == _bag(want)


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_driver_form_matches_under_pandas(spark, con, name):
    """The driver-facing pair, compared the naive way: pandas dtypes and text."""
    got = entry.queries()[name](spark, SF).toPandas()
    want = con.sql(entry.oracle_sql()[name]).df()
    cols = sorted(got.columns)
    assert cols == sorted(want.columns)
    got, want = got[cols], want[cols]
    assert [str(t) for t in got.dtypes] == [str(t) for t in want.dtypes]
    assert sorted(map(tuple, got.astype(str).values.tolist())) == sorted(map(tuple, want.astype(str).values.tolist()))


def test_portable_spec_is_current(spark):
    assert set(SPEC) == set(catalog.QUERIES)
    for name, fn in catalog.QUERIES.items():
        assert kinds(fn(spark, SF).schema) == SPEC[name], name
