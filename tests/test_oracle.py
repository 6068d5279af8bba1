"""Every catalogue query with an oracle: Spark result == DuckDB result on
the sf0.001 tables (row count, column names, multiset of rows)."""

import math

import pytest

import __spark_entry__ as E
from paths import SF_SMALL

ORACLE = E.oracle_sql()
QUERIES = E.queries()


def _norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "None"
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    return repr(v)


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


def test_every_query_has_a_plan():
    assert set(ORACLE) <= set(QUERIES)
    assert len(QUERIES) >= 100


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    srows = [tuple(r) for r in df.collect()]
    cur = duck.execute(ORACLE[name])
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert _canon(df.columns, srows) == _canon(dcols, drows)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() >= 0
    assert "winner" in df.columns
