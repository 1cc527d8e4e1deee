"""Every registered query against its SQL, on whole tables."""

import datetime
import decimal
import os

import duckdb
import pytest

import __spark_entry__ as entry
from tidemark.plans.bindings import SCHEMAS
from tidemark.plans.queries import CATALOG

FOLDER = os.environ.get("TIDEMARK_TEST_DATA", "/root/testdata/sf0.01")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not there")
TYPES = {
    "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}
QUERIES = entry.queries()
SQL = {name: sql for name, sql in entry.oracle_sql().items() if name in CATALOG}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in sorted(SCHEMAS):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, (float, decimal.Decimal)):
        return float(f"{float(value):.10g}")
    return value.isoformat() if isinstance(value, (datetime.date, datetime.datetime)) else value


def ordered(rows):
    return sorted(rows, key=lambda row: [(v is None, "" if v is None else v) for v in row])


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [step for step in ("CartesianProduct", "NestedLoop", "Python", "Pandas") if step in plan]
    names = sorted(df.columns)
    cursor = duck.execute(SQL[name])
    found = {d[0]: (i, str(d[1])) for i, d in enumerate(cursor.description)}
    assert sorted(found) == names
    kinds = {f.name: TYPES[f.dataType.simpleString()] for f in df.schema.fields}
    assert {n: found[n][1] for n in names} == kinds
    want = [tuple(plain(row[found[n][0]]) for n in names) for row in cursor.fetchall()]
    got = [tuple(map(plain, row)) for row in df.select(*names).collect()]
    assert ordered(got) == ordered(want)


def test_every_query_has_sql():
    assert set(CATALOG) == set(SQL)


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0
