"""Every query against its SQL on an independent engine."""

import decimal

import duckdb
import pytest

import __spark_entry__ as entry_points
from casewright.plans import queries as registry
from casewright.plans.adapter import BASE_TABLES

SF_DIR = "/root/testdata/sf0.001"
QUERIES, ORACLE = entry_points.queries(), entry_points.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in BASE_TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return con


def canonical(value):
    if isinstance(value, bool) or value is None or isinstance(value, str):
        return repr(value)
    if isinstance(value, (int, float, decimal.Decimal)):
        return repr(round(float(value), 9))
    return repr(value)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    columns = sorted(df.columns)
    result = duck.execute(ORACLE[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    expected = sorted(tuple(canonical(r[i]) for i in at) for r in result.fetchall())
    actual = sorted(tuple(canonical(r[c]) for c in columns) for r in df.collect())
    assert actual == expected


def test_every_query_has_sql(spark):
    assert set(registry.registered()) <= set(ORACLE)
    text = [r["line"] for r in QUERIES["report_lines"](spark, SF_DIR).orderBy("line_no").collect()]
    assert text[0] == "# Processing Summary" and any(line.startswith("| DEMO | 1,500 | 1,500 | 100.0% |") for line in text)


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0
