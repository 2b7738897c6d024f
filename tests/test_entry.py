"""Every registered query against its SQL statement."""

import decimal
from datetime import date

import duckdb
import pytest

import __spark_entry__ as entry
from prodseq.fixtures.queries import queries as fixture_queries

SF_DIR = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()
REPORTS = fixture_queries()
SQL = {name: entry.oracle_sql()[name] for name in REPORTS}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    return con


def comparable(value):
    if value is None:
        return ""
    if isinstance(value, bool) or isinstance(value, (str, date)):
        return str(value)
    if isinstance(value, (int, float, decimal.Decimal)):
        return f"{float(value) + 0.0:.6f}"
    return str(value)


def rows_of(records, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(comparable(r[i]) for i in order) for r in records)


def test_every_query_has_sql():
    assert set(REPORTS) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, duck, name):
    df = entry.queries()[name](spark, SF_DIR)
    cursor = duck.execute(SQL[name])
    names = [d[0] for d in cursor.description]
    assert sorted(df.columns) == sorted(names)
    assert rows_of(df.collect(), df.columns) == rows_of(cursor.fetchall(), names)


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns[:3] == ["report_date", "Final Rank", "SKUCode"] and len(df.columns) == 42
    assert df.count() > 0
