"""Every registered query against its SQL, value by value."""

import math
from pathlib import Path

import pytest

import __spark_entry__ as entry_module
from catalog.registry import ORACLE, QUERIES

SF = Path("/root/testdata/sf0.01")
TABLES = [p.stem for p in sorted(SF.glob("*.parquet"))]

pytestmark = pytest.mark.skipif(not TABLES, reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return "null" if value is None else str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in rows)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert QUERIES.items() <= entry_module.queries().items()
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    df = entry_module.queries()[name](spark, str(SF))
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    result = duck.execute(entry_module.oracle_sql()[name])
    columns = [d[0] for d in result.description]
    want = rows_of(columns, result.fetchall())
    assert sorted(df.columns) == sorted(columns)
    assert len(got) == len(want) > 0
    different = [(g, w) for g, w in zip(got, want) if g != w]
    assert not different, different[:3]
