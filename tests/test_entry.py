"""The registered queries against DuckDB on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(value):
    if isinstance(value, float):
        return round(value, 6)
    if isinstance(value, (list, tuple)):
        return tuple(map(plain, value))
    return value.replace(tzinfo=None) if getattr(value, "tzinfo", None) else value


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def market_names():
    from tidemark.plans import ORACLES, QUERIES

    return [n for n in QUERIES if n in ORACLES]


@pytest.mark.parametrize("name", market_names())
def test_query_equals_sql(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    result = duck.execute(entry.oracle_sql()[name])
    names = [c[0] for c in result.description]
    assert sorted(names) == columns
    want = sorted((tuple(plain(r[names.index(c)]) for c in columns) for r in result.fetchall()), key=repr)
    assert got == want


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
