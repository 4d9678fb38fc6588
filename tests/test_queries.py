"""Each registered read query with SQL against DuckDB, at the smallest size."""

import duckdb
import pytest

from strandloom import entries

SF = "/root/testdata/sf0.001"


def rows(columns, data):
    at = [columns.index(c) for c in sorted(columns)]
    return sorted(tuple(repr(float(r[i])) if isinstance(r[i], float) else repr(r[i]) for i in at) for r in data)


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in ("documents", "lineitem"):
        c.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


def test_every_query_has_sql():
    # programmes over sorted hits aren't SQL; tests/test_aligner.py holds them against brute force
    assert set(entries.QUERIES) - set(entries.ORACLE_SQL) == {"chains", "aligned_paf"} and set(entries.ORACLE_SQL) <= set(entries.QUERIES)


@pytest.mark.parametrize("name", sorted(entries.ORACLE_SQL))
def test_query(spark, duck, name):
    got = entries.QUERIES[name](spark, SF)
    want = duck.sql(entries.ORACLE_SQL[name])
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got.columns, got.collect()) == rows(list(want.columns), want.fetchall())


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() == 8
