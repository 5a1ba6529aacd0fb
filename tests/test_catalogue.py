"""Every query against its SQL, on the smallest tables."""

import decimal
import os

import duckdb
import pytest

from weftline.plans import queries as Q

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def engine(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        con.execute(
            f"create view {t} as select * from read_parquet('{path}{'/*.parquet' if os.path.isdir(path) else ''}')"
        )
    return con


def plain(value):
    return float(value) if isinstance(value, (decimal.Decimal, float)) else value


@pytest.mark.parametrize("name", sorted(Q.QUERIES))
def test_query(spark, sf_dir, engine, name):
    df = Q.QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=str)
    assert got
    if name in Q.ORACLE_SQL:
        found = engine.execute(Q.ORACLE_SQL[name])
        names = [x[0] for x in found.description]
        assert sorted(names) == columns
        assert got == sorted((tuple(plain(r[names.index(c)]) for c in columns) for r in found.fetchall()), key=str)


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
