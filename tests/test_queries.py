"""Every query against its SQL, column by column."""

import math
from collections import Counter

import duckdb
import pytest
from docledger.plans import registry

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def value(x):
    if isinstance(x, float):
        return None if math.isnan(x) else round(x, 9)
    return str(x) if type(x).__name__ in ("date", "datetime", "Decimal") else x


@pytest.fixture(scope="session")
def con(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def test_every_query_has_sql():
    assert set(registry.queries()) == set(registry.oracle_sql())


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, con, sf_dir, name):
    got = registry.queries()[name](spark, sf_dir)
    cursor = con.sql(registry.oracle_sql()[name])
    names = sorted(got.columns)
    assert names == sorted(cursor.columns)
    want = Counter(tuple(value(r[cursor.columns.index(n)]) for n in names) for r in cursor.fetchall())
    mine = Counter(tuple(value(r[n]) for n in names) for r in got.collect())
    assert sum(mine.values()) > 0 and mine == want
