"""Every registered query of the library against its SQL on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__
from marketloom.plans import registry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def canonical(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])

    def cell(x):
        if isinstance(x, float):
            return f"{x + 0.0:.5g}"
        return str(x)

    return sorted(tuple(cell(r[i]) for i in order) for r in rows)


def test_contract():
    found, sql = __spark_entry__.queries(), __spark_entry__.oracle_sql()
    assert set(registry.QUERIES) <= set(found) and set(sql) <= set(found)


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables are not here")
@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query_equals_sql(spark, duck, name):
    df = registry.QUERIES[name](spark, SF)
    got = canonical(df.collect(), df.columns)
    relation = duck.sql(registry.ORACLES[name])
    assert sorted(df.columns) == sorted(relation.columns)
    assert got == canonical(relation.fetchall(), relation.columns)


def test_flagship(spark):
    assert __spark_entry__.entry(spark).count() > 0
