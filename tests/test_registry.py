"""Every registered query against its SQL, on the smallest tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from cityobs.registry.oracles import ORACLES
from cityobs.registry.queries import QUERIES
from conftest import SMALL, plan

TYPES = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "date": "DATE",
    "boolean": "BOOLEAN",
}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in os.listdir(SMALL):
        con.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{SMALL}/{name}'")
    return con


def canonical(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(r[i] for i in order) for r in rows), key=repr)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, SMALL)
    cursor = duck.execute(ORACLES[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(df.columns) == sorted(columns)
    sql_types = {d[0]: str(d[1]) for d in cursor.description}
    for field in df.schema:
        assert TYPES[field.dataType.simpleString()] == sql_types[field.name], field.name
    text = plan(df)
    for operator in ("Python", "MapPartitions", "Cartesian", "NestedLoop", "ObjectHash"):
        assert operator not in text
    got, wanted = canonical(df.collect(), df.columns), canonical(cursor.fetchall(), columns)
    assert got == wanted
    assert not any(isinstance(v, float) and math.isnan(v) for r in got for v in r)


def test_entry_gives_rows(spark):
    assert entry.entry(spark).count() > 0
