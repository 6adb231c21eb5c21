"""Every registered query of the library against its SQL in DuckDB."""

import math

import duckdb
import pytest

from stratakit.plans.queries import ORACLE_SQL, QUERIES
from tests.conftest import SF_DIR

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")
TYPES = {"bigint": {"BIGINT"}, "int": {"INTEGER"}, "string": {"VARCHAR"}, "double": {"DOUBLE"}, "boolean": {"BOOLEAN"}, "timestamp_ntz": {"TIMESTAMP", "TIMESTAMP_NS"}}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF_DIR}/{t}.parquet'")
    return con


def plain(v):
    return ("nan" if math.isnan(v) else round(v, 6)) if isinstance(v, float) else v


def ordered(rows):
    return sorted(rows, key=lambda r: tuple((v is None, str(v)) for v in r))


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLE_SQL.keys()


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_its_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    columns = sorted(df.columns)
    got = ordered(tuple(plain(r[c]) for c in columns) for r in df.collect())
    relation = duck.sql(ORACLE_SQL[name])
    assert sorted(relation.columns) == columns
    kinds, at = dict(df.dtypes), [relation.columns.index(c) for c in columns]
    for c, kind in zip(relation.columns, relation.dtypes):
        assert str(kind) in TYPES[kinds[c]], c
    assert got == ordered(tuple(plain(r[i]) for i in at) for r in relation.fetchall())
