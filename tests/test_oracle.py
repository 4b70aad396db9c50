"""Every query against DuckDB on the smallest driver tables, where both are there."""

import math
from pathlib import Path

import duckdb
import pytest

from quarry.plans import landed  # noqa: F401  (adds its queries)
from quarry.plans import queries as plans

SF = Path("/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not SF.exists(), reason="needs the driver's tables")


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def rows(columns, found):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    value = lambda x: "null" if x is None or (isinstance(x, float) and math.isnan(x)) else f"{x:.9g}" if isinstance(x, float) else str(x)
    return [columns[i] for i in order], sorted(tuple(value(r[i]) for i in order) for r in found)


@pytest.mark.parametrize("name", sorted(plans.ORACLE_SQL))
def test_same_as_sql(spark, duck, name):
    got = plans.QUERIES[name](spark, str(SF))
    want = duck.execute(plans.ORACLE_SQL[name])
    assert rows(got.columns, got.collect()) == rows([d[0] for d in want.description], want.fetchall())


def test_all_queries_have_sql():
    assert set(plans.QUERIES) == set(plans.ORACLE_SQL)


def test_all_queries_have_rows(duck):
    for name, sql in plans.ORACLE_SQL.items():
        assert duck.execute(f"SELECT count(*) FROM ({sql})").fetchone()[0] > 0, name
