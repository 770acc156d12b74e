"""Every registered query against its SQL, value by value."""

import os

import pytest

import __spark_entry__ as entry_points
from basketry.plans import oracle
from basketry.plans.adapters import TABLES
from basketry.plans.registry import QUERIES

ORACLE = oracle.build()


@pytest.fixture(scope="module")
def duck(sf_dir):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{os.path.join(sf_dir, t)}.parquet'")
    return con


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(repr(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    result = canonical(df.columns, df.collect())
    cursor = duck.execute(ORACLE[name])
    columns = [c[0] for c in cursor.description]
    assert result == canonical(columns, cursor.fetchall())
    assert result[1], "no rows"


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


def test_entry(spark):
    assert entry_points.entry(spark).columns == ["user_id", "rank", "product_id", "score"]
