"""Every catalogue query with SQL gives the same rows as DuckDB."""

from __future__ import annotations

import datetime
import decimal
import math
import os

import duckdb
import pytest

from pressmill.plans import catalogue
from pressmill.sources.session import ship

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


def plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, (int, float, decimal.Decimal)):
        return round(float(v), 5) + 0.0
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return v.isoformat() if isinstance(v, (datetime.date, datetime.datetime)) else v


def rows(names, data):
    order = sorted(range(len(names)), key=lambda k: names[k])
    return sorted((tuple(plain(r[k]) for k in order) for r in data), key=repr)


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{FOLDER}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(catalogue.ORACLE_SQL))
def test_same_rows_as_sql(spark, duck, name):
    ship(spark)
    got = catalogue.QUERIES[name](spark, FOLDER)
    want = duck.execute(catalogue.ORACLE_SQL[name])
    names = [c[0] for c in want.description]
    assert sorted(got.columns) == sorted(names)
    assert rows(got.columns, got.collect()) == rows(names, want.fetchall())


@pytest.mark.parametrize("name", sorted(set(catalogue.QUERIES) - set(catalogue.ORACLE_SQL)))
def test_others_run(spark, name):
    ship(spark)
    assert catalogue.QUERIES[name](spark, FOLDER).count() > 0


@pytest.mark.parametrize("name", sorted(set(catalogue.QUERIES) - {"cosine_matrix", "bold_extremes"}))
def test_no_cartesian_product(spark, name):
    plan = catalogue.QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan
