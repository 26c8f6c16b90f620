"""Every registered query that has an SQL twin gives its rows."""

import math
import os

import duckdb
import pytest

from noisetrack.plans import registry

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def comparable(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    number = lambda v: None if isinstance(v, float) and math.isnan(v) else round(float(v), 5) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v) if v is not None else None
    return sorted([tuple(number(r[i]) for i in order) for r in rows], key=repr)


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_sql(spark, db, name):
    df = registry.queries()[name](spark, SF)
    got = db.execute(registry.oracle_sql()[name])
    names = [d[0] for d in got.description]
    assert sorted(df.columns) == sorted(names)
    assert comparable(df.collect(), df.columns) == comparable(got.fetchall(), names)


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - set(registry.oracle_sql())))
def test_other_queries_run(spark, name):
    assert registry.queries()[name](spark, SF).count() > 0


def test_entry(spark):
    assert registry.entry(spark, SF).count() > 0
