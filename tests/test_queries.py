"""Every query with SQL gives the rows that DuckDB gives."""

import glob
import os

import duckdb
import pytest
from tidelog.plans import catalogue, log_queries  # noqa: F401  the latter adds its queries


def plain(v):
    if isinstance(v, float):
        return round(v, 9)
    return str(v) if type(v).__name__ == "Decimal" else tuple(map(plain, v)) if isinstance(v, (list, tuple)) else v


@pytest.fixture(scope="module")
def duck(sf_dir):
    c = duckdb.connect()
    for p in glob.glob(f"{sf_dir}/*.parquet"):
        c.execute(f"create view {os.path.basename(p)[:-8]} as select * from '{p}'")
    return c


@pytest.mark.parametrize("name", list(catalogue.QUERIES))
def test_query(spark, sf_dir, duck, name):
    df = catalogue.QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    got = sorted((tuple(plain(v) for v in r) for r in df.select(*columns).collect()), key=repr)
    made = duck.execute(catalogue.ORACLES[name])
    at = [[d[0] for d in made.description].index(c) for c in columns]
    assert got == sorted((tuple(plain(r[k]) for k in at) for r in made.fetchall()), key=repr)


def test_entry(spark, sf_dir):
    assert catalogue.entry(spark, sf_dir).count() > 0
