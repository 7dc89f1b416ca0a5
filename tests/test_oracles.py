"""Every query with SQL against DuckDB over the whole smallest tables."""

import glob
import os

import duckdb
import pytest

from doclathe.plans.queries import ORACLES, QUERIES


def plain(v):
    if hasattr(v, "tolist") and not isinstance(v, (str, bytes)):
        v = v.tolist()
    if v is None or v != v:
        return None
    if isinstance(v, float):
        return int(v) if v == int(v) else round(v, 6)
    if isinstance(v, (list, tuple)):
        return tuple(map(plain, v))
    return v


def table(df):
    df = df[sorted(df.columns)]
    return sorted((tuple(map(plain, r)) for r in df.astype(object).where(df.notna(), None).itertuples(index=False)), key=repr)


@pytest.fixture(scope="module")
def duck(data):
    con = duckdb.connect()
    for p in glob.glob(f"{data}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    return con


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql_agrees(spark, duck, data, name):
    ours, theirs = QUERIES[name](spark, data).toPandas(), duck.execute(ORACLES[name]).fetchdf()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert table(ours) == table(theirs)


def test_every_oracle_has_a_query():
    assert ORACLES.keys() <= QUERIES.keys()
