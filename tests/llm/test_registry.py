"""What is registered, and the queries that have SQL against it on the smallest tables."""

import glob
import os

import duckdb
import pytest

from emberline.llm import registry

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for p in glob.glob(f"{FOLDER}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    return con


def test_names_and_kinds():
    assert len(registry.QUERIES) == 13 and all(callable(q) for q in registry.QUERIES.values())
    assert set(registry.ORACLES) <= set(registry.QUERIES) and all(isinstance(s, str) for s in registry.ORACLES.values())


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query(spark, db, name):
    got = registry.QUERIES[name](spark, FOLDER)
    columns = sorted(got.columns)
    want = db.execute(f"SELECT {', '.join(columns)} FROM ({registry.ORACLES[name]})").fetchall()
    rows = [tuple(r) for r in got.select(*columns).collect()]
    assert rows and sorted(rows, key=repr) == sorted(want, key=repr)
