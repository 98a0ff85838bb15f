"""Every registered query against its SQL on the smallest tables."""

import glob
import os

import duckdb
import pandas as pd
import pytest

from emberline.plans import catalogue

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for p in glob.glob(f"{FOLDER}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    return con


def frame(df: pd.DataFrame) -> pd.DataFrame:
    for c in df.columns:
        if str(df[c].dtype).startswith("datetime") or df[c].dtype == object and len(df) and hasattr(df[c].iloc[0], "isoformat"):
            df[c] = pd.to_datetime(df[c]).astype("datetime64[us]")
    df = df[sorted(df.columns)]
    return df.sort_values(list(df.columns), ignore_index=True)


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query(spark, db, name):
    got = frame(catalogue.QUERIES[name](spark, FOLDER).toPandas())
    assert len(got) > 0
    if name not in catalogue.ORACLES:
        assert name in ("perimeter_loss", "new_perimeter_loss")
        return
    want = frame(db.execute(catalogue.ORACLES[name]).df())
    pd.testing.assert_frame_equal(got, want, check_dtype=False, check_exact=True)


def test_entry_and_names():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(catalogue.QUERIES) <= set(entry.queries())
