"""Every query against its SQL in another engine, on the whole tables."""

from __future__ import annotations

import os

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
NAMES = sorted(oracle_sql())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for table in ("events", "supplier", "documents", "embeddings", "conversations"):
        con.execute(
            f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF_DIR}/{table}.parquet')"
        )
    yield con
    con.close()


def _rows(frame):
    frame = frame[sorted(frame.columns)].astype(object)
    frame = frame.where(frame.notna(), None)
    return sorted(map(tuple, frame.itertuples(index=False)), key=repr)


def test_every_query_has_an_oracle():
    without = {name for name in queries() if name not in oracle_sql()}
    assert all(name.startswith("op") or name == "pipeline" for name in without)
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert entry(spark).columns == ["run_id", "energy_wh"]


@pytest.mark.parametrize("name", NAMES)
def test_agrees(spark, duck, name):
    ours = queries()[name](spark, SF_DIR).toPandas()
    theirs = duck.execute(oracle_sql()[name]).fetchdf()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert len(ours) > 0
    assert _rows(ours) == _rows(theirs)
