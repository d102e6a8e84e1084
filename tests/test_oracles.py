"""Every core query against its SQL on the smallest tables."""

import glob
import os

import duckdb
import pytest

from inkfall.plans import registry

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    c = duckdb.connect()
    for f in glob.glob(f"{FOLDER}/*.parquet"):
        c.sql(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    return c


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_same_rows(spark, db, tmp_path, name):
    df = registry.queries()[name](spark, FOLDER)
    df.write.parquet(f"{tmp_path}/out")
    cols = ",".join(f'"{c}"' for c in df.columns)
    db.sql(f"create or replace table o as select {cols} from ({registry.oracle_sql()[name]})")
    db.sql(f"create or replace table m as select {cols} from '{tmp_path}/out/*.parquet'")
    assert db.sql("select (select count(*) from (from o except all from m)), (select count(*) from (from m except all from o))").fetchall() == [(0, 0)]


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - set(registry.oracle_sql())))
def test_runs(spark, name):
    assert registry.queries()[name](spark, FOLDER).count() > 0
