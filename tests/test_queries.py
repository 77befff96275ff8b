"""Registered queries against their SQL on the smallest tables."""

import glob
import math
import os
from collections import Counter

import duckdb
import pytest

from glossaflow import catalog, catalog_files, catalog_pages, catalog_runs  # noqa: F401  (registers its queries)


@pytest.fixture(scope="module")
def db(sf_dir):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"create view {os.path.basename(path)[:-8]} as select * from read_parquet('{path}')")
    return con


def tidy(value):
    if isinstance(value, float):
        return round(value, 9) if math.isfinite(value) else str(value)
    return value


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_query_equals_its_sql(spark, sf_dir, db, name):
    frame = catalog.QUERIES[name](spark, sf_dir)
    columns = sorted(frame.columns)
    ours = Counter(tuple(tidy(r[c]) for c in columns) for r in frame.collect())
    found = db.execute(catalog.ORACLES[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == columns
    theirs = Counter(tuple(tidy(row[names.index(c)]) for c in columns) for row in found.fetchall())
    assert ours == theirs


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLES)))
def test_query_runs(spark, sf_dir, name):
    assert catalog.QUERIES[name](spark, sf_dir).columns


def test_entry_has_rows(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).limit(1).count() == 1


def test_a_dictionary_of_many_rows_is_not_gathered_by_its_name(spark, sf_dir):
    plan = catalog.QUERIES["conversion_run"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "LeftOuter" not in plan and "Exchange hashpartitioning(name" not in plan.split("LeftAnti")[0]
