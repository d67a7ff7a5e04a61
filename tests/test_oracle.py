"""Every registered query against its DuckDB oracle on the smallest tables."""

import os
import sys

import duckdb
import pytest

from conftest import ROOT, SF_SMALL

sys.path.insert(0, os.path.join(ROOT, "scripts"))

import __spark_entry__ as E  # noqa: E402
from check_oracle import canon  # noqa: E402
from strata.plans.standins import TABLES  # noqa: E402

from strata.plans.oracle import ORACLE  # noqa: E402
from strata.plans.queries import REGISTRY as QUERIES  # noqa: E402


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


DUCK_TYPE = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE",
             "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "date": "DATE"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    s_cols, s_rows = canon(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(ORACLE[name])
    o_cols, o_rows = canon([d[0] for d in cur.description], cur.fetchall())
    assert s_cols == o_cols
    assert s_rows == o_rows
    rel = con.sql(ORACLE[name])
    duck = dict(zip(rel.columns, [str(t) for t in rel.types]))
    assert {f.name: DUCK_TYPE.get(f.dataType.simpleString()) for f in df.schema.fields} == duck


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "customer_sk" in df.columns
