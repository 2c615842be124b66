"""Spark query vs DuckDB oracle at sf0.001 for every query with an oracle."""
import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from fraudlake.sources.tables import TABLES
from paths import SF_SMALL

import sys, os  # noqa: E401
sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "scripts"))
from oracle_check import cell, spark_type  # noqa: E402


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_entry_runs(spark):
    df = entry(spark)
    assert df.limit(5).count() == 5 and "acct_opened_months" in df.columns


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    sdf = queries()[name](spark, SF_SMALL)
    s_types = {f.name: spark_type(f.dataType.simpleString()) for f in sdf.schema.fields}
    rel = con.sql(oracle_sql()[name])
    d_types = dict(zip(rel.columns, [str(t) for t in rel.types]))
    assert s_types == d_types
    order = sorted(s_types)
    s_rows = sorted(tuple(cell(r[c]) for c in order) for r in sdf.collect())
    idx = {c: i for i, c in enumerate(rel.columns)}
    d_rows = sorted(tuple(cell(r[idx[c]]) for c in order) for r in rel.fetchall())
    assert s_rows == d_rows
