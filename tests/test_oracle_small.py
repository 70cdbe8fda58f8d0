"""Every registered query against its DuckDB oracle on the smallest scale (sf0.001).

The round driver does the same at sf0.01; this keeps the check in the local test loop."""

import duckdb
import pytest

import __spark_entry__ as E
from tessera.plans import load_all
from tools.check import TABLES, digest

SF = "/root/testdata/sf0.001"
LIBRARY, LIBRARY_SQL = load_all()
QUERIES = {k: v for k, v in E.queries().items() if k in LIBRARY}
ORACLE = LIBRARY_SQL


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_matches_oracle(spark, con, key):
    df = QUERIES[key](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    cur = con.execute(ORACLE[key])
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert digest(df.columns, rows)[0] == digest(ocols, orows)[0]


@pytest.mark.parametrize("key", sorted(set(QUERIES) - set(ORACLE)))
def test_rows_only_keys_run(spark, key):
    assert QUERIES[key](spark, SF).count() > 0
