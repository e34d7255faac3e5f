"""Every registered query equals its DuckDB oracle (driver-style digest)."""

import duckdb
import pytest

import __spark_entry__ as se
from ingestflow.plans.catalog import QUERIES
from scripts.check_oracle import TABLES, digest
from tests.conftest import SF_SMALL

NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(se.queries())
    assert set(QUERIES) <= set(se.oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = se.queries()[name](spark, SF_SMALL)
    mine = digest(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(se.oracle_sql()[name])
    theirs = digest([d[0] for d in cur.description], cur.fetchall())
    assert mine[0] == theirs[0]
    assert mine[1] == theirs[1]
    assert mine[2] == theirs[2]


def test_entry_runs(spark):
    df = se.entry(spark)
    assert df.count() > 0
    assert "route" in df.columns


@pytest.mark.parametrize("name", ["await_two_rounds", "await_routes_skewed", "stage_routes_skewed",
                                  "load_history", "history_document", "result_payload"])
def test_query_is_deterministic(spark, name):
    runs = []
    for _ in range(2):
        df = se.queries()[name](spark, SF_SMALL)
        runs.append(digest(df.columns, [tuple(r) for r in df.collect()]))
    assert runs[0] == runs[1]
