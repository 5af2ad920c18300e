"""Every query with an oracle must match DuckDB on the same parquet tables (sf0.001)."""

import pytest

from tests.conftest import SF_SMALL
from tools.oracle_check import TABLES, digest

import __spark_entry__ as entry
from contrail.plans.registry import QUERIES

ORACLE = entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_matches_duckdb(spark, duck, key):
    df = entry.queries()[key](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    cur = duck.execute(ORACLE[key])
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert digest(df.columns, rows)[0] == digest(ocols, orows)[0]


def test_every_query_has_stable_schema(spark):
    # rows-only keys: run them and check the schema is what the registry promises
    for key in sorted(set(QUERIES) - set(ORACLE)):  # of the library itself
        first, again = (entry.queries()[key](spark, SF_SMALL) for _ in range(2))
        assert first.schema == again.schema
        rows = first.collect()
        assert rows and rows == again.collect()


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert 0 < len(rows) <= 5
    assert df.columns == ["tailnum", "flights_count", "departure_delay_minutes", "departure_delay_count"]
