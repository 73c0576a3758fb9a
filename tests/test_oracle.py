"""Every registered query against its DuckDB oracle on the smallest tables."""

import duckdb
import pytest

from conftest import SF_SMALL
from oracle_check import TABLES, compare
from telemetry_qc.plans.oracle import ORACLE_SQL
from telemetry_qc.plans.queries import QUERIES
from telemetry_qc.streaming.queries import STREAM_ORACLE_SQL, STREAM_QUERIES

ALL = {**QUERIES, **STREAM_QUERIES}
ORACLES = {**ORACLE_SQL, **STREAM_ORACLE_SQL}
NAMES = sorted(ALL)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(ORACLES) == set(ALL)


def test_entry_registers_them_all():
    import __spark_entry__ as E

    assert set(ALL) <= set(E.queries())
    assert set(ORACLES) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, con, name, ALL[name], ORACLES[name], SF_SMALL)
    assert r["cols_match"] and r["types_match"], r
    assert r["rows"] == r["oracle_rows"], r
    assert r["hash_match"], r
