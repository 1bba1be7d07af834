"""Every registered query with an oracle, Spark vs DuckDB, at sf0.001.

Same comparison as the driver's gate: row count, column names and an
order-insensitive hash of the values (floats to 9 decimals).
"""

from __future__ import annotations

import duckdb
import pytest

from conftest import SF001
from tools.check_oracle import TABLES, _digest


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    yield con
    con.close()


def _names():
    from marketlake.plans.catalog import ORACLE
    return sorted(ORACLE)


@pytest.mark.parametrize("name", _names())
def test_query_matches_oracle(spark, duck, name):
    from marketlake.plans.catalog import ORACLE, QUERIES
    df = QUERIES[name](spark, SF001)
    cols = df.columns
    rows = [tuple(r) for r in df.collect()]
    res = duck.execute(ORACLE[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(cols) == sorted(ocols)
    assert len(rows) == len(orows)
    assert _digest(rows, cols)[0] == _digest(orows, ocols)[0]
