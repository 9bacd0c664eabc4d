"""Every registered query with SQL against DuckDB on the smallest tables.

Model-dependent queries have no SQL and are only run for a row count in
test_entry.py; here each SQL twin must match rows, columns and values.
"""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))),
                                "scripts"))

from panelkit.plans import catalog  # noqa: E402

catalog.load_all()
SLOW = {"q10_stream_scoring"}


@pytest.fixture(scope="module")
def duck(sf_small):
    import duckdb

    from panelkit.sources.tables import TABLES, table_path
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(sf_small, t)}')")
    return con


@pytest.mark.parametrize("key", sorted(catalog.SQL))
def test_query_matches_duckdb(spark, sf_small, duck, key):
    from check_oracle import rows_of
    sdf = catalog.QUERIES[key](spark, sf_small).toPandas()
    ddf = duck.execute(catalog.SQL[key]).df()
    sc, sr = rows_of(sdf)
    dc, dr = rows_of(ddf)
    assert sc == dc
    assert len(sr) == len(dr)
    assert sr == dr
