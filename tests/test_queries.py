"""Driver contract: ``entry`` runs; every registered query matches its DuckDB oracle on the smallest tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "scripts"))

import __spark_entry__ as E  # noqa: E402
from compare import rows_of  # noqa: E402
from conftest import SF_SMALL  # noqa: E402

from quire.session import TABLES  # noqa: E402


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    yield con
    con.close()


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["doc_id", "n_pii", "redacted_text"]
    assert df.count() > 0


def test_every_query_has_unique_columns():
    for name, fn in E.queries().items():
        assert callable(fn), name
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    a, ac = rows_of(df.columns, [tuple(r) for r in df.collect()])
    rel = duck.execute(E.oracle_sql()[name])
    b, bc = rows_of([d[0] for d in rel.description], rel.fetchall())
    assert ac == bc
    assert a == b
