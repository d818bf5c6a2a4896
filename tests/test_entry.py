"""Every registered query with SQL gives the rows that DuckDB gives."""

import duckdb
import pytest

import __spark_entry__ as entry
from tilescan.plans import catalog

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def rows(columns, records):
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    return sorted(tuple("" if r[k] is None else str(r[k] + 0.0 if isinstance(r[k], float) else r[k]) for k in order) for r in records)


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_oracle(spark, name):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    got, want = catalog.queries()[name](spark, DATA), c.sql(catalog.oracle_sql()[name])
    assert rows(got.columns, got.collect()) == rows(want.columns, want.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
