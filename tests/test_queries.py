"""Every catalog query against its SQL, on the smallest tables."""

import glob
import math
import os

import duckdb
import pytest

from tessaline import catalog

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, bool) or type(value).__name__ == "bool":
        return bool(value)
    if hasattr(value, "year"):
        return str(value)[:19]
    try:
        return round(float(value), 6) + 0.0
    except (TypeError, ValueError):
        return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    return sorted((tuple(plain(r[k]) for k in order) for r in rows), key=str)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_matches_sql(spark, duck, name):
    got = catalog.QUERIES[name](spark, FOLDER)
    want = duck.execute(catalog.ORACLE_SQL[name])
    columns = [c[0] for c in want.description]
    assert sorted(got.columns) == sorted(columns)
    assert rows_of(got.columns, got.collect()) == rows_of(columns, want.fetchall())


def test_entry_has_rows(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
