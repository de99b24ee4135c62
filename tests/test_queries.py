"""Every registered query of the engine against its SQL on the smallest tables."""

from pathlib import Path

import duckdb
import pytest

from docweave.plans import catalog

DATA = Path("/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for file in DATA.glob("*.parquet"):
        con.sql(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def rows(columns, values):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    norm = lambda v: round(float(v), 6) if isinstance(v, float) else v
    return sorted((tuple(norm(r[i]) for i in order) for r in values), key=repr)


@pytest.mark.skipif(not DATA.exists(), reason="no test tables")
@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, duck, name):
    found = catalog.QUERIES[name](spark, str(DATA))
    values = [tuple(r) for r in found.collect()]
    if name in catalog.ORACLES:
        wanted = duck.sql(catalog.ORACLES[name])
        assert sorted(found.columns) == sorted(wanted.columns)
        assert rows(found.columns, values) == rows(wanted.columns, wanted.fetchall())
    else:
        assert values


def test_entry_without_the_optional_part(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() > 0
