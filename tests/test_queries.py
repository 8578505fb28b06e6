"""Every registered query against its SQL in DuckDB, over whole tables."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from metframe.operators import refine, seasonal
from tests.compare import of_spark, table

SF_DIR = "/root/testdata/sf0.001"
NAMES = sorted(entry.queries())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for file in Path(SF_DIR).glob("*.parquet"):
        con.execute(f"create view {file.stem} as from '{file}'")
    yield con
    con.close()


def test_every_sql_has_its_query():
    assert set(entry.oracle_sql()) <= set(NAMES)


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, duck, name):
    got = of_spark(entry.queries()[name](spark, SF_DIR))
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert got[0]
        return
    cursor = duck.execute(sql)
    assert got == table([d[0] for d in cursor.description], cursor.fetchall())


@pytest.mark.parametrize("name", ["arima_css", "sarima_css", "sarima_models", "train_models"])
def test_fits_of_blocks(spark, duck, name, monkeypatch):
    """The same SQL with every series cut into blocks of 64 values."""
    monkeypatch.setattr(refine, "BLOCK", 64)
    monkeypatch.setattr(seasonal, "PACKED", 64)
    test_query(spark, duck, name)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
