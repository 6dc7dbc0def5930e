"""Every linkage query with SQL must give the rows that DuckDB gives."""

import duckdb
import pytest

from weftlink.plans import catalog

SF = "/root/testdata/sf0.001"


def _rows(frame):
    frame = frame[sorted(frame.columns)]
    clean = frame.astype(object).where(frame.notna(), None)
    return list(clean.columns), sorted(([round(v, 6) if isinstance(v, float) else v for v in r] for r in clean.itertuples(index=False, name=None)), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for table in "part documents embeddings".split():
        con.execute(f"create view {table} as select * from '{SF}/{table}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_query_equals_sql(spark, duck, name):
    assert _rows(catalog.QUERIES[name](spark, SF).toPandas()) == _rows(duck.execute(catalog.ORACLES[name]).df())


def test_nearest_records_runs(spark):
    assert catalog.QUERIES["nearest_records"](spark, SF).count() > 0
