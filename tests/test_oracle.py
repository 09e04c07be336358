"""Every registered earth-observation query against DuckDB on the small tables."""

import os

import duckdb
import pytest

from skygrid import queries as sky
from skygrid.sources.views import TABLES

SF = "/root/testdata/sf0.001"
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "float": "FLOAT", "string": "VARCHAR", "boolean": "BOOLEAN", "date": "DATE"}

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="the driver's tables are not here")


@pytest.fixture(scope="module")
def db():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(sky.QUERIES))
def test_query(spark, db, name):
    df = sky.QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    rows = sorted(tuple(map(repr, r)) for r in df.select(*cols).collect())
    if name not in sky.SQL:
        assert rows
        return
    rel = db.sql("SELECT " + ", ".join(f'"{c}"' for c in cols) + f" FROM ({sky.SQL[name]}) q")
    assert [TYPES[t] for _, t in df.select(*cols).dtypes] == [str(t) for t in rel.types]
    assert rows == sorted(tuple(map(repr, r)) for r in rel.fetchall())
