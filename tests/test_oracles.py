"""Every registered query against its DuckDB oracle (sf0.001): same column
names, same column types, same rows (order-insensitive, exact values)."""

import math
import os
import sys
from decimal import Decimal

import duckdb
import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

import __spark_entry__ as E  # noqa: E402

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()
SPARK_TO_DUCK = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE",
                 "date": "DATE", "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    yield con
    con.close()


def norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        return (1, "nan") if math.isnan(v) else (2, repr(v))
    if isinstance(v, Decimal):
        return (2, str(v))
    if hasattr(v, "isoformat"):
        return (3, v.isoformat())
    return (4, str(v))


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF)
    cur = duck.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    dtypes = {d[0]: str(d[1]) for d in cur.description}
    drows = cur.fetchall()
    stypes = {c: SPARK_TO_DUCK.get(t, t.upper()) for c, t in df.dtypes}
    assert sorted(df.columns) == sorted(dcols)
    assert stypes == dtypes
    order = sorted(range(len(dcols)), key=lambda i: dcols[i])
    spark_rows = sorted(tuple(norm(r[c]) for c in sorted(df.columns)) for r in df.collect())
    duck_rows = sorted(tuple(norm(r[i]) for i in order) for r in drows)
    assert spark_rows == duck_rows
