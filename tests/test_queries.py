"""Every query runs; every query with SQL gives what the second engine gives."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
from pairlab.oracles import ORACLES

SF = os.environ.get("PAIRLAB_TEST_DATA", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def canonical(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    value = lambda v: round(float(v), 6) if isinstance(v, float) else v
    return sorted((tuple(value(r[i]) for i in order) for r in rows), key=str)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    assert rows
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return
    result = duck.execute(sql)
    columns = [c[0] for c in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert canonical(rows, df.columns) == canonical(result.fetchall(), columns)


def test_integers_are_bigint_on_both_sides(spark, duck):
    for name, sql in ORACLES.items():
        kinds = {c[0]: str(c[1]) for c in duck.execute(f"DESCRIBE {sql}").fetchall()}
        ours = dict(entry.queries()[name](spark, SF).dtypes)
        wanted = {"bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE"}
        assert {c: wanted[t] for c, t in ours.items()} == kinds, name


def test_entry(spark):
    assert entry.entry(spark).columns == ["split", "num_rows"]
