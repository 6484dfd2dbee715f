"""Every catalogue query against its SQL in DuckDB, and its plan."""

import glob
import math
import os

import duckdb
import pytest

from tessera.plans import registry

SF = "/root/testdata/sf0.001"
TYPES = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "boolean": "BOOLEAN"}
#: Queries that join with a small dimension or a one-row total on purpose.
SMALL_SIDES = {"small_dimension_cross", "zero_filled_grid", "mask_status_grid", "status_counts", "filter_associations", "condition_report"}


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS FROM '{path}'")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6) + 0.0
    return value


def ordered(rows, columns):
    at = [columns.index(c) for c in sorted(columns)]
    return sorted((tuple(plain(r[i]) for i in at) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, oracle, name):
    df = registry.QUERIES[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    plan = df._jdf.queryExecution().executedPlan().toString()
    if name not in SMALL_SIDES:
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    if name not in registry.ORACLES:
        assert rows
        return
    cur = oracle.execute(registry.ORACLES[name])
    columns, types = [c[0] for c in cur.description], [str(c[1]) for c in cur.description]
    want = cur.fetchall()
    assert sorted(columns) == sorted(df.columns)
    assert ordered(rows, df.columns) == ordered(want, columns)
    kinds = dict(zip(columns, types))
    assert {c: TYPES[t] for c, t in df.dtypes if t in TYPES and kinds[c] != TYPES[t]} == {}


#: Orders as (item, customer, date): days without overlap, equal days, and what lacks a date or a customer.
GAPPY = """(1, 1, '1996-01-01'), (2, 1, '1996-02-01'), (3, 1, NULL), (4, 1, NULL), (5, 2, NULL), (6, NULL, '1997-01-01'), (7, NULL, '1997-02-01'),
  (8, NULL, NULL), (9, 3, '1997-01-01'), (10, 3, '1997-12-01'), (11, 3, NULL), (12, 3, '1997-12-01')"""


@pytest.mark.parametrize("name", ["interval_closed_merge", "interval_merge", "interval_union_length", "containment_join", "interval_gaps"])
def test_missing_dates_and_customers(spark, tmp_path, name):
    con = duckdb.connect()
    con.execute(f"CREATE TABLE orders AS SELECT i::BIGINT AS o_orderkey, c::BIGINT AS o_custkey, d::TIMESTAMP AS o_orderdate FROM (VALUES {GAPPY}) t(i, c, d)")
    con.execute("CREATE TABLE customer AS SELECT c::BIGINT AS c_custkey FROM (VALUES (1), (2), (3), (4), (NULL)) t(c)")
    for source in ("orders", "customer"):
        con.execute(f"COPY {source} TO '{tmp_path}/{source}.parquet'")
    df = registry.QUERIES[name](spark, str(tmp_path))
    cur = con.execute(registry.ORACLES[name])
    columns = [c[0] for c in cur.description]
    assert ordered(df.collect(), df.columns) == ordered(cur.fetchall(), columns)
