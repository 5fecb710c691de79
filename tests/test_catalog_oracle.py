"""Every catalog query against its DuckDB oracle on sf0.001 (same tables)."""
import os

import duckdb
import pytest

import __spark_entry__ as E
from stride.plans import catalog
from tests.conftest import SF0001
from tools.oracle_check import TABLES, canon

ROWS_ONLY: set[str] = set()
NAMES = sorted(set(catalog.QUERIES) - ROWS_ONLY)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF0001}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_every_query_has_oracle():
    missing = set(catalog.QUERIES) - set(catalog.ORACLE)
    assert missing == ROWS_ONLY, missing


def test_entry_schema(spark):
    df = E.entry(spark)
    assert df.columns == ["bu", "nb_employees", "nb_eligible_prime", "nb_eligible_wellbeing",
                          "total_prime_cost_eur", "total_wellbeing_days"]
    got = {r.bu: (r.nb_employees, r.nb_eligible_prime, r.nb_eligible_wellbeing,
                  str(r.total_prime_cost_eur), r.total_wellbeing_days) for r in df.collect()}
    assert got["AUTOMOBILE"] == (23, 2, 3, "5923.09", 15)  # 2 x 5 % of the 10,000 every salary starts from
    assert got["FURNITURE"] == (40, 10, 9, "30736.79", 45)


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "boolean": "BOOLEAN",
                 "date": "DATE", "timestamp_ntz": "TIMESTAMP", "double": "DOUBLE"}

# Operators a plan must never contain: pair-producing joins and per-row Python.
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython")


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF0001)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [op for op in FORBIDDEN if op in plan], plan
    s_cols, s_rows = canon(df.columns, [tuple(r) for r in df.collect()])
    rel = con.sql(E.oracle_sql()[name])
    duck_types = dict(zip(rel.columns, [str(t).replace(" ", "") for t in rel.types]))
    for col, t in df.dtypes:  # same column types on both sides
        assert SPARK_TO_DUCK.get(t, t.upper().replace(" ", "")) == duck_types.get(col), (col, t, duck_types)
    res = con.execute(E.oracle_sql()[name])
    d_cols, d_rows = canon([d[0] for d in res.description], res.fetchall())
    assert s_cols == d_cols
    assert len(s_rows) == len(d_rows)
    assert s_rows == d_rows


def test_flagship_plan_prunes_and_pushes(spark):
    plan = E.entry(spark)._jdf.queryExecution().executedPlan().toString()
    # the trailing-window filter reaches the orders scan, which reads two columns
    assert "GreaterThanOrEqual(o_orderdate" in plan
    assert "ReadSchema: struct<o_custkey:bigint,o_orderdate:timestamp_ntz>" in plan
    # the customer scan reads only what the KPI needs (no name, no address)
    assert "c_name" not in plan
