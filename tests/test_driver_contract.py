"""The driver contract, and every registered query against its DuckDB oracle
on the smallest generated tables (brute force on a small fixture)."""

import datetime as dt
import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from catalogprep.plans.registry import ORACLE, QUERIES, load_all

load_all()

SMALL = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}")
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dt.datetime):
        return v.isoformat()
    return v


def _key(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["show_id", "released_countries", "released_languages"]
    assert df.count() >= 0


def test_oracle_keys_are_queries():
    assert set(ORACLE) == set(QUERIES)
    assert set(E.oracle_sql()) <= set(E.queries())
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql())


@pytest.fixture(scope="module")
def duck():
    if not os.path.isdir(SMALL):
        pytest.skip("generated tables not available")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SMALL)
    srows = [tuple(r) for r in df.collect()]
    cur = duck.execute(ORACLE[name])
    dcols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(dcols)
    assert _key(df.columns, srows) == _key(dcols, cur.fetchall())


def test_no_python_udf_in_any_plan(spark):
    for name, fn in QUERIES.items():
        plan = fn(spark, SMALL)._jdf.queryExecution().executedPlan().toString()
        for bad in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "CartesianProduct",
                    "BroadcastNestedLoopJoin"):
            assert bad not in plan, (name, bad)


SPARK_TO_DUCK = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
                 "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP", "float": "FLOAT"}


def test_result_types_match_oracle(spark, duck):
    for name, sql in ORACLE.items():
        df = QUERIES[name](spark, SMALL)
        rel = duck.sql(sql)
        duck_types = dict(zip(rel.columns, [str(t) for t in rel.types]))
        for f in df.schema.fields:
            s = f.dataType.simpleString()
            assert SPARK_TO_DUCK.get(s, s) == duck_types[f.name], (name, f.name, s, duck_types[f.name])
