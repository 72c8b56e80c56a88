"""Every registered relational query against DuckDB."""

import os

import duckdb
import pytest

from stillframe.plans import kernel_oracle, kernel_queries
from stillframe.plans.oracle import ORACLE as RELATIONAL
from stillframe.plans.queries import QUERIES as OPERATORS

ORACLE, QUERIES = {**RELATIONAL, **kernel_oracle.ORACLE}, {**OPERATORS, **kernel_queries.QUERIES}


def plain(v):
    if v is None or v != v:
        return "NULL"
    return repr(round(v, 6) + 0.0) if isinstance(v, float) else str(v)


def normal(columns, rows):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted(tuple(plain(row[i]) for i in order) for row in rows)


@pytest.fixture(scope="module")
def duck(tiny):
    con = duckdb.connect()
    con.sql("SET timezone = 'UTC'")
    for f in os.listdir(tiny):
        con.sql(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{tiny}/{f}'")
    return con


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_like_duckdb(spark, tiny, duck, name):
    got = QUERIES[name](spark, tiny)
    want = duck.execute(ORACLE[name])
    columns = [c[0] for c in want.description]
    assert sorted(got.columns) == sorted(columns)
    assert normal(got.columns, got.collect()) == normal(columns, want.fetchall())


def test_all_change_classes_occur(spark, small):
    from stillframe.operators import diff
    from stillframe.plans import relations as r

    kinds = {x.change for x in diff.classify(r.spark(spark, small, r.BEFORE), r.spark(spark, small, r.AFTER)).select("change").distinct().collect()}
    assert kinds == {"improved", "regressed", "unchanged_ok", "unchanged_bad", "new", "removed"}
