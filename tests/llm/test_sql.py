"""Registered queries of the subpackage against their DuckDB SQL at sf0.001."""

import duckdb
import pytest

from covlens.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "pages", "labels", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = QUERIES[name](spark, SF)
    res = con.sql(ORACLE[name])
    order = sorted(df.columns)
    assert order == sorted(res.columns)
    rows = sorted(tuple(repr(r[c]) for c in order) for r in df.collect())
    assert rows == sorted(tuple(repr(r[res.columns.index(c)]) for c in order) for r in res.fetchall())


def test_native_operators_run_no_python(spark):
    for name in ("op2_feistel_pseudonyms", "op8_rule_ledger"):
        plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert not any(n in plan for n in ("Python", "Pandas", "Arrow", "Exchange"))
