"""Registered queries against their SQL; LLM_SF names other tables than the smallest."""

import glob
import os

import duckdb
import pytest

from pressroom.llm.queries import llm_oracles, llm_queries

SF = os.environ.get("LLM_SF", "/root/testdata/sf0.001")


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
@pytest.mark.parametrize("name", sorted(llm_oracles()))
def test_query_equals_sql(session, name):
    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    cursor = con.execute(llm_oracles()[name])
    columns = [d[0] for d in cursor.description]
    result = llm_queries()[name](session, SF)
    assert sorted(result.columns) == sorted(columns)
    assert sorted(map(str, cursor.fetchall())) == sorted(str(tuple(r)) for r in result.select(columns).collect())
