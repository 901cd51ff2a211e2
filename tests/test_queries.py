"""Registered queries against their SQL on the smallest tables. PRESSROOM_ALL=1 runs them all."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as registry
from pressroom.plans.oracles import all_oracles
from pressroom.plans.queries import all_queries

SF = "/root/testdata/sf0.001"
QUICK = [
    "text_normalize", "spam_score", "quality_report", "feed_pages_until_empty", "metadata_rows",
    "high_water_mark", "status_advance", "upsert_metrics", "url_left_join", "extract_text",
    "extract_text_unrepeated", "dense_centrality", "tfidf_centrality", "summary", "parse_responses",
    "price_refresh",
]
NAMES = sorted(all_queries()) if os.environ.get("PRESSROOM_ALL") else QUICK


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    return con


def values(rows, columns):
    def text(value):
        return f"{value:.6f}" if isinstance(value, float) else str(value)

    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(text(row[i]) for i in order) for row in rows)


def test_every_query_has_sql():
    """Those of the news library; the others say in their folder what stands for SQL."""
    assert set(all_queries()) == set(all_oracles())
    assert set(registry.oracle_sql()) <= set(registry.queries())


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
@pytest.mark.parametrize("name", NAMES)
def test_query_matches_sql(spark, duck, name):
    result = registry.queries()[name](spark, SF)
    cursor = duck.execute(registry.oracle_sql()[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(result.columns)
    assert values([tuple(r) for r in result.collect()], result.columns) == values(cursor.fetchall(), columns)
