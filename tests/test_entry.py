"""Driver contract: entry, queries and oracles line up; a smoke run on sf0.001."""

import os

import pytest
from conftest import SF_SMALL

import __spark_entry__ as E

ROWS_ONLY: set = set()


def test_every_query_has_an_oracle():
    from pagetables.plans.catalog import QUERIES
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q) and set(QUERIES) <= set(q)
    assert set(QUERIES) - set(o) == ROWS_ONLY


@pytest.mark.skipif(not os.path.exists(SF_SMALL), reason="no test data")
def test_entry_runs(spark):
    df = E.entry(spark)
    got = {r.category: r.n_stories for r in df.collect()}
    assert got and all(v > 0 for v in got.values())


@pytest.mark.skipif(not os.path.exists(SF_SMALL), reason="no test data")
@pytest.mark.parametrize("name", ["extract_anchors", "follow_next", "story_table_by_label",
                                  "semantic_chunks", "story_table_from_answers"])
def test_queries_smoke(spark, name):
    df = E.queries()[name](spark, SF_SMALL)
    assert df.count() >= 0 and len(df.columns) > 0
