"""The near-duplicate stage on null ids, repeated rows and ids with two texts."""

from collections import Counter

import pytest
from llm_helpers import docs_of, no_docs, shingle_set  # noqa: F401
from pyspark.sql import functions as F

A = " ".join(f"a{i}" for i in range(60))
NEAR_A = A + " tail"
B, C, D = (" ".join(f"{x}{i}" for i in range(60)) for x in "bcd")


@pytest.fixture(scope="module")
def rows():
    return [(1, A), (1, A), (1, A), (2, NEAR_A), (2, B), (None, NEAR_A), (None, C), (None, C), (None, C + " z"),
            (3, D), (None, D), (None, None), (None, None), (4, ""), (4, ""), (5, "x"), (None, "x")]


def test_one_row_of_each_component(spark, docs_of, no_docs, rows):  # noqa: F811
    import corpus_pipeline as P
    docs = docs_of(rows).withColumn("m", F.create_map(F.lit("k"), F.col("doc_id"))).withColumn("row", F.lit(1))
    got = P.near_dedup(spark, docs, "")
    assert got.columns == docs.columns
    kept = Counter((r.doc_id, r.text) for r in got.collect())
    c = [t for i, t in kept if i is None and t and t.startswith("c0 ")]
    assert len(c) == 1
    assert kept == Counter([(1, A), (2, B), (None, c[0]), (3, D), (None, None), (None, None), (4, ""), (4, ""), (5, "x")])
    again = P.near_dedup(spark, docs.repartition(7), "")
    assert Counter((r.doc_id, r.text) for r in again.collect()) == kept
    sets = [shingle_set(t) for _, t in kept if shingle_set(t)]
    assert not any(100 * len(x & y) >= 75 * len(x | y) for n, x in enumerate(sets) for y in sets[:n])
    assert P.near_dedup(spark, no_docs, "").collect() == []
