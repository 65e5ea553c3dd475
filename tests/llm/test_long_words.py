"""A word whose lattice marginal is below the smallest double still costs all of it."""

import math

import pytest
from llm_helpers import docs_of  # noqa: F401
from pyspark.sql import functions as F

from pagetables.llm import lattice


@pytest.mark.parametrize("hot", [1, 1 << 18])       # by the shuffle, and sent to every task
def test_long_held_out_words(docs_of, monkeypatch, hot):  # noqa: F811
    monkeypatch.setattr(lattice, "HOT", hot)
    train = [(i, "the cat sat on the mat") for i in range(20)]
    chars = [40, 400, 5000]
    held = [(100, "")] + [(100 + n, "鿿" * n) for n in chars] + [(9000, "鿿" * 5000 + " " + "鿿" * 5000)]
    got = {r.doc_id: r for r in lattice.lattice_scores(docs_of(train + held), F.col("doc_id") >= 100).collect()}
    empty, kinds, tokens = got[100], 6, 20 * 7           # five words and the end
    assert empty.train_tokens == tokens
    prior = math.log10(lattice.REPEATS * kinds / (tokens + kinds))
    for n in chars:
        r = got[100 + n]
        word = r.lattice_score - empty.lattice_score
        assert word < n * 3 * math.log10(lattice.BYTE_MASS / 256) + 1
        assert math.isclose(r.mixed_score - empty.mixed_score, prior + word - math.log10(lattice.REPEATS + 1), rel_tol=1e-9)
    # a second time the word costs its repetition only: the factor x + 1
    twice = got[9000].mixed_score - got[5100].mixed_score
    assert math.isclose(twice, -math.log10(lattice.REPEATS + 2), abs_tol=1e-6)
