"""A source with a third of its rows under one id, and under null ids of one length."""

import math
from collections import Counter, defaultdict

import pytest
from llm_helpers import docs_of, words  # noqa: F401
from pyspark.sql import functions as F

from pagetables.llm import mixing


@pytest.mark.parametrize("part", [1024, 8])
def test_target_with_hot_keys(spark, docs_of, monkeypatch, part):  # noqa: F811
    monkeypatch.setattr(mixing, "PART", part)
    rows = []
    for source, hot in (("a", 7), ("b", None), ("c", 8), ("d", None)):
        rows += [(hot, f"{source} " + "same " * 19, "en", source)] * 60            # equal rows
        rows += [(hot, f"{source}{i} " + "w " * 19, "en", source) for i in range(61)]   # other texts, one key
        rows += [(1000 * ord(source) + i, "w " * (3 + i % 20), "en", source) for i in range(240)]
    docs = docs_of(rows).withColumn("tags", F.create_map(F.lit("k"), F.col("source")))
    got = mixing.mix(docs).collect()
    assert sum(r.m for r in got) == len(rows)
    taken, target, per = defaultdict(int), {}, defaultdict(list)
    for r in got:
        taken[r.source] += r.m * r.copies * r.size
        target[r.source] = r.target
        per[r.doc_id, r.source, r.size].append(r)
        share = r.target / r.source_size
        assert math.floor(share) <= r.copies <= math.ceil(share)
    assert any(not (t / 20).is_integer() for t in target.values())
    assert all(abs(taken[s] - target[s]) <= 22 / 4 for s in target), (dict(taken), target)
    for v in per.values():
        assert len(v) == 1 or abs(v[0].copies - v[1].copies) == 1
    row = mixing.taken(docs).collect()
    assert len(row) == len(rows) and sum(r.taken for r in row) == sum(taken.values())
    out = mixing.resample(docs)
    assert out.columns == docs.columns
    count = Counter((r.doc_id, r.source, r.text) for r in out.collect())
    held = Counter((r[0], r[3], r[1]) for r in rows)
    words_out, by_key, limits = defaultdict(int), defaultdict(int), {}
    for (i, s, t), n in count.items():
        words_out[s] += n * len(words(t))
        by_key[i, s, len(words(t))] += n
    assert dict(words_out) == dict(taken)
    for k, v in per.items():
        assert by_key[k] == sum(r.m * r.copies for r in v)
        limits[k] = min(r.copies for r in v), max(r.copies for r in v)
    for (i, s, t), n in held.items():
        lo, hi = limits[i, s, len(words(t))]
        assert lo * n <= count[i, s, t] <= hi * n
    again = Counter((r.doc_id, r.source, r.text) for r in mixing.resample(docs.repartition(7)).collect())
    assert again == count
