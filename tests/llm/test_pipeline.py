"""The pipeline's stages on odd rows, and held against plain Python."""

from collections import Counter

import corpus_pipeline as P
import pytest
from llm_helpers import docs_of, no_docs, odd, SF, shingle_set, words  # noqa: F401
from pyspark.sql import functions as F


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """A folder with ``documents`` and ``labels``."""
    def make(docs, labels=None):
        path = str(tmp_path_factory.mktemp("sf"))
        docs.write.parquet(f"{path}/documents.parquet")
        labels = labels if labels is not None else spark.createDataFrame([], "doc_id long, quality int, toxic int")
        labels.write.parquet(f"{path}/labels.parquet")
        return path
    return make


def staged(spark, sf, tmp_path):
    """Each stage's rows, written and read again as the next one's input."""
    prev, out = spark.read.parquet(f"{sf}/documents.parquet"), {}
    for name, stage in P.STAGES:
        stage(spark, prev, sf).write.parquet(str(tmp_path / name))
        out[name] = prev = spark.read.parquet(str(tmp_path / name))
    return out


def test_odd_rows_pass_every_stage(spark, odd, tables, tmp_path):
    sf = tables(odd)
    out = staged(spark, sf, tmp_path)
    assert all(out[n].columns == odd.columns for n, _ in P.STAGES[:-1])
    assert out["quality"].count() == odd.count()            # nothing is learned, nothing rejected
    kept = out["near_dedup"].collect()
    sets = [shingle_set(r.text) for r in kept if shingle_set(r.text)]
    assert not any(100 * len(a & b) >= 75 * len(a | b) for n, a in enumerate(sets) for b in sets[:n])
    assert sum(not shingle_set(r.text) for r in kept) == sum(not shingle_set(r.text) for r in odd.collect())
    told = Counter((r.doc_id, r.text) for r in kept)
    assert Counter((r.doc_id, r.text) for r in out["secrets"].collect()) == told      # no secrets: as they were
    copies = Counter((r.doc_id, r.text) for r in out["mixing"].collect())
    assert set(copies) <= set(told) and all(n <= 3 * told[k] for k, n in copies.items())
    packed = Counter((r.doc_id, r.n_tokens) for r in out["packing"].collect())
    assert packed == Counter((i, len(words(t))) for (i, t), n in copies.items() for _ in range(n))
    assert P.run(spark, sf).count() == sum(copies.values())


def test_no_rows_and_one_null_row(spark, no_docs, docs_of, tables, tmp_path):
    assert P.run(spark, tables(no_docs)).collect() == []
    one = P.run(spark, tables(docs_of([(None, None)]))).collect()
    assert len(one) <= 3 and all(r.doc_id is None and r.n_tokens == 0 for r in one)


def test_secrets_stage_keeps_rows_and_counts(spark, docs_of):
    docs = docs_of([(1, "password = hunter22 x"), (1, "password = hunter22 x"), (None, "token=abcdef"), (2, None), (3, "")])
    got = sorted(((r.doc_id, r.text, r.n_chars) for r in P.secret_redaction(spark, docs, "").collect()), key=str)
    want = [(1, "[SECRET] x", 10), (1, "[SECRET] x", 10), (None, "[SECRET]", 8), (2, None, None), (3, "", 0)]
    assert got == sorted(want, key=str)


def test_copies_restated(spark, docs_of):
    """Each source's words after the mix come near the target that plain Python gives."""
    from test_native import shared
    docs = docs_of([(i, "w " * (1 + i % 7), "en", f"s{i % 4}" if i % 3 else "s0") for i in range(400)])
    before, after = Counter(), Counter()
    for r in docs.collect():
        before[r.source] += len(words(r.text))
    for r in P.mix_sources(spark, docs, "").collect():
        after[r.source] += len(words(r.text))
    assert all(abs(after[s] - t) <= 7 for s, t in shared(before).items())


def test_quality_stage_judges_by_text(spark, docs_of, tables):
    """Rejected texts go whatever their ids; equal texts share their fate."""
    sf = SF.replace("0.001", "0.01")
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    twice = docs.unionByName(docs.withColumn("doc_id", F.lit(None).cast("long")))
    kept = Counter(r.text for r in P.quality_filter(spark, twice, sf).select("text").collect())
    every = Counter(r.text for r in twice.select("text").collect())
    assert 0 < len(kept) < len(every) and all(every[t] == n for t, n in kept.items())
