"""Vectors, segmentation and merging: cross-checks and properties of SURVEY §5."""

import hashlib

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from pagetables.operators import merge as M
from pagetables.operators import vectors as V


def test_bucket_rule_matches_python(spark):
    ws = ["the", "über", "故事", "x1"]
    df = spark.createDataFrame([(w,) for w in ws], ["w"])
    got = [r[0] for r in df.select(V.bucket("w", 128)).collect()]
    want = [int(hashlib.md5(w.encode()).hexdigest()[:8], 16) % 128 for w in ws]
    assert got == want


def test_dim_is_checked():
    with pytest.raises(ValueError):
        V.check_dim(0)
    with pytest.raises(ValueError):
        V.check_dim(1025)


def test_segments_respect_the_cap_and_keep_text(spark):
    text = "\n".join(["a" * 5, "b" * 3, "c" * 12, "d", "e" * 2])
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    ch = [r.chunk for r in V.segment_texts(df, max_chars=10).orderBy("chunk_no").collect()]
    assert ch == ["aaaaa\nbbb", "cccccccccc", "cc\nd\nee"]
    assert all(len(c) <= 10 for c in ch)


def test_weighted_mean_equal_weights_is_mean(spark):
    df = spark.createDataFrame([(1, 1.0, [1.0, 2.0]), (1, 1.0, [3.0, 6.0])],
                               "g long, w double, vec array<double>")
    long = df.select("g", "w", F.posexplode("vec").alias("dim", "value"))
    got = rows(V.weighted_mean_vectors(long, "g"), "dim", "value")
    assert got == [(0, 2.0), (1, 4.0)]


def test_position_weighted_pool(spark):
    t = spark.createDataFrame([(1, 0, 1, [1.0]), (1, 1, 1, [4.0]), (1, 2, 0, [100.0])],
                              "doc_id long, pos int, mask int, hidden array<double>")
    got = rows(V.position_weighted_pool(t), "value")
    assert got == [(3.0,)]  # weights 1, 2, 0


def test_padding_only_has_no_mean(spark):
    t = V.subword_tokens(spark.createDataFrame([(1, "a a"), (2, ""), (3, " \n\t"), (4, None)], "doc_id long, text string"),
                         {"[PAD]": 0, "[UNK]": 1, "a": 2}, max_len=3)
    t = t.withColumn("hidden", F.array(F.col("token_id").cast("double")))
    assert rows(V.position_weighted_pool(t), "doc_id", "dim", "value") == [(1, 0, 2.0), (2, 0, None), (3, 0, None), (4, 0, None)]


def test_merge_cross_checks():
    chunks = ["the cat sat", "the cat ran", "dogs bark loud", "dogs bark more"]
    one = M.merge_sequence(chunks, 1)
    assert len(one) == 1 and one[0][2].split() == " ".join(chunks).split()
    same = M.merge_sequence(chunks, 4)
    assert [t for _, _, t in same] == chunks
    two = M.merge_sequence(chunks, 2)
    assert [t for _, _, t in two] == ["the cat sat the cat ran", "dogs bark loud dogs bark more"]


def test_merge_sum_equals_reembedding():
    a, b = "x y z y", "y q"
    assert np.array_equal(M.hashed_vector(a, 64) + M.hashed_vector(b, 64),
                          M.hashed_vector(a + " " + b, 64))


def test_merge_adjacent_chunks_in_spark(spark):
    data = [(1, i, t) for i, t in enumerate(["a b", "a b c", "z y", "z y w", "q"])] + \
           [(2, 0, "only one")]
    df = spark.createDataFrame(data, "doc_id long, chunk_no int, chunk string")
    out = M.merge_adjacent_chunks(df, target=3, dim=64).orderBy("doc_id", "chunk_no").collect()
    d1 = [r.chunk for r in out if r.doc_id == 1]
    assert len(d1) == 3 and " ".join(d1).split() == "a b a b c z y z y w q".split()
    assert [r.chunk for r in out if r.doc_id == 2] == ["only one"]


def test_merge_revector_modes_and_custom_embedder():
    chunks = ["a a b", "a b", "z z", "z y"]
    by_sum = M.merge_sequence(chunks, 2, dim=32, revector="sum")
    by_mean = M.merge_sequence(chunks, 2, dim=32, revector="mean")
    calls = []

    def emb(ts):
        calls.append(len(ts))
        return [M.hashed_vector(t, 32) for t in ts]

    by_embed = M.merge_sequence(chunks, 2, revector="embed", embedder=emb)
    assert [t for _, _, t in by_sum] == ["a a b a b", "z z z y"]
    assert [t for _, _, t in by_mean] == [t for _, _, t in by_sum]
    assert [t for _, _, t in by_embed] == [t for _, _, t in by_sum]
    assert calls[0] == 4 and all(c == 1 for c in calls[1:])


def test_embed_texts_with_a_user_batch_function(spark):
    df = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")

    def embedder(texts):
        return [[float(len(t)), 1.0] for t in texts]

    got = rows(V.embed_texts(df, embedder=embedder), "doc_id", "vec")
    assert got == [(1, [3.0, 1.0]), (2, [0.0, 1.0])]


def test_tokenize_truncate_equals_python_split(spark):
    texts = ["  lead  and trail  ", "a b c d e f", "one", "", "x　y z w"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {}
    for r in V.tokenize_truncate(df, max_len=3).collect():
        got.setdefault(r.doc_id, []).append((r.pos, r.token))
    for i, t in enumerate(texts):
        assert [w for _, w in sorted(got.get(i, []))] == t.split()[:3]


def test_merge_adjacent_chunks_with_user_embedder(spark):
    data = [(1, i, t) for i, t in enumerate(["aa", "ab", "zz", "zy"])]
    df = spark.createDataFrame(data, "doc_id long, chunk_no int, chunk string")

    def emb(texts):  # first-letter vectors
        return [[1.0, 0.0] if t.startswith("a") else [0.0, 1.0] for t in texts]

    out = M.merge_adjacent_chunks(df, 2, revector="embed", embedder=emb)
    assert [r.chunk for r in out.orderBy("chunk_no").collect()] == ["aa ab", "zz zy"]


VOCAB = {t: i for i, t in enumerate(["[PAD]", "[UNK]", "[CLS]", "[SEP]", "th", "the", "t", "##e", "c", "##a", "##t", "##at", "a", "é"])}


def pieces(word):
    out, at = [], 0
    while at < len(word):
        n = next((n for n in range(len(word) - at, 0, -1) if ("##" if at else "") + word[at:at + n] in VOCAB), 0)
        out.append(VOCAB[("##" if at else "") + word[at:at + n]] if n else VOCAB["[UNK]"])
        at += n or 1
    return out


def test_subwords_cut_and_padded(spark):
    import pytest
    texts = ["the cat  at　th x", "", None, "é漢a the", "t " * 50, "thecat\n"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    for first, last in ((None, None), ("[CLS]", "[SEP]")):
        got = V.subword_tokens(df, VOCAB, max_len=7, first=first, last=last).collect()
        around = [[VOCAB[t]] if t else [] for t in (first, last)]
        for i, t in enumerate(texts):
            ids = around[0] + [p for w in (t or "").split() for p in pieces(w)][:7 - 2 * bool(first)] + around[1]
            mine = sorted((r.pos, r.token_id, r.mask) for r in got if r.doc_id == i)
            assert mine == [(k, (ids + [0] * 7)[k], int(k < len(ids))) for k in range(7)]
    with pytest.raises(ValueError):
        V.subword_tokens(df, {"a": 1})


def test_counts_in_the_row_equal_python(spark):
    from pagetables.operators.merge import hashed_vector
    texts = ["a b a c a", "", None, " \n", "x" * 1000 + " x", " ".join(f"w{i % 37}" for i in range(3000))]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    raw, unit = V.hashed_counts(df, dim=16).collect(), V.embed_texts(df, dim=16).collect()
    for i, t in enumerate(texts):
        want = hashed_vector(t, 16)
        assert {r.dim: r.cnt for r in raw if r.doc_id == i} == {d: c for d, c in enumerate(want) if c}
        n = sum(c * c for c in want) ** 0.5 or 1
        assert all(abs(r.value - want[r.dim] / n) < 1e-12 for r in unit if r.doc_id == i)


def exchanges(df):
    import re
    return len(re.findall(r"Exchange hashpartitioning", df._jdf.queryExecution().executedPlan().toString()))


def test_embedding_plans_shuffle_as_little_as_said(spark):
    df = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    assert exchanges(V.embed_texts(df)) == exchanges(V.subword_tokens(df, VOCAB)) == 0
    assert exchanges(V.embed_long_texts(df)) == 1
