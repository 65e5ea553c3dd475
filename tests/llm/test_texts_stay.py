"""What the pipeline's stages join with documents reaches them without a shuffle of their texts."""

from collections import Counter

from llm_helpers import docs_of  # noqa: F401

from pagetables.llm import mixing, quality, tables


def test_most_texts_learn_their_copies_where_they_lie(spark, docs_of, monkeypatch):  # noqa: F811
    shuffled = []

    def spy(*args):
        alone, others = tables.told(*args)
        shuffled.extend(r.doc_id for r in others.collect())
        return alone, others
    monkeypatch.setattr(mixing, "told", spy)
    rows = [(i, "w " * (i % 20), "en", [None, "a", "b", "c"][i % 4]) for i in range(400)]
    rows += [(500, "x y z", "en", "a"), (500, "u v w", "en", "a"), (None, "x y", "en", "b")]
    docs = docs_of(rows)
    want = Counter()
    for r in mixing.mix(docs).collect():
        want[r.doc_id] += r.m * r.copies
    assert Counter(r.doc_id for r in mixing.resample(docs).collect()) == +want
    assert shuffled.count(500) == 2 and len(shuffled) < 20


def test_training_rows_are_joined_once(spark, docs_of, monkeypatch):  # noqa: F811
    names = []

    def spy(df, name, *more):
        names.append(name)
        return tables.stored(df, name, *more)
    monkeypatch.setattr(quality, "stored", spy)
    docs = docs_of([(i, "good words here " * (1 + i % 5) if i % 2 else "!!! ||| x", "en", "a") for i in range(60)])
    labels = spark.createDataFrame([(i, i % 2) for i in range(0, 60, 1)], "doc_id long, quality int")
    _x, model = quality.train(docs, labels)
    assert names == ["statistics", "train"] and model.weights.any()
