"""Lattice scores, neighbours, quality, languages and the pipeline."""

import math
from collections import Counter
from zlib import crc32

import numpy as np
from llm_helpers import docs_of, no_docs, odd, SF, shingle_set, words  # noqa: F401
from pyspark.sql import functions as F

from pagetables.llm import langid, lattice, nndescent, quality, queries


def test_lattice_sums_all_segmentations():
    pieces = [lattice.START + "a", lattice.START, "a", "b", "ab", "ba", "é", "aba"]
    lat = lattice.Lattice(pieces)
    p = np.log(np.array([.1, .2, .1, .1, .2, .1, .1, .1]))
    prob = dict(zip(pieces, np.exp(p)))
    byte = lattice.BYTE_MASS / 256

    def total(t):
        if not t:
            return 1.0
        if t[0] not in prob:
            return byte ** len(t[0].encode()) * total(t[1:])
        return sum(v * total(t[len(k):]) for k, v in prob.items() if t.startswith(k))
    ws = ["a", "ab", "aba", "abab", "éba", "xa", "漢b", "b" * 40, "a𝒳"]
    got = lat.log10(ws, np.append(p, -np.inf))
    assert np.allclose(got, [math.log10(total(lattice.START + w)) for w in ws])
    # expected counts: each segmentation weighted by its probability
    at, mat, edge = next(lat.by_length(["ab"]))
    e = lat.expected(mat, edge, np.append(p, -np.inf), np.array([3.0]))
    seg = {(lattice.START, "ab"): .2 * .2, (lattice.START, "a", "b"): .2 * .1 * .1, (lattice.START + "a", "b"): .1 * .1}
    want = Counter()
    for s, v in seg.items():
        for x in s:
            want[x] += 3 * v / sum(seg.values())
    assert np.allclose(e, [want[x] for x in pieces])


def test_lattice_scores(spark, odd, no_docs, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    monkeypatch.setattr(lattice, "HOT", 200)                   # most words meet in the shuffle
    got = {r.doc_id: r for r in queries.op1_lattice(spark, SF).collect()}
    texts = {r.doc_id: words(r.text) for r in docs.collect()}
    c = Counter()
    for i, w in texts.items():
        if crc32(str(i).encode()) % 7 != 2:
            c.update([*w, None])
    n, v = sum(c.values()), len(c)
    for i, w in texts.items():
        r, t = got[i], [*w, None]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (
            crc32(str(i).encode()) % 7 == 2, len(t), sum(c[x] > 0 for x in t), n)
        assert math.isclose(r.base_score, sum(math.log10((c[x] + 1) / (n + v + 1)) for x in t), rel_tol=1e-9)
        assert r.score < 0 and r.lattice_score == r.score and r.mixed_score < 0
    held = [r for r in got.values() if r.held_out and r.n_tokens > 100]
    assert sum(r.mixed_score for r in held) > sum(r.score for r in held)
    rows = lattice.lattice_scores(odd, F.col("doc_id") == 1).collect()
    assert len(rows) == 12 and all(math.isfinite(r.score) for r in rows)
    by = {r.doc_id: r for r in rows if r.doc_id is not None}
    assert by[4].score == by[5].score and by[2].n_tokens == by[3].n_tokens == 1 and by[4].n_tokens == 30_001
    assert lattice.lattice_scores(no_docs).collect() == []


def restated_scores(train, texts):
    """The lattice model in plain Python: pieces re-estimated over the training words, then
    log10 of the sum over all segmentations of each text's words, times its end."""
    pieces, prior = lattice.load_pieces()
    at = {p: i for i, p in enumerate(pieces)}
    ends, count = len(train), Counter(w for t in train for w in words(t))

    def edges(word, p):
        s = lattice.START + word
        for i in range(len(s)):
            found = [(i, i + n, at[s[i:i + n]], p[at[s[i:i + n]]]) for n in range(1, min(16, len(s) - i) + 1) if s[i:i + n] in at]
            if s[i] not in at:
                found.append((i, i + 1, None, (lattice.BYTE_MASS / 256) ** len(s[i].encode())))
            yield from found

    def forward(word, p):
        a = [1.0] + [0.0] * (len(word) + 1)
        for i, j, _, q in sorted(edges(word, p)):
            a[j] += a[i] * q
        return a

    expected = {}
    for _ in range(lattice.WARM_ROUNDS + 2 if ends else 1):      # the last probabilities are those of the last counts
        e = [lattice.PRIOR * x for x in prior]
        for i, x in expected.items():
            e[i] += x
        mass = sum(e) + ends + 1.0
        p = [x * (1 - lattice.BYTE_MASS) / mass for x in e]
        expected = Counter()
        for w, c in count.items():
            a, b = forward(w, p), [0.0] * (len(w) + 1) + [1.0]
            for i, j, _, q in sorted(edges(w, p), reverse=True):
                b[i] += q * b[j]
            for i, j, k, q in edges(w, p):
                if k is not None:
                    expected[k] += c * a[i] * q * b[j] / a[-1]
    end = (ends + 1.0) * (1 - lattice.BYTE_MASS) / mass
    return [sum(math.log10(forward(w, p)[-1]) for w in words(t)) + math.log10(end) for t in texts]


def test_score_of_whole_documents_restated(docs_of):
    train = ["the cat sat on the mat", "A cat, the Dog and 漢字 über", "", "reading readers read the readings", None]
    held = ["the dog read über 漢 字", "", "xyzzy the  the\ttheatre ¤𝒳", None]
    docs = docs_of([(i, t) for i, t in enumerate(train)] + [(100 + i, t) for i, t in enumerate(held)])
    got = {r.doc_id: r.score for r in lattice.lattice_scores(docs, F.col("doc_id") >= 100).collect()}
    want = restated_scores(train, [*train, *held])
    assert np.allclose([got[i] for i in [*range(5), *range(100, 104)]], want, rtol=1e-9)
    none = {r.doc_id: r.score for r in lattice.lattice_scores(docs, F.lit(True)).collect()}
    assert np.allclose([none[100 + i] for i in range(4)], restated_scores([], held), rtol=1e-9)


def test_rising_product():
    x, n = np.array([1e-12, 0.5, 3.0, 300.0]), np.array([1.0, 7.0, 4000.0, 2.0])
    want = [(math.lgamma(a + b) - math.lgamma(a)) / math.log(10) for a, b in zip(x, n)]
    assert np.allclose(lattice._log10_rising(x, n), want)


def test_nearest(spark, monkeypatch):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(900, 16)) * rng.uniform(0.5, 2.0, size=(900, 1))
    x[600:] = x[5]                                            # a third of all rows are equal
    rows = [(i, v.tolist(), 1, 2) for i, v in enumerate(x)]
    rows += [(2000, None, 1, 2), (2020, [0.0] * 16, 1, 2), (2040, [1.0, None] + [0.0] * 14, 1, 2),
             (2060, [float("nan")] * 16, 1, 2), (2080, [1.0] * 3, 1, 2), (None, [1.0] * 16, 1, 2), (7, x[7].tolist(), 1, 2)]
    v = spark.createDataFrame(rows, "vec_id long, embedding array<double>, node int, score int")
    monkeypatch.setattr(nndescent, "RUN", 64)
    monkeypatch.setattr(nndescent, "BUCKET", 200)
    monkeypatch.setattr(nndescent, "QUERIES", 20)
    got = {}
    for r in nndescent.nearest(v, F.col("vec_id") % 20 == 0).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert sorted(got) == list(range(0, 900, 20))               # row 7 comes twice: two candidates
    hit = 0
    for q, found in got.items():
        s = x @ x[q]
        order = [i for i in np.lexsort((np.arange(900), -np.round(s, 9))) if i != q][:20]
        found.sort()
        assert [f[0] for f in found] == list(range(1, 21)) and len({f[1] for f in found} - {q}) == 20 - (sum(f[1] == 7 for f in found) > 1)
        assert np.allclose([f[2] for f in found], s[[f[1] for f in found]])
        hit += sum(f[2] >= s[order[-1]] - 1e-9 for f in found)
    assert hit >= 0.9 * 20 * len(got)
    assert nndescent.nearest(v.limit(0), F.col("vec_id") % 20 == 0).collect() == []


def test_isotonic():
    rng = np.random.default_rng(0)
    at, n = np.arange(50.0), rng.integers(1, 9, 50).astype(float)
    y = np.minimum(n, rng.integers(0, 9, 50)).astype(float)
    knots, p = quality.isotonic(at, n, y)
    assert (np.diff(p) > 0).all() and math.isclose(sum(y), sum(y))
    # the best monotone fit has no better neighbour by min-max
    best = [max(min(y[i:j + 1].sum() / n[i:j + 1].sum() for j in range(k, 50)) for i in range(k + 1)) for k in range(50)]
    assert np.allclose(sorted(set(np.round(best, 9))), np.round(p, 9))


def test_quality_held_out(spark, odd, no_docs):
    sf = SF.replace("0.001", "0.01")
    got = queries.op3_quality(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").toPandas()
    held = got[got.held_out]
    assert set(got.held_out) == {True, False} and ((held.score >= 0.5) == (held.predicted == 1)).all()
    assert (held.predicted == held.quality).mean() >= 0.95
    labels = spark.createDataFrame([(1, 1, 0), (9, 0, 0), (4, None, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    rows = quality.score(odd, labels).collect()
    assert len(rows) == 12 and all(0 <= r.score <= 1 for r in rows)
    assert quality.score(no_docs, labels).collect() == [] and quality.score(odd, labels.limit(0)).first().score == 0.5
    assert quality.keep(odd, labels.limit(0)).columns == odd.columns


def test_language_held_out(spark, odd, no_docs):
    sf = SF.replace("0.001", "0.01")
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = queries.op10_langid(spark, sf).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out and lang is not null").toPandas()
    assert (got.lang == got.lang_pred).mean() >= 0.95 and got.score.between(0, 1).all()
    rows = langid.identify(odd).collect()
    by = {r.doc_id: r for r in rows if r.doc_id is not None}
    assert len(rows) == 12 and {by[2].lang_pred, by[3].lang_pred, by[6].lang_pred} == {"und"} and by[2].score == 0
    assert by[4].lang_pred in ("de", "en", "fr") and by[4].score == by[5].score
    assert langid.identify(no_docs).collect() == []
    assert {r.lang_pred for r in langid.identify(odd.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


def test_pipeline(spark, tmp_path):
    import corpus_pipeline as P
    from pagetables.llm import minhash, mixing, secrets
    sf = SF
    docs = spark.read.parquet(f"{sf}/documents.parquet").withColumn("gone", F.lit(1)).withColumn("spans", F.lit(2))
    cols, prev, seen = docs.columns, docs, {}
    for name, stage in P.STAGES[:-1]:
        stage(spark, prev, sf).write.parquet(str(tmp_path / name))
        prev = spark.read.parquet(str(tmp_path / name))
        assert prev.columns == cols
        seen[name] = prev
    text = {r.doc_id: r.text for r in docs.collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    good = {r.doc_id for r in seen["quality"].collect()}
    assert sum((i in good) == bool(q) for i, q in labels.items()) >= 0.95 * len(labels)
    kept = {r.doc_id: r for r in seen["near_dedup"].collect()}
    want = {r.doc_id for r in minhash.near_duplicates(seen["quality"]).collect() if r.kept}
    assert set(kept) == want and len(kept) == seen["near_dedup"].count()
    sets = {i: shingle_set(r.text) for i, r in kept.items() if shingle_set(r.text)}
    for a in sets:
        assert not any(b < a and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]) for b in sets)
    clean = {r.doc_id: r for r in seen["secrets"].collect()}
    assert set(clean) == set(kept) and secrets.scan(seen["secrets"]).filter("size(spans) > 0").count() == 0
    assert all(r.n_chars == len(r.text) for r in clean.values())
    assert all(r.text == text[i] for i, r in clean.items() if "[SECRET]" not in r.text)
    copies = Counter(r.doc_id for r in seen["mixing"].collect())
    mix = {r.doc_id: r.copies for r in mixing.mix(seen["secrets"]).collect()}
    assert {i: n for i, n in mix.items() if n} == dict(copies)
    packed = P.run(spark, sf).collect()
    assert Counter(r.doc_id for r in packed) == copies


def test_nearest_with_unequal_norms_and_repeated_ids(spark):
    """Shipped constants; a search scores a small share of the table."""
    rng = np.random.default_rng(7)
    n = 6000
    x = rng.normal(size=(n, 24))
    x[11] *= 10
    x[12] *= 1000
    x[13] *= 1e-3
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(20, (x[5] * 1.5).tolist()), (40, x[40].tolist())]
    every = np.vstack([x, x[5] * 1.5, x[40]])
    got = nndescent.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4), F.col("vec_id") % 20 == 0).collect()
    assert len(got) == 20 * (n // 20 + 2)
    hit = 0
    by = {}
    for r in got:
        by.setdefault(r.query_id, []).append(r.score)
    for q, scores in by.items():
        own = [i for i, (k, _) in enumerate(rows) if k == q]
        scores.sort(reverse=True)
        want = sorted((s for o in own for s in sorted(np.delete(every @ every[o], o))[-20:]), reverse=True)
        assert len(scores) == len(want)
        hit += sum(any(abs(s - w) <= 1e-9 * max(1, abs(w)) for w in want) for s in scores)
    assert hit >= 0.95 * len(got)
