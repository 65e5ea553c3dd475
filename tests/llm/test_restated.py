"""Fits of the quality classifier and of the language model, restated in plain numpy and Python."""

import math
from collections import Counter

import numpy as np
from llm_helpers import SF
from pyspark.sql import functions as F

from pagetables.llm import langid, quality, queries


def pooled(at, n, y):
    """Isotonic fit by its min-max form: (position, value) of each level."""
    k = len(n)
    c = lambda v: np.concatenate([[0.0], np.cumsum(v)])
    cn, cy, ca = c(n), c(y), c(at * n)
    fit = [max(min((cy[j + 1] - cy[i]) / (cn[j + 1] - cn[i]) for j in range(m, k)) for i in range(m + 1)) for m in range(k)]
    out = []
    for v in sorted(set(np.round(fit, 12))):
        m = [i for i in range(k) if abs(fit[i] - v) < 1e-11]
        lo, hi = m[0], m[-1] + 1
        out.append(((ca[hi] - ca[lo]) / (cn[hi] - cn[lo]), v))
    return np.array(out).T


def test_quality_scores(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    got = {r.doc_id: r.score for r in queries.op3_quality(spark, SF).collect()}
    stats = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(quality._stat_rows, "doc_id long, x array<double>")
    x = {r.doc_id: np.array(r.x) for r in stats.collect()}
    told = labels.filter("quality is not null and pmod(crc32(cast(cast(doc_id as string) as binary)), 3) <> 1").select(
        "doc_id", "quality", (F.pmod(F.xxhash64("doc_id", F.lit("calibrate")), F.lit(4)) == 0).alias("cal")).collect()
    told = [r for r in told if r.doc_id in x]
    every, y = np.stack([x[r.doc_id] for r in told]), np.array([float(r.quality) for r in told])
    cal = np.array([r.cal for r in told])

    rng = np.random.default_rng(5)
    w, b = rng.normal(0.0, quality.WIDTH, size=(quality.D, quality.FEATURES)), rng.uniform(0.0, 2 * np.pi, size=quality.FEATURES)

    def features(m):
        z = np.clip((m - every.mean(axis=0)) / (every.std(axis=0) + 1e-6), -quality.CLIP, quality.CLIP)
        return np.hstack([np.sqrt(2 / quality.FEATURES) * np.cos(z @ w + b), np.ones((len(z), 1))])
    # ridge as a plain least-squares problem: one more row a weight
    z = features(every[~cal])
    root = np.sqrt(np.append(np.full(quality.FEATURES, quality.RIDGE), 1e-6))
    weights = np.linalg.lstsq(np.vstack([z, np.diag(root)]), np.append(y[~cal], np.zeros(len(root))), rcond=None)[0]
    raw, bins = features(every[cal]) @ weights, {}
    for r, v in zip(raw, y[cal]):
        bins.setdefault(int(min(max((r + 0.5) * quality.BINS / 2, 0), quality.BINS - 1)), []).append((r, v))
    held = [(np.mean([r for r, _ in v]), len(v), sum(t for _, t in v)) for _, v in sorted(bins.items())]
    at, level = pooled(*map(np.array, zip(*held)))
    ids = sorted(x)
    want = np.interp(features(np.stack([x[i] for i in ids])) @ weights, at, level)
    assert np.allclose([got[i] for i in ids], np.clip(want, 0, 1), atol=1e-6)


def test_language_scores(spark, monkeypatch):
    monkeypatch.setattr(langid, "TASKS", 1)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = {r.doc_id: (r.lang_pred, r.score) for r in queries.op10_langid(spark, SF).collect()}
    rows = docs.withColumn("o", F.xxhash64(F.col("doc_id").cast("long"), "text")).withColumn("held", queries._held(4, 2)).collect()
    grams = {r.doc_id: Counter(langid.grams(r.text)[0].tolist()) for r in rows}
    train = sorted((r for r in rows if not r.held and r.lang is not None), key=lambda r: r.o)
    df = Counter(g for r in train for g in grams[r.doc_id])
    classes = sorted({r.lang for r in train})

    def vector(r):
        v = {g: c * (math.log((1 + len(train)) / (1 + df[g])) + 1 if g in df else math.log(1 + len(train))) for g, c in grams[r.doc_id].items()}
        norm = math.sqrt(sum(a * a for a in v.values())) or 1.0
        return {g: a / norm for g, a in v.items()}

    z, n = {}, {}

    def weight(key):
        a, b = z.get(key, 0.0), n.get(key, 0.0)
        return 0.0 if abs(a) <= langid.L1 else -(a - math.copysign(langid.L1, a)) / ((langid.BETA + math.sqrt(b)) / langid.ALPHA + langid.L2)

    def logits(v):
        return [sum(a * weight((g, k)) for g, a in v.items()) + weight(("bias", k)) for k in range(len(classes))]

    def softmax(v):
        e = [math.exp(a - max(v)) for a in v]
        return [a / sum(e) for a in e]
    vectors = {r.doc_id: vector(r) for r in rows}
    for _ in range(langid.EPOCHS):
        for r in train:
            if r.o % langid.CALIBRATION == 0 or not grams[r.doc_id]:
                continue
            v = vectors[r.doc_id]
            p = softmax(logits(v))
            for k, c in enumerate(classes):
                d = p[k] - (c == r.lang)
                for g, a in [*v.items(), ("bias", 1.0)]:
                    grad, key = a * d, (g, k)
                    w, old = weight(key), n.get(key, 0.0)
                    z[key] = z.get(key, 0.0) + grad - (math.sqrt(old + grad * grad) - math.sqrt(old)) / langid.ALPHA * w
                    n[key] = old + grad * grad
    scores = {r.doc_id: logits(vectors[r.doc_id]) for r in rows}
    held = [r for r in train if r.o % langid.CALIBRATION == 0 and grams[r.doc_id]]

    def loss(t):
        out = 0.0
        for r in held:
            p = [math.log(max(a, 1e-12)) for a in softmax([a / t for a in scores[r.doc_id]])]
            out -= (1 - langid.DOUBT) * p[classes.index(r.lang)] + langid.DOUBT * sum(p) / len(p)
        return out / len(held)
    t = min((0.02 * 1.15 ** k for k in range(40)), key=loss)
    for r in rows:
        if grams[r.doc_id]:
            p = softmax([a / t for a in scores[r.doc_id]])
            k = p.index(max(p))
            assert got[r.doc_id][0] == classes[k] and math.isclose(got[r.doc_id][1], p[k], rel_tol=1e-6), r.doc_id
        else:
            assert got[r.doc_id] == ("und", 0.0)
