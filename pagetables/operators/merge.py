"""Merging neighbouring chunks by similarity.

The merge is sequential within a document (each step changes the next
step's neighbours), so it runs per document with ``applyInPandas``; all
documents run in parallel.  A group is one document's chunks, which a
segmenter bounds by the text's length.  Documents with no more chunks
than the target never reach Python (E10).

Within a document: vectors are the hashed word counts (E2 rule, in
numpy); the most similar adjacent pair is merged (lowest position on
ties; similarities rounded to 12 places so float summation order does not
decide), its vector becomes the sum of the two (the same as re-embedding
the joined text, E11) and only the two neighbouring similarities are
recomputed.  A heap with lazy deletion makes it O(n log n).
"""

from __future__ import annotations

import hashlib
import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagetables.operators.vectors import check_dim

MERGED_SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("chunk_no", T.IntegerType()),
    T.StructField("first_chunk", T.IntegerType()),
    T.StructField("last_chunk", T.IntegerType()),
    T.StructField("chunk", T.StringType()),
])


def hashed_vector(text: str, dim: int, known: dict | None = None) -> np.ndarray:
    """The E2 rule in Python (same words, same buckets as the JVM side).

    ``known``: buckets of words met before, filled here."""
    known = {} if known is None else known
    at = []
    for w in (text or "").split():
        b = known.get(w)
        if b is None:
            b = known[w] = int(hashlib.md5(w.encode("utf-8")).hexdigest()[:8], 16) % dim
        at.append(b)
    return np.bincount(np.asarray(at, dtype=np.intp), minlength=dim).astype(np.float64)


def _cos(a: np.ndarray, b: np.ndarray) -> float:
    na, nb = float(np.linalg.norm(a)), float(np.linalg.norm(b))
    if na == 0.0 or nb == 0.0:
        return 0.0
    return round(float(np.dot(a, b)) / (na * nb), 12)


def hashed_embedder(dim: int = 128):
    """The built-in embedder as a batch function ``list[str] -> vectors``; a batch hashes each
    of its words once."""
    def embed(texts):
        known: dict = {}
        return [hashed_vector(t, dim, known) for t in texts]
    return embed


def merge_sequence(chunks: list[str], target: int, dim: int = 128, joiner: str = " ",
                   revector: str = "sum", embedder=None):
    """Merge adjacent chunks until ``target`` remain.

    Returns a list of (first_index, last_index, text).  ``revector``: 'sum'
    (counts add: equal to re-embedding the joined text), 'mean' (length
    weighted), or 'embed' (call ``embedder`` on the joined text).
    """
    n = len(chunks)
    items = [[i, i, c] for i, c in enumerate(chunks)]
    if n <= target:
        return [tuple(x) for x in items]
    vec_of = embedder or (lambda ts: [hashed_vector(t, dim) for t in ts])
    vecs = [np.asarray(v, dtype=np.float64) for v in vec_of(chunks)]
    lens = [float(len(c)) for c in chunks]
    nxt = list(range(1, n)) + [-1]
    prv = [-1] + list(range(0, n - 1))
    alive = [True] * n
    version = [0] * n
    heap = [(-_cos(vecs[i], vecs[i + 1]), i, 0) for i in range(n - 1)]
    heapq.heapify(heap)
    count = n
    while count > target and heap:
        negsim, i, ver = heapq.heappop(heap)
        if not alive[i] or ver != version[i] or nxt[i] < 0:
            continue
        j = nxt[i]
        items[i][1] = items[j][1]
        items[i][2] = f"{items[i][2]}{joiner}{items[j][2]}"
        if revector == "sum":
            vecs[i] = vecs[i] + vecs[j]
        elif revector == "mean":
            vecs[i] = (vecs[i] * lens[i] + vecs[j] * lens[j]) / max(lens[i] + lens[j], 1.0)
        else:
            vecs[i] = np.asarray(vec_of([items[i][2]])[0], dtype=np.float64)
        lens[i] += lens[j]
        alive[j] = False
        nxt[i] = nxt[j]
        if nxt[j] >= 0:
            prv[nxt[j]] = i
        count -= 1
        version[i] += 1
        if nxt[i] >= 0:
            heapq.heappush(heap, (-_cos(vecs[i], vecs[nxt[i]]), i, version[i]))
        p = prv[i]
        if p >= 0:
            version[p] += 1
            heapq.heappush(heap, (-_cos(vecs[p], vecs[i]), p, version[p]))
    return [tuple(items[i]) for i in range(n) if alive[i]]


def merge_adjacent_chunks(chunks: DataFrame, target: int, dim: int = 128,
                          key: str = "doc_id", order: str = "chunk_no", text: str = "chunk",
                          joiner: str = " ", revector: str | None = None,
                          embedder=None) -> DataFrame:
    """(key, chunk_no, chunk) -> merged (key, chunk_no, first_chunk,
    last_chunk, chunk) with at most ``target`` chunks per document; the key
    keeps its name and type.

    ``embedder`` (a batch function ``list[str] -> vectors``) replaces the
    built-in hashed counts; a merged pair is then re-embedded with it
    (``revector='embed'``, the default with an embedder; 'sum' without one).
    """
    revector = revector or ("embed" if embedder else "sum")
    if target < 1:
        raise ValueError("target must be at least 1")
    if revector not in ("sum", "mean", "embed"):
        raise ValueError("revector is 'sum', 'mean' or 'embed'")
    if revector == "embed" and embedder is None:
        raise ValueError("revector='embed' needs an embedder")
    check_dim(dim)
    c = chunks.select(F.col(key).alias("doc_id"), F.col(order).cast("int").alias("chunk_no"), F.col(text).alias("chunk"))
    n = c.groupBy("doc_id").agg(F.count(F.lit(1)).alias("_n"))
    c = c.join(n, "doc_id")
    small = c.filter(F.col("_n") <= target).select(
        "doc_id", "chunk_no", F.col("chunk_no").alias("first_chunk"),
        F.col("chunk_no").alias("last_chunk"), "chunk")

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("chunk_no")
        ids = pdf["chunk_no"].tolist()
        merged = merge_sequence(pdf["chunk"].tolist(), target, dim, joiner, revector, embedder)
        doc = pdf["doc_id"].iloc[0]
        return pd.DataFrame({
            "doc_id": [doc] * len(merged),
            "chunk_no": list(range(len(merged))),
            "first_chunk": [ids[a] for a, _, _ in merged],
            "last_chunk": [ids[b] for _, b, _ in merged],
            "chunk": [t for _, _, t in merged],
        })

    big = (c.filter(F.col("_n") > target).drop("_n")
            .groupBy("doc_id").applyInPandas(run, T.StructType(
                [T.StructField("doc_id", chunks.schema[key].dataType), *MERGED_SCHEMA.fields[1:]])))
    return small.unionByName(big).withColumnRenamed("doc_id", key)
