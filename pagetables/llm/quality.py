"""Quality classifier: random Fourier features, ridge, isotonic calibration (operator 3).

Document statistics (character classes, words, repetition, lines) are
standardised and mapped to random Fourier features, which approximate a
Gaussian kernel.  Partitions sum their normal equations; the ridge solution
is one small linear system.  An isotonic fit on other labelled documents
turns its score into a probability.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagetables.llm import kernels as K
from pagetables.llm.tables import scratch, stored

FEATURES = 256        # random Fourier features
WIDTH = 0.25          # 1 / bandwidth of the kernel, per standardised statistic
RIDGE = 1.0
BINS = 512            # score bins of the isotonic fit
TRAIN_ROWS = 200_000  # labelled rows that the fit may use (chosen by a hash of the id)
FIT_PARTITIONS = 16   # partial normal equations that reach the driver, 0.5 MB each
CLIP = 6.0            # standardised statistics are cut here

# Character classes by byte; bytes over 127 are letters but for U+0080-U+00BF
_CLASS = np.zeros(256, dtype=np.int64)
for _c, _s in ((1, range(65, 91)), (2, range(97, 123)), (3, range(48, 58)), (4, (9, 11, 12, 13, 32)),
               (5, (10,)), (6, b".,;:?!'\"()-"), (7, range(128, 256))):
    _CLASS[list(_s)] = _c
N_CLASS = 8           # class 0: every other symbol
NAMES = (["log_bytes", "log_words", "word_len", "line_words"] + [f"class_{i}" for i in range(N_CLASS)]
         + ["bang", "pipe", "caps_words", "symbol_end", "one_byte_words", "distinct_words", "top_word",
            "same_as_last", "distinct_lines", "upper_high", "long_words"])
D = len(NAMES)


def _per_doc(flag: np.ndarray, first: np.ndarray) -> np.ndarray:
    c = np.zeros(len(flag) + 1, dtype=np.float64)
    np.cumsum(flag, out=c[1:])
    return c[first[1:]] - c[first[:-1]]


def statistics(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """``[documents, D]`` statistics of a chunk; an empty text has zeros only."""
    n_docs = len(off) - 1
    w = K.Words(data, off)
    n_bytes = np.diff(off).astype(np.float64)
    n_words = w.per_doc.astype(np.float64)
    per_byte, per_word = 1.0 / np.maximum(n_bytes, 1), 1.0 / np.maximum(n_words, 1)
    kind = _CLASS[data]
    doc_of_byte = np.repeat(np.arange(n_docs), np.diff(off))
    classes = np.bincount(doc_of_byte * N_CLASS + kind, minlength=n_docs * N_CLASS).reshape(n_docs, N_CLASS)
    size = (w.end - w.start).astype(np.float64)
    cum_upper = np.zeros(len(data) + 1, dtype=np.int64)
    upper = kind == 1
    high = np.zeros(len(data), dtype=bool)       # A-circumflex to THORN in UTF-8: C3 80-9E
    high[1:] = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E)
    np.cumsum(upper | high, out=cum_upper[1:])
    cum_lower = np.zeros(len(data) + 1, dtype=np.int64)
    np.cumsum(kind == 2, out=cum_lower[1:])
    ups, lows = cum_upper[w.end] - cum_upper[w.start], cum_lower[w.end] - cum_lower[w.start]
    last = kind[w.end - 1] if len(w.end) else np.zeros(0, np.int64)
    h, doc = w.hashes(), w.doc()
    same = np.zeros(len(h), dtype=bool)
    same[1:] = (h[1:] == h[:-1]) & (doc[1:] == doc[:-1])
    distinct, top = np.zeros(n_docs), np.zeros(n_docs)
    for d in range(n_docs):
        if n_words[d]:
            s = np.sort(h[w.first[d]:w.first[d + 1]])
            cut = np.flatnonzero(np.r_[True, s[1:] != s[:-1], True])
            distinct[d], top[d] = len(cut) - 1, np.diff(cut).max()
    # lines: a hash of the bytes from one line end to the next
    ends = np.zeros(len(data) + 1, dtype=bool)
    ends[off] = True
    ends[1:] |= data == 10
    at = np.flatnonzero(ends)
    line_first = np.searchsorted(at[:-1], off) if len(at) > 1 else np.zeros(n_docs + 1, np.int64)
    n_lines = np.diff(line_first).astype(np.float64)
    lines = np.zeros(n_docs)
    if len(at) > 1:
        p, inv = K._powers(len(data) + 1)
        with np.errstate(over="ignore"):
            c = np.zeros(len(data) + 1, dtype=np.uint64)
            np.cumsum((w.low.astype(np.uint64) + np.uint64(1)) * p[:-1], out=c[1:])
            lh = (c[at[1:]] - c[at[:-1]]) * inv[at[:-1]]
        ld = np.repeat(np.arange(n_docs), np.diff(line_first))
        o = np.lexsort((lh, ld))
        new = np.ones(len(o), dtype=bool)
        new[1:] = (lh[o][1:] != lh[o][:-1]) | (ld[o][1:] != ld[o][:-1])
        lines = np.bincount(ld[o][new], minlength=n_docs).astype(np.float64)
    out = np.empty((n_docs, D))
    out[:, 0], out[:, 1] = np.log1p(n_bytes), np.log1p(n_words)
    out[:, 2] = np.log1p(_per_doc(size, w.first) * per_word)
    out[:, 3] = np.log1p(n_words / np.maximum(n_lines, 1))
    out[:, 4:4 + N_CLASS] = classes * per_byte[:, None]
    k = 4 + N_CLASS
    byte_first = off
    out[:, k] = _per_doc(data == 33, byte_first) * per_byte
    out[:, k + 1] = _per_doc(data == 124, byte_first) * per_byte
    out[:, k + 2] = _per_doc((ups > 1) & (lows == 0), w.first) * per_word
    out[:, k + 3] = _per_doc(last == 0, w.first) * per_word
    out[:, k + 4] = _per_doc(size == 1, w.first) * per_word
    out[:, k + 5] = distinct * per_word
    out[:, k + 6] = top * per_word
    out[:, k + 7] = _per_doc(same, w.first) * per_word
    out[:, k + 8] = lines / np.maximum(n_lines, 1)
    out[:, k + 9] = _per_doc(high, byte_first) * per_byte
    out[:, k + 10] = _per_doc(size > 30, w.first) * per_word
    out[n_bytes == 0] = 0.0
    return out


def _stat_rows(batches):
    for b in batches:
        texts = K.text_column(b, "text")
        ids = b.column(b.schema.get_field_index("doc_id"))
        for i, j, data, off in K.chunks(texts):
            x = statistics(data, off)
            yield pa.RecordBatch.from_arrays(
                [ids.slice(i, j - i), pa.FixedSizeListArray.from_arrays(pa.array(x.reshape(-1)), D)
                 .cast(pa.list_(pa.float64()))], names=["doc_id", "x"])


class Model:
    """Standardisation, random features, ridge weights and the isotonic steps."""

    def __init__(self, mean, scale, weights=None, knots=None, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.mean, self.scale, self.weights, self.knots = mean, scale, weights, knots
        self.w = rng.normal(0.0, WIDTH, size=(D, FEATURES))
        self.b = rng.uniform(0.0, 2 * np.pi, size=FEATURES)

    def features(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -CLIP, CLIP)
        z = np.sqrt(2.0 / FEATURES) * np.cos(z @ self.w + self.b)
        return np.hstack([z, np.ones((len(z), 1))])

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.features(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        at, p = self.knots
        return np.interp(self.raw(x), at, p)


def _matrix(col) -> np.ndarray:
    return col.flatten().to_numpy(zero_copy_only=False).reshape(-1, D)


def isotonic(at: np.ndarray, n: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators over bins (position, rows, positives)."""
    pools: list[list[float]] = []
    for a, c, s in zip(at, n, y):
        pools.append([a * c, c, s])
        while len(pools) > 1 and pools[-2][2] * pools[-1][1] >= pools[-1][2] * pools[-2][1]:
            top = pools.pop()
            pools[-1] = [u + v for u, v in zip(pools[-1], top)]
    p = np.array(pools).reshape(-1, 3)
    return p[:, 0] / p[:, 1], p[:, 2] / p[:, 1]


def fit(train: DataFrame) -> Model:
    """A model from ``(doc_id, x, y)`` rows, y 0.0 or 1.0.

    A quarter of the rows (by a hash of the id) calibrates, the others fit.
    Without rows, or with one class only, every score is the share of ones
    (0.5 without rows)."""
    # written once, as it is read three times
    train = stored(train.withColumn("cal", F.pmod(F.xxhash64("doc_id", F.lit("calibrate")), F.lit(4)) == 0)
                   .repartition(FIT_PARTITIONS, "doc_id"), "train")

    def moments(batches):
        s = np.zeros((2, D))
        n, y = 0, 0.0
        for b in batches:
            x = _matrix(b.column(0))
            s += [x.sum(axis=0), (x * x).sum(axis=0)]
            n, y = n + len(x), y + float(b.column(1).to_numpy().sum())
        yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([y]), pa.array([s.tobytes()])], names=["n", "y", "s"])
    parts = train.select("x", "y").mapInArrow(moments, "n long, y double, s binary").collect()
    n, y = sum(p["n"] for p in parts), sum(p["y"] for p in parts)
    if n == 0 or y in (0, n):
        share = y / n if n else 0.5
        return Model(np.zeros(D), np.ones(D), np.zeros(FEATURES + 1), (np.array([0.0]), np.array([share])))
    s = sum(np.frombuffer(p["s"]).reshape(2, D) for p in parts) / n
    model = Model(s[0], np.sqrt(np.maximum(s[1] - s[0] ** 2, 0)) + 1e-6)
    f = FEATURES + 1

    def normal(batches):
        a, v = np.zeros((f, f)), np.zeros(f)
        for b in batches:
            keep = ~b.column(2).to_numpy(zero_copy_only=False)
            if keep.any():
                z = model.features(_matrix(b.column(0))[keep])
                a += z.T @ z
                v += z.T @ (b.column(1).to_numpy()[keep])
        yield pa.RecordBatch.from_arrays([pa.array([a.tobytes()]), pa.array([v.tobytes()])], names=["a", "v"])
    parts = train.select("x", "y", "cal").mapInArrow(normal, "a binary, v binary").collect()
    a = sum(np.frombuffer(p["a"]) for p in parts).reshape(f, f)
    v = sum(np.frombuffer(p["v"]) for p in parts)
    penalty = np.full(f, RIDGE)
    penalty[-1] = 1e-6
    model.weights = np.linalg.solve(a + np.diag(penalty), v)

    def binned(batches):
        t = np.zeros((3, BINS))
        for b in batches:
            keep = b.column(2).to_numpy(zero_copy_only=False)
            if keep.any():
                r = model.raw(_matrix(b.column(0))[keep])
                i = np.clip((r + 0.5) * (BINS / 2), 0, BINS - 1).astype(np.int64)
                t += [np.bincount(i, weights=u, minlength=BINS) for u in (r, np.ones(len(r)), b.column(1).to_numpy()[keep])]
        yield pa.RecordBatch.from_arrays([pa.array([t.tobytes()])], names=["t"])
    t = sum(np.frombuffer(p["t"]).reshape(3, BINS) for p in
            train.select("x", "y", "cal").mapInArrow(binned, "t binary").collect())
    has = t[1] > 0
    model.knots = isotonic(t[0][has] / t[1][has], t[1][has], t[2][has]) if has.any() else (
        np.array([0.0, 1.0]), np.array([0.0, 1.0]))
    return model


def train(docs: DataFrame, labels: DataFrame, held_out=None, train_rows: int = TRAIN_ROWS,
          id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, Model]:
    """Statistics ``(doc_id, x)`` of every row, and the model fitted on the labelled ones."""
    x = stored(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
               .mapInArrow(_stat_rows, "doc_id long, x array<double>"), "statistics")
    marks = labels.filter("quality is not null").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("double").alias("y"))
    if held_out is not None:
        marks = marks.filter(~F.coalesce(held_out, F.lit(False)))
    share = min(1.0, train_rows / max(1, marks.count()))
    if share < 1.0:
        marks = marks.filter(F.pmod(F.xxhash64("doc_id", F.lit("train")), F.lit(1 << 20)) < int(share * (1 << 20)))
    return x, fit(x.join(marks, "doc_id"))


def score(docs: DataFrame, labels: DataFrame, held_out=None, train_rows: int = TRAIN_ROWS,
          id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row of ``docs``.

    ``labels`` is ``(doc_id, quality)``; ids for which ``held_out`` (a Column of
    ``doc_id``) holds are not learned from, nor are null labels.  Where an id
    has several labels or texts, each pair is a training row.  At most about
    ``train_rows`` labelled rows, chosen by a hash of the id, are fitted; every
    row is scored on its whole text.  A null text is an empty one (all
    statistics 0).  Repeated rows each get the same score.  Extra columns are
    ignored; an empty table gives no rows.
    """
    x, model = train(docs, labels, held_out, train_rows, id_col, text_col)

    def scored(batches):
        for b in batches:
            p = model.score(_matrix(b.column(1))) if b.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.clip(p, 0.0, 1.0))], names=["doc_id", "score"])
    held = F.lit(False) if held_out is None else F.coalesce(held_out, F.lit(False))
    out = x.mapInArrow(scored, "doc_id long, score double")
    return out.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep(docs: DataFrame, labels: DataFrame, at_least: float = 0.5, train_rows: int = TRAIN_ROWS,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, whose score is ``at_least`` that.

    The filter reads the texts where they are: nothing but statistics is shuffled.
    A null text is an empty one, scored like any other; null ids and repeated rows are
    judged by their texts, long ones whole; an empty table gives no rows.  Without labels
    every score is 0.5, so all rows stay at the default."""
    with scratch(docs.sparkSession):        # the model outlives its tables
        _x, model = train(docs, labels, None, train_rows, id_col, text_col)

    def good(batches):
        for b in batches:
            texts = K.text_column(b, text_col)
            ok = [model.score(statistics(data, off)) >= at_least for _i, _j, data, off in K.chunks(texts)]
            if ok:
                yield b.filter(pa.array(np.concatenate(ok)))
    # the row's own columns go through the filter, whatever their names
    return docs.mapInArrow(good, docs.schema)
