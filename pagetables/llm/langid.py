"""Language identification (operator 10): sparse multinomial logistic regression
on TF-IDF character n-grams, follow-the-regularised-leader with an elastic
net, then temperature calibration.

Texts are lower-cased; every run of characters that are no letters is one
space; n-grams of 1 to 3 characters are hashed into ``DIMS`` features.
Document frequencies come from all training documents.  The weights are fitted
on a bounded sample of them: tasks run the leader over their rows from common
accumulators, which are averaged after each epoch.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagetables.llm import kernels as K
from pagetables.llm.tables import stored

DIMS = 1 << 15
SIZES = (1, 2, 3)
TRAIN_ROWS = 6_000     # about so many training documents fit the weights (by a hash of the id and text)
TASKS = 6              # tasks of an epoch; their accumulators (1 MB a class) reach the driver
EPOCHS = 4
ALPHA, BETA = 0.5, 1.0     # step size of the leader
L1, L2 = 1e-4, 1e-4        # elastic net
CALIBRATION = 5            # one sampled document in so many sets the temperature
DOUBT = 0.01               # share of each calibration label spread over all classes (so that a
                           # separable sample doesn't drive the temperature to zero)

_U = np.uint64
_LETTER = np.zeros(0x110001, dtype=bool)


def _letters() -> np.ndarray:
    """Which code points are letters (built once a process)."""
    if not _LETTER[97]:
        _LETTER[:0x110000] = [chr(c).isalpha() for c in range(0x110000)]
    return _LETTER


def grams(text: str) -> tuple[np.ndarray, bool]:
    """Hashed n-grams of a whole text, and whether it has a letter."""
    cp = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    ok = _letters()[cp]
    if not ok.any():
        return np.zeros(0, np.int64), False
    c = np.where(ok, cp, 32).astype(_U)
    keep = np.ones(len(c), dtype=bool)
    keep[1:] = ok[1:] | ok[:-1]                  # one space for a run of others
    c = np.concatenate([[_U(32)], c[keep], [_U(32)]])
    out = []
    with np.errstate(over="ignore"):
        h = np.zeros(len(c), dtype=_U)
        for n in range(1, max(SIZES) + 1):
            h = (h[:len(c) - n + 1] * _U(0x9E3779B97F4A7C15)) ^ ((c[n - 1:] + _U(n)) * _U(0xBF58476D1CE4E5B9))
            h ^= h >> _U(29)
            if n in SIZES:
                out.append((h * _U(0x94D049BB133111EB)) >> _U(64 - 15))
    return np.concatenate(out).astype(np.int64), True


def _texts(batch: pa.RecordBatch, column: int):
    col = batch.column(column)
    for i in range(len(col)):
        yield i, col[i].as_py() or ""


def _frequencies(batches):
    df, n = np.zeros(DIMS), 0
    seen = np.zeros(DIMS, dtype=bool)
    for b in batches:
        for _i, t in _texts(b, 0):
            g, any_letter = grams(t)
            n += 1
            if any_letter:
                seen[g] = True
                df += seen
                seen[g] = False
    at = np.flatnonzero(df)
    yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), pa.array(np.append(df[at], n))], names=["g", "df"])


class Model:
    def __init__(self, classes: list[str], idf: np.ndarray, weights=None, bias=None, temperature: float = 1.0):
        self.classes, self.idf, self.weights, self.bias, self.temperature = classes, idf, weights, bias, temperature

    def vector(self, g: np.ndarray) -> np.ndarray:
        x = np.bincount(g, minlength=DIMS) * self.idf
        return x / (math.sqrt(float(x @ x)) or 1.0)

    def logits(self, g: np.ndarray) -> np.ndarray:
        return self.vector(g) @ self.weights + self.bias


def softmax(v: np.ndarray) -> np.ndarray:
    e = np.exp(v - v.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def leader_weights(z: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The leader's closed form: 0 inside the L1 ball, shrunk by L2 and the adaptive step outside."""
    return np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2))


def _epoch(rows, z: np.ndarray, n: np.ndarray) -> None:
    """One pass over ``(index, value, class)`` rows; the accumulators change in place.  The last feature is the bias."""
    for idx, val, y in rows:
        zi, ni = z[idx], n[idx]
        w = leader_weights(zi, ni)
        p = softmax(val @ w)
        p[y] -= 1.0
        g = val[:, None] * p[None, :]
        s = (np.sqrt(ni + g * g) - np.sqrt(ni)) / ALPHA
        z[idx] = zi + g - s * w
        n[idx] = ni + g * g


def fit(train: DataFrame, train_rows: int = TRAIN_ROWS) -> Model | None:
    """A model from ``(doc_id, text, lang)`` rows; ``None`` without rows."""
    rows = train.select("text").mapInArrow(_frequencies, "g long, df double").groupBy("g") \
        .agg(F.sum("df").alias("df")).collect()            # at most DIMS + 1 rows
    df = {r["g"]: r["df"] for r in rows}
    total = df.pop(-1, 0.0)
    if not total:
        return None
    idf = np.full(DIMS, math.log(1.0 + total))
    for g, v in df.items():
        idf[g] = math.log((1.0 + total) / (1.0 + v)) + 1.0
    classes = sorted(r["lang"] for r in train.select("lang").distinct().collect())
    model = Model(classes, idf, np.zeros((DIMS, len(classes))), np.zeros(len(classes)))
    number = {c: i for i, c in enumerate(classes)}
    share = min(1.0, train_rows / total)
    order = F.xxhash64("doc_id", "text")
    some = train if share == 1.0 else train.filter(F.pmod(order, F.lit(1 << 20)) < int(share * (1 << 20)))

    def vectors(batches):
        for b in batches:
            for i, t in _texts(b, 0):
                g, any_letter = grams(t)
                if any_letter:
                    x = model.vector(g)
                    at = np.flatnonzero(x)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([np.append(at, DIMS).astype(np.int32)]), pa.array([np.append(x[at], 1.0)]),
                         pa.array([number[b.column(1)[i].as_py()]], pa.int32()), b.column(2).slice(i, 1)],
                        names=["idx", "val", "y", "o"])
    sample = some.select("text", "lang", order.alias("o")).mapInArrow(
        vectors, "idx array<int>, val array<double>, y int, o long")
    sample = stored(sample.repartition(TASKS, "o").sortWithinPartitions("o"), "vectors")
    fitted = sample.filter(F.pmod("o", F.lit(CALIBRATION)) != 0).coalesce(TASKS)
    shape = (DIMS + 1, len(classes))
    z, n = np.zeros(shape), np.zeros(shape)
    for _ in range(EPOCHS):
        z0, n0 = z, n

        def epoch(batches):
            z, n = z0.copy(), n0.copy()
            for b in batches:
                _epoch(((b.column(0)[i].values.to_numpy(), b.column(1)[i].values.to_numpy(), b.column(2)[i].as_py())
                        for i in range(b.num_rows)), z, n)
            yield pa.RecordBatch.from_arrays([pa.array([z.tobytes()]), pa.array([n.tobytes()])], names=["z", "n"])
        z, n, parts = np.zeros(shape), np.zeros(shape), 0
        for r in fitted.select("idx", "val", "y").mapInArrow(epoch, "z binary, n binary").toLocalIterator():
            z += np.frombuffer(r["z"]).reshape(shape)
            n += np.frombuffer(r["n"]).reshape(shape)
            parts += 1
        z, n = z / max(1, parts), n / max(1, parts)
    w = leader_weights(z, n)
    model.weights, model.bias = w[:-1], w[-1]

    def raw(batches):
        for b in batches:
            out = [b.column(1)[i].values.to_numpy() @ w[b.column(0)[i].values.to_numpy()] for i in range(b.num_rows)]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.list_(pa.float64())), b.column(2)], names=["v", "y"])
    held = sample.filter(F.pmod("o", F.lit(CALIBRATION)) == 0).select("idx", "val", "y") \
        .mapInArrow(raw, "v array<double>, y int").collect()     # about train_rows / CALIBRATION rows
    if held:
        v, y = np.array([r["v"] for r in held]), np.array([r["y"] for r in held])

        def loss(t):
            log_p = np.log(np.maximum(softmax(v / t), 1e-12))
            return -((1 - DOUBT) * log_p[np.arange(len(y)), y] + DOUBT * log_p.mean(axis=1)).mean()
        model.temperature = min((0.02 * 1.15 ** k for k in range(40)), key=loss)
    return model


def identify(docs: DataFrame, held_out: Column | None = None, train_rows: int = TRAIN_ROWS,
             id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Per input row ``doc_id, held_out, lang_pred, score``.

    Learns from rows with a language for which ``held_out`` (a Column of
    ``doc_id``) does not hold.  A null text, or one without a letter, is
    ``und`` with score 0; so is everything if there is nothing to learn from.
    ``score`` is the calibrated probability of ``lang_pred``; of equal
    probabilities the first language in code point order wins.  Repeated rows
    get equal results.  Extra columns are ignored; an empty table gives no
    rows.  Whole texts are read; a task holds one text's n-grams at a time.
    """
    held = F.lit(False) if held_out is None else F.coalesce(held_out, F.lit(False))
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                      F.col(lang_col).cast("string").alias("lang"))
    model = fit(src.filter(~held & F.col("lang").isNotNull()).select("doc_id", "text", "lang"), train_rows)

    def predict(batches):
        for b in batches:
            lang, score = ["und"] * b.num_rows, np.zeros(b.num_rows)
            if model is not None:
                for i, t in _texts(b, 1):
                    g, any_letter = grams(t)
                    if any_letter:
                        p = softmax(model.logits(g) / model.temperature)
                        k = int(p.argmax())
                        lang[i], score[i] = model.classes[k], p[k]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(lang, pa.string()), pa.array(score)],
                                             names=["doc_id", "lang_pred", "score"])
    out = src.select("doc_id", "text").mapInArrow(predict, "doc_id long, lang_pred string, score double")
    return out.select("doc_id", held.alias("held_out"), "lang_pred", "score")
