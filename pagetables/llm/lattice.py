"""Subword lattice likelihood of whole documents (operator 1).

The pieces of an existing subword vocabulary span a lattice over each text;
every segmentation counts with the product of its pieces' unigram
probabilities, and a log-space forward recursion sums them.  No piece crosses
a word boundary (a word starts with U+2581), so a document's marginal
lattice likelihood is the product of its words' marginals and of one end
symbol (``score``), and each distinct word is scored once.

The vocabulary is never trained.  Its own scores give the first piece
probabilities; expected counts over the training documents' words
(forward-backward) re-estimate them.  A character that no piece covers costs
the bytes of its UTF-8 form.

Independent pieces spell frequent words too dearly, so a further column, ``mixed_score``,
gives each word two more arcs beside its segmentations: the word as a whole, as often as
training documents hold it, and the word as seen earlier in the document.
Both are Dirichlet priors around the lattice marginal (weights ``kinds`` of
the training words and ``REPEATS``), so ``mixed_score`` is again the log of a
normalised probability, with the document's own word distribution summed out.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagetables.llm import kernels as K
from pagetables.llm.tables import stored

CHUNK = 2 << 20       # bytes of text whose words are counted together before they are shuffled
VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
START = "▁"
LONGEST = 16           # code points of a piece
HOT = 1 << 18          # words with at least 1 / HOT of all tokens (so at most HOT) go to every task
BYTE_MASS = 1e-3       # probability of the 256 byte pieces together
PRIOR = 1000.0         # pseudo-counts of the vocabulary's own scores
REPEATS = 300.0        # weight, in words, of the corpus against a document's own words
WARM_ROUNDS = 6        # EM rounds over the hot words, before one over all words
CELLS = 1 << 21        # lattice edges held at a time

_U = np.uint64


def load_pieces(path: str = VOCABULARY) -> tuple[list[str], np.ndarray]:
    """Lower-case pieces of a sentencepiece file and their prior probabilities.

    A byte-pair vocabulary scores a piece by minus its merge rank; rank r is
    taken as a weight of 1 / (r + 10)."""
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces, weight = [], []
    for i in range(sp.get_piece_size()):
        if sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i):
            continue
        p = sp.id_to_piece(i)
        if len(p) <= LONGEST and START not in p[1:] and not any("A" <= c <= "Z" or c.isspace() for c in p):
            pieces.append(p)
            weight.append(1.0 / (10.0 - min(0.0, sp.get_score(i))))
    w = np.array(weight)
    return pieces, w / w.sum()


def _hash(cp: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` code points along the last axis."""
    p, inv = K._powers(cp.shape[-1] + 1)
    with np.errstate(over="ignore"):
        h = np.zeros((*cp.shape[:-1], cp.shape[-1] + 1), dtype=_U)
        np.cumsum((cp.astype(_U) + _U(1)) * p[:-1], axis=-1, out=h[..., 1:])
        return K.mix((h[..., size:] - h[..., :-size]) * inv[:cp.shape[-1] - size + 1], size)


class Lattice:
    """The vocabulary as a hash table, and the recursions over words of one length."""

    def __init__(self, pieces: list[str]):
        self.n = len(pieces)
        key = np.zeros(self.n + 1, dtype=_U)
        for size in range(1, LONGEST + 1):
            at = [i for i, p in enumerate(pieces) if len(p) == size]
            if at:
                cp = np.array([[ord(c) for c in pieces[i]] for i in at], dtype=np.uint32)
                key[at] = _hash(cp, size)[:, 0]
        self.key = key                    # the last entry stands for "no piece"
        self.first = np.full(1 << 19, self.n, dtype=np.int32)
        slot = (key[:-1] >> _U(45)).astype(np.int64)
        order = np.arange(self.n)[::-1]
        self.first[slot[order]] = order
        late = np.flatnonzero(self.first[slot] != np.arange(self.n))
        self.late, self.late_key = late, None
        o = np.argsort(key[late])
        self.late, self.late_key = late[o].astype(np.int32), key[late][o]
        self.late_bits = np.zeros(1 << 16, dtype=bool)
        self.late_bits[(self.late_key & _U(0xFFFF)).astype(np.int64)] = True

    def find(self, h: np.ndarray) -> np.ndarray:
        i = self.first[(h >> _U(45)).astype(np.int64)]
        miss = self.key[i] != h
        i[miss] = self.n
        if len(self.late):
            may = np.flatnonzero((miss & self.late_bits[(h & _U(0xFFFF)).astype(np.int64)]).reshape(-1))
            if len(may):
                v = h.reshape(-1)[may]
                at = np.minimum(np.searchsorted(self.late_key, v), len(self.late) - 1)
                ok = self.late_key[at] == v
                i.reshape(-1)[may[ok]] = self.late[at[ok]]
        return i

    def edges(self, cp: np.ndarray) -> np.ndarray:
        """``[words, start, size - 1]`` piece numbers, ``n`` where none."""
        w, n = cp.shape
        out = np.full((w, n, min(LONGEST, n)), self.n, dtype=np.int32)
        for size in range(1, out.shape[2] + 1):
            out[:, :n - size + 1, size - 1] = self.find(_hash(cp, size))
        return out

    def forward(self, cp: np.ndarray, edge: np.ndarray, logp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(alpha, log weight of each edge)``; alpha[:, j] sums all ways to spell j characters."""
        s = logp[edge]
        bare = edge[:, :, 0] == self.n
        if bare.any():                   # byte fallback of an uncovered character
            c = cp[bare]
            size = 1 + (c > 0x7F) + (c > 0x7FF) + (c > 0xFFFF)
            s[bare, 0] = size * math.log(BYTE_MASS / 256)
        w, n, m = s.shape
        alpha = np.full((w, n + 1), -np.inf)
        alpha[:, 0] = 0.0
        for j in range(1, n + 1):
            k = min(j, m)
            # pieces of size 1..k that end at j start at j-1..j-k
            v = alpha[:, j - k:j][:, ::-1] + s[:, np.arange(j - 1, j - k - 1, -1), np.arange(k)]
            top = v.max(axis=1)
            alpha[:, j] = top + np.log(np.exp(v - top[:, None]).sum(axis=1))
        return alpha, s

    def expected(self, cp: np.ndarray, edge: np.ndarray, logp: np.ndarray, count: np.ndarray) -> np.ndarray:
        """Expected piece counts of words that occur ``count`` times."""
        alpha, s = self.forward(cp, edge, logp)
        w, n, m = s.shape
        beta = np.full((w, n + 1), -np.inf)
        beta[:, n] = 0.0
        for i in range(n - 1, -1, -1):
            k = min(n - i, m)
            v = s[:, i, :k] + beta[:, i + 1:i + k + 1]
            top = v.max(axis=1)
            beta[:, i] = top + np.log(np.exp(v - top[:, None]).sum(axis=1))
        out = np.zeros(self.n + 1)
        total = alpha[:, n]
        for size in range(1, m + 1):
            e = edge[:, :n - size + 1, size - 1]
            has = e < self.n
            if has.any():
                v = alpha[:, :n - size + 1] + s[:, :n - size + 1, size - 1] + beta[:, size:] - total[:, None]
                out += np.bincount(e[has], weights=(np.exp(v) * count[:, None])[has], minlength=self.n + 1)
        return out[:-1]

    def by_length(self, words: list[str]):
        """``(positions, code points, edges)`` of words of one length, a bounded number at a time."""
        cp = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        size = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        first = np.cumsum(size) - size
        for n in np.unique(size):
            at = np.flatnonzero(size == n)
            step = max(1, CELLS // ((int(n) + 1) * LONGEST))
            for i in range(0, len(at), step):
                some = at[i:i + step]
                mat = np.empty((len(some), int(n) + 1), dtype=np.uint32)
                mat[:, 0] = ord(START)
                mat[:, 1:] = cp[first[some][:, None] + np.arange(n)]
                yield some, mat, self.edges(mat)

    def log10(self, words: list[str], logp: np.ndarray) -> np.ndarray:
        """log10 of the marginal probability of each word."""
        out = np.zeros(len(words))
        for at, mat, edge in self.by_length(words):
            out[at] = self.forward(mat, edge, logp)[0][:, -1]
        return out / math.log(10)


def _word_rows(batches):
    for b in batches:
        texts = K.text_column(b, "text")
        train = b.column(b.schema.get_field_index("train")).to_numpy(zero_copy_only=False)
        for i, j, data, off in K.chunks(texts, CHUNK):
            w = K.Words(data, off)
            if not len(w.start):
                continue
            h, at, inv = np.unique(w.hashes(), return_index=True, return_inverse=True)
            learned = np.repeat(train[i:j], w.per_doc)
            c = np.bincount(inv, weights=learned, minlength=len(h)).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(h.view(np.int64)), w.strings(at).cast(pa.string()), pa.array(c),
                 pa.array(np.bincount(inv).astype(np.int64))], names=["h", "word", "c", "n"])


def lattice_scores(docs: DataFrame, held_out: Column | None = None, vocabulary: str = VOCABULARY,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per input row ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``.

    ``score`` is the log10 of the lattice's marginal probability of the whole text: of all
    segmentations of all its words and one end (``lattice_score`` is the same number).
    ``mixed_score`` is that of a wider model in which a word may also come whole, as training
    documents hold it or as seen earlier in the text, the lattice being the prior of both;
    ``base_score`` that of an add-one unigram over words.  All learn from
    rows for which ``held_out`` (a Column of ``doc_id``) does not hold.  A null
    text is empty and has the end only.  Ids may be null or repeat: equal rows
    get equal scores.  Extra columns are ignored; an empty table gives no rows;
    without training rows the pieces keep the vocabulary's own probabilities.

    Word counts, and the scores of words, are joined to documents by word:
    words with at least 1 / 2**18 of all tokens (at most 2**18 words, whatever
    the input) are sent to every task, the others meet in a shuffle.  Words are
    joined by 64-bit hashes: two of n words share one with odds n * n / 2**65.
    """
    held = F.lit(False) if held_out is None else F.coalesce(held_out, F.lit(False))
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")) \
        .withColumn("train", ~held)
    words = stored(src.select("text", "train").mapInArrow(_word_rows, "h long, word string, c long, n long")
                   .groupBy("h", "word").agg(F.sum("c").alias("c"), F.sum("n").alias("n")), "words")
    ends = src.filter("train").count()
    total = words.agg(F.sum("c"), F.sum("n"), F.count(F.when(F.col("c") > 0, 1))).first()
    tokens, everything, kinds = (total[0] or 0) + ends, total[1] or 0, total[2] + (ends > 0)
    is_hot = F.col("n") * HOT >= everything

    pieces, prior = load_pieces(vocabulary)
    lat = Lattice(pieces)

    def log_probabilities(expected: np.ndarray) -> tuple[np.ndarray, float]:
        """Log probabilities of the pieces (and -inf for none), and of the end."""
        e = expected + PRIOR * prior
        mass = e.sum() + ends + 1.0
        return np.append(np.log(e * (1 - BYTE_MASS) / mass), -np.inf), math.log((ends + 1.0) * (1 - BYTE_MASS) / mass)

    def expectations(part: DataFrame, logp: np.ndarray) -> np.ndarray:
        def count(batches):
            out = np.zeros(lat.n)
            for b in batches:
                c = b.column(1).to_numpy().astype(np.float64)
                for at, mat, edge in lat.by_length(b.column(0).to_pylist()):
                    out += lat.expected(mat, edge, logp, c[at])
            i = np.flatnonzero(out)
            yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(out[i])], names=["piece", "e"])
        rows = part.filter("c > 0").select("word", "c").mapInArrow(count, "piece long, e double") \
            .groupBy("piece").agg(F.sum("e").alias("e")).collect()      # at most one row a piece
        out = np.zeros(lat.n)
        for r in rows:
            out[r["piece"]] = r["e"]
        return out

    logp, end = log_probabilities(np.zeros(lat.n))
    hot_words = words.filter(is_hot)
    if ends:
        hot_words = stored(hot_words, "hot")
        for _ in range(WARM_ROUNDS):
            logp, end = log_probabilities(expectations(hot_words, logp))
        logp, end = log_probabilities(expectations(words, logp))

    def corpus_weight(c, log_marginal):
        """Log of ``REPEATS`` times a word's probability under the training words and the lattice.
        The marginal of a long word has no double, its log has."""
        with np.errstate(divide="ignore"):
            both = np.logaddexp(np.log(c), math.log(max(1, kinds)) + log_marginal)
        return both + math.log(REPEATS) - math.log(tokens + max(1, kinds))

    def scored(batches):
        for b in batches:
            h, word, c = (b.column(i) for i in range(3))
            p = lat.log10(word.to_pylist(), logp) if b.num_rows else np.zeros(0)
            x = corpus_weight(c.to_numpy().astype(np.float64), p * math.log(10))
            yield pa.RecordBatch.from_arrays([h, c, pa.array(p), pa.array(x)], names=["h", "c", "p", "x"])
    score_schema = "h long, c long, p double, x double"
    hot = hot_words.select("h", "word", "c").mapInArrow(scored, score_schema).toPandas()    # at most HOT rows
    hot = hot.sort_values("h")
    sent = docs.sparkSession.sparkContext.broadcast(tuple(hot[k].to_numpy() for k in ("h", "c", "p", "x")))

    def per_doc(batches):
        hot_h, hot_c, hot_p, hot_x = sent.value
        hot_known, hot_base = (hot_c > 0).astype(np.float64), np.log10(hot_c + 1.0)
        pick = np.append(hot_h, np.int64(0))
        for b in batches:
            texts = K.text_column(b, "text")
            ids = b.column(b.schema.get_field_index("doc_id"))
            for i, j, data, off in K.chunks(texts, CHUNK):
                n_docs = j - i
                w = K.Words(data, off)
                h, doc = w.hashes(), w.doc()
                # which text of the id: a hash of its words in order and of its bytes' number
                with np.errstate(over="ignore"):
                    order = K.mix(h ^ K.mix(np.arange(len(h), dtype=_U) - w.first[doc].astype(_U)), 5)
                    cum = np.zeros(len(h) + 1, dtype=_U)
                    np.cumsum(order, out=cum[1:])
                    tag = K.mix(cum[w.first[1:]] - cum[w.first[:-1]] + np.diff(off).astype(_U), 6).view(np.int64)
                h = h.view(np.int64)
                o = np.argsort(h)
                o = o[np.argsort(doc[o].astype(np.uint16) if n_docs < 65536 else doc[o], kind="stable")]
                new = np.ones(len(o), dtype=bool)
                new[1:] = (h[o][1:] != h[o][:-1]) | (doc[o][1:] != doc[o][:-1])
                first = np.flatnonzero(new)
                who, word = doc[o][first], h[o][first]
                times = np.diff(np.append(first, len(o)))
                at = np.searchsorted(hot_h, word)
                is_hot = (pick[at] == word) & (at < len(hot_h))
                a, d, t = at[is_hot], who[is_hot], times[is_hot].astype(np.float64)

                def total(v):
                    return np.bincount(d, weights=v, minlength=n_docs) if len(a) else np.zeros(n_docs)
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(i, n_docs), pa.array(tag), pa.nulls(n_docs, pa.int64()), pa.array(w.per_doc + 1),
                     pa.array(total(hot_known[a] * t).astype(np.int64)), pa.array(total(hot_base[a] * t)),
                     pa.array(total(hot_p[a] * t)), pa.array(total(_log10_rising(np.exp(hot_x[a]), t, hot_x[a])))], names=names)
                if not is_hot.all():
                    who, word, times = who[~is_hot], word[~is_hot], times[~is_hot]
                    zero = pa.nulls(len(who), pa.float64())
                    yield pa.RecordBatch.from_arrays(
                        [ids.slice(i, n_docs).take(pa.array(who)), pa.array(tag[who]), pa.array(word), pa.array(times),
                         pa.nulls(len(who), pa.int64()), zero, zero, zero], names=names)
    names = ["doc_id", "tag", "h", "n", "known", "base", "p", "s"]
    rows = src.select("doc_id", "text").mapInArrow(
        per_doc, "doc_id long, tag long, h long, n long, known long, base double, p double, s double")
    rows = stored(rows, "tokens")
    sums = ["n", "known", "base", "p", "s"]
    whole = rows.filter("h is null").select("doc_id", "tag", F.lit(1).cast("long").alias("m"), *sums)
    rare = rows.filter("h is not null").select("doc_id", "tag", "h", "n")
    lookup = words.filter(~is_hot).select("h", "word", "c").mapInArrow(scored, score_schema)
    zero = F.lit(0).cast("long")
    met = rare.join(lookup, "h").select(
        "doc_id", "tag", zero.alias("m"), zero.alias("z"), F.when(F.col("c") > 0, F.col("n")).otherwise(zero).alias("known"),
        (F.col("n") * F.log10(F.col("c") + 1.0)).alias("base"), (F.col("n") * F.col("p")).alias("p"),
        _rising_column(F.col("x"), F.col("n")).alias("s")).withColumnRenamed("z", "n")
    per = whole.unionByName(met).groupBy("doc_id", "tag").agg(*[F.sum(c).alias(c) for c in ["m", *sums]])
    one = per.select("doc_id", "m", *[(F.col(c) / F.col("m")).alias(c) for c in sums])
    out = one.withColumn("_", F.explode(F.sequence(F.lit(1).cast("long"), F.col("m"))))
    log_all = math.log10(tokens + 1.0 * (kinds + 1))
    # the end is a token too, once a document; n counts it
    end_x = float(corpus_weight(float(ends), end))
    return out.select(
        "doc_id", held.alias("held_out"), F.col("n").cast("long").alias("n_tokens"),
        (F.col("known") + (1 if ends else 0)).cast("long").alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("base") + math.log10(ends + 1.0) - F.col("n") * log_all).alias("base_score"),
        (F.col("p") + end / math.log(10)).alias("score"), (F.col("p") + end / math.log(10)).alias("lattice_score"),
        (F.col("s") + end_x / math.log(10) - _rising_column(F.lit(math.log(REPEATS)), F.col("n"))).alias("mixed_score"))


def _log_gamma(z, log):
    """Stirling's series after a shift by six; ``z`` is at least 1."""
    y = z + 6.0
    shift = log(z) + log(z + 1.0) + log(z + 2.0) + log(z + 3.0) + log(z + 4.0) + log(z + 5.0)
    return (y - 0.5) * log(y) - y + 0.5 * math.log(2 * math.pi) + 1.0 / (y * 12.0) - 1.0 / (y * y * y * 360.0) \
        + 1.0 / (y * y * y * y * y * 1260.0) - shift


def _log10_rising(x: np.ndarray, n: np.ndarray, log_x: np.ndarray | None = None) -> np.ndarray:
    """log10 of x (x + 1) ... (x + n - 1); ``log_x`` where x itself may be too small for a double."""
    more = np.flatnonzero(n > 1)
    out = np.log(x) if log_x is None else log_x.copy()
    out[more] += _log_gamma(x[more] + n[more], np.log) - _log_gamma(x[more] + 1.0, np.log)
    return out / math.log(10)


def _rising_column(log_x: Column, n: Column) -> Column:
    """The same on Columns, from the log of x."""
    x = F.exp(log_x)
    more = _log_gamma(x + n, F.log) - _log_gamma(x + F.lit(1.0), F.log)
    return (log_x + F.when(n > 1, more).otherwise(0.0)) / math.log(10)
