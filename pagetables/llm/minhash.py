"""MinHash near-duplicates by a multi-index Hamming join (operator 7).

A document's set is its distinct 5-word shingles.  Its signature is
``SYMBOLS`` b-bit MinHash values; the distance of two signatures is the number
of values that differ.  The signature is split into ``CHUNKS`` chunks of
``WIDTH`` values.  By the pigeonhole principle two signatures at a distance of
at most ``2 * CHUNKS - 1`` have a chunk with at most one differing value, so
each chunk enumerates its single-error forms (one value left out): such a
pair always meets under one of the ``SYMBOLS`` keys.  Pairs that meet are
confirmed on full sets.

Copies are folded first (one class per distinct set).  Inside a bucket no
all-pairs list is made.  Members are first compared with a few leaders of theirs.  Then a class
that met a large component without joining it is compared with all of that
component, block by block, by counting shared shingles in an inverted index;
only links come out.  Members of small components that are still apart meet
likewise in large buckets, and in pairs of near signatures in small ones.

What can be missed: a pair at a similarity of exactly 0.75 shares no key with
odds of 6e-6, and pairs that met are compared on full sets only up to a signature
distance of ``FARTHEST``, which such a pair exceeds with odds of 2e-9.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from pagetables.llm import kernels as K
from pagetables.llm.graph import components
from pagetables.llm.tables import among, forget, row_hash, scratch, spare, split, stored

BITS = 16             # b: bits kept of each MinHash value
WIDTH = 5             # values in a chunk
CHUNKS = 12
SYMBOLS = WIDTH * CHUNKS
GUARANTEED = 2 * CHUNKS - 1   # signature distance up to which a pair always meets
#: Pairs that meet at a larger distance than this are not compared on sets.  At similarity
#: 0.75 the distance is binomial(60, 1/4): over 36 with odds of 2e-9 (larger similarities: less).
FARTHEST = 36
LEADERS = 4           # leaders that a class is compared with first
LARGE = 16            # classes from which a component is compared in blocks
BLOCK = 256           # classes of a large component in one block
ASKED = 512           # classes compared with a block in one task
SMALL_BUCKET = 32     # members of small components up to which a bucket lists its near pairs
MEMBERS = 512         # members of a block of a larger bucket; two blocks meet in a task

_ODD = K.mix(np.arange(SYMBOLS, dtype=np.uint64), 11) | np.uint64(1)
_XOR = K.mix(np.arange(SYMBOLS, dtype=np.uint64), 12)


def _signatures(h: np.ndarray, count: np.ndarray) -> np.ndarray:
    """b-bit MinHash values ``[documents with a set, SYMBOLS]``."""
    have = count[count > 0]
    first = np.cumsum(have) - have
    low = np.empty((SYMBOLS, len(have)), dtype=np.uint64)
    with np.errstate(over="ignore"):
        for j in range(SYMBOLS):
            low[j] = np.minimum.reduceat((h ^ _XOR[j]) * _ODD[j], first) if len(have) else 0
    return np.ascontiguousarray((K.mix(low, 13) >> np.uint64(64 - BITS)).astype(np.uint16).T)


def _sets(batch: pa.RecordBatch):
    texts = K.text_column(batch, "text")
    for i, j, data, off in K.chunks(texts):
        h, doc = K.shingles(K.Words(data, off))
        u, count = K.unique_per_doc(h, doc, j - i)
        yield i, j, u, count


def _class_ids(u: np.ndarray, count: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each non-empty set."""
    have = count[count > 0]
    if not len(have):
        return np.zeros(0, np.int64)
    with np.errstate(over="ignore"):
        s = np.add.reduceat(K.mix(u, 14), np.cumsum(have) - have)
    return K.mix(s ^ K.mix(have.astype(np.uint64), 15), 16).view(np.int64)


def _sketch(batches):
    for b in batches:
        at = b.schema.get_field_index("text_hash")
        for i, j, u, count in _sets(b):
            has = count > 0
            cid = np.zeros(j - i, dtype=np.int64)
            cid[has] = _class_ids(u, count)
            sig = np.zeros((j - i, SYMBOLS), dtype=np.uint16)
            sig[has] = _signatures(u, count)
            packed = pa.Array.from_buffers(
                pa.binary(2 * SYMBOLS), j - i, [None, pa.py_buffer(sig.tobytes())])
            yield pa.RecordBatch.from_arrays(
                [b.column(b.schema.get_field_index("doc_id")).slice(i, j - i), pa.array(count),
                 pa.array(cid, mask=~has), packed.cast(pa.binary()), b.column(at).slice(i, j - i)],
                names=["doc_id", "n_shingles", "cid", "sig", "text_hash"])


def _set_rows(batches):
    for b in batches:
        for _i, _j, u, count in _sets(b):
            has = count > 0
            off = np.zeros(int(has.sum()) + 1, dtype=np.int32)
            np.cumsum(count[has], out=off[1:])
            yield pa.RecordBatch.from_arrays(
                [pa.array(_class_ids(u, count)),
                 pa.ListArray.from_arrays(pa.array(off), pa.array(u.view(np.int64)))],
                names=["cid", "shingles"])


def _keys(batches):
    """Every chunk with each one of its values left out: ``(key, cid)``."""
    for b in batches:
        cid = b.column(0).to_numpy()
        for i in range(0, len(cid), 4096):
            n = min(4096, len(cid) - i)
            sig = np.frombuffer(b"".join(b.column(1).slice(i, n).to_pylist()), dtype=np.uint16)
            sig = sig.reshape(n, CHUNKS, WIDTH).astype(np.uint64)
            key = np.empty((n, CHUNKS, WIDTH), dtype=np.uint64)
            place = np.arange(CHUNKS * WIDTH, dtype=np.uint64).reshape(CHUNKS, WIDTH)
            for out in range(WIDTH):
                h = np.broadcast_to(K.mix(place[:, out], 17), (n, CHUNKS))
                for at in range(WIDTH):
                    if at != out:
                        h = K.mix(h ^ sig[:, :, at], 18 + at)
                key[:, :, out] = h
            yield pa.RecordBatch.from_arrays(
                [pa.array(key.reshape(-1).view(np.int64)), pa.array(np.repeat(cid[i:i + n], SYMBOLS))],
                names=["key", "cid"])


def _distance(a, b) -> np.ndarray:
    x = np.frombuffer(b"".join(a), dtype=np.uint16).reshape(-1, SYMBOLS)
    y = np.frombuffer(b"".join(b), dtype=np.uint16).reshape(-1, SYMBOLS)
    return (x != y).sum(axis=1)


def _near_pairs(comp, n, sig, cid, num: int, den: int):
    """Pairs of one small bucket in different components that may be near."""
    near = (sig[:, None, :] != sig[None, :, :]).sum(axis=2) <= FARTHEST
    near &= comp[:, None] != comp[None, :]
    near &= den * np.minimum(n[:, None], n[None, :]) >= num * np.maximum(n[:, None], n[None, :])
    p, q = np.nonzero(near)
    return np.minimum(cid[p], cid[q]), np.maximum(cid[p], cid[q])


def _common(sets, size):
    """``f(x)``: how many elements of x each of the sets holds."""
    flat = sets.flatten().to_numpy()
    o = np.argsort(flat, kind="stable")
    flat, owner = flat[o], np.repeat(np.arange(len(size)), size)[o]

    def count(x):
        lo, hi = np.searchsorted(flat, x, "left"), np.searchsorted(flat, x, "right")
        many = hi - lo
        at = np.arange(many.sum()) + np.repeat(lo - (np.cumsum(many) - many), many)
        return np.bincount(owner[at], minlength=len(size))
    return count


def _bucket_links(num: int, den: int):
    """Links in a large bucket (or two blocks of it) between different components."""
    def run(t: pa.Table) -> pa.Table:
        cid, comp, own = (t.column(i).combine_chunks().to_numpy() for i in (1, 2, 3))
        sets = t.column(4).combine_chunks()
        size = np.diff(sets.offsets.to_numpy())
        count, two = _common(sets, size), own.min() != own.max()
        u, v = [], []
        for i in range(len(cid)):
            common = count(sets[i].values.to_numpy())
            hit = (den * common >= num * (size[i] + size - common)) & (comp != comp[i])
            if two:
                hit &= own != own[i]
            hit = np.flatnonzero(hit)
            u += [int(cid[i])] * len(hit)
            v += cid[hit].tolist()
        return pa.table({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})
    return run


def _block_links(num: int, den: int):
    """Links between classes that ask and a block of a large component: the first of each."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        u, v = [], []
        if left.num_rows and right.num_rows:
            cid = right.column(1).combine_chunks().to_numpy()
            sets = right.column(2).combine_chunks()
            size = np.diff(sets.offsets.to_numpy())
            count = _common(sets, size)
            ask = left.column(2).combine_chunks()
            for i in range(len(ask)):
                x = ask[i].values.to_numpy()
                common = count(x)
                hit = np.flatnonzero(den * common >= num * (len(x) + size - common))
                if len(hit):
                    u.append(left.column(1)[i].as_py())
                    v.append(int(cid[hit[0]]))
        return pa.table({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})
    return run


def _bucket_pairs(num: int, den: int):
    def run(batches):
        import pandas as pd
        held = []

        def pairs(part):
            f = pd.concat(part, ignore_index=True) if len(part) > 1 else part[0]
            key = f["key"].to_numpy()
            cut = np.flatnonzero(key[1:] != key[:-1]) + 1
            sig = np.frombuffer(b"".join(f["sig"]), dtype=np.uint16).reshape(-1, SYMBOLS)
            comp, n, cid = (f[c].to_numpy() for c in ("comp", "n", "cid"))
            seen = [_near_pairs(comp[s:e], n[s:e], sig[s:e], cid[s:e], num, den)
                    for s, e in zip(np.r_[0, cut], np.r_[cut, len(key)]) if e - s > 1]
            if seen:
                both = np.unique(np.stack([np.concatenate([a for a, _ in seen]),
                                           np.concatenate([b for _, b in seen])]), axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(both[0]), pa.array(both[1])], names=["a", "b"])

        for b in batches:   # sorted by key: the last bucket may go on in the next batch
            f = b.to_pandas()
            if not len(f):
                continue
            k = f["key"].to_numpy()
            last = np.flatnonzero(k != k[-1])
            at = int(last[-1]) + 1 if len(last) else 0
            if at or (held and held[-1]["key"].iloc[-1] != k[0]):
                yield from pairs([*held, f.iloc[:at]])
                held = []
            held.append(f.iloc[at:])
        if held:
            yield from pairs(held)
    return run


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    num: int = 75, den: int = 100) -> DataFrame:
    """One row per input row: ``doc_id, n_shingles, component_id, kept``.

    Two documents are linked when ``den * |A & B| >= num * |A | B|`` on their
    distinct shingles; ``component_id`` is the smallest id reachable.  A null
    or empty text has no set and is linked with nothing.  Rows that repeat an
    id count as documents of that id, each with its own text; a row with a null
    id joins a component without naming it (its own ``component_id`` is null
    if nothing else is in it).  Extra columns are ignored; an empty table gives
    no rows.  Texts are read whole.
    """
    node = _placed(docs, id_col, text_col, num, den)
    first = node.filter("n_shingles > 0").groupBy("comp").agg(F.min("doc_id").alias("first_id"))
    return (node.join(first, "comp", "left")
            .withColumn("component_id", F.when(F.col("n_shingles") > 0, F.col("first_id")).otherwise(F.col("doc_id")))
            .select("doc_id", "n_shingles", "component_id",
                    F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                num: int = 75, den: int = 100) -> DataFrame:
    """The rows of ``docs`` without near duplicates: exactly one row of each component.

    That is the row of the smallest id (a null id is the last), of an id's several
    texts the one of the smallest hash, of rows equal in both the one whose other
    columns hash smallest.  A text without a word is linked with nothing: all such
    rows stay.  Rows are told apart by id and a 64-bit hash of the text.
    """
    node = stored(_placed(docs, id_col, text_col, num, den).filter("n_shingles > 0")
                  .groupBy("comp", "doc_id", "text_hash").agg(F.count("*").alias("rows")), "texts")
    rank = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_hash")
    first = node.groupBy("comp").agg(F.min(rank).alias("first"))
    told = stored(node.join(first, "comp").withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("text_hash") == F.col("first.text_hash")))
        .filter("not kept or rows > 1").select("doc_id", "text_hash", "kept"), "told")
    i, h, t = spare(docs, "id", "hash", "text_hash")
    told = told.withColumnsRenamed({"doc_id": i, "text_hash": h})
    at = docs.withColumn(t, F.xxhash64(F.col(text_col).cast("string")))
    same = F.col(id_col).cast("long").eqNullSafe(F.col(i)) & (F.col(t) == F.col(h))
    # few rows go: the others need not be shuffled to learn that they stay
    gone, stays = split(at, F.struct(F.col(id_col).cast("long"), F.col(t)), told.select(F.struct(i, h)))
    out = stays.unionByName(gone.join(told, same, "left_anti")).select(*docs.columns)
    again = told.filter("kept")
    if again.take(1):
        k, r = spare(at, "key", "row")
        rows = at.join(again, same, "left_semi").select(F.col(id_col).cast("long").alias(k), t, F.struct(*docs.columns).alias(r),
                                                        row_hash(docs).alias(h))
        one = rows.groupBy(k, t).agg(F.min_by(r, h).alias(r))
        out = out.unionByName(one.select(f"{r}.*"))
    return out


def _placed(docs: DataFrame, id_col: str, text_col: str, num: int, den: int) -> DataFrame:
    """Per input row ``doc_id, n_shingles, cid, text_hash, comp``; rows of one ``comp`` are one component.

    It is built on two tables, sketches and components; all others are removed."""
    with scratch(docs.sparkSession):
        return _joined(docs, id_col, text_col, num, den)


def _joined(docs: DataFrame, id_col: str, text_col: str, num: int, den: int) -> DataFrame:
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                      F.col(text_col).cast("string").alias("text"))
    sk = stored(src.withColumn("text_hash", F.xxhash64("text")).mapInArrow(
        _sketch, "doc_id long, n_shingles long, cid long, sig binary, text_hash long"), "sketches", keep=True)

    # one class per distinct set; its text is read from one of its documents
    classes = stored(sk.filter("n_shingles > 0").groupBy("cid").agg(
        F.min("doc_id").alias("rep"), F.min("n_shingles").alias("n"), F.min("sig").alias("sig")), "classes")
    with scratch(docs.sparkSession):
        keys = stored(classes.select("cid", "sig").mapInArrow(_keys, "key long, cid long"), "keys")
        many = keys.groupBy("key").agg(F.count("*").alias("size")).filter("size > 1")     # a class has a key once
        members = stored(keys.join(many, "key"), "buckets", keep=True)
    live = members.select("cid").distinct()
    reps = stored(classes.join(live, "cid").select(F.col("rep").alias("id")).distinct(), "reps")
    # few classes meet another: the texts of the others need not be shuffled to learn that
    asked, _rest = split(src, F.col("doc_id"), reps)
    from_docs = asked.join(reps, F.col("doc_id").eqNullSafe(F.col("id")), "left_semi")
    sets = stored(from_docs.mapInArrow(_set_rows, "cid long, shingles array<long>")
                  .dropDuplicates(["cid"]), "sets")

    # distances are cheap and drop nearly all pairs that met by accident
    distance = F.pandas_udf(lambda a, b: __import__("pandas").Series(_distance(a, b)), "int")

    def close(pairs: DataFrame) -> DataFrame:
        one = classes.select(F.col("cid").alias("a"), F.col("n").alias("na"), F.col("sig").alias("sa"))
        two = classes.select(F.col("cid").alias("b"), F.col("n").alias("nb"), F.col("sig").alias("sb"))
        return (pairs.join(one, "a").join(two, "b")
                .filter(den * F.least("na", "nb") >= num * F.greatest("na", "nb"))
                .filter(distance("sa", "sb") <= FARTHEST).select("a", "b"))

    def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
        one = sets.select(F.col("cid").alias("a"), F.col("shingles").alias("x"))
        two = sets.select(F.col("cid").alias("b"), F.col("shingles").alias("y"))
        both = pairs.join(one, "a").join(two, "b").withColumn(
            "common", F.size(F.array_intersect("x", "y")))
        return both.filter(den * F.col("common") >= num * (F.size("x") + F.size("y") - F.col("common"))) \
            .select(F.col("a").alias("u"), F.col("b").alias("v"))

    comp = None         # (cid, comp) of classes with a link

    def placed(df: DataFrame) -> DataFrame:
        if comp is None:
            return df.withColumn("comp", F.col("cid"))
        return df.join(comp, "cid", "left").withColumn("comp", F.coalesce("comp", "cid"))

    def contracted(links: DataFrame) -> DataFrame:
        """Components of the links between components known: far fewer nodes than classes."""
        ends = links.join(comp.select(F.col("cid").alias("u"), F.col("comp").alias("a")), "u", "left") \
            .join(comp.select(F.col("cid").alias("v"), F.col("comp").alias("b")), "v", "left")
        wider = stored(components(ends.select(F.coalesce("a", "u").alias("u"), F.coalesce("b", "v").alias("v"))), "wider")
        wider = wider.select(F.col("node").alias("comp"), "label")
        old = comp.join(wider, "comp", "left").select("cid", F.coalesce("label", "comp").alias("comp"))
        new = wider.join(comp.select("comp"), "comp", "left_anti").select(F.col("comp").alias("cid"), F.col("label").alias("comp"))
        return old.unionByName(new)

    def open_buckets() -> DataFrame:
        """Members of buckets in which more than one component is left."""
        at = placed(members)
        state = at.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo < hi").select("key")
        return at.join(state, "key", "left_semi")

    # each bucket's leader twice over: the same one under many keys, and another a key
    ranks = [F.xxhash64("cid"), F.xxhash64("cid", "key")]
    lead = members.groupBy("key").agg(*[F.min_by("cid", rank).alias(f"lead{i}") for i, rank in enumerate(ranks)])
    met = members.join(lead, "key").select("cid", F.explode(F.array("lead0", "lead1")).alias("leader")) \
        .filter("cid <> leader").groupBy("cid", "leader").agg(F.count("*").alias("shared"))
    best = W.partitionBy("cid").orderBy(F.desc("shared"), "leader")
    pairs = met.withColumn("k", F.row_number().over(best)).filter(F.col("k") <= LEADERS) \
        .select(F.least("cid", "leader").alias("a"), F.greatest("cid", "leader").alias("b")).distinct()
    links = stored(confirmed(close(pairs), sets), "links")
    comp = stored(components(links).select(F.col("node").alias("cid"), F.col("label").alias("comp")), "comps")

    # a class that shares a bucket with a large component is compared with all of it
    large = stored(comp.groupBy("comp").agg(F.count("*").alias("size")).filter(F.col("size") >= LARGE), "large")
    at = stored(open_buckets(), "open")
    there = at.join(large.select("comp"), "comp").select("key", F.col("comp").alias("big")).distinct()
    ask = stored(at.join(there, "key").filter("comp <> big").select("cid", "big").distinct(), "ask")
    parts = ask.groupBy("big").agg(F.ceil(F.count("*") / ASKED).cast("int").alias("askers")) \
        .join(large.select(F.col("comp").alias("big"), F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks")), "big")

    # members of small components that are still apart
    in_large = comp.join(large.select("comp"), "comp").select("cid", F.col("comp").alias("big"))
    sized = at.join(in_large.select("cid"), "cid", "left_anti")
    per = sized.groupBy("key").agg(F.count("*").alias("c")).filter("c > 1")
    sized = stored(sized.join(per, "key"), "apart")
    # few classes are left: the sets of the others need not be shuffled to learn that
    asked_of = in_large.join(parts, "big").select("cid")
    left = among(sets, F.col("cid"), ask.select("cid").union(asked_of).union(sized.select("cid")))

    def dealt(df: DataFrame, own: str, other: str, place: str) -> DataFrame:
        """Rows in their block of ``own``, sent to every block of ``other``."""
        one = df.join(parts, "big").join(left, "cid").withColumn("mine", F.pmod(F.xxhash64("cid"), F.col(own)).cast("int")) \
            .withColumn("theirs", F.explode(F.sequence(F.lit(0), F.col(other) - 1)))
        pair = ("mine", "theirs") if own == "askers" else ("theirs", "mine")
        return one.select(F.xxhash64("big", *pair).alias(place), "cid", "shingles")
    asked = dealt(ask, "askers", "blocks", "task")
    held = dealt(in_large, "blocks", "askers", "place").select(
        "place", F.col("cid").alias("held"), F.col("shingles").alias("held_shingles"))
    links = asked.groupBy("task").cogroup(held.groupBy("place")).applyInArrow(_block_links(num, den), "u long, v long")

    # those still apart meet in a small bucket in pairs of near signatures, in a large one
    # by shared shingles, where only links come out
    few = sized.filter(F.col("c") <= SMALL_BUCKET).join(classes.select("cid", "n", "sig"), "cid") \
        .select("key", "cid", "comp", "n", "sig").repartition("key").sortWithinPartitions("key")
    pairs = few.mapInArrow(_bucket_pairs(num, den), "a long, b long").distinct()
    blocks = F.ceil(F.col("c") / MEMBERS).cast("int")
    salts = F.transform(F.sequence(F.lit(0), blocks - 1), lambda b: F.least(F.col("own"), b) * blocks
                        + F.greatest(F.col("own"), b))      # one task for every two blocks of a bucket
    many = sized.filter(F.col("c") > SMALL_BUCKET).withColumn("own", F.pmod(F.xxhash64("cid"), blocks).cast("int")) \
        .withColumn("salt", F.explode(salts)).join(left, "cid") \
        .select(F.xxhash64("key", "salt").alias("task"), "cid", "comp", "own", "shingles")
    links = links.unionByName(many.groupBy("task").applyInArrow(_bucket_links(num, den), "u long, v long"))
    links = stored(links.unionByName(confirmed(pairs, left)), "links")
    comp = stored(contracted(links), "comps", keep=True)
    forget(members)
    return sk.drop("sig").join(comp, "cid", "left").withColumn("comp", F.coalesce("comp", "cid"))
