"""SimHash near-duplicates with bit-sliced comparison (operator 11).

A fingerprint has a bit set where more than half of the document's 3-word
shingle hashes have it.  Documents of one fingerprint are one class from then
on.  Two fingerprints at a distance of at most ``RADIUS`` agree on two of
``PARTS`` parts whatever the wrong bits are, so each class is listed under every
two of its parts, and classes meet in buckets of one such key.  A bucket of many
classes is split anew by the same rule on the bits that its key does not fix;
what is still large is compared block against block, one task for two blocks.

Inside a task fingerprints stand in words of 64, one machine word a bit plane.
A fingerprint is compared with a whole word at once: each plane's differences
are added to vertical counters by full adders (two planes and the low counter
bit make a sum and a carry), a lane whose counter runs over is out, and a word
all of whose lanes are out is left.  Links of a task are merged to one link a
class and group; groups across tasks are components of a graph.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagetables.llm import kernels as K
from pagetables.llm.graph import components
from pagetables.llm.tables import stored

BITS = 64
RADIUS = 3
SHINGLE = 3
SEED = 42
PARTS = RADIUS + 2     # RADIUS wrong bits leave two parts right
LARGE = 256            # classes from which a bucket is split by further parts
BLOCK = 4096           # classes of a block of what is still larger
HASHES = 1 << 16       # shingle hashes whose bits are counted together
ROWS = 1 << 15         # classes that a comparing task reads before it compares
PAIRS = 1 << 18        # (class, word) pairs compared together

_U = np.uint64
_FULL = _U(2**64 - 1)
_BIT = _U(1) << np.arange(64, dtype=_U)
#: Byte value -> its eight bits, one a byte.
_SPREAD = np.array([sum((v >> k & 1) << 8 * k for k in range(8)) for v in range(256)], dtype=_U)


#: A-Z lower-cased, white space as blanks.
_PLAIN = bytes(b + 32 if 65 <= b <= 90 else 32 if 9 <= b <= 13 else b for b in range(256))


def _shingle_hashes(data: bytes, size: int = SHINGLE):
    """XXH64 of every ``size`` consecutive words, piece by piece; of all words where they are fewer."""
    from xxhash import xxh64_intdigest

    left: list[bytes] = []
    some = False
    for piece in K.cut(data):
        words = left + piece.split()
        if len(words) >= size:
            some = True
            yield [xxh64_intdigest(b" ".join(t), SEED) for t in zip(*(words[k:] for k in range(size)))]
            left = words[1 - size:]
        else:
            left = words
    if left and not some:
        yield [xxh64_intdigest(b" ".join(left), SEED)]


def _add_bits(ones: np.ndarray, h: np.ndarray, row: np.ndarray) -> None:
    """Adds to ``ones[row]`` the bits of the hashes ``h``, whose rows ascend."""
    new = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
    run = np.diff(np.r_[new, len(row)])
    parts = -(-run // 255)                     # a byte counts to 255
    at = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
    start = np.repeat(new, parts) + 255 * at
    first = np.cumsum(parts) - parts
    octet = h.view(np.uint8).reshape(-1, 8)
    for j in range(8):
        lanes = np.add.reduceat(_SPREAD[octet[:, j]], start).view(np.uint8).reshape(-1, 8)
        ones[row[new], 8 * j:8 * j + 8] += np.add.reduceat(lanes, first, axis=0, dtype=np.int64)


def _fingerprints(batches):
    for b in batches:
        n = b.num_rows
        ones, total = np.zeros((n, BITS), np.int64), np.zeros(n, np.int64)
        held: list[int] = []
        rows: list[int] = []
        sizes: list[int] = []

        def add():
            if held:
                _add_bits(ones, np.array(held, dtype=_U), np.repeat(rows, sizes))
                for x in (held, rows, sizes):
                    x.clear()

        for i, text in enumerate(b.column(1)):
            if not text.is_valid:
                continue
            for h in _shingle_hashes(text.as_buffer().to_pybytes().translate(_PLAIN)):
                total[i] += len(h)
                held += h
                rows.append(i)
                sizes.append(len(h))
                if len(held) >= HASHES:
                    add()
        add()
        fp = ((2 * ones > total[:, None]) * _BIT).sum(axis=1, dtype=_U)
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp.view(np.int64))], names=["doc_id", "fp"])


def _masks(bits: list[int]) -> list[int]:
    """Masks of every two of ``PARTS`` parts of the given bit places."""
    parts = [sum(1 << b for b in bits[len(bits) * k // PARTS:len(bits) * (k + 1) // PARTS]) for k in range(PARTS)]
    return [x | y for x, y in combinations(parts, 2)]


_KEYS = _masks(list(range(BITS)))
_FURTHER = [_masks([b for b in range(BITS) if not m >> b & 1]) for m in _KEYS]


def _keys(batches):
    """Every class under each of its keys: ``(key, made, fp)``."""
    for b in batches:
        fp = b.column(0).to_numpy().view(_U)
        for k, mask in enumerate(_KEYS):
            yield pa.RecordBatch.from_arrays(
                [pa.array(K.mix(fp & _U(mask), k).view(np.int64)), pa.array(np.full(len(fp), k, np.int32)), b.column(0)],
                names=["key", "made", "fp"])


def _further_keys(batches):
    """Classes of large buckets under keys that also hold two parts of the bits left."""
    for b in batches:
        key, made, fp = (b.column(i).to_numpy() for i in range(3))
        for k, masks in enumerate(_FURTHER):
            own = made == k
            if own.any():
                x, old = fp[own].view(_U), key[own].view(_U)
                for j, mask in enumerate(masks):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(K.mix(K.mix(x & _U(mask), 100 + j) ^ old, 200 + j).view(np.int64)), pa.array(x.view(np.int64))],
                        names=["key", "fp"])


def _within(planes: np.ndarray, fp: np.ndarray, q: np.ndarray, w: np.ndarray, over: np.ndarray, radius: int):
    """Lanes of words ``w`` within ``radius`` of ``fp[q]``: ``(q, w, lanes)`` of the pairs that have any.

    ``over`` has the lanes that are out from the start.  The counters begin so
    high that difference ``radius + 1`` makes them run over."""
    high = max(1, radius.bit_length())
    begin = (1 << high) - 1 - radius
    count = [np.full(len(q), _FULL if begin >> k & 1 else 0, dtype=_U) for k in range(high)]
    x = fp[q]
    for p in range(0, BITS, 2):
        d, e = (planes[i][w] ^ (_U(0) - (x >> _U(i) & _U(1))) for i in (p, p + 1))
        half = count[0] ^ d
        carry = (count[0] & d) | (half & e)
        count[0] = half ^ e
        for k in range(1, high):
            count[k], carry = count[k] ^ carry, count[k] & carry
        over = over | carry
        if p % 8 == 6:
            stay = over != _FULL
            if not stay.all():
                q, w, x, over = q[stay], w[stay], x[stay], over[stay]
                count = [c[stay] for c in count]
                if not len(q):
                    break
    return q, w, ~over


def _merge(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Joins the groups of a[i] and b[i]; a group's label is its smallest row."""
    while len(a):
        la, lb = label[a], label[b]
        apart = la != lb
        a, b, la, lb = a[apart], b[apart], la[apart], lb[apart]
        np.minimum.at(label, np.maximum(la, lb), np.minimum(la, lb))
        while (label[label] != label).any():
            label[:] = label[label]


def _links(task: np.ndarray, own: np.ndarray, fp: np.ndarray, radius: int = RADIUS):
    """Links in tasks, rows sorted by task and block: ``(u, v)``, a forest over each task's groups."""
    n = len(fp)
    new = np.r_[True, (task[1:] != task[:-1]) | (own[1:] != own[:-1])]
    start = np.flatnonzero(new)
    part = np.cumsum(new) - 1                                   # block of a task
    size = np.diff(np.r_[start, n])
    place = np.arange(n) - start[part]
    words = -(-size // 64)
    word0 = np.cumsum(words) - words
    word, lane = word0[part] + place // 64, (place % 64).astype(_U)
    first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
    planes = np.stack([np.bitwise_or.reduceat((fp >> _U(p) & _U(1)) << lane, first) for p in range(BITS)])
    empty = ~np.bitwise_or.reduceat(_U(1) << lane, first)

    follows = np.r_[task[start[1:]] == task[start[:-1]], False]  # a second block: only one against the other
    second = np.r_[False, follows[:-1]]
    lo = np.where(follows[part], word0[np.minimum(part + 1, len(start) - 1)], word)
    hi = np.where(follows[part], lo + words[np.minimum(part + 1, len(start) - 1)], (word0 + words)[part])
    hi = np.where(second[part], lo, hi)
    label = np.arange(n)
    ends = np.cumsum(hi - lo)
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(ends, (ends[i - 1] if i else 0) + PAIRS, "right")))
        many = (hi - lo)[i:j]
        q = np.repeat(np.arange(i, j), many)
        w = np.arange(len(q)) + np.repeat(lo[i:j] - (np.cumsum(many) - many), many)
        # in its own word a class meets the lanes after it
        over = empty[w] | np.where(w == word[q], (_U(2) << lane[q]) - _U(1), _U(0))
        q, w, lanes = _within(planes, fp, q, w, over, radius)
        for s in range(0, len(q), 4096):
            hit, at = np.nonzero(np.unpackbits(lanes[s:s + 4096].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))
            _merge(label, q[s:s + 4096][hit], first[w[s:s + 4096][hit]] + at)
        i = j
    tied = np.flatnonzero(label != np.arange(n))
    return fp[tied], fp[label[tied]]


def _compare(batches):
    """Links of tasks that lie whole in the partition, which is sorted by task and block."""
    held, rows = [], 0

    def run(t: pa.Table):
        u, v = _links(t.column(0).to_numpy(), t.column(1).to_numpy(), t.column(2).to_numpy().view(_U))
        yield pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], names=["u", "v"])

    for b in batches:
        held.append(b)
        rows += b.num_rows
        if rows >= ROWS:
            t = pa.Table.from_batches(held)
            task = t.column(0).to_numpy()
            at = int(np.searchsorted(task, task[-1]))     # the last task may go on
            if at:
                yield from run(t.slice(0, at))
                held = t.slice(at).to_batches()
                rows = t.num_rows - at
    if rows:
        yield from run(pa.Table.from_batches(held))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, fingerprint, component_id``.

    ``fingerprint`` is 16 lower-case hex digits.  Documents whose fingerprints
    differ in at most ``RADIUS`` bits are linked; ``component_id`` is the smallest
    id reachable.  A null, empty or wordless text has fingerprint zero and is
    linked like any other.  A text of fewer than ``SHINGLE`` words is one shingle.
    Rows that repeat an id count as documents of that id; a row with a null id
    joins a component without naming it (its ``component_id`` is null where no
    other is in it).  Extra columns are ignored; an empty table gives no rows.
    Texts are read whole, long ones piece by piece.
    """
    sk = stored(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
                .mapInArrow(_fingerprints, "doc_id long, fp long"), "fingerprints")
    classes = stored(sk.groupBy("fp").agg(F.min("doc_id").alias("low")), "classes")
    comp = components(links(classes.select("fp")))
    placed = classes.join(comp.select(F.col("node").alias("fp"), "label"), "fp", "left") \
        .withColumn("label", F.coalesce("label", "fp"))
    first = placed.groupBy("label").agg(F.min("low").alias("component_id"))
    of = placed.join(first, "label").select("fp", "component_id")
    return sk.join(of, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def links(classes: DataFrame) -> DataFrame:
    """``(u, v)``: links between distinct fingerprints ``fp`` that connect all that are within ``RADIUS``."""
    def shared(keys: DataFrame, name: str) -> DataFrame:
        keys = stored(keys, name)
        many = keys.groupBy("key").agg(F.count("*").alias("size")).filter("size > 1")
        return stored(keys.join(many, "key"), f"{name}-shared")

    met = shared(classes.mapInArrow(_keys, "key long, made int, fp long"), "keys")
    again = shared(met.filter(F.col("size") > LARGE).select("key", "made", "fp")
                   .mapInArrow(_further_keys, "key long, fp long"), "further")
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("fp"), blocks).cast("int")
    salts = F.transform(F.sequence(F.lit(0), blocks - 1), lambda k: F.least(F.col("own"), k) * blocks
                        + F.greatest(F.col("own"), k))         # one task for every two blocks of a bucket
    dealt = again.withColumn("own", own).withColumn("salt", F.explode(salts)) \
        .select(F.xxhash64("key", "salt").alias("task"), "own", "fp")
    few = met.filter(F.col("size") <= LARGE).select(F.col("key").alias("task"), F.lit(0).alias("own"), "fp")
    return few.unionByName(dealt).repartition("task").sortWithinPartitions("task", "own", "fp") \
        .mapInArrow(_compare, "u long, v long").distinct()
