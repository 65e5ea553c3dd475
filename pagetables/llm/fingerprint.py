"""Threshold-scaled document fingerprints (operator 4, native).

A sketch retains every 5-word shingle hash below a fixed fraction of the hash
range (and always the smallest one, so that a text with words has a sketch).
Whether a hash is kept depends on the hash alone, so sketches of unequal
documents are comparable and merge by union.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from pagetables.llm.kernels import SHINGLE
from pagetables.llm.mixing import WORDS

SCALE_BITS = 3        # hashes kept: those below 1 / 2**SCALE_BITS of the range
PER_BLOCK = 512       # documents of a block in which neighbours are found
MOST_BLOCKS = 1 << 16

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def sketch(text: Column) -> Column:
    """The sketch of a text: a sorted array of distinct longs (empty for a text without words).

    A text of fewer than five words has its whole sequence as one shingle."""
    words = F.transform(F.regexp_extract_all(F.translate(text, _UPPER, _LOWER), F.lit(WORDS), F.lit(0)),
                        lambda w: F.xxhash64(w))

    def hashes(h):
        n = F.size(h)
        many = F.transform(F.sequence(F.lit(0), n - SHINGLE), lambda i: F.xxhash64(*[F.get(h, i + j) for j in range(SHINGLE)]))
        return F.when(n >= SHINGLE, many).when(n > 0, F.array(F.xxhash64(h))).otherwise(F.array().cast("array<long>"))

    def kept(all_):
        low = F.filter(all_, lambda x: F.shiftrightunsigned(x, 64 - SCALE_BITS) == 0)
        # the smallest as an unsigned number: below the sign bit first
        least = F.array_min(F.transform(all_, lambda x: x.bitwiseXOR(F.lit(-2**63).cast("long"))))
        guard = F.array(least.bitwiseXOR(F.lit(-2**63).cast("long")))
        return F.when(F.size(low) > 0, F.array_sort(F.array_distinct(low))) \
            .when(F.size(all_) > 0, guard).otherwise(F.array().cast("array<long>"))
    # each step bound once: an expression named twice would be computed twice
    one = F.transform(F.array(words), hashes)
    return F.transform(one, kept)[0]


def merge(a: Column, b: Column) -> Column:
    """The sketch of two documents' shingles together."""
    low = F.array_union(a, b)
    small = F.filter(low, lambda x: F.shiftrightunsigned(x, 64 - SCALE_BITS) == 0)
    return F.when(F.size(small) > 0, F.array_sort(small)).otherwise(F.array_sort(F.slice(F.array_sort(low), 1, 1)))


def likeness(a: Column, b: Column) -> Column:
    """Estimated share of common shingles among all (1 for equal sketches, two empty ones too)."""
    common = F.size(F.array_intersect(a, b))
    every = F.size(a) + F.size(b) - common
    return F.when(every == 0, 1.0).otherwise(common / every)


def containment(a: Column, b: Column) -> Column:
    """Estimated share of a's shingles that b holds (1 for an empty a)."""
    return F.when(F.size(a) == 0, 1.0).otherwise(F.size(F.array_intersect(a, b)) / F.size(a))


def as_text(s: Column) -> Column:
    """A sketch as 16 hex digits a hash."""
    return F.array_join(F.transform(s, lambda x: F.lpad(F.lower(F.hex(x)), 16, "0")), "")


_LOW = np.iinfo(np.int64).min


def _blocks(docs: DataFrame) -> tuple[Column, int]:
    """The block of consecutive (``_id``, ``_h``) that holds a row, and how many blocks there are."""
    want = min(MOST_BLOCKS, max(1, math.ceil(docs.count() / PER_BLOCK)))
    low = docs.select("_id", "_h").repartitionByRange(want, "_id", "_h").groupBy(F.spark_partition_id().alias("p")).agg(
        F.min(F.struct("_id", "_h")).alias("low")).collect()                 # two numbers a block
    found = sorted(tuple(r["low"]) for r in low)
    n = 1
    while n < len(found):       # a session may deal out more partitions than asked for
        n *= 2
    starts = np.full((2, n), np.iinfo(np.int64).max, dtype=np.int64)
    starts[:, :len(found)] = np.array(found, dtype=np.int64).T
    starts[:, 0] = _LOW
    steps, s = [], n // 2
    while s:
        steps.append(s)
        s //= 2
    ids, hashes = F.lit(starts[0]), F.lit(starts[1])

    def begun(k: Column) -> Column:
        at = F.get(ids, k)
        return (at < F.col("_id")) | ((at == F.col("_id")) & (F.get(hashes, k) <= F.col("_h")))
    block = F.aggregate(F.array(*[F.lit(x) for x in steps]).cast("array<int>"), F.lit(0), lambda acc, st: F.when(
        begun(acc + st), acc + st).otherwise(acc)) if steps else F.lit(0)
    return block, n


def with_next(docs: DataFrame, columns: list[str]) -> DataFrame:
    """``docs(doc_id, text, ...)`` with ``next_<c>`` of the document that follows in
    descending id order (after the last: the first), for each of ``columns``.

    Equal ids follow the order of a hash of their texts, null ids come last.  Documents
    meet in blocks of consecutive ids and hashes, so rows of one id are spread over blocks
    as well (equal rows are not); the first row of a block is also the context at the
    end of the block above.  Texts are shuffled once.  There are at most ``MOST_BLOCKS``
    blocks: beyond ``MOST_BLOCKS * PER_BLOCK`` rows a block, which is sorted and read with
    spilling, grows with the table.
    """
    docs = docs.withColumn("_id", F.coalesce("doc_id", F.lit(_LOW))).withColumn("_h", F.xxhash64("text"))
    block, n = _blocks(docs)
    dealt = docs.withColumn("block", block)
    tops = dealt.groupBy("block").agg(F.max(F.struct("_id", "_h")).alias("top")).collect()     # at most n rows
    there = sorted(r["block"] for r in tops)
    above = {b: there[(i + 1) % len(there)] for i, b in enumerate(there)}
    top, target = np.zeros((2, n), np.int64), np.zeros(n, np.int32)
    for r in tops:
        target[r["block"]] = above[r["block"]]
        top[:, r["block"]] = tuple(r["top"])
    b = F.col("block")
    first = (F.get(F.lit(top[0]), b) == F.col("_id")) & (F.get(F.lit(top[1]), b) == F.col("_h"))
    here = F.struct(b.alias("at"), F.lit(False).alias("context"))
    there_too = F.struct(F.get(F.lit(target), b).alias("at"), F.lit(True).alias("context"))
    rows = dealt.withColumn("_p", F.explode(F.when(first, F.array(here, there_too)).otherwise(F.array(here))))
    order = W.partitionBy("_p.at").orderBy(F.col("_p.context"), F.col("_id").desc(), F.col("_h").desc())
    out = rows.select("*", *[F.lead(c).over(order).alias(f"next_{c}") for c in columns])
    return out.filter("not _p.context").drop("_p", "block", "_id", "_h")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per input row the fingerprints of its text and of its edited text, and their likeness.

    The edited text has the last ``floor(n_chars / 2)`` code points replaced by
    the first as many (or all) of the next document in descending id order
    (after the last: the first; a single document follows itself).  A null text
    is an empty one.  ``near_*`` estimate shared among all shingles,
    ``held_*`` the share of the document's own shingles that the other holds.
    Repeated rows each have their row; extra columns are ignored; an empty
    table gives no rows.  Texts are read whole.
    """
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    own = src.withColumn("sketch", sketch(F.col("text")))
    both = with_next(own, ["text", "sketch"]) if src.take(1) else own.select(
        "*", F.col("text").alias("next_text"), F.col("sketch").alias("next_sketch"))
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = both.select("doc_id", n.cast("long").alias("n_chars"), "sketch", "next_sketch", F.concat(
        F.substr(F.col("text"), F.lit(1), n - half), F.substr(F.col("next_text"), F.lit(1), half)).alias("edited"))
    done = edited.select("doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
                         "sketch", "next_sketch", sketch(F.col("edited")).alias("edited_sketch"))
    s, e, x = F.col("sketch"), F.col("edited_sketch"), F.col("next_sketch")
    return done.select("doc_id", "n_chars", "edited_sha256", as_text(s).alias("fingerprint"),
                       as_text(e).alias("edited_fingerprint"), likeness(s, e).alias("near_edited"),
                       likeness(s, x).alias("near_next"), containment(s, e).alias("held_edited"),
                       containment(s, x).alias("held_next"))
