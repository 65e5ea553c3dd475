"""Optimal length buckets and token-budget batches (operator 6).

The global histogram of lengths is small at any input size: lengths up to 256
are cells of their own, longer ones share cells 1/128 of an octave wide.  A
dynamic program over its cells chooses the bucket boundaries that minimise
padding.  Inside a bucket documents follow the MD5 of their id and fill
batches of ``budget // boundary`` documents.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from pagetables.llm.mixing import WORDS
from pagetables.llm.tables import stored

BUCKETS = 12
BUDGET = 16_384        # padded tokens of a batch (a longer document has a batch of its own)
FINE = 256             # lengths up to here have cells of their own
PART = 1 << 16        # rows of a unit that are dealt out together
PER_BLOCK = 50_000     # documents that one task numbers


def cell(n: Column) -> Column:
    """The histogram cell of a length; cells keep the order of lengths."""
    step = F.floor(F.log2(n.cast("double"))).cast("int")
    octave = F.pow(F.lit(2.0), step - 7)
    return F.when(n <= FINE, n).otherwise((F.floor(n / octave) * octave).cast("long"))


def best_boundaries(count: np.ndarray, total: np.ndarray, longest: np.ndarray, k: int) -> list[int]:
    """Upper lengths of at most ``k`` buckets of consecutive cells with the least padding.

    Of equal paddings the earlier last cut wins, and fewer buckets win.
    """
    m = len(count)
    if m == 0:
        return []
    c, t = np.r_[0, np.cumsum(count)].astype(np.int64), np.r_[0, np.cumsum(total)].astype(np.int64)
    far = np.iinfo(np.int64).max // 4
    cost = np.full(m + 1, far, dtype=np.int64)
    cost[0] = 0
    back, paid = [], []
    for _ in range(k):
        new, cut = np.full(m + 1, far, dtype=np.int64), np.zeros(m + 1, dtype=np.int64)
        for j in range(1, m + 1):
            v = cost[:j] + longest[j - 1] * (c[j] - c[:j]) - (t[j] - t[:j])
            cut[j] = int(np.argmin(v))
            new[j] = v[cut[j]]
        back.append(cut)
        paid.append(int(new[m]))
        cost = new
    n = int(np.argmin(paid)) + 1
    j, out = m, []
    for r in range(n - 1, -1, -1):
        out.append(int(longest[j - 1]))
        j = int(back[r][j])
    return out[::-1]


def pack(docs: DataFrame, buckets: int = BUCKETS, budget: int = BUDGET,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per input row ``doc_id, n_tokens, bucket, bucket_len, batch, slot``.

    ``n_tokens`` counts whitespace-separated words of the whole text (null: 0).
    ``bucket`` counts from 0; every document of it is padded to ``bucket_len``,
    its longest; ``batch`` counts from 0 inside the bucket, ``slot`` inside the
    batch.  A batch holds ``max(1, budget // max(1, bucket_len))`` documents.
    Ids may be null or repeat: equal rows are interchangeable.  An empty table
    gives no rows; extra columns are ignored.
    """
    spark = docs.sparkSession
    n = F.regexp_count(F.coalesce(F.col(text_col), F.lit("")), F.lit(WORDS)).cast("long")
    sized = stored(docs.select(F.col(id_col).cast("long").alias("doc_id"), n.alias("n_tokens")), "sized")
    hist = sized.groupBy(cell(F.col("n_tokens")).alias("cell")).agg(
        F.count("*").alias("n"), F.sum("n_tokens").alias("t"), F.max("n_tokens").alias("l")).collect()
    hist.sort(key=lambda r: r["cell"])       # at most 256 + 128 * log2(longest) cells
    bounds = best_boundaries(*[np.array([r[x] for r in hist], dtype=np.int64) for x in ("n", "t", "l")], buckets)
    rows = sum(r["n"] for r in hist)
    digits = 0
    while 16 ** digits * PER_BLOCK < rows:
        digits += 1
    table = spark.createDataFrame(list(enumerate(bounds)), "bucket int, bucket_len long")
    at = F.array(*[F.lit(b).cast("long") for b in bounds]) if bounds else F.array().cast("array<long>")
    place = F.size(F.filter(at, lambda b: b < F.col("n_tokens")))
    key = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    # rows of one id and length are interchangeable: one unit, however many they are
    units = sized.groupBy("doc_id", "n_tokens").agg(F.count("*").alias("m"))
    one = stored(units.withColumn("bucket", place).withColumn("key", key).withColumn(
        "block", F.substring("key", 1, digits) if digits else F.lit("")), "units")
    # positions: inside a (bucket, block) by a window over units, before it by the blocks' counts
    first = W.rowsBetween(W.unboundedPreceding, -1)
    offset = one.groupBy("bucket", "block").agg(F.sum("m").alias("c")).withColumn(
        "before", F.coalesce(F.sum("c").over(first.partitionBy("bucket").orderBy("block")), F.lit(0))).drop("c")
    inside = first.partitionBy("bucket", "block").orderBy("key", "doc_id", "n_tokens")
    pos = one.withColumn("i", F.coalesce(F.sum("m").over(inside), F.lit(0))).join(offset, ["bucket", "block"])
    # a unit's rows again, in parts: no array grows with a unit
    pos = pos.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("m") - 1) / PART))))
    last = F.least(F.col("m") - F.col("part") * PART, F.lit(PART)) - 1
    pos = pos.withColumn("at", F.explode(F.sequence(F.lit(0).cast("long"), last))) \
        .withColumn("i", F.col("i") + F.col("part") * PART + F.col("at"))
    size = F.greatest(F.lit(1), F.floor(F.lit(budget) / F.greatest(F.lit(1), F.col("bucket_len")))).cast("long")
    pos = pos.join(F.broadcast(table), "bucket").withColumn("pos", F.col("i") + F.col("before"))  # <= `buckets` rows
    return pos.select("doc_id", "n_tokens", "bucket", "bucket_len",
                      F.floor(F.col("pos") / size).alias("batch"), (F.col("pos") % size).alias("slot"))
