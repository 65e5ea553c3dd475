"""Positions and neighbours inside groups that may be huge.

A window partitioned by a group sorts the whole group in one task; when a
group can hold a third of all rows (a label, a category) that task is the
job.  Here the rows are sorted globally instead (range partitioning splits
a hot group across tasks), each row gets its global rank from its
partition's offset (one count per partition, a table as small as the
partition count) and its index in the partition, and a group's first
rank comes from an aggregate.  The next row of a group is then an equi join
on rank + 1.  The sorted table is checkpointed so that every use sees the
same partitioning.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pagetables.session import cut_lineage

_ROW_BITS = 33   # monotonically_increasing_id: partition index << 33 | row index


def with_positions(df: DataFrame, group: Sequence[str], order: Sequence[str],
                   out: str = "pos") -> DataFrame:
    """Adds ``out`` = 1-based position within the group in ``order``, and ``_g``,
    the global rank (contiguous over the whole sorted table)."""
    keys, ords = list(group), list(order)
    s = (df.orderBy(*keys, *ords)
           .withColumn("_pid", F.spark_partition_id())
           .withColumn("_mid", F.monotonically_increasing_id()))
    s = cut_lineage(s)
    counts = s.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offs = counts.select("_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    s = s.join(F.broadcast(offs), "_pid")
    s = s.withColumn("_g", F.col("_off") + F.col("_mid")
                     - F.shiftleft(F.col("_pid").cast("long"), _ROW_BITS))
    first = s.groupBy(*keys).agg(F.min("_g").alias("_g0"))
    s = s.join(first, keys)
    return (s.withColumn(out, (F.col("_g") - F.col("_g0") + 1).cast("long"))
             .drop("_pid", "_mid", "_off", "_g0"))


def with_next(df: DataFrame, group: Sequence[str], order: Sequence[str],
              cols: Sequence[str], prefix: str = "next_") -> DataFrame:
    """``lead(col)`` over (group, order) for each of ``cols``, without a per-group
    sort: the next row is the one with global rank + 1 in the same group."""
    keys = list(group)
    p = with_positions(df, keys, order)
    nxt = p.select(*[F.col(k).alias("_n_" + k) for k in keys],
                   (F.col("_g") - 1).alias("_gn"),
                   *[F.col(c).alias(prefix + c) for c in cols])
    cond = [F.col("_g") == F.col("_gn")] + [F.col(k) == F.col("_n_" + k) for k in keys]
    j = p.join(nxt, cond, "left")
    return j.drop("_gn", *["_n_" + k for k in keys])
