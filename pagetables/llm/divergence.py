"""Source divergence audit by count cells (operator 13).

How far does each source of a language stray from the language, and from each
other source?  Terms with the same (count in the source, count in the language)
have the same probabilities and so the same divergence ``f``: it is evaluated
once a cell, cells are ranked by their value with the number of their terms
summed up, and only the cells that reach the asked ranks are expanded into
terms, cells of equal value together, in UTF-8 order.

Between two sources a cell is (count in one, count in the other).  Most terms
are missing from one of the two, so only cells of terms that both hold are
listed; the rest follows from each source's own counts:

    sum f(a, b) = V f(0, 0) + sum over a's terms [f(a, 0) - f(0, 0)]
                + sum over b's terms [f(0, b) - f(0, 0)]
                + sum over shared terms [f(a, b) - f(a, 0) - f(0, b) + f(0, 0)]

All arithmetic is on integers.
"""

from __future__ import annotations

from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from pagetables.llm import kernels as K
from pagetables.llm.tables import stored

SCALE = 1_000_000_000
LEAST_DOCS = 10       # documents of a language that a kept term is in
TOP = 10              # ranks of the term part
ENTRIES = 200_000     # (group, term) counts that a task holds before it passes them on

#: ASCII letters stay, A-Z lower-cased; bytes of non-ASCII characters stay; all else parts terms.
_TERM = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def _counts(batches):
    """``(lang, source, term, n, docs)``, summed over as many documents as ``ENTRIES`` allows."""
    held: dict[tuple[str, str], tuple[Counter, Counter]] = {}
    size = 0

    def out():
        for (lang, source), (n, docs) in held.items():
            terms = pa.array(list(n), pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays(
                [pa.repeat(pa.scalar(lang, pa.string()), len(n)), pa.repeat(pa.scalar(source, pa.string()), len(n)), terms,
                 pa.array(list(n.values()), pa.int64()), pa.array([docs[t] for t in n], pa.int64())],
                names=["lang", "source", "term", "n", "docs"])

    for b in batches:
        for lang, source, text in zip(*(b.column(i) for i in range(3))):
            n, docs = held.setdefault((lang.as_py(), source.as_py()), (Counter(), Counter()))
            before, seen = len(n), None
            data = text.as_buffer().to_pybytes()
            for piece in K.cut(data.translate(_TERM)):
                words = piece.split()
                n.update(words)
                new = set(words) if seen is None else set(words) - seen
                docs.update(new)
                if len(piece) < len(data):
                    seen = new if seen is None else seen | new
                size, before = size + len(n) - before, len(n)
            if size >= ENTRIES:
                yield from out()
                held.clear()
                size = 0
    yield from out()


def _p(count: str | int, total: str, kept: str) -> Column:
    """``1 + floor(SCALE * (count + 2) / (total + 2 * kept))``; null where no term is kept."""
    return F.expr(f"""1 + (CAST({SCALE} AS DECIMAL(10, 0)) * CAST({count} + 2 AS DECIMAL(20, 0)))
                      div nullif(CAST({total} + 2 * {kept} AS DECIMAL(20, 0)), 0)""")


def _f(p: str, q: str) -> str:
    return f"(({p} - {q}) * ({p} - {q}) div ({p} + {q}))"


def audit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
          least_docs: int = LEAST_DOCS, top: int = TOP) -> DataFrame:
    """``lang, source, part, item, value, rank`` for each (lang, source) group that occurs.

    Part ``pair`` ranks the language's other sources by the divergence from
    them, part ``term`` the ``top`` terms that the group has more of than its
    language.  Null text, lang and source are read as empty.  A text without a
    term still makes its group; a language that keeps no term has value 0 in all
    pairs and no terms.  Equal values rank in UTF-8 order of the item.  Rows that
    repeat count as documents; an empty table gives no rows; other columns are
    ignored.  Texts are read whole, a long one piece by piece.
    """
    src = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n)
                        for c, n in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))])
    counts = src.mapInArrow(_counts, "lang string, source string, term string, n long, docs long") \
        .groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    # a term's row holds its count in each source of the language: no longer than a group's pair part
    kept = stored(counts.groupBy("lang", "term").agg(
        F.sum("n").alias("total"), F.sum("docs").alias("docs"), F.collect_list(F.struct("source", "n")).alias("by"))
        .filter(F.col("docs") >= least_docs).drop("docs"), "terms")
    each = kept.select("lang", "term", "total", F.inline("by"))

    langs = kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("total").alias("lang_n"))
    sums = each.groupBy("lang", "source").agg(F.sum("n").alias("group_n"))
    groups = stored(src.select("lang", "source").distinct().join(langs, "lang", "left").join(sums, ["lang", "source"], "left")
                    .na.fill(0, ["v", "lang_n", "group_n"]).withColumn("p0", _p(0, "group_n", "v")), "groups")
    return _pairs(kept, each, groups).unionByName(_terms(each, groups, top))


def _terms(each: DataFrame, groups: DataFrame, top: int) -> DataFrame:
    cells = each.groupBy("lang", "source", "n", "total").agg(F.count("*").alias("terms")) \
        .join(groups, ["lang", "source"]).withColumn("p", _p("n", "group_n", "v")).withColumn("q", _p("total", "lang_n", "v")) \
        .filter("p > q").select("lang", "source", "n", "total", "terms", F.expr(_f("p", "q")).alias("value"))
    cells = stored(cells, "cells")
    # every value has a term, so a group's first `top` values suffice; of these, those that begin within the ranks
    falling = W.partitionBy("lang", "source").orderBy(F.desc("value"))
    first = cells.groupBy("lang", "source", "value").agg(F.sum("terms").alias("terms")) \
        .withColumn("k", F.row_number().over(falling)).filter(F.col("k") <= top) \
        .withColumn("before", F.coalesce(F.sum("terms").over(falling.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))) \
        .filter(F.col("before") < top).select("lang", "source", "value", "before")
    chosen = stored(cells.join(first, ["lang", "source", "value"]).drop("terms"), "chosen")
    alike = W.partitionBy("lang", "source", "value").orderBy("term")
    return each.join(chosen, ["lang", "source", "n", "total"]) \
        .withColumn("k", F.row_number().over(alike)).filter(F.col("k") <= top) \
        .withColumn("rank", (F.col("before") + F.col("k")).cast("int")).filter(F.col("rank") <= top) \
        .select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value", "rank")


def _pairs(kept: DataFrame, each: DataFrame, groups: DataFrame) -> DataFrame:
    own = stored(each.groupBy("lang", "source", "n").agg(F.count("*").alias("terms")).join(groups, ["lang", "source"])
                 .withColumn("p", _p("n", "group_n", "v")).select("lang", "source", "n", "terms", "p", "p0"), "own")
    one, two = (own.select("lang", F.col("source").alias(s), F.col("n").alias(f"n_{s}"), F.col("p").alias(f"p_{s}"),
                           F.col("p0").alias(f"z_{s}")) for s in "ab")

    shared = kept.select("lang", "by", F.inline("by")).withColumnsRenamed({"source": "a", "n": "n_a"}) \
        .select("lang", "a", "n_a", F.inline(F.expr("filter(by, x -> x.source > a)"))).withColumnsRenamed({"source": "b", "n": "n_b"}) \
        .groupBy("lang", "a", "b", "n_a", "n_b").agg(F.count("*").alias("terms"))
    f = f"{_f('p_a', 'p_b')} - {_f('p_a', 'z_b')} - {_f('z_a', 'p_b')} + {_f('z_a', 'z_b')}"
    shared = shared.join(one, ["lang", "a", "n_a"]).join(two, ["lang", "b", "n_b"]) \
        .groupBy("lang", "a", "b").agg(F.sum(F.expr(f"terms * ({f})")).alias("part"))

    other = groups.select("lang", F.col("source").alias("other"), F.col("p0").alias("q0"))
    alone = own.join(other, "lang").filter("source <> other") \
        .groupBy("lang", F.least("source", "other").alias("a"), F.greatest("source", "other").alias("b")) \
        .agg(F.sum(F.expr(f"terms * ({_f('p', 'q0')} - {_f('p0', 'q0')})")).alias("part"))
    neither = groups.join(other, "lang").filter("source < other") \
        .select("lang", F.col("source").alias("a"), F.col("other").alias("b"),
                F.expr(f"coalesce(v * {_f('p0', 'q0')}, 0)").alias("part"))
    sums = neither.unionByName(alone).unionByName(shared).groupBy("lang", "a", "b").agg(F.sum("part").alias("value"))
    both = sums.select("lang", F.inline(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")),
                                                F.struct(F.col("b").alias("source"), F.col("a").alias("item")))), "value")
    ranks = W.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return both.select("lang", "source", F.lit("pair").alias("part"), "item", "value",
                       F.row_number().over(ranks).alias("rank"))
