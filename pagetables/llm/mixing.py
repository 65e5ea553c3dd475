"""Mixing sources to target weights by pivotal dependent rounding (operator 9, native).

A document of source s should be taken ``target / size`` times.  The whole
part is taken outright; the fractional parts are rounded together.  Two
documents trade expected words until one of them is a whole copy or none;
the other carries on.  Of m rows of one id and size, as many as m fractions make
whole are taken once more outright, and one row's fraction is left to trade.  So a source's words stay at their target but for one
last document, and every document keeps its expected number of copies.
Blocks of documents are rounded in one task each; what each block carries
over meets in the next level of a reduction tree, until a source has one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from pagetables.llm.tables import row_hash, spare, stored, told

WORDS = r"[^\x20\x09-\x0D]+"
BLOCK = 128          # documents that one aggregate rounds
MOST = 3             # a source's target, and a document's copies, stop at this many times
CYCLE = 3            # weights 1, 2, 3, 1, 2, 3, ... over the sources in order
FLIPS = 2            # documents of a source that may be rounded anew at the end
PART = 1024          # rows of one id and size, about, that are numbered in one task
#: ``whole``: copies that the m rows have together; ``p``: the chance of one more.
UNIT = "struct<doc_id:bigint,size:bigint,m:bigint,whole:bigint,p:double>"
DONE = "array<struct<doc_id:bigint,size:bigint,m:bigint,copies:bigint>>"


def targets(sizes: DataFrame) -> DataFrame:
    """``(source, source_size, target)``: all words shared by weight, a share above
    ``MOST`` times its source's words cut there and the excess shared again.

    The fixed point is ``min(MOST * words, level * weight)``; the level is read off
    the sources ordered by the level at which they are full.  One row a source.
    """
    per = sizes.groupBy("source").agg(F.sum(F.col("size") * F.col("m")).alias("source_size"))
    order = W.orderBy(F.col("source").asc_nulls_last())
    per = per.withColumn("w", (F.row_number().over(order) - 1) % CYCLE + 1)
    per = per.withColumn("cap", MOST * F.col("source_size"))
    before = W.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last()).rowsBetween(
        W.unboundedPreceding, -1)
    every = W.partitionBy()
    per = per.withColumn("left_words", F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(before), F.lit(0)))
    per = per.withColumn("left_w", F.sum("w").over(every) - F.coalesce(F.sum("w").over(before), F.lit(0)))
    per = per.withColumn("level", F.col("left_words") / F.col("left_w"))
    at = F.min(F.when(F.col("level") <= F.col("cap") / F.col("w"), F.struct(F.col("cap") / F.col("w"), "level")))
    per = per.withColumn("level", at.over(every)["level"])
    return per.select("source", "source_size", F.least(
        F.col("cap").cast("double"), F.coalesce(F.col("level") * F.col("w"), F.lit(0.0))).alias("target"))


def _chance(a: Column, b: Column, level: int) -> Column:
    """A number in [0, 1) that depends on the pair alone: reruns agree."""
    return F.shiftrightunsigned(F.xxhash64(a, b, F.lit(level), F.lit("pivot")), 11) / F.lit(float(1 << 53))


def _pivot(units: Column, level: int) -> Column:
    """Rounds a block: ``done`` documents and at most one that carries on."""
    start = F.struct(F.lit(None).cast(UNIT).alias("carry"), F.array().cast(DONE).alias("done"))

    def unit(x, p):
        return F.struct(x["doc_id"].alias("doc_id"), x["size"].alias("size"), x["m"].alias("m"),
                        x["whole"].cast("long").alias("whole"), p.alias("p"))

    def done(x, take):
        return F.struct(x["doc_id"].alias("doc_id"), x["size"].alias("size"), x["m"].alias("m"),
                        (x["whole"] + take).cast("long").alias("copies"))

    def trade(acc, x):
        c = acc["carry"]
        cs, xs = c["size"], x["size"]
        up = F.least((1 - c["p"]) * cs, x["p"] * xs)       # words that may move to the carried one
        down = F.least(c["p"] * cs, (1 - x["p"]) * xs)     # or from it
        rise = _chance(c["doc_id"], x["doc_id"], level) * (up + down) < down
        move = F.when(rise, up).otherwise(-down)
        # the one whose way is shorter becomes whole; the other carries the rest
        first = F.when(rise, (1 - c["p"]) * cs <= x["p"] * xs).otherwise(c["p"] * cs <= (1 - x["p"]) * xs)
        pc = F.least(F.greatest(c["p"] + move / cs, F.lit(0.0)), F.lit(1.0))
        px = F.least(F.greatest(x["p"] - move / xs, F.lit(0.0)), F.lit(1.0))
        return F.struct(
            F.when(first, unit(x, px)).otherwise(unit(c, pc)).alias("carry"),
            F.concat(acc["done"], F.array(F.when(first, done(c, F.when(rise, 1).otherwise(0)))
                                          .otherwise(done(x, F.when(rise, 0).otherwise(1))))).alias("done"))

    def step(acc, x):
        return F.when(acc["carry"].isNull(), F.struct(x.cast(UNIT).alias("carry"), acc["done"].alias("done"))) \
            .otherwise(trade(acc, x))
    return F.aggregate(units, start, step)


def mix(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """``(doc_id, source, size, m, source_size, target, copies)``: ``m`` input rows of this
    id, source and size are taken ``copies`` times each.  The rows of one id, source and
    size are one row here, or two whose copies differ by one.

    A null text has size 0; a null source is a source of its own, last in order;
    rows of size 0 are taken as often as whole copies go.  Ids may be null or
    repeat.  Extra columns are ignored; an empty table gives no rows.  The random
    choices are hashes of ids, so a rerun, or other partitions, give the same mix.
    """
    each = F.floor(F.col("copies") / F.col("m")).cast("int")
    more = F.pmod("copies", "m")
    parts = F.array(F.struct((F.col("m") - more).alias("m"), each.alias("copies")),
                    F.struct(more.alias("m"), (each + 1).alias("copies")))
    return _rounded(docs, id_col, source_col, text_col).select(
        "doc_id", "source", "size", "source_size", "target", F.inline(parts)).filter("m > 0") \
        .select("doc_id", "source", "size", "m", "source_size", "target", "copies")


def _rounded(docs: DataFrame, id_col: str, source_col: str, text_col: str) -> DataFrame:
    """One row per distinct (id, source, size); ``copies`` of its ``m`` rows together."""
    size = F.regexp_count(F.coalesce(F.col(text_col), F.lit("")), F.lit(WORDS)).cast("long")
    units = stored(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).alias("source"),
                               size.alias("size")).groupBy("doc_id", "source", "size")
                   .agg(F.count("*").alias("m")), "units")
    per = targets(units)
    times = F.when(F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(float(MOST)))) \
        .otherwise(0.0)
    # a fraction that is none but for the last bits of a double
    near = F.abs(times - F.round(times)) < 1e-9
    per = per.withColumn("whole", F.when(near, F.round(times)).otherwise(F.floor(times)).cast("int"))
    per = stored(per.withColumn("p", F.when(near, 0.0).otherwise(times - F.col("whole"))), "targets")
    all_units = units.join(per.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).drop("s")
    # rows of size 0 have no words to trade; of the others the rows' fractions make whole copies first
    part = F.when(F.col("size") > 0, F.col("m") * F.col("p")).otherwise(0.0)
    near = F.abs(part - F.round(part)) < 1e-9
    sure = F.when(near, F.round(part)).otherwise(F.floor(part)).cast("long")
    all_units = all_units.withColumn("whole", F.col("m") * F.col("whole") + sure) \
        .withColumn("p", F.when(near, 0.0).otherwise(part - sure))
    settled = [all_units.filter("p = 0 or size = 0").select("doc_id", "source", "size", "m", F.col("whole").alias("copies"))]
    open_ = all_units.filter("p > 0 and size > 0").select("doc_id", "source", "size", "m", "whole", "p")

    level = 0
    while True:
        # blocks of a source by hash: a hot source has as many more blocks
        n = open_.groupBy("source").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
        dealt = open_.join(n.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).drop("s")
        dealt = dealt.withColumn("block", F.pmod(F.xxhash64("doc_id", "size", F.lit(level)), F.col("blocks")))
        unit = F.struct(F.xxhash64("doc_id", "size", F.lit(level)).alias("at"), "doc_id", "size", "m", "whole", "p")
        units_in = F.transform(F.array_sort(F.collect_list(unit)), lambda x: F.struct(
            x["doc_id"].alias("doc_id"), x["size"].alias("size"), x["m"].alias("m"), x["whole"].alias("whole"),
            x["p"].alias("p")))
        out = stored(dealt.groupBy("source", "block").agg(units_in.alias("u"))
                     .select("source", _pivot(F.col("u"), level).alias("r")), f"level{level}")
        settled.append(out.select("source", F.inline("r.done")).select("doc_id", "source", "size", "m", "copies"))
        carried = out.filter("r.carry is not null").select("source", "r.carry.*")
        most = out.groupBy("source").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0]
        if not most or most <= 1:
            last = _chance(F.col("doc_id"), F.col("doc_id"), -1) < F.col("p")
            settled.append(carried.select("doc_id", "source", "size", "m",
                                          (F.col("whole") + last.cast("long")).alias("copies")))
            break
        open_, level = carried.select("doc_id", "source", "size", "m", "whole", "p"), level + 1

    rows = settled[0]
    for s in settled[1:]:
        rows = rows.unionByName(s)
    info = per.select(F.col("source").alias("s"), "source_size", "target", "whole", "p")
    rows = rows.join(info, F.col("source").eqNullSafe(F.col("s"))).drop("s")
    # written each time: a settling reads its rows several times over
    rows = stored(rows, "rounded")
    for _ in range(FLIPS):
        rows = stored(_settle(rows), "settled")
    return rows.drop("whole", "p")


def _settle(rows: DataFrame) -> DataFrame:
    """The last carried document of a source is rounded whole, so its words may miss
    the target by up to a document.  One other document whose words are nearest
    to the miss, if that lessens it, is rounded the other way."""
    words = F.col("size")
    miss = rows.groupBy("source").agg((F.sum(F.col("copies") * words) - F.first("target")).alias("miss"))
    at = rows.join(miss.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).drop("s")
    may = (F.col("p") > 0) & (words < 2 * F.abs("miss")) & F.when(
        F.col("miss") > 0, F.col("copies") > F.col("m") * F.col("whole")) \
        .otherwise(F.col("copies") < F.col("m") * (F.col("whole") + 1))
    rank = F.struct(F.abs(F.abs("miss") - words).alias("left"), F.xxhash64("doc_id", "size").alias("h"), "doc_id", "size")
    best = at.filter(may).groupBy("source").agg(F.min(rank).alias("b"), F.first(F.signum("miss")).alias("sign")) \
        .select(F.col("source").alias("s"), F.col("b.doc_id").alias("bd"), F.col("b.size").alias("bs"), "sign")
    hit = F.col("source").eqNullSafe(F.col("s")) & F.col("doc_id").eqNullSafe(F.col("bd")) & (F.col("size") == F.col("bs"))
    out = rows.join(best, hit, "left")
    return out.withColumn("copies", (F.col("copies") - F.coalesce(F.col("sign"), F.lit(0.0))).cast("long")) \
        .drop("s", "bd", "bs", "sign")


def taken(docs: DataFrame) -> DataFrame:
    """Per document: its size, its source's size and target, and the words taken of it."""
    r = mix(docs).withColumn("_", F.explode(F.sequence(F.lit(1).cast("long"), F.col("m"))))
    return r.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def resample(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """``docs`` with every row repeated as often as the mix takes it (0 to ``MOST`` times).

    Where the rows of one id, source and size can't all be taken equally often, those
    of the smallest row hashes have the copy more: other partitions give the same rows."""
    i, s, z, c, m, n, h, e, r = spare(docs, "id", "source_of", "size", "copies", "m", "n", "hash", "extra", "row")
    every = stored(_rounded(docs, id_col, source_col, text_col).select(
        F.col("doc_id").alias(i), F.col("source").alias(s), F.col("size").alias(z), F.col("m").alias(m),
        F.col("copies").alias(c)), "copies")
    units = every.filter(F.col(c) > 0)
    # a document alone under its id, source and size mostly learns its copies where it lies; others are shuffled to their unit
    kind = F.when(F.col(m) == 1, F.least(F.col(c), F.lit(MOST + 1))).otherwise(MOST + 1).cast("int")
    alone, others = told(docs, F.struct(F.col(id_col).cast("long"), F.col(source_col)),
                         every.select(F.struct(i, s).alias("key"), kind.alias("kind")), MOST + 1, n)
    sized = others.withColumn(n, F.regexp_count(F.coalesce(F.col(text_col), F.lit("")), F.lit(WORDS)).cast("long"))
    same = F.col(id_col).cast("long").eqNullSafe(F.col(i)) & F.col(source_col).eqNullSafe(F.col(s)) & (F.col(n) == F.col(z))
    even = F.pmod(F.col(c), F.col(m)) == 0

    def repeated(df: DataFrame, times: Column) -> DataFrame:
        return df.withColumn(n, times.cast("int")).filter(F.col(n) > 0) \
            .withColumn(n, F.explode(F.sequence(F.lit(1), F.col(n)))).select(*docs.columns)
    out = repeated(alone, F.col(n)).unionByName(
        repeated(sized.join(units.filter(even), same), F.col(c) / F.col(m)))
    uneven = units.filter(~even)
    if not uneven.take(1):
        return out
    # equal rows are counted as one; a key's rows are numbered by hash, in parts of the hash's range
    hit = sized.join(uneven, same).withColumn(h, row_hash(docs))
    key = [i, s, z]
    kinds = stored(hit.groupBy(*key, h).agg(F.count("*").alias(e), F.first(m).alias(m), F.first(c).alias(c))
                   .withColumn("part", F.pmod(F.shiftrightunsigned(h, 1), F.ceil(F.col(m) / PART))), "kinds")
    parts = kinds.groupBy(*key, "part").agg(F.sum(e).alias("rows"))
    upto = W.rowsBetween(W.unboundedPreceding, -1)
    parts = parts.withColumn("ahead", F.coalesce(F.sum("rows").over(
        upto.partitionBy(*key).orderBy("part")), F.lit(0))).drop("rows").withColumnsRenamed({k: k + "_p" for k in key})
    met = kinds.join(parts.withColumnRenamed("part", "part_p"), F.col("part").eqNullSafe(F.col("part_p")) & F.col(z).eqNullSafe(
        F.col(z + "_p")) & F.col(i).eqNullSafe(F.col(i + "_p")) & F.col(s).eqNullSafe(F.col(s + "_p")))
    before = F.col("ahead") + F.coalesce(F.sum(e).over(upto.partitionBy(*key, "part").orderBy(h)), F.lit(0))
    extra = F.least(F.greatest(F.pmod(F.col(c), F.col(m)) - before, F.lit(0)), F.col(e))
    # copies of this kind's equal rows together
    chosen = stored(met.select(i, s, z, h, F.col(e).alias(m), (F.floor(F.col(c) / F.col(m)) * F.col(e) + extra).alias(c))
                    .filter(F.col(c) > 0), "chosen").withColumnRenamed(h, e)
    hashed = sized.withColumn(h, row_hash(docs))
    same &= F.col(h) == F.col(e)
    out = out.unionByName(repeated(hashed.join(chosen.filter(even), same), F.col(c) / F.col(m)))
    # at most one kind of a key is left: equal rows, so one of them stands for all
    one = hashed.join(chosen.filter(~even), same).select(*key, h, c, F.struct(*docs.columns).alias(r)) \
        .groupBy(*key, h, c).agg(F.first(r).alias(r))
    copies = one.withColumn(n, F.explode(F.sequence(F.lit(1).cast("long"), F.col(c))))
    return out.unionByName(copies.select(f"{r}.*"))
