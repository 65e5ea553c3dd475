"""Tables cut from their lineage, in the folder that executors share."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagetables.session import scratch_path

_SCOPES: list[list[str]] = []      # of open scratch scopes, the tables written in each
FILTER_BITS = 1 << 22              # of the bit map of split()


def stored(df: DataFrame, name: str, keep: bool = False) -> DataFrame:
    """``df`` written as Parquet under ``spark.checkpoint.dir`` and read back.

    A lost executor costs the tasks that were running, never an earlier step;
    later readers prune columns.  In a ``scratch`` scope the table goes with the
    scope unless ``keep`` is set.
    """
    path = scratch_path(df.sparkSession, name)
    if _SCOPES and not keep:
        _SCOPES[-1].append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession):
    """Tables ``stored`` inside are removed at the end, but for those kept: what leaves the scope
    may be built on kept tables only."""
    _SCOPES.append([])
    try:
        yield
    finally:
        for path in _SCOPES.pop():
            _remove(spark, path)


def _remove(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def forget(df: DataFrame) -> None:
    """Removes a table that ``stored`` gave and nothing reads any more."""
    for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
        _remove(df.sparkSession, folder)


def _place(c: Column) -> Column:
    """A key's bit among ``FILTER_BITS``, counted from 1."""
    return F.pmod(F.xxhash64(c), F.lit(FILTER_BITS)) + 1


def _is_set(bits: Column, place: Column) -> Column:
    """Is the bit of ``place`` set in its range's ``bits`` (null: none is)?"""
    bit = F.bitmap_bit_position(place)
    octet = F.conv(F.hex(F.substr(bits, (F.shiftright(bit, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.coalesce(F.pmod(F.floor(octet / F.pow(F.lit(2.0), F.pmod(bit, F.lit(8)))), F.lit(2)) == 1, F.lit(False))


def split(df: DataFrame, key: Column, keys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``df`` in two: rows whose ``key`` may be among ``keys`` (one column), and rows whose key surely is not.

    For a join of wide rows with keys that few of them have: only the first part has to
    be shuffled.  A bit map of ``FILTER_BITS`` bits (half a megabyte, whatever the input) is sent
    to every task, a piece a hash range; with more keys than bits all rows are in the first part."""
    p, g, m = spare(df, "place", "range", "bits")
    at = _place(F.col(keys.columns[0]))
    bits = keys.select(F.bitmap_bucket_number(at).alias(g), F.bitmap_bit_position(at).alias(p)) \
        .groupBy(g).agg(F.bitmap_construct_agg(p).alias(m))
    bits = stored(bits, "bits")
    dealt = df.withColumn(p, _place(key)).join(F.broadcast(bits), F.bitmap_bucket_number(F.col(p)) == F.col(g), "left")
    hit = _is_set(F.col(m), F.col(p))
    return dealt.filter(hit).select(*df.columns), dealt.filter(~hit).select(*df.columns)


def among(df: DataFrame, key: Column, keys: DataFrame) -> DataFrame:
    """The rows of ``df`` whose ``key`` may be among ``keys`` (see ``split``)."""
    return split(df, key, keys)[0]


def told(df: DataFrame, key: Column, keys: DataFrame, kinds: int, out: str) -> tuple[DataFrame, DataFrame]:
    """``df`` in two: rows whose ``key`` surely has one kind only, that kind as ``out``, and all others.

    ``keys(key, kind)`` holds every key of ``df`` with its kinds: 0 to ``kinds`` - 1, or ``kinds`` if it is
    to be among the others.  For a join of wide rows with a small number each: a bit map a kind (as in
    ``split``) tells most rows their number where they are, as a key's own kinds never miss; only rows
    found under several kinds have to be shuffled.  With more keys than bits all rows are."""
    k, kind = keys.columns
    p, g, w, *maps = spare(df, "place", "range", "kind", *[f"bits{i}" for i in range(kinds + 1)])
    at = _place(F.col(k))
    bits = keys.select(F.bitmap_bucket_number(at).alias(g), F.bitmap_bit_position(at).alias(p), F.col(kind).alias(w)) \
        .groupBy(g, w).agg(F.bitmap_construct_agg(p).alias(p)) \
        .groupBy(g).agg(*[F.max(F.when(F.col(w) == i, F.col(p))).alias(m) for i, m in enumerate(maps)])
    bits = stored(bits, "bits")
    dealt = df.withColumn(p, _place(key)).join(F.broadcast(bits), F.bitmap_bucket_number(F.col(p)) == F.col(g), "left")
    found = F.array_compact(F.array(*[F.when(_is_set(F.col(m), F.col(p)), i) for i, m in enumerate(maps)]))
    dealt = dealt.withColumn(w, F.when(F.size(found) == 1, F.get(found, F.lit(0))).otherwise(kinds))
    return (dealt.filter(F.col(w) < kinds).select(*df.columns, F.col(w).alias(out)),
            dealt.filter(F.col(w) == kinds).select(*df.columns))


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def spare(df: DataFrame, *names: str) -> list[str]:
    """The names, each lengthened until ``df`` has no such column."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def row_hash(df: DataFrame) -> Column:
    """A 64-bit hash of a row's columns, maps (which Spark does not hash) by their JSON.
    A null leaves xxhash64 as it is, so which columns are null counts as well."""
    cols = [F.to_json(F.struct(F.col(f"`{f.name}`"))) if "map<" in f.dataType.simpleString() else F.col(f"`{f.name}`")
            for f in df.schema.fields]
    return F.xxhash64(*cols, F.concat(F.lit(""), *[c.isNull().cast("string") for c in cols]))
