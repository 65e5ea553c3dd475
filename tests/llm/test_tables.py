import os

from pyspark.sql import functions as F

from pagetables.llm import tables
from pagetables.llm.tables import scratch, split, stored, told
from pagetables.session import checkpoint_dir


def test_split_loses_no_key(spark, monkeypatch):
    for bits in (64, 1 << 16, 1 << 22):
        monkeypatch.setattr(tables, "FILTER_BITS", bits)
        df = spark.range(3000).withColumn("place", F.lit(7)).withColumn("k", F.when(F.col("id") % 50 != 0, F.col("id")))
        keys = spark.createDataFrame([(i,) for i in range(0, 3000, 13)] + [(None,)], "k long")
        may, not_ = split(df, F.col("k"), keys)
        assert may.columns == not_.columns == df.columns
        a, b = ({r.id for r in x.collect()} for x in (may, not_))
        assert a | b == set(range(3000)) and not a & b
        assert {i for i in range(3000) if i % 13 == 0 and i % 50 or i % 50 == 0} <= a
        assert bits < 2**22 or len(b) > 2500
    may, not_ = split(df, F.col("k"), keys.limit(0))
    assert may.count() == 0 and not_.count() == 3000


def test_scratch_tables_go_and_kept_ones_stay(spark):
    base = checkpoint_dir(spark).removeprefix("file:")
    with scratch(spark):
        gone = stored(spark.range(5), "gone")
        kept = stored(gone.select((F.col("id") * 2).alias("x")), "stays", keep=True)
        with scratch(spark):
            stored(spark.range(1), "inner")
        assert any(n.startswith("gone-") for n in os.listdir(base)) and not any(n.startswith("inner-") for n in os.listdir(base))
    assert not any(n.startswith("gone-") for n in os.listdir(base))
    assert kept.agg(F.sum("x")).first()[0] == 20


def test_told_gives_each_row_its_own_kind_or_none(spark, monkeypatch):
    rows = [(i if i % 10 else None, f"t{i}", f"_{i}") for i in range(200)]
    df = spark.createDataFrame(rows, "id long, bits0 string, range string")
    key = F.struct("id")
    # every seventh key has two kinds, every ninth none of its own
    kinds = spark.createDataFrame([(i if i % 10 else None, k) for i in range(200) for k in
                                   ([3] if i % 9 == 0 else [0, 2] if i % 7 == 0 else [i % 3])], "id long, kind int") \
        .select(F.struct("id").alias("key"), "kind").distinct()
    for bits in (1 << 22, 1 << 15, 8):
        monkeypatch.setattr(tables, "FILTER_BITS", bits)
        one, rest = told(df, key, kinds, 3, "kind")
        one, rest = one.collect(), rest.collect()
        assert sorted(r.bits0 for r in one + rest) == sorted(r[1] for r in rows)
        for r in one:
            i = int(r.bits0[1:])
            assert r.range == f"_{i}" and i % 10 and i % 9 and i % 7 and r.kind == i % 3
        if bits == 1 << 22:
            assert len(one) == sum(bool(i % 10 and i % 9 and i % 7) for i in range(200))
