"""Positions and neighbours in huge groups agree with windows."""

from conftest import rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from pagetables.operators import content as C
from pagetables.operators.ordering import with_next, with_positions


def test_positions_and_next_match_windows_on_a_hot_group(spark):
    # one group holds almost every row and is spread over many partitions
    df = spark.range(0, 3000, 1, 12).select(
        F.when(F.col("id") % 50 == 0, F.lit("cold")).otherwise(F.lit("hot")).alias("g"),
        ((F.col("id") * 7919) % 3001).alias("o"), F.col("id").alias("v"))
    w = Window.partitionBy("g").orderBy("o")
    want = rows(df.select("g", "o", F.row_number().over(w).alias("pos"),
                          F.lead("v").over(w).alias("next_v")), "g", "o", "pos", "next_v")
    got = rows(with_next(df, ["g"], ["o"], ["v"]), "g", "o", "pos", "next_v")
    assert got == want
    assert rows(with_positions(df, ["g"], ["o"]), "g", "o", "pos") == \
        [(g, o, p) for g, o, p, _ in want]


def test_full_page_fallback_is_sticky_per_chain(spark):
    df = spark.createDataFrame(
        [(1, 1, ["a"], ["a", "x"]), (1, 2, [], ["b", "y"]), (1, 3, ["c"], ["c", "z"]),
         (2, 1, ["d"], ["d"])],
        "category_no int, page_no int, links array<string>, full array<string>")
    got = rows(C.with_full_page_fallback(df, "links", "full"), "category_no", "page_no",
               "full_page", "input")
    assert got == [(1, 1, False, ["a"]), (1, 2, True, ["b", "y"]), (1, 3, True, ["c", "z"]),
                   (2, 1, False, ["d"])]
