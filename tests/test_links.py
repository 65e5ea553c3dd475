"""Filters, windows and dedup semantics (order as data)."""

from conftest import rows
from pyspark.sql import functions as F

from pagetables.functions import text as TX
from pagetables.operators import links as L


def test_prefix_filter_drops_null_href(spark):
    df = spark.createDataFrame([(1, "/a/x"), (2, None), (3, "/b/y")], "elem_seq int, href string")
    assert rows(L.links_with_prefix(df, "/a/"), "elem_seq") == [(1,)]


def test_isdigit_like_python(spark):
    df = spark.createDataFrame([("12",), ("１２",), ("²",), ("1a",), ("",)], ["t"])
    got = [r[0] for r in df.select(TX.is_digits("t")).collect()]
    assert got == [True, True, False, False, False]


def test_take_through_index(spark):
    titles = ["s1", "s2", "1", "2", "s3", "s4", "3"]
    df = spark.createDataFrame([(1, i, t) for i, t in enumerate(titles)],
                               "page_id long, elem_seq int, title string")
    kept = [r.title for r in L.take_through_index(df).orderBy("elem_seq").collect()]
    assert kept == ["s1", "s2", "1", "2", "s3"]


def test_strip_and_suffix_helpers(spark):
    df = spark.createDataFrame([("　 a b\n\t", "http://stories.example/bedtime/")], ["s", "u"])
    r = df.select(TX.py_strip("s").alias("a"), TX.py_rstrip("s").alias("b"),
                  TX.url_suffix("u").alias("c")).collect()[0]
    assert (r.a, r.b, r.c) == ("a b", "　 a b", "bedtime")


def test_resolve_href(spark):
    base = "http://h.example/cat/list_1.html?x=1#f"
    hrefs = ["list_2.html", "/a/b", "//o.example/p", "https://z/", "?page=3"]
    df = spark.createDataFrame([(h,) for h in hrefs], ["h"])
    got = [r[0] for r in df.select(TX.resolve_href(F.lit(base), F.col("h"))).collect()]
    assert got == ["http://h.example/cat/list_2.html", "http://h.example/a/b",
                   "http://o.example/p", "https://z/", "http://h.example/cat/list_1.html?page=3"]


def _links(spark):
    data = [("t1", "u1", "c0", 0, 1, 0, 0), ("t2", "u2", "c0", 0, 1, 0, 1),
            ("t1", "u3", "c1", 1, 1, 0, 0), ("t1", "u4", "c1", 1, 2, 0, 5)]
    return spark.createDataFrame(
        data, "title string, url string, category string, category_no int, page_no int, "
              "phase int, elem_seq int")


def test_dedup_first_and_last(spark):
    df = _links(spark)
    first = rows(L.dedup_first(df), "title", "url")
    last = L.dedup_last(df)
    assert first == [("t1", "u1"), ("t2", "u2")]
    assert rows(last, "title", "url", "category") == [("t1", "u4", "c1"), ("t2", "u2", "c0")]
    fo = {r.title: tuple(r.first_ord) for r in last.collect()}
    assert fo["t1"] == (0, 1, 0, 0)


def test_dedup_is_idempotent_and_partition_independent(spark):
    df = _links(spark)
    once = rows(L.dedup_last(df), "title", "url")
    again = L.dedup_last(L.dedup_last(df).select(
        "title", "url", "category", F.col("first_ord.*")))
    assert rows(again, "title", "url") == once
    assert rows(L.dedup_last(df.repartition(1)), "title", "url") == \
        rows(L.dedup_last(df.repartition(8)), "title", "url")


def test_exclude_recent_only_from_page_two(spark):
    df = _links(spark)
    recent = spark.createDataFrame([("t1",)], ["title"])
    got = rows(L.exclude_recent(df, recent), "url")
    assert got == [("u1",), ("u2",), ("u3",)]


def test_entities_decode_like_python(spark):
    import html
    texts = ["a&amping &copyright", "&amp;lt; &lt;b&gt;", "x &quot;y&quot z&nbsp;",
             "&apos; &apos q", "tail &amp", "&#39;ok"]
    df = spark.createDataFrame([(t,) for t in texts], ["t"])
    got = [r[0] for r in df.select(TX.unescape_entities("t")).collect()]
    assert got == [html.unescape(t) for t in texts]


def test_through_index_equals_the_window_form(spark):
    import random
    from pyspark.sql import functions as F
    rng = random.Random(3)
    pages = [(p, [(i, rng.choice(["1", "２", "a", "b", None, "9x"])) for i in range(rng.randrange(12))]) for p in range(60)]
    arrays = spark.createDataFrame(pages, "page_id int, links array<struct<elem_seq int, title string>>")
    flat = arrays.select("page_id", F.inline("links")).filter("title is not null")
    got = rows(arrays.withColumn("links", F.filter("links", lambda x: x["title"].isNotNull()))
               .select("page_id", F.inline(L.through_index(F.col("links")))), "page_id", "elem_seq", "title")
    assert got == rows(L.take_through_index(flat), "page_id", "elem_seq", "title")


def test_recent_block_of_the_first_category_that_has_one(spark):
    rec = spark.createDataFrame([(2, "t2"), (2, "t1"), (5, "t3")], "category_no int, title string")
    assert rows(L.first_block(rec), "category_no", "title") == [(2, "t1"), (2, "t2")]
    assert L.first_block(rec.filter("category_no > 9")).collect() == []
    links = spark.createDataFrame([(c, p, "t1") for c in (1, 2, 3) for p in (1, 2)], "category_no int, page_no int, title string")
    kept = L.exclude_recent(links, L.first_block(rec), since="category_no")
    assert rows(kept, "category_no", "page_no") == [(1, 1), (1, 2), (2, 1), (3, 1)]


def test_categories_that_lead_to_stories(spark):
    cats = spark.createDataFrame([("h", "a", "ca"), ("h", "b", "cb"), ("h", "c", "cc")], "key string, category string, url string")
    pairs = spark.createDataFrame([("h", "ca"), ("h", "cb"), ("ca", "s1"), ("ca", "s1"), ("cb", "x"), ("cc", "s1")], "u string, v string")
    stories = spark.createDataFrame([("s1",), ("s2",)], "url string")
    assert rows(L.leading_to_stories(cats, pairs, stories), "category") == [("a",)]
