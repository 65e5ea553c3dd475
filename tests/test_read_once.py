"""What several steps read is made once."""

from pyspark.sql import functions as F

from conftest import pages_df
from pagetables.operators import merge as M
from pagetables.plans import paginate as P
from pagetables.plans import pipelines as PL

N = 6


def _counted(spark, df, col):
    """``df`` and the number of times that a value of its column was made."""
    acc = spark.sparkContext.accumulator(0)

    def made(x):
        acc.add(1)
        return x
    return df.withColumn(col, F.udf(made, "string")(col)), acc


def _chain(spark):
    url = "http://t.example/c1/list_{}.html".format
    return pages_df(spark, [(i, url(i), f'<a href="list_{i + 1}.html">下一页</a>') for i in range(N)]), \
        spark.createDataFrame([(1, "c", url(0))], "category_no int, category string, url string"), [url(i) for i in range(N)]


def test_recursive_walk_reads_pages_once(spark):
    pages, seeds, urls = _chain(spark)
    pages, acc = _counted(spark, pages, "html")
    got = P.follow_next(pages, seeds, method="recursive").orderBy("page_no").collect()
    assert [(r.page_no, r.url) for r in got] == list(enumerate(urls, 1))
    assert acc.value == N


def test_recursive_walk_has_no_row_limit(spark):
    pages, seeds, urls = _chain(spark)
    key = "spark.sql.cteRecursionRowLimit"
    old = spark.conf.get(key)
    spark.conf.set(key, "3")
    try:
        assert P.follow_next(pages, seeds, method="recursive").count() == N
    finally:
        spark.conf.set(key, old)


def test_answers_are_made_once(spark):
    rows = [("home", "categories", '{"categories": {"a": "l1"}}'), ("l1", "decision", '{"decision": true}'),
            ("l1", "titles", '{"titles_and_urls": {"T": "s1"}, "next_page": "l2"}'),
            ("l2", "titles", '{"titles_and_urls": {"U": "s2"}, "next_page": ""}'),
            ("s1", "story", '{"title": "T", "author": "x", "content": "once"}')]
    c, acc = _counted(spark, spark.createDataFrame(rows, "key string, kind string, content string"), "content")
    got = {(r.title, r.author, r.content, r.category, r.url) for r in PL.story_table_from_answers(c).collect()}
    assert got == {("T", "x", "once", "a", "s1"), ("U", "", "", "a", "s2")}
    assert acc.value == len(rows)


def test_embedder_hashes_a_word_once_a_batch(monkeypatch):
    seen, md5 = [], M.hashlib.md5
    monkeypatch.setattr(M.hashlib, "md5", lambda b: seen.append(b) or md5(b))
    got = M.hashed_embedder(8)(["b a b", "a", "", None])
    assert sorted(seen) == [b"a", b"b"]
    assert [v.sum() for v in got] == [3, 1, 0, 0] and all(len(v) == 8 for v in got)


def test_normalised_vectors(spark):
    from pagetables.functions.vectors import l2_normalize_expr
    df = spark.createDataFrame([(0, [3.0, 4.0]), (1, [0.0, 0.0]), (2, None), (3, []), (4, [None, 1.0])], "i int, v array<double>")
    got = {r.i: r.n for r in df.select("i", l2_normalize_expr("v").alias("n")).collect()}
    assert got == {0: [0.6, 0.8], 1: [0.0, 0.0], 2: None, 3: [], 4: got[4]}
    plan = df.select(l2_normalize_expr("v").alias("n"))._jdf.queryExecution().analyzed().toString()
    assert "/ greatest(" not in plan      # the norm is not summed for every component
