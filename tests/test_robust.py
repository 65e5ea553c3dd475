"""Ordinary web markup and data: references, urls, bad bytes, long chains, repeats."""

import html as pyhtml
import json
from urllib.parse import urldefrag, urljoin

from conftest import pages_df, rows
from pyspark.sql import functions as F

from pagetables.functions.text import resolve_href, unescape_entities
from pagetables.operators import answers as X
from pagetables.operators import content as C
from pagetables.operators import html as H
from pagetables.operators import links as L
from pagetables.plans import paginate as P
from pagetables.plans.pipelines import story_table_from_answers
from pagetables.sources import readers as R


def test_references_like_python(spark):
    texts = ["Tom &mdash; Jerry&#8217;s &hellip; caf&eacute;", "&amp;lt; &ampx &copy=2 &notit; &notin; &#x1F600; &#128; &#0;",
             "&#xD800; &#99999999999; & &; &#; &#x; a&b&amp;", "&#39;&#390;&apos;&nbsp", "plain", "&#13;&#1;&#x7f;&NotEqualTilde;&AMP"]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select(unescape_entities("t")).collect()
    assert [r[0] for r in got] == [pyhtml.unescape(t) for t in texts]


def test_urls_like_urljoin(spark):
    bases = ["http://h.example/a/b/list_1.html", "http://h.example", "http://h.example/a/?q=1#z"]
    hrefs = ["./list_2.html", "../cat/list_2.html", "list_2.html#top", "x.html", "/r/../s.html", "?p=2", "#f", "",
             "//o.example/x", "https://q/z", "../../../up/", "..", ".", "a/./b/../c?d=../e"]
    pairs = [(b, h) for b in bases for h in hrefs]
    got = spark.createDataFrame(pairs, "b string, h string").select("b", "h", resolve_href("b", "h").alias("u")).collect()
    assert all(r.u == urldefrag(urljoin(r.b, r.h))[0] for r in got)


def test_hard_anchors_equal_the_tree(spark):
    many = " ".join(f'd{i}="{i}"' for i in range(5000))
    p = pages_df(spark, [
        (1, "u", '<a href="/1">one<a href="/2">two</a><a href="/3">three'), (2, "u", '<a href="/x" ' + "y" * 50_000 + ">t</a>"),
        (3, "u", "<p><a name=q>no</a><a title=\"a > b href=z\" HREF='/k?a&amp;b'>A &mdash; <b>x</b></a></a><a href=\"\">e</a>"),
        (4, "u", "none"), (5, "u", ""), (6, "u", f"<a {many} href=/l>deep</a> <abbr>no</abbr>")])
    cols = ("page_id", "elem_seq", "href", "text")
    got = rows(H.extract_anchors(p), *cols)
    assert got == rows(H.anchors_from_elements(H.shred_elements(p, tags=["a"])), *cols) and len(got) == 7


def test_split_label_and_long_chains(spark):
    n = 1010
    label = ["下一页", "下一<b>页</b>", "&#19979;&#19968;&#39029;"]
    p = pages_df(spark, [(i, f"http://h/c/list_{i}.html", f'<a href="./list_{i + 1}.html#top">{label[i % 3]}</a>')
                         for i in range(1, n + 1)])
    seeds = spark.createDataFrame([(0, "c", "http://h/c/list_1.html")], "category_no int, category string, url string")
    assert P.follow_next(p, seeds).count() == n
    num = pages_df(spark, [(i, f"http://h/news/s/{i}", "".join(
        f'<a href="/news/s/{k}">{k}</a>' for k in (i, i + 1) if k <= n)) for i in range(1, n + 1)])
    s2 = spark.createDataFrame([(0, "c", "http://h/news/s/1".replace("/1", ""))], "category_no int, category string, url string")
    first = num.withColumn("url", F.when(F.col("page_id") == 1, "http://h/news/s").otherwise(F.col("url")))
    assert P.follow_numbered(first, s2).count() == n


def test_one_page_and_one_answer_a_url(spark):
    links = spark.createDataFrame([("t", "u1", "c"), ("s", "u2", "c")], "title string, url string, category string")
    p = pages_df(spark, [(7, "u1", "b"), (3, "u1", "a"), (9, "u3", "z")])
    assert rows(C.fetch_pages(links, p), "title", "page_id", "html") == [("s", None, None), ("t", 3, "a")]
    assert rows(C.fetch_pages(links, p, cols=("page_id",)), "title", "page_id", "fetched") == [("s", None, False), ("t", 3, True)]
    st = X.parse_story(spark.createDataFrame([("u1", json.dumps({"title": "t", "author": a, "content": c})) for a, c in
                                              (("x", "late"), ("y", "early"))], "key string, content string"))
    assert rows(X.assemble_stories(links, st), "title", "author", "content") == [("s", "", ""), ("t", "y", "early")]


def test_answer_maps_keep_their_order(spark):
    c = spark.createDataFrame([("k", '{"titles_and_urls": {"z": "1", "a": "2", "m": "3"}, "next_page": "n"}')], "key string, content string")
    assert [r.title for r in X.parse_titles(c).orderBy("pos").collect()] == ["z", "a", "m"]


def answers(next_page="u2"):
    return [("home", "categories", '{"categories": {"c": "u1"}}'), ("u1", "decision", '{"decision": true}'),
            ("u1", "titles", json.dumps({"titles_and_urls": [{"title": "A", "url": "s1"}], "next_page": next_page})),
            ("u2", "titles", json.dumps({"titles_and_urls": {"B": "s2", "A": "s9"}, "next_page": "u1"})),
            ("s2", "story", json.dumps({"content": {"title": "B", "author": "w", "content": "x"}}))]


def test_answers_follow_next_pages(spark):
    c = spark.createDataFrame(answers(), "key string, kind string, content string")
    want = [("A", "", "", "c", "s9"), ("B", "w", "x", "c", "s2")]
    cols = ("title", "author", "content", "category", "url")
    assert rows(story_table_from_answers(c), *cols) == want
    linked = pages_df(spark, [(1, "u1", '<a href="u2">next</a>')]).withColumn("url", F.lit("u1"))
    real = spark.createDataFrame([(k.replace("u", "http://h/u"), kind, t.replace('"u', '"http://h/u')) for k, kind, t in answers()],
                                 "key string, kind string, content string")
    p = pages_df(spark, [(1, "http://h/u1", '<a href="u2">next</a>'), (2, "http://h/u2", "")])
    assert [r[0] for r in rows(story_table_from_answers(real, p), "title")] == ["A", "B"]
    assert [r[0] for r in rows(story_table_from_answers(real, linked), "title")] == ["A"]


def test_decoding_never_fails(spark):
    raw = spark.createDataFrame([
        (1, "下一页".encode("gbk"), "GBK"), (2, "é".encode("latin-1"), "iso-8859-1"), (3, b"a\xffb", "utf-8"),
        (4, b"ok", None), (5, b"\x81", "gb2312"), (6, b"x", "nope"), (7, None, "gbk"), (8, "国".encode("gb18030"), "gb18030")],
        "page_id long, body binary, charset string")
    got = rows(R.decode_pages(raw, status="status"), "page_id", "html", "status")
    assert got == [(1, "下一页", "ok"), (2, "é", "ok"), (3, "a�b", "replaced"), (4, "ok", "ok"), (5, "�", "replaced"),
                   (6, "x", "unknown_charset"), (7, None, None), (8, "国", "ok")]


def test_home_links_and_null_titles(spark):
    l = spark.createDataFrame([("/a/b.html", "http://h/x"), ("http://h/", "http://h/x"), ("/", "http://h/x"), ("", "http://h/x"),
                               ("http://o/p", "http://h/x"), ("http://h/p ", "http://h/x")], "url string, page string")
    assert rows(L.drop_home_links(l, "url", "page"), "url") == [("/a/b.html",), ("http://h/p",)]
    t = spark.createDataFrame([("a",), (None,)], "title string")
    stop = spark.createDataFrame([("a",)], "w string")
    assert L.drop_ignored_titles(t, ["a"]).collect() == L.drop_ignored_titles(t, stop).collect() == [(None,)]
