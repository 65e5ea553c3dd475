"""Pages to tables: golden pages in the shapes of FIXTURES.md §2."""

from conftest import pages_df, rows
from pyspark.sql import functions as F

from pagetables.operators import html as H

LISTING = """<html><body><ul>
<li><a href="/bedtime/101.html" target="_blank">小猫钓鱼 </a><span>2024-01-02</span></li>
<li><a href="/bedtime/102.html" target="_blank">　晚安小故事</a></li>
<li><a name="no-href">no link</a></li>
<li><a href='/bedtime/103.html'>Tom &amp; Jerry</a></li>
</ul><script>var s = "<a href='/x'>x</a>";</script><!-- <a href="/c">c</a> -->
<div class="pages"><ul><li><a href="list_1_2.html">下一页</a></li><li><a href="list_1_9.html">末页</a></li></ul></div>
</body></html>"""

STORY_DIV = ("<html><body><div class=\"content\"><p><p>　　第一段\r</p><p>第二段 \r"
             "</p></div><div class=\"content\">second</div></body></html>")

NESTED = ("<html><head><script>var t=\"</p>\";</script></head><body><article><h1>The Title</h1>"
          "<p><b>The Title here<br><p>Story text.</p><p>More.</p></article></body></html>")


def test_anchors_in_order_with_quotes_entities_and_no_script(spark):
    df = H.extract_anchors(pages_df(spark, [(1, "http://x/bedtime/", LISTING)]))
    got = rows(df, "elem_seq", "href", "text")
    assert got == [
        (0, "/bedtime/101.html", "小猫钓鱼"),
        (1, "/bedtime/102.html", "晚安小故事"),
        (2, "/bedtime/103.html", "Tom & Jerry"),
        (3, "list_1_2.html", "下一页"),
        (4, "list_1_9.html", "末页"),
    ]


def test_tree_parse_anchors_equal_regex_anchors(spark):
    p = pages_df(spark, [(1, "http://x/bedtime/", LISTING), (2, "http://y/", NESTED)])
    h1 = H.anchors_from_elements(H.shred_elements(p, tags=["a"]))
    h2 = H.extract_anchors(p).select("page_id", "elem_seq", "href", "text")
    assert h1.exceptAll(h2).count() == 0 and h2.exceptAll(h1).count() == 0


def test_nested_unclosed_paragraphs_and_script_end_tag(spark):
    el = H.shred_elements(pages_df(spark, [(7, "u", NESTED)]), tags=["p", "h1"])
    paras = rows(H.paragraphs(el), "p_no", "text")
    # the outer <p> is never closed, so it holds the later paragraphs too
    assert paras[0] == (0, "The Title hereStory text.More.")
    assert paras[1:] == [(1, "Story text."), (2, "More.")]
    assert rows(H.heading_title(el), "page_id", "title") == [(7, "The Title")]


def test_first_by_class_keeps_raw_text(spark):
    el = H.shred_elements(pages_df(spark, [(3, "u", STORY_DIV)]), tags=["div"])
    got = H.first_by_class(el, "div", "content").collect()
    assert got[0]["text"] == "　　第一段\r第二段 \r"


def test_anchors_after_marker(spark):
    html = ("<html><body><a href=\"/bedtime/1.html\">old</a>"
            "<div><span class=\"on\">最新发布</span><ul><li><span>d</span>"
            "<a href=\"/bedtime/2.html\">新</a></li><li><a href=\"/fairy/3.html\">别</a></li>"
            "<li><a href=\"list_1_2.html\">下一页</a></li><li><a href=\"/x/4.htm\">htm</a></li>"
            "</ul></div></body></html>")
    el = H.shred_elements(pages_df(spark, [(1, "u", html)]), tags=["span", "a"])
    got = rows(H.anchors_after_marker(el, "span", "最新发布", ".html"), "href")
    assert got == [("/bedtime/2.html",), ("/fairy/3.html",), ("list_1_2.html",)]


def test_snapshot_selectors_links_and_images(spark):
    html = ("<html><head><title> T  </title></head><body><div class=\"ad\">BUY</div>"
            "<div class=\"main\"><h2>Head</h2><p>Hello <a href=\"/s/1\">one</a></p>"
            "<img src=\"/i.png\" alt=\"pic\"></div><div class=\"share\"><a href=\"/sh\">s</a></div>"
            "</body></html>")
    p = pages_df(spark, [(1, "http://h.example/a/", html)])
    s = H.page_snapshot(p, exclude=H.FURNITURE_SELECTORS, links_at_end=True,
                        images_at_end=True).collect()[0]
    assert "BUY" not in s["snapshot"] and "/sh" not in s["snapshot"]
    assert s["title"] == "T"
    assert s["snapshot"].endswith("Links/Buttons:\n- [one](http://h.example/s/1)\n\n"
                                  "Images:\n- ![pic](http://h.example/i.png)")
    t = H.page_snapshot(p, target=[".main"], remove_images=True, fmt="text").collect()[0]
    assert t["snapshot"] == "Head\nHello one" and t["images"] == []
    md = H.page_snapshot(p, target=[".main"], fmt="markdown").collect()[0]
    assert "## Head" in md["snapshot"] and "[one](/s/1)" in md["snapshot"]


def test_links_section_is_null_when_absent(spark):
    df = spark.createDataFrame([("abc Links/Buttons:\n- [a](b)",), ("no links",)], ["s"])
    got = [r[0] for r in df.select(H.links_section(F.col("s"))).collect()]
    assert got == ["Links/Buttons:\n- [a](b)", None]


def test_byline_and_main_text(spark):
    html = ("<html><body><header><p>By Site Staff</p></header><article><h1>T</h1>"
            "<p>By: Jane Doe</p><p>Para one.</p><div class=\"related-posts\"><p>Other</p></div>"
            "<p>Para two.</p></article><footer><p>foot</p></footer></body></html>")
    p = pages_df(spark, [(1, "u", html), (2, "v", "<p>no byline</p>")])
    el = H.shred_elements(p, tags=H.BYLINE_TAGS)
    assert rows(H.byline_author(el, p), "page_id", "author") == [(1, "Site Staff"), (2, "")]
    mt = rows(H.main_text(p), "page_id", "text")
    assert mt == [(1, "By: Jane Doe\nPara one.\nPara two."), (2, "no byline")]


def test_main_text_skips_paragraphs_nested_through_other_tags(spark):
    p = pages_df(spark, [(1, "u", NESTED)])
    assert rows(H.main_text(p), "text") == [("The Title hereStory text.More.",)]


def test_snapshot_record_and_html_format(spark):
    html = ('<html><head><title>T</title></head><body><div class="ad">x</div>'
            '<p>a &amp; <b>b</b></p></body></html>')
    p = pages_df(spark, [(1, "http://h.example/", html)])
    r = H.page_snapshot(p, exclude=[".ad"], as_struct=True).collect()[0]
    assert (r.record.url, r.record.title, r.record.content) == ("http://h.example/", "T", "a & b")
    h = H.page_snapshot(p, exclude=[".ad"], fmt="html").collect()[0]
    assert "<p>a &amp; <b>b</b></p>" in h.snapshot and "class=\"ad\"" not in h.snapshot


def test_quoted_greater_than_inside_attributes(spark):
    html = ('<p><a title="x>y" href="/z">t</a> <a data-x=\'q\' href=/u class="c>">u</a>'
            '<a name=n>no</a></p>')
    p = pages_df(spark, [(1, "u", html)])
    h2 = rows(H.extract_anchors(p), "href", "text")
    h1 = rows(H.anchors_from_elements(H.shred_elements(p, tags=["a"])), "href", "text")
    assert h2 == h1 == [("/u", "u"), ("/z", "t")]


def test_a_page_leaves_the_parse_about_as_long_as_it_came(spark):
    html = "".join(f"<p>w{i:03}" for i in range(4000))
    p = pages_df(spark, [(1, "u", html)])
    r = H.page_spans(p).select("buffer", F.to_json("elems").alias("elems"), "elems.start", "elems.stop", "elems.outer_seq").first()
    assert bytes(r.buffer).decode() == html.replace("<p>", "") and len(r.start) == 4000
    assert r.start == sorted(r.start) and set(r.stop) == {len(r.buffer)} and r.outer_seq == [-1] + [0] * 3999
    assert rows(H.main_text(p), "text") == [(html.replace("<p>", ""),)]
    assert H.paragraphs(H.page_elements(p)).filter("p_no = 3999").first().text == "w3999"
    assert H.page_snapshot(p, fmt="text").first().snapshot.split("\n") == [f"w{i:03}" for i in range(4000)]


def test_ranges_count_bytes_and_tell_what_lies_inside(spark):
    html = "é<div class='x'>漢<b>𝒳</b><br>z</div><script>no</script><i/>&amp;"
    e = H.page_spans(pages_df(spark, [(1, "u", html)])).select("buffer", "elems").first()
    text = bytes(e.buffer)
    got = {x.tag: (text[x.start:x.stop].decode(), x.elem_seq, x.last_seq, x.parent_seq, x.depth) for x in e.elems}
    assert text.decode() == "é漢𝒳z&"
    assert got == {"div": ("漢𝒳z", 0, 2, -1, 0), "b": ("𝒳", 1, 1, 0, 1), "br": ("", 2, 2, 0, 1), "script": ("", 3, 3, -1, 0),
                   "i": ("", 4, 4, -1, 0)}


def test_spans_of_null_and_empty_pages_and_kept_columns(spark):
    p = pages_df(spark, [(1, "u", None), (2, "v", ""), (None, "w", "<p>x")])
    got = H.page_spans(p, keep_cols=("url",)).collect()
    assert sorted((r.url, bytes(r.buffer), len(r.elems)) for r in got) == [("u", b"", 0), ("v", b"", 0), ("w", b"x", 1)]
    s = {r.url: r.snapshot for r in H.page_snapshot(p.withColumn("url", F.expr("if(url = 'w', null, url)")), links_at_end=True).collect()}
    assert s["u"] == "Title: \n\nURL Source: u\n\nMarkdown Content:\n\n\nLinks/Buttons:\n" and "URL Source: \n" in s[None]


def test_links_in_snapshots(spark):
    html = ('<a href="1">one<div>two</div>three <b>x\n y</b></a> <a href="2"> out <a href="../3?q#f">in</a></a>'
            '<a name="n">no</a><ul><li><a href="">self</a><li><a href="//o.example/z"><img src="i.png" alt="I"></a></ul>')
    p = pages_df(spark, [(1, "http://h.example/a/b/c.html", html)])
    r = H.page_snapshot(p).first()
    assert [(x.text, x.href) for x in r.links] == [
        ("one two three x y", "http://h.example/a/b/1"), ("out in", "http://h.example/a/b/2"), ("in", "http://h.example/a/3?q"),
        ("self", "http://h.example/a/b/c.html"), ("", "http://o.example/z")]
    assert r.body_text == "one\ntwo\nthree x\ny out inno\nself"
    md = H.page_snapshot(p, fmt="markdown").first()
    assert md.body_text.split("\n") == ["[one two three x y](1) [out [in](../3?q#f)](2)no", "[self]()", "[![I](i.png)](//o.example/z)"]
    assert [(x.alt, x.src) for x in md.images] == [("I", "http://h.example/a/b/i.png")]
    bare = H.page_snapshot(p, fmt="markdown", remove_images=True).first()
    assert "I]" not in bare.body_text and bare.images == []


def test_html_is_written_anew(spark):
    html = '<p class="a&quot;b" id=x>1 &lt; 2<br><img alt="&amp;">&quot;q&quot;<i>open'
    r = H.page_snapshot(pages_df(spark, [(1, "u", html)]), fmt="html").first()
    assert r.snapshot == '<p class="a&quot;b" id="x">1 &lt; 2\n<br><img alt="&amp;">"q"<i>open</i></p>'
    t = H.page_snapshot(pages_df(spark, [(1, "u", "<title>A\n B</title><h3>H</h3><p>x")]), fmt="markdown", target=["h3"]).first()
    assert (t.title, t.body_text) == ("A B", "### H")
