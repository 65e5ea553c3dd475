"""The two crawls end to end on small golden sites (FIXTURES.md §2 shapes)."""

from conftest import pages_df, rows

from pagetables.plans import pipelines as PL
from pagetables.sources import readers as R

H = "http://s.example/"


def _listing(stories, recent=(), nxt=None):
    s = "".join(f'<li><a href="{h}" target="_blank">{t}</a><span>2024-01-01</span></li>'
                for h, t in stories)
    r = ""
    if recent:
        r = ('<div><span class="on">最新发布</span><ul>' + "".join(
            f'<li><span>2024</span><a href="{h}">{t}</a></li>' for h, t in recent) + "</ul></div>")
    n = f'<li><a href="{nxt}">下一页</a></li>' if nxt else ""
    return f'<html><body><ul>{s}</ul>{r}<div class="pages"><ul>{n}</ul></div></body></html>'


def _story(text):
    return f'<html><body><div class="content"><p>　　{text}\r</p></div></body></html>'


def test_story_table_by_label(spark):
    pages = pages_df(spark, [
        (1, H + "bedtime/", _listing(
            [("/bedtime/1.html", "T1"), ("/bedtime/2.html", "晚安小故事")],
            recent=[("/bedtime/9.html", " R1 "), ("/fairy/8.html", "X")], nxt="list_1_2.html")),
        (2, H + "bedtime/list_1_2.html", _listing(
            [("/bedtime/3.html", "T2"), ("/bedtime/9b.html", "R1")])),
        (3, H + "talesdaquan/", _listing(
            [("/a/5.html", "T1"), ("/talesdaquan/6.html", "W")], nxt="list_2.html")),
        (4, H + "talesdaquan/list_2.html", _listing([("/a/7.html", "R1"), ("/a/10.html", "T3")])),
        (11, H + "bedtime/1.html", _story("one")),
        (13, H + "bedtime/3.html", _story("two 　")),
        (15, H + "a/5.html", _story("five")),
        (19, H + "bedtime/9.html", _story("nine")),
    ])
    seeds = R.category_seeds(spark, {"晚安故事": H + "bedtime/", "故事合集": H + "talesdaquan/"})
    out = PL.story_table_by_label(pages, seeds, ignore=["晚安小故事"],
                                  suffix_overrides={"故事合集": "a"})
    assert rows(out, "name", "url", "category", "content") == sorted([
        ("T1", H + "a/5.html", "故事合集", "five"),        # last write wins across categories
        ("T2", H + "bedtime/3.html", "晚安故事", "two"),   # cleaned: \r and U+3000 gone
        ("R1", H + "bedtime/9.html", "晚安故事", "nine"),  # recent kept off pages >= 2
        ("T3", H + "a/10.html", "故事合集", None),          # story page not landed
    ])


def _num(parts):
    return "<html><body>" + "".join(parts) + "</body></html>"


def _a(href, t):
    return f'<a href="{href}">{t}</a>'


def test_story_table_by_number_from_gbk_pages(spark):
    N = "http://n.example"
    p1 = _num([f'<p align="left"><img src="/i.gif"/>{_a("/news/tales/a1.htm", "山里的小熊")}</p>',
               _a("/news/tales/", "孩子们的故事"), _a("/news/tales/", "1"),
               _a("/news/tales/list_2.htm", "2"), _a("/news/tales/a2.htm", "小猫"),
               _a("/news/tales/a3.htm", "不读")])
    p2 = _num([_a("/news/tales/a9.htm", "山里的小熊"), _a("/news/tales/a4.htm", "河边的石头"),
               _a("/news/tales/", "1"), _a("/news/tales/list_2.htm", "2")])
    story = {"a1": "<p>网站</p><p>山里的小熊</p><p>小熊的故事。</p>",
             "a2": "<p>小猫</p><p> 小猫钓鱼。</p>",
             "a4": "<p>没有标题</p><p>x</p>"}
    raw = [(1, f"{N}/news/tales/", p1), (2, f"{N}/news/tales/list_2.htm", p2)] + \
          [(10 + i, f"{N}/news/tales/{k}.htm", _num([v])) for i, (k, v) in enumerate(story.items())]
    df = spark.createDataFrame([(i, u, bytearray(h.encode("gbk")), "gbk") for i, u, h in raw],
                               R.RAW_PAGES_SCHEMA)
    pages = R.decode_pages(df).select("page_id", "url", "html")
    seeds = R.category_seeds(spark, {"孩子们的故事": f"{N}/news/tales/"})
    out = PL.story_table_by_number(pages, seeds, ignore=["孩子们的故事"])
    assert rows(out, "title", "text", "category", "story_url") == sorted([
        ("山里的小熊", "小熊的故事。", "孩子们的故事", f"{N}/news/tales/a1.htm"),   # first wins
        ("小猫", "小猫钓鱼。", "孩子们的故事", f"{N}/news/tales/a2.htm"),
    ])


def test_recent_block_per_category_option(spark):
    pages = pages_df(spark, [
        (1, H + "a/", _listing([("/a/1.html", "A1")], recent=[("/a/9.html", "R")],
                               nxt="list_2.html")),
        (2, H + "a/list_2.html", _listing([("/a/2.html", "R")])),
        (3, H + "b/", _listing([("/b/1.html", "B1")], recent=[("/b/9.html", "S")],
                               nxt="list_2.html")),
        (4, H + "b/list_2.html", _listing([("/b/2.html", "S"), ("/b/3.html", "R")])),
    ])
    seeds = R.category_seeds(spark, {"a": H + "a/", "b": H + "b/"})
    first = rows(PL.label_links(pages, seeds), "title", "url")
    each = rows(PL.label_links(pages, seeds, recent_from="each"), "title", "url")
    # first: only a's block is read, so R stays off b's page 2 while S (b's) does not
    assert first == [("A1", H + "a/1.html"), ("B1", H + "b/1.html"), ("R", H + "a/9.html"),
                     ("S", H + "b/2.html")]
    # each: b's block keeps S off b's page 2; a's R is kept off a's pages only
    assert each == [("A1", H + "a/1.html"), ("B1", H + "b/1.html"), ("R", H + "b/3.html"),
                    ("S", H + "b/9.html")]


def test_empty_answers_send_the_walk_to_whole_pages(spark):
    """The switch comes with the first empty answer of a category and stays for its later pages."""
    import json
    from pagetables.plans.pipelines import story_table_from_answers

    def listing(rows, nxt=""):
        return json.dumps({"titles_and_urls": [{"title": t, "url": u} for t, u in rows], "next_page": nxt})
    home = json.dumps({"categories": {"one": "c1", "two": "d1", "no": "n1"}})
    a = [("home", "categories", home), ("c1", "decision", '{"decision": true}'), ("d1", "decision", '{"decision": true}'),
         ("c1", "titles", listing([("A", "s1")], "c2")),
         ("c2", "titles", listing([], "lost")), ("c2", "titles_full", listing([("B", "s2")], "c3")),
         ("c3", "titles", listing([("links only", "x")], "")), ("c3", "titles_full", listing([("C", "s3"), ("A", "s9")], "c1")),
         ("c1", "titles_full", listing([("again", "s4")], "c2")),
         ("d1", "titles", listing([("D", "s5")], "c3")), ("n1", "titles", listing([("N", "s6")]))]
    c = spark.createDataFrame(a, "key string, kind string, content string")
    got = rows(story_table_from_answers(c), "title", "url", "category")
    assert got == [("A", "s9", "one"), ("B", "s2", "one"), ("C", "s3", "one"), ("D", "s5", "two"), ("again", "s4", "one"),
                   ("links only", "x", "two")]
    bad = c.filter("key <> 'c2' or kind <> 'titles'").union(spark.createDataFrame([("c2", "titles", "oops")], c.schema))
    assert rows(story_table_from_answers(bad), "title", "url", "category") == got
