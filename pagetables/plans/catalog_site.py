"""Listing sites that Spark derives from the ``conversations`` table.

The driver's ``pages`` table holds article pages with navigation links but
no pagers, so the walks (I1, I2) and the two crawl pipelines (Q1, Q2) run on
sites built from ``conversations``: one category per conversation, one
listing page per turn, one story per line of a turn.  Everything is a
projection or a window over the conversation rows, so the site grows with
the table.  Rules (restated by the SQL oracles):

* label site: page 1 of category c is ``http://tales.example/c{c}/``, page
  t+1 is ``.../list_{c}_{t+1}.html``.  A page lists its turn's lines as
  stories (``/c{c}/{c}_{t}_{i}.html``, title = first word of the line), then
  a pager with ``首页``, ``下一页`` (to the next turn, missing on a
  ``system`` turn; on the last turn of a conversation that ends with an
  ``assistant`` turn it points back to page 2, a cycle) and ``末页``.
  Page 1 also has a recent block (``最新发布``) listing the last turn's
  stories.  Story pages hold the line in ``div.content`` with ideographic
  spaces and a carriage return; lines of ``system`` turns have no story page.
* number site: page n of category c is ``http://num.example/news/c{c}/``
  (n = 1) or ``.../list_{n}.htm``; a page lists the first half of its lines,
  then page numbers n-2 .. n+2 (n+1 left out when the turn is ``system``),
  then the other half.  Story pages are ``<p>`` title, ``<p>`` story.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fixed values of the derived sites.
LABEL_HOST = "http://tales.example/"
NUMBER_HOST = "http://num.example"
NEXT_LABEL = "下一页"
FIRST_LABEL = "首页"
LAST_LABEL = "末页"
RECENT_LABEL = "最新发布"
LIST_DATE = "2031-02-07"
NUMBER_SITE_NAME = "故事网"
TITLE_RE = "^[ \\t\\r]*([^ \\t\\n\\r]+)"


def esc(c: Column) -> Column:
    """Minimal html escaping of text put into markup."""
    return F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")),
                               F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


def _turns(conversations: DataFrame) -> DataFrame:
    w = Window.partitionBy("conv_id")
    wo = Window.partitionBy("conv_id").orderBy("turn")
    return conversations.select(
        "conv_id", "turn", "role", "text",
        F.max("turn").over(w).alias("last_turn"),
        F.last("text").over(wo.rowsBetween(Window.unboundedPreceding,
                                           Window.unboundedFollowing)).alias("last_text"),
        F.last("role").over(wo.rowsBetween(Window.unboundedPreceding,
                                           Window.unboundedFollowing)).alias("last_role"))


def _lines(text: Column) -> Column:
    """array<struct<i, title, line>> of a turn's lines with a non-empty first word."""
    arr = F.transform(F.split(text, "\n"),
                      lambda line, i: F.struct(i.alias("i"),
                                               F.regexp_extract(line, TITLE_RE, 1).alias("title"),
                                               line.alias("line")))
    return F.filter(arr, lambda s: s["title"] != "")


def label_categories(conversations: DataFrame) -> DataFrame:
    """Seeds of the label site: (category_no, category, url)."""
    return (conversations.select("conv_id").distinct()
            .select(F.col("conv_id").cast("int").alias("category_no"),
                    F.concat(F.lit("cat"), F.col("conv_id")).alias("category"),
                    F.concat(F.lit(LABEL_HOST + "c"), F.col("conv_id"), F.lit("/")).alias("url")))


def label_site(conversations: DataFrame) -> DataFrame:
    """Listing and story pages of the label site: (page_id, url, html)."""
    t = (_turns(conversations).withColumn("_ls", _lines(F.col("text")))
         .withColumn("_lls", _lines(F.col("last_text"))))
    c = F.col("conv_id").cast("string")
    cat_url = F.concat(F.lit(LABEL_HOST + "c"), c, F.lit("/"))
    page_url = F.when(F.col("turn") == 0, cat_url).otherwise(
        F.concat(cat_url, F.lit("list_"), c, F.lit("_"), (F.col("turn") + 1).cast("string"),
                 F.lit(".html")))

    def story_href(turn_col):
        return lambda s: F.concat(F.lit("/c"), c, F.lit("/"), c, F.lit("_"),
                                  turn_col.cast("string"), F.lit("_"), s["i"].cast("string"),
                                  F.lit(".html"))

    items = F.array_join(F.transform(F.col("_ls"), lambda s: F.concat(
        F.lit("<li><a href=\""), story_href(F.col("turn"))(s), F.lit("\" target=\"_blank\">"),
        esc(s["title"]), F.lit("</a><span>" + LIST_DATE + "</span></li>"))), "")
    recent = F.when(F.col("turn") == 0, F.concat(
        F.lit("<div class=\"recent\"><span class=\"on\">" + RECENT_LABEL + "</span><ul>"),
        F.array_join(F.transform(F.col("_lls"), lambda s: F.concat(
            F.lit("<li><span>" + LIST_DATE + "</span><a href=\""),
            story_href(F.col("last_turn"))(s), F.lit("\">"), esc(s["title"]),
            F.lit("</a></li>"))), ""),
        F.lit("</ul></div>"))).otherwise(F.lit(""))
    nxt_turn = (F.when((F.col("turn") < F.col("last_turn")) & (F.col("role") != "system"),
                       F.col("turn") + 1)
                 .when((F.col("turn") == F.col("last_turn")) & (F.col("turn") >= 1)
                       & (F.col("role") == "assistant"), F.lit(1)))
    nxt = F.when(nxt_turn.isNotNull(), F.concat(
        F.lit("<li><a href=\"list_"), c, F.lit("_"), (nxt_turn + 1).cast("string"),
        F.lit(".html\">" + NEXT_LABEL + "</a></li>"))).otherwise(F.lit(""))
    pager = F.concat(
        F.lit("<div class=\"pages\"><ul><li><a href=\"list_"), c,
        F.lit("_1.html\">" + FIRST_LABEL + "</a></li>"), nxt,
        F.lit("<li><a href=\"list_"), c, F.lit("_"), (F.col("last_turn") + 1).cast("string"),
        F.lit(".html\">" + LAST_LABEL + "</a></li></ul></div>"))
    html = F.concat(F.lit("<html><head><meta charset=\"utf-8\"><title>cat"), c,
                    F.lit("</title></head><body><ul class=\"list\">"), items, F.lit("</ul>"),
                    recent, pager, F.lit("</body></html>"))
    listing = t.select((F.col("conv_id") * 1000 + F.col("turn")).alias("page_id"),
                       page_url.alias("url"), html.alias("html"))

    s = (t.filter(F.col("role") != "system")
          .select("conv_id", "turn", F.posexplode("_ls").alias("_p", "s")))
    cs = F.col("conv_id").cast("string")
    story_url = F.concat(F.lit(LABEL_HOST + "c"), cs, F.lit("/"), cs, F.lit("_"),
                         F.col("turn").cast("string"), F.lit("_"), F.col("s.i").cast("string"),
                         F.lit(".html"))
    story_html = F.concat(
        F.lit("<html><head><title>"), esc(F.col("s.title")),
        F.lit("</title></head><body><div class=\"nav\"><a href=\"/\">" + FIRST_LABEL
              + "</a></div><div class=\"content\"><p>　　"),
        esc(F.col("s.line")), F.lit("\r</p></div></body></html>"))
    stories = s.select(
        (F.lit(1 << 40) + F.col("conv_id") * 1000000 + F.col("turn") * 10000
         + F.col("s.i")).alias("page_id"),
        story_url.alias("url"), story_html.alias("html"))
    return listing.unionByName(stories)


def number_categories(conversations: DataFrame) -> DataFrame:
    return (conversations.select("conv_id").distinct()
            .select(F.col("conv_id").cast("int").alias("category_no"),
                    F.concat(F.lit("num"), F.col("conv_id")).alias("category"),
                    F.concat(F.lit(NUMBER_HOST + "/news/c"), F.col("conv_id"),
                             F.lit("/")).alias("url")))


def number_site(conversations: DataFrame) -> DataFrame:
    """Listing and story pages of the number site: (page_id, url, html)."""
    t = _turns(conversations).withColumn("_ls", _lines(F.col("text")))
    c = F.col("conv_id").cast("string")
    base = F.concat(F.lit("/news/c"), c, F.lit("/"))
    n = F.col("turn") + 1
    page_url = F.when(n == 1, F.concat(F.lit(NUMBER_HOST), base)).otherwise(
        F.concat(F.lit(NUMBER_HOST), base, F.lit("list_"), n.cast("string"), F.lit(".htm")))
    lines = F.col("_ls")
    half = F.floor(F.size(lines) / 2)

    def story(s):
        return F.concat(F.lit("<p align=\"left\"><img src=\"/i/arrow.gif\"/><a href=\""), base, c,
                        F.lit("_"), F.col("turn").cast("string"), F.lit("_"),
                        s["i"].cast("string"), F.lit(".htm\" target=\"_blank\">"),
                        esc(s["title"]), F.lit("</a></p>"))

    first = F.array_join(F.transform(F.filter(lines, lambda s, k: k < half), story), "")
    rest = F.array_join(F.transform(F.filter(lines, lambda s, k: k >= half), story), "")
    nums = F.filter(F.sequence(F.greatest(n - 2, F.lit(1)),
                               F.least(n + 2, F.col("last_turn") + 1)),
                    lambda m: ~((m == n + 1) & (F.col("role") == "system")))
    index = F.array_join(F.transform(nums, lambda m: F.concat(
        F.lit("<a href=\""), base,
        F.when(m == 1, F.lit("")).otherwise(F.concat(F.lit("list_"), m.cast("string"),
                                                     F.lit(".htm"))),
        F.lit("\">"), m.cast("string"), F.lit("</a> "))), "")
    html = F.concat(F.lit("<html><body><div class=\"list\"><a href=\""), base,
                    F.lit("\">" + FIRST_LABEL + "</a>"), first, F.lit("<div class=\"page\">"),
                    index, F.lit("</div>"), rest, F.lit("</div></body></html>"))
    listing = t.select((F.lit(2 << 40) + F.col("conv_id") * 1000 + F.col("turn")).alias("page_id"),
                       page_url.alias("url"), html.alias("html"))

    s = t.select("conv_id", "turn", F.posexplode(lines).alias("_p", "s"))
    cs = F.col("conv_id").cast("string")
    story_url = F.concat(F.lit(NUMBER_HOST + "/news/c"), cs, F.lit("/"), cs, F.lit("_"),
                         F.col("turn").cast("string"), F.lit("_"), F.col("s.i").cast("string"),
                         F.lit(".htm"))
    story_html = F.concat(F.lit("<html><body><p>" + NUMBER_SITE_NAME + "</p><p>"),
                          esc(F.col("s.title")), F.lit("</p><p>"), esc(F.col("s.line")),
                          F.lit("</p></body></html>"))
    stories = s.select(
        (F.lit(3 << 40) + F.col("conv_id") * 1000000 + F.col("turn") * 10000
         + F.col("s.i")).alias("page_id"),
        story_url.alias("url"), story_html.alias("html"))
    return listing.unionByName(stories)


# ---------------------------------------------------------------------------
# A completions table derived from `documents` + `labels` (answers of the four
# questions as a batch-inference job would return them).
#
#   categories  key HOME(d):  {"categories": {lang: CAT(d), source: SRC(d)}}
#   decision    key CAT(d):   {"decision": quality = 1}; unlabelled -> "yes"
#   titles      key CAT(d):   one entry per line (array form for en/fr, a map
#                             "title (i)" -> url otherwise), "next_page": ""
#   story       key STORY(d,0): nested {"content": {...}} (flat for es),
#                             author = source ('' for de)
#   toxic = 1 -> a refusal; quality = 0 and lang = de -> "oops" (bad JSON)

STORY_HOST = "http://stories.example/"
REFUSAL = "Refused: this listing holds no tales to read."


def home_url(d: Column) -> Column:
    return F.concat(F.lit(STORY_HOST + "home/"), d.cast("string"))


def cat_url(lang: Column, d: Column) -> Column:
    return F.concat(F.lit(STORY_HOST), lang, F.lit("/"), d.cast("string"), F.lit("/"))


def story_url(d: Column, i: Column) -> Column:
    return F.concat(F.lit(STORY_HOST + "story/"), d.cast("string"), F.lit("/"), i.cast("string"))


def completions(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """(key, kind, content) built row by row from documents and their labels."""
    d = documents.select("doc_id", "text", "lang", "source").join(
        labels.select("doc_id", "quality", "toxic"), "doc_id", "left")
    did = F.col("doc_id")
    toxic = F.coalesce(F.col("toxic"), F.lit(0)) == 1
    refusal = F.to_json(F.struct(F.lit(REFUSAL).alias("error")))
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = _lines(text)

    # a category has a name, and one name is one entry
    named = F.array_distinct(F.filter(F.array(F.col("lang"), F.col("source")), lambda n: n.isNotNull()))
    cats = F.to_json(F.struct(F.map_from_entries(F.transform(named, lambda n: F.struct(n, cat_url(n, did)))).alias("categories")))
    c_cat = F.when(toxic, refusal).otherwise(cats)

    c_dec = (F.when(F.col("quality") == 1, F.lit('{"decision": true}'))
              .when(F.col("quality") == 0, F.lit('{"decision": false}'))
              .otherwise(F.lit('{"decision": "yes"}')))

    entries = F.transform(lines, lambda s: F.struct(s["title"].alias("title"),
                                                    story_url(did, s["i"]).alias("url")))
    arr_form = F.to_json(F.struct(entries.alias("titles_and_urls"),
                                  F.lit("").alias("next_page")))
    map_form = F.to_json(F.struct(F.map_from_entries(F.transform(lines, lambda s: F.struct(
        F.concat(s["title"], F.lit(" ("), s["i"].cast("string"), F.lit(")")),
        story_url(did, s["i"])))).alias("titles_and_urls"), F.lit("").alias("next_page")))
    c_titles = (F.when(toxic, refusal)
                 .when((F.col("quality") == 0) & (F.col("lang") == "de"), F.lit("oops"))
                 .when(F.col("lang").isin("en", "fr"), arr_form)
                 .otherwise(map_form))

    author = F.when(F.col("lang") == "de", F.lit("")).otherwise(F.col("source"))
    first_title = F.coalesce(F.get(lines, F.lit(0))["title"], F.lit(""))      # a text may have no titles
    story = F.struct(first_title.alias("title"), author.alias("author"), text.alias("content"))
    nested = F.to_json(F.struct(story.alias("content"), F.lit("").alias("next_page")))
    flat = F.to_json(story)
    c_story = F.when(toxic, refusal).when(F.col("lang") == "es", flat).otherwise(nested)

    rows = F.array(
        F.struct(home_url(did).alias("key"), F.lit("categories").alias("kind"),
                 c_cat.alias("content")),
        F.struct(cat_url(F.col("lang"), did).alias("key"), F.lit("decision").alias("kind"),
                 c_dec.alias("content")),
        F.struct(cat_url(F.col("lang"), did).alias("key"), F.lit("titles").alias("kind"),
                 c_titles.alias("content")),
        F.struct(story_url(did, F.lit(0)).alias("key"), F.lit("story").alias("kind"),
                 c_story.alias("content")))
    return d.select(F.inline(rows))


# ---------------------------------------------------------------------------
# A crawl by answers over listings in chains, derived from `documents`: document d (n = its
# characters) has a listing LIST(d); six listings are a chain, their heads a category each.
#
#   categories  key HOME(d):  {lang-d: LIST(d)}, for heads
#   decision    key LIST(d):  true unless n % 4 = 1
#   titles      key LIST(d):  the first two lines; a refusal if n % 5 = 2, none if n % 5 = 3;
#                             next LIST(d+1), missing at the end of a chain and if n % 7 = 3
#   titles_full key LIST(d):  all lines, titles starred, next LIST(d+1); missing if n % 11 = 0
#   story       key STORY(d,0): flat; missing if n % 3 = 0
#   pages       HOME(d) links to LIST(d) unless n % 13 = 4; LIST(d) to its stories unless
#               n % 9 = 1, and to LIST(d+1) unless n % 10 = 7

CHAIN = 6


def list_url(d: Column) -> Column:
    return F.concat(F.lit(STORY_HOST + "list/"), d.cast("string"))


def _chained(documents: DataFrame) -> DataFrame:
    d = documents.select("doc_id", "text", "lang", "source", F.length("text").alias("n"))
    return d.withColumn("lines", _lines(F.col("text"))).withColumn(
        "next", F.when(F.col("doc_id") % CHAIN != CHAIN - 1, list_url(F.col("doc_id") + 1)).otherwise(""))


def chained_answers(documents: DataFrame) -> DataFrame:
    """(key, kind, content) of the chained listings."""
    d = _chained(documents)
    did, n, lines = F.col("doc_id"), F.col("n"), F.col("lines")
    head = did % CHAIN == 0

    def listing(rows, star, nxt):
        entries = F.transform(rows, lambda s: F.struct(F.concat(s["title"], F.lit(star)).alias("title"),
                                                       story_url(did, s["i"]).alias("url")))
        return F.to_json(F.struct(entries.alias("titles_and_urls"), nxt.alias("next_page")))
    named = F.when(n % 5 == 2, F.to_json(F.struct(F.lit(REFUSAL).alias("error")))).otherwise(listing(
        F.when(n % 5 == 3, F.slice(lines, 1, 0)).otherwise(F.slice(lines, 1, 2)), "", F.when(n % 7 == 3, "").otherwise(F.col("next"))))
    story = F.to_json(F.struct(F.element_at(lines, 1)["title"].alias("title"), F.col("source").alias("author"),
                               F.col("text").alias("content")))
    cats = F.to_json(F.struct(F.create_map(F.concat("lang", F.lit("-"), did.cast("string")), list_url(did)).alias("categories")))

    def row(key, kind, content, when=F.lit(True)):
        return F.struct(key.alias("key"), F.lit(kind).alias("kind"), F.when(when, content).alias("content"))
    rows = F.array(row(home_url(did), "categories", cats, head),
                   row(list_url(did), "decision", F.when(n % 4 == 1, '{"decision": false}').otherwise('{"decision": true}')),
                   row(list_url(did), "titles", named),
                   row(list_url(did), "titles_full", listing(lines, "*", F.col("next")), n % 11 != 0),
                   row(story_url(did, F.lit(0)), "story", story, (n % 3 != 0) & (F.size(lines) > 0)))
    return d.select(F.inline(rows)).filter("content is not null")


def chained_pages(documents: DataFrame) -> DataFrame:
    """(page_id, url, html) of the chained listings and their home pages."""
    d = _chained(documents)
    did, n = F.col("doc_id"), F.col("n")

    def link(url, text):
        return F.concat(F.lit('<li><a href="'), url, F.lit('">'), text, F.lit("</a></li>"))
    stories = F.array_join(F.transform("lines", lambda s: link(story_url(did, s["i"]), esc(s["title"]))), "")
    listing = F.concat(F.lit("<html><body><ul>"), F.when(n % 9 == 1, "").otherwise(stories), F.lit("</ul>"),
                       F.when((F.col("next") != "") & (n % 10 != 7), link(F.col("next"), F.lit("more"))).otherwise(""),
                       F.lit("</body></html>"))
    home = F.concat(F.lit("<html><body>"), F.when(n % 13 != 4, link(list_url(did), F.col("lang"))).otherwise(""), F.lit("</body></html>"))
    return d.select((did * 2).alias("page_id"), list_url(did).alias("url"), listing.alias("html")).unionByName(
        d.filter(did % CHAIN == 0).select((did * 2 + 1).alias("page_id"), home_url(did).alias("url"), home.alias("html")))
