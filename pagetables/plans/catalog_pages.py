"""Queries over pages that ``catalog`` has no room for: nesting without bound, snapshot formats."""

from __future__ import annotations

from pyspark.sql import functions as F

from pagetables.operators import html as H
from pagetables.plans import sqlfrag as Q
from pagetables.plans import catalog_site as S
from pagetables.plans.catalog import read_table, register

_STRIP = Q.lit(Q.STRIP_RE)
_LINES = "(?i)</?(article|div|footer|h1|li|nav|p|title|ul|br)\\b[^>]*>"


@register("nested_paragraphs", r"""
WITH w AS (
  SELECT doc_id, unnest(regexp_extract_all(text, '[^ \t\n\r\f]+')) AS word, unnest(range(len(regexp_extract_all(text, '[^ \t\n\r\f]+')))) AS i
  FROM documents)
SELECT doc_id AS page_id, count(*)::INT AS n, max(i)::INT AS deepest, sum(strlen(word))::BIGINT AS page_bytes,
  sum((i + 1) * strlen(word))::BIGINT AS nested_bytes, max_by(word, i) AS innermost
FROM w GROUP BY doc_id
""")
def nested_paragraphs_q(spark, sf):
    """H1 on pages of never-closed paragraphs, one a word of a document: every paragraph lies in
    all before it.  The page's text leaves the parse once; ``nested_bytes`` is what it would be if
    each paragraph carried its own."""
    words = F.filter(F.split(S.esc(F.col("text")), "[ \t\n\r\f]+"), lambda w: w != "")
    pages = read_table(spark, sf, "documents").filter(F.size(words) > 0).select(
        F.col("doc_id").alias("page_id"), F.concat(F.lit("<p>"), F.array_join(words, "<p>")).alias("html"))
    p = H.page_spans(pages, tags=["p"])
    total = F.aggregate("elems", F.lit(0).cast("long"), lambda s, e: s + e["stop"] - e["start"])
    return p.select("page_id", F.size("elems").alias("n"), F.array_max(F.transform("elems", lambda e: e["depth"])).alias("deepest"),
                    F.octet_length("buffer").cast("long").alias("page_bytes"), total.alias("nested_bytes"),
                    H.cut("buffer", F.element_at("elems", -1)).alias("innermost"))


def _with_figure(spark, sf):
    """The driver's pages, each with a link over two lines and an image after its heading."""
    more = F.concat(F.lit('</h1><p>See <a href="/more"><b>More</b>\n of it</a><img alt="P '), F.col("page_id").cast("string"),
                    F.lit('" src="/pics/'), F.col("page_id").cast("string"), F.lit('.png"></p>'))
    return read_table(spark, sf, "pages").withColumn("html", F.replace("html", F.lit("</h1>"), more))


@register("page_snapshot_markdown", f"""
WITH s AS (SELECT page_id, url, regexp_replace(html, {_STRIP}, '', 'g') AS h FROM pages),
b AS (SELECT page_id, url,
  {Q.collapse_space(Q.unescape("regexp_extract(h, '(?is)<title[^>]*>(.*?)</title>', 1)"))} AS title,
  regexp_replace(replace(replace(regexp_replace(regexp_replace(regexp_replace(h, '(?is)<head\\b.*?</head>', '', 'g'),
    '(?is)<div class="ad">.*?</div>', '', 'g'), '(?s)<a href="([^"]*)">(.*?)</a>', '[\\2](\\1)', 'g'),
    '</h1>', '</h1><p>See [More of it](/more)![P ' || page_id || '](/pics/' || page_id || '.png)</p>'),
    '<h1>', '<h1># '), '{_LINES}', chr(10), 'g') AS hb FROM s),
l AS (SELECT page_id, unnest(string_split({Q.strip_tags('hb')}, chr(10))) AS line, unnest(range(len(string_split(hb, chr(10))))) AS li FROM b),
body AS (SELECT page_id, string_agg(cl, chr(10) ORDER BY li) AS body
         FROM (SELECT page_id, li, {Q.collapse_space('line')} AS cl FROM l) WHERE cl <> '' GROUP BY page_id)
SELECT page_id, 'Title: ' || title || chr(10) || chr(10) || 'URL Source: ' || url || chr(10) || chr(10) || 'Markdown Content:' ||
  chr(10) || body || chr(10) || chr(10) || 'Images:' || chr(10) || '- ![P ' || page_id || '](' || {Q.url_origin('url')} || '/pics/' ||
  page_id || '.png)' AS snapshot
FROM b JOIN body USING (page_id)
""")
def page_snapshot_markdown_q(spark, sf):
    """H14 markdown, H11: headings, links and images in place, the list of images at the end."""
    return H.page_snapshot(_with_figure(spark, sf), exclude=H.FURNITURE_SELECTORS, fmt="markdown",
                           images_at_end=True).select("page_id", "snapshot")


@register("page_snapshot_target", f"""
WITH s AS (SELECT page_id, url, {Q.collapse_space(Q.unescape("regexp_extract(h, '(?is)<title[^>]*>(.*?)</title>', 1)"))} AS title,
  regexp_replace(replace(regexp_extract(h, '(?s)<article>(.*)</article>', 1), '</h1>', '</h1><p>See <a>More' || chr(10) || ' of it</a></p>'),
    '{_LINES}', chr(10), 'g') AS hb
  FROM (SELECT page_id, url, regexp_replace(html, {_STRIP}, '', 'g') AS h FROM pages)),
l AS (SELECT page_id, unnest(string_split({Q.strip_tags('hb')}, chr(10))) AS line, unnest(range(len(string_split(hb, chr(10))))) AS li FROM s)
SELECT page_id, any_value(url) AS url, any_value(title) AS title, string_agg(cl, chr(10) ORDER BY li) AS content, 0 AS n_images, '[More of it]' AS links
FROM (SELECT page_id, li, {Q.collapse_space('line')} AS cl FROM l) JOIN s USING (page_id) WHERE cl <> '' GROUP BY page_id
""")
def page_snapshot_target_q(spark, sf):
    """H9, H12, H13, H14 text: only the article, no images, as a record."""
    snap = H.page_snapshot(_with_figure(spark, sf), target=["article"], remove_images=True, fmt="text", as_struct=True)
    return snap.select("page_id", "record.url", "record.title", F.col("record.content").alias("content"),
                       F.size("images").alias("n_images"),
                       F.array_join(F.transform("links", lambda x: F.concat(F.lit("["), x["text"], F.lit("]"))), "").alias("links"))


def _tagged(x, *tags):
    for t in tags:
        x = f"replace(replace({x}, '<{t}>', chr(10) || '<{t}>'), '</{t}>', '</{t}>' || chr(10))"
    return x


@register("page_snapshot_html", f"""
WITH s AS (SELECT page_id, replace(replace(regexp_extract(regexp_replace(html, {_STRIP}, '', 'g'), '(?s)<article>(.*)</article>', 1),
  '&quot;', '"'), '&#x27;', '''') AS h FROM pages)
SELECT page_id, '<article>' || {_tagged('h', 'p', 'h1', 'br')} || repeat('</b></p>' || chr(10), (length(h) - length(replace(h, '<p><b>', ''))) // 6)
  || '</article>' AS snapshot FROM s
""")
def page_snapshot_html_q(spark, sf):
    """H14 html: the article written anew, what it left open closed at its end."""
    return H.page_snapshot(read_table(spark, sf, "pages"), target=["article"], fmt="html").select("page_id", "snapshot")
