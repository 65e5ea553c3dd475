"""Registered queries: each Spark query beside its DuckDB oracle.

Every query reads the driver's tables (or data Spark derives from them)
whole: no id subsets, no row caps.  Every one has an oracle, the Python
stages included: their rules (tree nesting, snapshot lines, the merge
loop) are restated in DuckDB SQL, independently of the Spark code.  A
``None`` oracle would register a rows-only check.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagetables.functions import text as TX
from pagetables.operators import html as H
from pagetables.operators import links as L
from pagetables.plans import sqlfrag as Q
from pagetables.session import sized
from pagetables.sources.readers import read_table as _read

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


# Tables of long texts, and the bytes under which one is dealt over all
# cores (a small file has one row group, so one task would do all its per-row work).
WIDE_TABLES = ("pages", "documents", "conversations", "embeddings")
SMALL_TABLE = 64 << 20


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = _read(spark, sf_dir, name)
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    if name in WIDE_TABLES and size <= SMALL_TABLE:
        return df.repartition(spark.sparkContext.defaultParallelism)
    return df


def register(name: str, sql: str | None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


# Fixed values used by the page queries.
IGNORE_WORDS = ["the"]          # stop list of the entry slice (SURVEY §7.2)
PREFIX_TH = "/th"               # the F1 prefix of SURVEY §7.4


def _page_links(spark, sf):
    """Anchors of the landed pages as story links: category = first url path segment."""
    pages = read_table(spark, sf, "pages")
    a = H.extract_anchors(pages)
    return (a.withColumn("category", TX.url_path_segment("url", 1))
             .withColumn("title", F.col("text"))
             .withColumn("story_url", TX.resolve_url(F.concat(TX.url_origin("url"), F.lit("/")),
                                                     F.col("href"))))


_LINKS_SQL = f"""
    links AS (
      SELECT page_id, url, elem_seq, href, text AS title,
             {Q.url_segment('url', 1)} AS category,
             {Q.url_origin('url')} || '/' || substr(href, 2) AS story_url
      FROM anchors)"""


# ---------------------------------------------------------------------------
# The entry slice

@register("stories_per_category", f"""
WITH {Q.anchors_cte()}, {_LINKS_SQL},
kept AS (SELECT * FROM links WHERE starts_with(href, '/') AND title NOT IN ('the')),
ranked AS (SELECT *, row_number() OVER (PARTITION BY title ORDER BY page_id, elem_seq) AS rn
           FROM kept)
SELECT category, count(*) AS n_stories FROM ranked WHERE rn = 1 GROUP BY category
""")
def stories_per_category(spark, sf):
    l = _page_links(spark, sf)
    l = L.links_with_prefix(l, "/")
    l = L.drop_ignored_titles(l, IGNORE_WORDS)
    d = L.dedup_first(l, "title", order=["page_id", "elem_seq"], values=["story_url", "category"])
    return d.groupBy("category").agg(F.count(F.lit(1)).alias("n_stories"))


@register("extract_anchors", f"""
WITH {Q.anchors_cte()}
SELECT page_id, elem_seq, href, text FROM anchors
""")
def extract_anchors_q(spark, sf):
    return H.extract_anchors(read_table(spark, sf, "pages")).select(
        "page_id", "elem_seq", "href", "text")


# ---------------------------------------------------------------------------
# F1, F4, J3, F9, A1, A2, A4, F14, F7, F8, F25 over the page anchors

@register("links_with_prefix", f"""
WITH {Q.anchors_cte()}
SELECT page_id, elem_seq, href, text AS title FROM anchors WHERE starts_with(href, '{PREFIX_TH}')
""")
def links_with_prefix_q(spark, sf):
    l = _page_links(spark, sf)
    return L.links_with_prefix(l, PREFIX_TH).select("page_id", "elem_seq", "href", "title")


# The stop list of navigation words for F4 (as the crawlers' ignore lists).
IGNORE_NAV = ["the", "and", "of", "der", "la", "de", "und", "le", "el", "y"]


@register("drop_ignored_titles", f"""
WITH {Q.anchors_cte()}
SELECT page_id, elem_seq, text AS title FROM anchors
WHERE text NOT IN ({", ".join(Q.lit(w) for w in IGNORE_NAV)})
""")
def drop_ignored_titles_q(spark, sf):
    l = _page_links(spark, sf)
    return L.drop_ignored_titles(l, IGNORE_NAV).select("page_id", "elem_seq", "title")


@register("drop_ignored_titles_table", f"""
WITH {Q.anchors_cte()},
stop AS (SELECT text FROM anchors GROUP BY text HAVING count(DISTINCT page_id) >= 10)
SELECT page_id, elem_seq, text AS title FROM anchors
WHERE text NOT IN (SELECT text FROM stop)
""")
def drop_ignored_titles_table_q(spark, sf):
    """The stop list is a table (titles on 10+ pages), applied as an anti join."""
    l = _page_links(spark, sf)
    stop = (l.groupBy("title").agg(F.countDistinct("page_id").alias("n"))
             .filter("n >= 10").select("title"))
    return L.drop_ignored_titles(l, stop).select("page_id", "elem_seq", "title")


@register("resolve_url", f"""
WITH {Q.anchors_cte()}, {_LINKS_SQL}
SELECT page_id, elem_seq, story_url FROM links
""")
def resolve_url_q(spark, sf):
    return _page_links(spark, sf).select("page_id", "elem_seq", "story_url")


def _dedup_out(d):
    return d.select("title", "story_url", "category",
                    F.col("first_ord.page_id").alias("first_page_id"),
                    F.col("first_ord.elem_seq").alias("first_elem_seq"))


@register("dedup_first", f"""
WITH {Q.anchors_cte()}, {_LINKS_SQL},
r AS (SELECT *, row_number() OVER (PARTITION BY title ORDER BY page_id, elem_seq) AS rn FROM links)
SELECT title, story_url, category, page_id AS first_page_id, elem_seq AS first_elem_seq
FROM r WHERE rn = 1
""")
def dedup_first_q(spark, sf):
    l = _page_links(spark, sf)
    return _dedup_out(L.dedup_first(l, "title", order=["page_id", "elem_seq"],
                                    values=["story_url", "category"]))


@register("dedup_last", f"""
WITH {Q.anchors_cte()}, {_LINKS_SQL},
r AS (SELECT *, row_number() OVER (PARTITION BY title ORDER BY page_id DESC, elem_seq DESC) AS rn,
             min(page_id * 100000 + elem_seq) OVER (PARTITION BY title) AS fo FROM links)
SELECT title, story_url, category, CAST(fo // 100000 AS BIGINT) AS first_page_id,
       CAST(fo % 100000 AS INTEGER) AS first_elem_seq
FROM r WHERE rn = 1
""")
def dedup_last_q(spark, sf):
    l = _page_links(spark, sf)
    return _dedup_out(L.dedup_last(l, "title", order=["page_id", "elem_seq"],
                                   values=["story_url", "category"]))


@register("count_titles", f"""
WITH {Q.anchors_cte()}
SELECT count(DISTINCT text) AS n_titles FROM anchors
""")
def count_titles_q(spark, sf):
    return L.count_titles(_page_links(spark, sf))


@register("categories_with_min_links", f"""
WITH {Q.anchors_cte()}, {_LINKS_SQL}
SELECT category, count(DISTINCT story_url) AS n_links FROM links
GROUP BY category HAVING count(DISTINCT story_url) > 200
""")
def categories_with_min_links_q(spark, sf):
    return L.categories_with_min_links(_page_links(spark, sf), 200, key="story_url")


# Fixed value: the F8 override (one category reads another suffix).
SUFFIX_OVERRIDE = {"de": "a"}


@register("category_prefix", f"""
SELECT page_id, {Q.url_segment('url', 1)} AS category,
       string_split(regexp_replace(url, '\\A/+|/+\\z', '', 'g'), '/')[-1] AS suffix,
       CASE WHEN {Q.url_segment('url', 1)} = 'de' THEN 'a'
            ELSE string_split(regexp_replace(url, '\\A/+|/+\\z', '', 'g'), '/')[-1] END AS prefix
FROM pages
""")
def category_prefix_q(spark, sf):
    p = read_table(spark, sf, "pages").withColumn("category", TX.url_path_segment("url", 1))
    return p.select("page_id", "category", TX.url_suffix("url").alias("suffix"),
                    TX.category_prefix("url", "category", SUFFIX_OVERRIDE).alias("prefix"))


@register("drop_home_links", f"""
WITH {Q.anchors_cte()}, {_LINKS_SQL}
SELECT page_id, elem_seq, CASE WHEN elem_seq % 5 = 1 THEN regexp_extract(story_url, '^[a-z]+://[^/]*(.*)$', 1)
  ELSE story_url END AS story_url
FROM links WHERE elem_seq % 5 IN (0, 1, 4)
""")
def drop_home_links_q(spark, sf):
    """F25 on story links of which a fifth each is made relative, a home link, another host's."""
    l = _page_links(spark, sf)
    k = F.col("elem_seq") % 5
    path = F.regexp_extract("story_url", "^[a-z]+://[^/]*(.*)$", 1)
    l = l.withColumn("story_url", F.when(k == 1, path).when(k == 2, F.concat(TX.url_origin("url"), F.lit("/ "))).when(
        k == 3, F.concat(F.lit("http://elsewhere.example"), path)).otherwise(F.col("story_url")))
    return L.drop_home_links(l, "story_url", page_url="url").select(
        "page_id", "elem_seq", "story_url")


# ---------------------------------------------------------------------------
# H1 and what is built on it (H4, H5, H16, J4), cross-checked against regex

def _strip_sql(x="html"):
    from pagetables.operators.html import STRIP_RE
    return f"regexp_replace({x}, {Q.lit(STRIP_RE)}, '', 'g')"


@register("anchors_from_elements", f"""
WITH {Q.anchors_cte()}
SELECT page_id, elem_seq, href, text FROM anchors
""")
def anchors_from_elements_q(spark, sf):
    """H1 = H2: anchors of the Python tree parse equal those of the JVM regex."""
    el = H.shred_elements(read_table(spark, sf, "pages"), tags=["a"])
    return H.anchors_from_elements(el)


@register("element_tag_counts", f"""
WITH s AS (SELECT page_id,
  regexp_replace(regexp_replace(html, '(?is)<!--.*?-->', '', 'g'),
                 '(?is)(<(script|style)\\b[^>]*>).*?</(script|style)\\s*>', '\\1', 'g') AS h
  FROM pages),
t AS (SELECT page_id, lower(unnest(regexp_extract_all(h, '<([A-Za-z][A-Za-z0-9]*)\\b[^>]*>', 1))) AS tag
      FROM s)
SELECT page_id, tag, count(*) AS n FROM t GROUP BY page_id, tag
""")
def element_tag_counts_q(spark, sf):
    """H1: element table, counted per page and tag."""
    el = H.shred_elements(read_table(spark, sf, "pages"), with_text=False)
    return el.groupBy("page_id", "tag").agg(F.count(F.lit(1)).alias("n"))


@register("first_by_class", f"""
WITH s AS (SELECT page_id, {_strip_sql()} AS h FROM pages)
SELECT page_id, {Q.unescape("regexp_extract(h, '(?s)<div class=\"ad\">(.*?)</div>', 1)")} AS text
FROM s WHERE h LIKE '%<div class="ad">%'
""")
def first_by_class_q(spark, sf):
    """H4: ``soup.find('div', class_='ad').text`` per page."""
    return H.first_by_class(H.page_elements(read_table(spark, sf, "pages"), only=["div.ad"]), "div", "ad")


@register("heading_title", f"""
WITH s AS (SELECT page_id, {_strip_sql()} AS h FROM pages)
SELECT page_id, {Q.py_strip(Q.strip_tags("regexp_extract(h, '(?s)<h1[^>]*>(.*?)</h1>', 1)"))} AS title
FROM s WHERE regexp_matches(h, '<h1[^>]*>')
""")
def heading_title_q(spark, sf):
    return H.heading_title(H.page_elements(read_table(spark, sf, "pages"), tags=["h1"]))


@register("paragraph_after_title", f"""
WITH s AS (SELECT page_id, {_strip_sql()} AS h FROM pages),
t AS (SELECT page_id, h,
        {Q.py_strip(Q.strip_tags("regexp_extract(h, '(?s)<h1[^>]*>(.*?)</h1>', 1)"))} AS title,
        string_split(h, '<p>') AS segs FROM s)
SELECT page_id, title,
       {Q.py_strip(Q.strip_tags("split_part(segs[3], '</p>', 1)"))} AS text
FROM t WHERE len(segs) >= 3 AND contains({Q.strip_tags('segs[2]')}, title)
""")
def paragraph_after_title_q(spark, sf):
    """J4 on landed pages: title = the page's h1; story = paragraph after the one holding it."""
    from pagetables.operators.content import paragraph_after_title
    pages = read_table(spark, sf, "pages")
    titles = H.heading_title(H.page_elements(pages, tags=["h1"]))
    return paragraph_after_title(titles, H.page_elements(pages, tags=["p"])).select("page_id", "title", "text")


@register("links_section", f"""
WITH {Q.anchors_cte()}
SELECT page_id,
  'Links/Buttons:' || chr(10) || string_agg('- [' || {Q.collapse_space('text')} || '](' ||
      {Q.url_origin('url')} || href || ')', chr(10) ORDER BY elem_seq) AS links_text
FROM anchors GROUP BY page_id
""")
def links_section_q(spark, sf):
    """H7 + H8 + H10 + H15: snapshot with furniture removed and links at the end; its links tail."""
    snap = H.page_snapshot(read_table(spark, sf, "pages"), exclude=H.FURNITURE_SELECTORS,
                           links_at_end=True)
    return (snap.filter(F.size("links") > 0)
                .select("page_id", H.links_section(F.col("snapshot")).alias("links_text")))


_BLOCK_RE = Q.lit("(?i)</?(" + "|".join(sorted(H.BLOCK_TAGS)) + ")\\b[^>]*>")


@register("page_snapshot", f"""
WITH {Q.anchors_cte()},
s AS (SELECT page_id, url, {_strip_sql()} AS h FROM pages),
b AS (SELECT page_id, url,
        {Q.collapse_space(Q.unescape("regexp_extract(h, '(?is)<title[^>]*>(.*?)</title>', 1)"))} AS title,
        regexp_replace(regexp_replace(regexp_replace(h, '(?is)<head\\b.*?</head>', '', 'g'),
                                      {Q.lit('(?is)<div class="ad">.*?</div>')}, '', 'g'),
                       {_BLOCK_RE}, chr(10), 'g') AS hb
      FROM s),
sp AS (SELECT page_id, string_split({Q.strip_tags('hb')}, chr(10)) AS ls FROM b),
l AS (SELECT page_id, unnest(ls) AS line, unnest(range(len(ls))) AS li FROM sp),
body AS (SELECT page_id, string_agg(cl, chr(10) ORDER BY li) AS body
         FROM (SELECT page_id, li, {Q.collapse_space('line')} AS cl FROM l) WHERE cl <> ''
         GROUP BY page_id),
lk AS (SELECT page_id, string_agg('- [' || {Q.collapse_space('text')} || '](' ||
                                  {Q.url_origin('url')} || href || ')', chr(10) ORDER BY elem_seq) AS lt
       FROM anchors GROUP BY page_id)
SELECT b.page_id, b.title,
  'Title: ' || b.title || chr(10) || chr(10) || 'URL Source: ' || b.url || chr(10) || chr(10) ||
  'Markdown Content:' || chr(10) || coalesce(body.body, '') || chr(10) || chr(10) ||
  'Links/Buttons:' || chr(10) || coalesce(lk.lt, '') || chr(10) || chr(10) || 'Images:' || chr(10)
    AS snapshot
FROM b LEFT JOIN body USING (page_id) LEFT JOIN lk USING (page_id)
""")
def page_snapshot_q(spark, sf):
    """Snapshot text of every page (furniture removed, links and images listed).

    The oracle restates the rendering rule: block tags break lines, lines
    are whitespace-collapsed and empty ones dropped, the head and the
    furniture do not show."""
    snap = H.page_snapshot(read_table(spark, sf, "pages"), exclude=H.FURNITURE_SELECTORS,
                           links_at_end=True, images_at_end=True)
    return snap.select("page_id", "title", "snapshot")


@register("main_text", f"""
WITH s AS (SELECT page_id, regexp_extract({_strip_sql()}, '(?s)<article>(.*)</article>', 1) AS art
           FROM pages),
sg AS (SELECT page_id, string_split(art, '<p>') AS segs FROM s)
SELECT page_id, {Q.collapse_space(Q.strip_tags("array_to_string(segs[2:], '')"))} AS text
FROM sg WHERE len(segs) >= 2 AND starts_with(segs[2], '<b>')
""")
def main_text_q(spark, sf):
    """Main text without nav/header/footer/aside and site furniture."""
    return H.main_text(read_table(spark, sf, "pages"))


_AD_TEXT = "regexp_extract(h, '(?s)<div class=\"ad\">(.*?)</div>', 1)"


# A byline restated for RE2.
_BYLINE = Q.lit("^By:? +(\\p{Lu}[\\p{L}\\p{M}'’.-]*( +(\\p{Lu}[\\p{L}\\p{M}'’.-]*|de|da|di|du|del|van|von|der|den|la|le|bin|al|y)){0,5})$")


@register("byline_author", f"""
WITH s AS (SELECT page_id, {_strip_sql()} AS h FROM pages),
sg AS (SELECT page_id, h, string_split(regexp_extract(h, '(?s)<article>(.*)</article>', 1), '<p>') AS segs
       FROM s),
u AS (SELECT page_id, segs, unnest(range(2, len(segs) + 1)) AS k FROM sg),
cand AS (
  SELECT page_id, 0 AS k, {Q.unescape(_AD_TEXT)} AS text
  FROM sg WHERE h LIKE '%<div class="ad">%'
  UNION ALL
  SELECT page_id, k, CASE WHEN starts_with(segs[k], '<b>') THEN {Q.strip_tags("array_to_string(segs[k:], '')")}
                          ELSE {Q.strip_tags("split_part(segs[k], '</p>', 1)")} END
  FROM u),
hit AS (SELECT page_id, arg_min(regexp_extract({Q.collapse_space('text')}, {_BYLINE}, 1), k) AS author
        FROM cand WHERE regexp_matches({Q.collapse_space('text')}, {_BYLINE}) GROUP BY page_id)
SELECT p.page_id, CASE WHEN p.page_id % 5 = 1 THEN 'M. Él ' || p.page_id
    WHEN p.page_id % 3 = 0 AND p.html LIKE '%</h1>%' THEN 'Ann van Dyk' ELSE coalesce(hit.author, '') END AS author
FROM pages p LEFT JOIN hit USING (page_id)
""")
def byline_author_q(spark, sf):
    """Author per page, blank when there is none: a third of the pages get a byline
    (and prose that starts like one before it), a fifth author metadata."""
    pages = read_table(spark, sf, "pages")
    i = F.col("page_id")
    more = F.when(i % 3 == 0, F.replace("html", F.lit("</h1>"), F.lit(
        "</h1><p>By the time it rained, all slept.</p><p>By: Ann  van Dyk</p>"))).otherwise(F.col("html"))
    pages = pages.withColumn("html", F.when(i % 5 == 1, F.concat(
        F.lit('<meta name="Author" content=" M. &Eacute;l '), i.cast("string"), F.lit('">'), more)).otherwise(more))
    el = H.shred_elements(pages, tags=[*H.BYLINE_TAGS, "meta"])
    return H.byline_author(el, pages)


@register("paragraphs", f"""
WITH s AS (SELECT page_id, regexp_extract({_strip_sql()}, '(?s)<article>(.*)</article>', 1) AS art
           FROM pages),
sg AS (SELECT page_id, string_split(art, '<p>') AS segs FROM s),
u AS (SELECT page_id, segs, unnest(range(2, len(segs) + 1)) AS k FROM sg)
SELECT page_id, CAST(k - 2 AS INTEGER) AS p_no,
  CASE WHEN starts_with(segs[k], '<b>') THEN {Q.strip_tags("array_to_string(segs[k:], '')")}
       ELSE {Q.strip_tags("split_part(segs[k], '</p>', 1)")} END AS text
FROM u
""")
def paragraphs_q(spark, sf):
    """H5: every paragraph in document order (text of nested paragraphs included).

    The oracle restates the tree rule for these pages: a paragraph opened
    with ``<b>…<br>`` is never closed, so it holds the rest of the article;
    the others end at their ``</p>``."""
    el = H.shred_elements(read_table(spark, sf, "pages"), tags=["p"])
    return H.paragraphs(el).select("page_id", "p_no", "text")


# ---------------------------------------------------------------------------
# Listing sites derived from `conversations`: I1, I2, F2, F5, F6, F12, A3, H6,
# F11, J2, U2, Q1, Q2 (rules in pagetables/plans/catalog_site.py)

from pagetables.plans import paginate as P  # noqa: E402
from pagetables.plans import pipelines as PL  # noqa: E402
from pagetables.plans import catalog_site as S  # noqa: E402

# Stop lists of the two crawls over the derived sites.
LABEL_IGNORE = ["Le", "La", "The", "Der", "El", "Et"]
NUMBER_IGNORE = ["首页", "Le", "La", "The"]

_TITLE = Q.lit(S.TITLE_RE)


_SITES: dict = {}


def _site(spark, sf, kind, build):
    """A derived site, written once per application and input folder to the
    shared checkpoint folder (a materialised view: walks read it several
    times per round, and several queries use the same site)."""
    from pagetables.session import cut_lineage
    key = (spark.sparkContext.applicationId, sf, kind)
    if key not in _SITES:
        _SITES[key] = cut_lineage(build(read_table(spark, sf, "conversations")))
    return _SITES[key]


def _label(spark, sf):
    conv = read_table(spark, sf, "conversations")
    return _site(spark, sf, "label", S.label_site), S.label_categories(conv)


def _number(spark, sf):
    conv = read_table(spark, sf, "conversations")
    return _site(spark, sf, "number", S.number_site), S.number_categories(conv)


_LINES_SQL = f"""
    _sl AS (SELECT conv_id, turn, role, unnest(string_split(text, chr(10))) AS line,
                   unnest(range(len(string_split(text, chr(10))))) AS i
            FROM conversations),
    lines AS (SELECT conv_id, turn, role, CAST(i AS BIGINT) AS i, line,
                     regexp_extract(line, {_TITLE}, 1) AS raw_title,
                     {Q.py_strip(f"regexp_extract(line, {_TITLE}, 1)")} AS title,
                     row_number() OVER (PARTITION BY conv_id, turn ORDER BY i) - 1 AS k,
                     count(*) OVER (PARTITION BY conv_id, turn) AS n_lines
              FROM _sl WHERE regexp_extract(line, {_TITLE}, 1) <> ''),
    turns AS (SELECT conv_id, turn, role, max(turn) OVER (PARTITION BY conv_id) AS last_turn
              FROM conversations)"""

_LABEL_WALK_SQL = f"""
    edges AS (SELECT conv_id, turn AS u,
                 CASE WHEN turn < last_turn AND role <> 'system' THEN turn + 1
                      WHEN turn = last_turn AND turn >= 1 AND role = 'assistant' THEN 1 END AS v
              FROM turns),
    walk AS (
      WITH RECURSIVE w(conv_id, node, d, seen) AS (
        SELECT conv_id, 0, 0, [0] FROM turns WHERE turn = 0
        UNION ALL
        SELECT w.conv_id, e.v, w.d + 1, list_append(w.seen, e.v)
        FROM w JOIN edges e ON e.conv_id = w.conv_id AND e.u = w.node
        WHERE e.v IS NOT NULL AND NOT list_contains(w.seen, e.v))
      SELECT conv_id, node AS turn, d + 1 AS page_no FROM w)"""


def _label_url(c, t):
    return (f"CASE WHEN {t} = 0 THEN '{S.LABEL_HOST}c' || {c} || '/' "
            f"ELSE '{S.LABEL_HOST}c' || {c} || '/list_' || {c} || '_' || ({t} + 1) || '.html' END")


_FOLLOW_NEXT_SQL = f"""
WITH {_LINES_SQL}, {_LABEL_WALK_SQL}
SELECT CAST(conv_id AS INTEGER) AS category_no, CAST(page_no AS INTEGER) AS page_no,
       {_label_url('conv_id', 'turn')} AS url
FROM walk
"""


@register("follow_next", _FOLLOW_NEXT_SQL)
def follow_next_q(spark, sf):
    """I1 by pointer doubling (cycles end at the first revisit)."""
    site, seeds = _label(spark, sf)
    return P.follow_next(site, seeds).select("category_no", "page_no", "url")


@register("follow_next_recursive", _FOLLOW_NEXT_SQL)
def follow_next_recursive_q(spark, sf):
    """I1 by Spark's recursive CTE (the plain form the doubling is checked against)."""
    site, seeds = _label(spark, sf)
    return P.follow_next(site, seeds, method="recursive").select("category_no", "page_no", "url")


@register("next_page_link", f"""
WITH {_LINES_SQL}, {_LABEL_WALK_SQL}
SELECT {_label_url('conv_id', 'u')} AS url, 'list_' || conv_id || '_' || (v + 1) || '.html' AS next_href
FROM edges WHERE v IS NOT NULL
""")
def next_page_link_q(spark, sf):
    """the first link labelled 下一页 on every listing page."""
    site, _ = _label(spark, sf)
    a = H.extract_anchors(site)
    return L.next_page_link(a, S.NEXT_LABEL, part=("url",))


@register("pagination_links", f"""
WITH {_LINES_SQL}, {_LABEL_WALK_SQL},
pl AS (
  SELECT conv_id, turn, 0 AS o, 'list_' || conv_id || '_1.html' AS href FROM turns
  UNION ALL SELECT conv_id, u, 1, 'list_' || conv_id || '_' || (v + 1) || '.html' FROM edges
            WHERE v IS NOT NULL
  UNION ALL SELECT conv_id, turn, 2, 'list_' || conv_id || '_' || (last_turn + 1) || '.html'
            FROM turns)
SELECT {_label_url('conv_id', 'turn')} AS url, href, count(*) AS n FROM pl GROUP BY ALL
""")
def pagination_links_q(spark, sf):
    """the pager links (list_…) of every listing page, counted per href."""
    site, _ = _label(spark, sf)
    a = L.pagination_links(H.extract_anchors(site))
    return a.groupBy("url", "href").agg(F.count(F.lit(1)).alias("n"))


_RECENT_SQL = f"""
    first_cat AS (SELECT min(conv_id) AS conv_id FROM turns),
    recent AS (SELECT l.conv_id, l.k, l.title, l.turn, l.i FROM lines l
               JOIN turns t ON t.conv_id = l.conv_id AND t.turn = 0 AND l.turn = t.last_turn
               WHERE l.conv_id = (SELECT conv_id FROM first_cat))"""


@register("recent_links", f"""
WITH {_LINES_SQL}, {_RECENT_SQL}
SELECT '/c' || conv_id || '/' || conv_id || '_' || turn || '_' || i || '.html' AS href,
       title FROM recent
""")
def recent_links_q(spark, sf):
    """H6 + F11: links after the 最新发布 marker on page 1 of the first category,
    kept when ``href.split('/')[-2]`` is the category suffix."""
    site, seeds = _label(spark, sf)
    first = seeds.orderBy("category_no").limit(1)
    p1 = site.join(sized(first.select("url")), "url")
    el = H.shred_elements(p1, tags=["span", "a"])
    rec = H.anchors_after_marker(el, "span", S.RECENT_LABEL, ".html")
    rec = rec.join(p1.select("page_id", TX.url_suffix("url").alias("suffix")), "page_id")
    return L.recent_links(rec, F.col("suffix")).select("href", TX.py_strip("text").alias("title"))


_NUMBER_SQL = f"""
    nt AS (SELECT conv_id, turn, role, turn + 1 AS n,
                  max(turn) OVER (PARTITION BY conv_id) + 1 AS n_pages FROM conversations),
    nums AS (SELECT conv_id, turn, m, row_number() OVER (PARTITION BY conv_id, turn ORDER BY m) - 1 AS j
             FROM (SELECT conv_id, turn, n, role,
                          unnest(range(greatest(n - 2, 1), least(n + 2, n_pages) + 1)) AS m FROM nt)
             WHERE NOT (m = n + 1 AND role = 'system')),
    hl AS (SELECT conv_id, turn, count(*) AS n_lines FROM lines GROUP BY ALL),
    meta AS (SELECT nt.conv_id, nt.turn, coalesce(hl.n_lines, 0) // 2 AS h,
                    (SELECT count(*) FROM nums WHERE nums.conv_id = nt.conv_id AND nums.turn = nt.turn) AS n_num
             FROM nt LEFT JOIN hl ON hl.conv_id = nt.conv_id AND hl.turn = nt.turn),
    seq AS (
      SELECT conv_id, turn, 0 AS elem_seq, '首页' AS title, NULL AS i FROM nt
      UNION ALL
      SELECT l.conv_id, l.turn, CASE WHEN l.k < m.h THEN 1 + l.k ELSE 1 + m.n_num + l.k END,
             l.title, l.i
      FROM lines l JOIN meta m ON m.conv_id = l.conv_id AND m.turn = l.turn
      UNION ALL
      SELECT s.conv_id, s.turn, 1 + m.h + s.j, CAST(s.m AS VARCHAR), NULL
      FROM nums s JOIN meta m ON m.conv_id = s.conv_id AND m.turn = s.turn),
    kept0 AS (SELECT *, CAST(regexp_matches(title, '^\\p{{Nd}}+$') AS INTEGER) AS dig FROM seq
              WHERE title NOT IN ({", ".join(Q.lit(w) for w in NUMBER_IGNORE)})),
    kept1 AS (SELECT *, CAST(coalesce(max(dig) OVER (PARTITION BY conv_id, turn ORDER BY elem_seq
                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) = 1 AND dig = 0 AS INTEGER) AS stp
              FROM kept0),
    kept AS (SELECT * FROM (SELECT *, coalesce(sum(stp) OVER (PARTITION BY conv_id, turn ORDER BY elem_seq
                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS sb FROM kept1) WHERE sb = 0),
    nwalk AS (
      WITH RECURSIVE w(conv_id, n) AS (
        SELECT DISTINCT conv_id, 1 FROM conversations
        UNION ALL
        SELECT DISTINCT w.conv_id, w.n + 1 FROM w
        JOIN kept k ON k.conv_id = w.conv_id AND k.dig = 1 AND k.title = CAST(w.n + 1 AS VARCHAR)
                   AND k.turn + 1 <= w.n
        WHERE w.n + 1 <= 1000)
      SELECT conv_id, n AS page_no FROM w)"""


def _number_url(c, n):
    return (f"CASE WHEN {n} = 1 THEN '{S.NUMBER_HOST}/news/c' || {c} || '/' "
            f"ELSE '{S.NUMBER_HOST}/news/c' || {c} || '/list_' || {n} || '.htm' END")


@register("take_through_index", f"""
WITH {_LINES_SQL}, {_NUMBER_SQL}
SELECT {_number_url('conv_id', 'turn + 1')} AS url, CAST(elem_seq AS INTEGER) AS elem_seq, title,
       dig = 1 AS is_index
FROM kept
""")
def take_through_index_q(spark, sf):
    """F4 + F5 + F6: links of each numbered listing page as the crawl reads them."""
    site, seeds = _number(spark, sf)
    links = P.numbered_page_links(site, seeds, NUMBER_IGNORE)
    return links.select("url", "elem_seq", "title", "is_index")


@register("split_index_links", f"""
WITH {_LINES_SQL}, {_NUMBER_SQL}
SELECT dig = 1 AS is_index, count(*) AS n FROM kept GROUP BY ALL
""")
def split_index_links_q(spark, sf):
    """page-number links against story links, counted."""
    site, seeds = _number(spark, sf)
    links = P.numbered_page_links(site, seeds, NUMBER_IGNORE)
    return links.groupBy("is_index").agg(F.count(F.lit(1)).alias("n"))


@register("follow_numbered", f"""
WITH {_LINES_SQL}, {_NUMBER_SQL}
SELECT CAST(conv_id AS INTEGER) AS category_no, CAST(page_no AS INTEGER) AS page_no,
       {_number_url('conv_id', 'page_no')} AS url
FROM nwalk
""")
def follow_numbered_q(spark, sf):
    """Numbered pages, index growing as pages are read, cap 1,000 pages."""
    site, seeds = _number(spark, sf)
    return P.follow_numbered(site, seeds, NUMBER_IGNORE).select("category_no", "page_no", "url")


@register("page_index", f"""
WITH {_LINES_SQL}, {_NUMBER_SQL}
SELECT CAST(k.conv_id AS INTEGER) AS category_no, k.title AS number,
       {_number_url('k.conv_id', 'CAST(k.title AS INTEGER)')} AS url
FROM kept k JOIN nwalk w ON w.conv_id = k.conv_id AND w.page_no = k.turn + 1
WHERE k.dig = 1 GROUP BY ALL
""")
def page_index_q(spark, sf):
    """A3: first-wins number -> url per category, over the pages walked."""
    site, seeds = _number(spark, sf)
    walked = P.follow_numbered(site, seeds, NUMBER_IGNORE)
    idx = P.page_index(site, walked, NUMBER_IGNORE)
    return idx.select("category_no", "number", "url")


@register("story_table_by_number", f"""
WITH {_LINES_SQL}, {_NUMBER_SQL},
st AS (SELECT k.conv_id, w.page_no, k.elem_seq, k.title, k.i, k.turn FROM kept k
       JOIN nwalk w ON w.conv_id = k.conv_id AND w.page_no = k.turn + 1 WHERE k.dig = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY title ORDER BY conv_id, page_no, elem_seq) AS rn FROM st),
src AS (SELECT conv_id, turn, i, line FROM lines)
SELECT r.title, {Q.py_strip('s.line')} AS text, 'num' || r.conv_id AS category,
       '{S.NUMBER_HOST}/news/c' || r.conv_id || '/' || r.conv_id || '_' || r.turn || '_' || r.i || '.htm'
         AS story_url
FROM r JOIN src s ON s.conv_id = r.conv_id AND s.turn = r.turn AND s.i = r.i
WHERE r.rn = 1
""")
def story_table_by_number_q(spark, sf):
    """Q2: numbered crawl -> (title, text, category, story_url)."""
    site, seeds = _number(spark, sf)
    return PL.story_table_by_number(site, seeds, NUMBER_IGNORE)


_IGN_L = ", ".join(Q.lit(w) for w in LABEL_IGNORE)

_LABEL_TITLES_SQL = f"""
    pl AS (
      SELECT w.conv_id, w.page_no, 0 AS phase, l.k AS o, l.title, l.turn, l.i
      FROM walk w JOIN lines l ON l.conv_id = w.conv_id AND l.turn = w.turn
      UNION ALL
      SELECT w.conv_id, w.page_no, 0, 100000 + l.k, l.title, l.turn, l.i
      FROM walk w JOIN turns t ON t.conv_id = w.conv_id AND t.turn = 0 AND w.turn = 0
      JOIN lines l ON l.conv_id = w.conv_id AND l.turn = t.last_turn),
    rc AS (SELECT conv_id, 1 AS page_no, 1 AS phase, k AS o, title, turn, i FROM recent
           WHERE title NOT IN ({_IGN_L})),
    alll AS (SELECT * FROM pl WHERE title NOT IN ({_IGN_L}) UNION ALL SELECT * FROM rc),
    f AS (SELECT * FROM alll WHERE NOT (page_no >= 2 AND title IN (SELECT title FROM rc))),
    r AS (SELECT *,
            row_number() OVER (PARTITION BY title ORDER BY conv_id DESC, page_no DESC, phase DESC, o DESC) AS rn
          FROM f),
    winners AS (SELECT r.title, r.conv_id, r.turn, r.i,
                  '{S.LABEL_HOST}c' || r.conv_id || '/' || r.conv_id || '_' || r.turn || '_' || r.i || '.html' AS url
                FROM r WHERE rn = 1)"""


@register("story_table_by_label", f"""
WITH {_LINES_SQL}, {_LABEL_WALK_SQL}, {_RECENT_SQL}, {_LABEL_TITLES_SQL}
SELECT w.title AS name, w.url, 'cat' || w.conv_id AS category,
       CASE WHEN l.role = 'system' THEN NULL
            ELSE translate({Q.py_rstrip("'　　' || l.line || chr(13)")}, chr(13) || '　', '') END AS content
FROM winners w JOIN lines l ON l.conv_id = w.conv_id AND l.turn = w.turn AND l.i = w.i
""")
def story_table_by_label_q(spark, sf):
    """Q1: labelled crawl -> (name, url, category, content)."""
    site, seeds = _label(spark, sf)
    return PL.story_table_by_label(site, seeds, LABEL_IGNORE)


@register("dedup_last_by_label", f"""
WITH {_LINES_SQL}, {_LABEL_WALK_SQL}, {_RECENT_SQL}, {_LABEL_TITLES_SQL}
SELECT title, url, 'cat' || conv_id AS category FROM winners
""")
def dedup_last_by_label_q(spark, sf):
    """A2 + J2 + U2 on the labelled crawl: last write wins, recent titles kept off later pages."""
    site, seeds = _label(spark, sf)
    return PL.label_links(site, seeds, LABEL_IGNORE).select("title", "url", "category")


# ---------------------------------------------------------------------------
# Structured answers: X1, A9, X2a–d, X3, X4, Q3 over a completions table
# derived from documents + labels (rules in pagetables/plans/catalog_site.py)

from pagetables.operators import answers as X  # noqa: E402

SH = S.STORY_HOST
# Fixed value: our own system prompt for the category question.
CATEGORY_PROMPT = ("List the categories of stories this page links to, as JSON "
                   "{\"categories\": {name: url}}; answer {\"error\": …} if there are none.")


def _answers(spark, sf):
    """The derived completions table, not written: for what writes its answers itself."""
    return S.completions(read_table(spark, sf, "documents"), read_table(spark, sf, "labels"))


def _completions(spark, sf, kind=None):
    """The derived completions table, written once per application and input
    folder (every answer kind reads it)."""
    from pagetables.session import cut_lineage
    key = (spark.sparkContext.applicationId, sf, "completions")
    if key not in _SITES:
        _SITES[key] = cut_lineage(_answers(spark, sf))
    c = _SITES[key]
    return c.filter(F.col("kind") == kind) if kind else c


_DOCS_SQL = """
    dl AS (SELECT d.doc_id, d.text, d.lang, d.source, l.quality, coalesce(l.toxic, 0) AS toxic
           FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id)"""


@register("parse_categories", f"""
WITH {_DOCS_SQL}
SELECT '{SH}home/' || doc_id AS key, lang AS category, '{SH}' || lang || '/' || doc_id || '/' AS url
FROM dl WHERE toxic <> 1
UNION ALL
SELECT '{SH}home/' || doc_id, source, '{SH}' || source || '/' || doc_id || '/' FROM dl WHERE toxic <> 1
""")
def parse_categories_q(spark, sf):
    return X.parse_categories(_completions(spark, sf, "categories"))


@register("parse_decision", f"""
WITH {_DOCS_SQL}
SELECT '{SH}' || lang || '/' || doc_id || '/' AS key, coalesce(quality = 1, false) AS decision FROM dl
""")
def parse_decision_q(spark, sf):
    return X.parse_decision(_completions(spark, sf, "decision"))


@register("split_refusals", f"""
WITH {_DOCS_SQL},
s AS (SELECT 'categories' AS kind, CASE WHEN toxic = 1 THEN 'refused' ELSE 'ok' END AS status FROM dl
      UNION ALL SELECT 'decision', 'ok' FROM dl
      UNION ALL SELECT 'titles', CASE WHEN toxic = 1 THEN 'refused'
                                      WHEN coalesce(quality = 0 AND lang = 'de', false) THEN 'bad' ELSE 'ok' END FROM dl
      UNION ALL SELECT 'story', CASE WHEN toxic = 1 THEN 'refused' ELSE 'ok' END FROM dl)
SELECT kind, status, count(*) AS n FROM s GROUP BY ALL
""")
def split_refusals_q(spark, sf):
    """Answers routed ok / refused / bad, counted per question."""
    s = X.split_refusals(_completions(spark, sf))
    return s.groupBy("kind", "status").agg(F.count(F.lit(1)).alias("n"))


_TITLE_ROWS_SQL = f"""
    tl AS (SELECT dl.doc_id, dl.lang, dl.quality, dl.toxic, l.i, l.k, l.title AS t0, l.raw_title
           FROM dl JOIN (SELECT doc_id, CAST(i AS BIGINT) AS i,
                                regexp_extract(line, {_TITLE}, 1) AS raw_title,
                                regexp_extract(line, {_TITLE}, 1) AS title,
                                row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1 AS k
                         FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
                                      unnest(range(len(string_split(text, chr(10))))) AS i
                               FROM documents)
                         WHERE regexp_extract(line, {_TITLE}, 1) <> '') l ON l.doc_id = dl.doc_id),
    tparsed AS (
      SELECT '{SH}' || lang || '/' || doc_id || '/' AS key, doc_id, lang, k,
             CASE WHEN lang IN ('en', 'fr') THEN raw_title ELSE raw_title || ' (' || i || ')' END AS title,
             '{SH}story/' || doc_id || '/' || i AS url, '' AS next_page
      FROM tl WHERE toxic <> 1 AND NOT coalesce(quality = 0 AND lang = 'de', false))"""


@register("parse_titles", f"""
WITH {_DOCS_SQL}, {_TITLE_ROWS_SQL}
SELECT key, title, url, next_page FROM tparsed
""")
def parse_titles_q(spark, sf):
    """Both answer shapes (array of {title, url}, map title -> url)."""
    return X.parse_titles(_completions(spark, sf, "titles")).select(
        "key", "title", "url", "next_page")


@register("parse_story", f"""
WITH {_DOCS_SQL},
ft AS (SELECT doc_id, min_by(regexp_extract(line, {_TITLE}, 1), i) AS t FROM
         (SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
                 unnest(range(len(string_split(text, chr(10))))) AS i FROM documents)
       WHERE regexp_extract(line, {_TITLE}, 1) <> '' GROUP BY doc_id)
SELECT '{SH}story/' || dl.doc_id || '/0' AS key,
       CASE WHEN toxic = 1 THEN '' ELSE coalesce(ft.t, '') END AS title,
       CASE WHEN toxic = 1 OR lang = 'de' THEN '' ELSE source END AS author,
       CASE WHEN toxic = 1 THEN '' ELSE text END AS content,
       '' AS next_page,
       CASE WHEN toxic = 1 THEN 'refused' ELSE 'ok' END AS status
FROM dl LEFT JOIN ft ON ft.doc_id = dl.doc_id
""")
def parse_story_q(spark, sf):
    """X2d: nested and flat story answers."""
    return X.parse_story(_completions(spark, sf, "story"))


@register("story_table_from_answers", f"""
WITH {_DOCS_SQL}, {_TITLE_ROWS_SQL},
okcat AS (SELECT '{SH}' || lang || '/' || doc_id || '/' AS url FROM dl WHERE toxic <> 1 AND quality = 1),
lk AS (SELECT t.* FROM tparsed t JOIN okcat c ON c.url = t.key),
r AS (SELECT *, row_number() OVER (PARTITION BY title ORDER BY key DESC, k DESC) AS rn FROM lk),
st AS (SELECT '{SH}story/' || doc_id || '/0' AS url, toxic, lang, source, text FROM dl)
SELECT r.title, CASE WHEN st.url IS NULL OR st.toxic = 1 OR st.lang = 'de' THEN '' ELSE st.source END AS author,
       CASE WHEN st.url IS NULL OR st.toxic = 1 THEN '' ELSE st.text END AS content,
       r.lang AS category, r.url
FROM r LEFT JOIN st ON st.url = r.url WHERE r.rn = 1
""")
def story_table_from_answers_q(spark, sf):
    """Q3: categories (X2a) kept by the decision (X2b) -> titles (X2c) -> A2 -> stories (X2d, X4)."""
    from pagetables.plans.pipelines import story_table_from_answers
    return story_table_from_answers(_answers(spark, sf))


@register("collect_messages", f"""
SELECT conv_id, 0 AS msg_no, 'system' AS role, {Q.lit(CATEGORY_PROMPT)} AS content
FROM conversations GROUP BY conv_id
UNION ALL
SELECT conv_id, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS INTEGER), role, text
FROM conversations
""")
def collect_messages_q(spark, sf):
    """A conversation's turns as one ordered message list (flattened to compare)."""
    m = X.collect_messages(read_table(spark, sf, "conversations"), system_prompt=CATEGORY_PROMPT)
    return m.select("conv_id", F.posexplode("messages").alias("msg_no", "m")).select(
        "conv_id", F.col("msg_no").cast("int").alias("msg_no"),
        F.col("m.role").alias("role"), F.col("m.content").alias("content"))


@register("build_chat_requests", f"""
WITH {Q.anchors_cte()}
SELECT page_id, 0 AS msg_no, 'system' AS role, {Q.lit(CATEGORY_PROMPT)} AS content FROM anchors
GROUP BY page_id
UNION ALL
SELECT page_id, 1, 'user',
  'Links/Buttons:' || chr(10) || string_agg('- [' || {Q.collapse_space('text')} || '](' ||
      {Q.url_origin('url')} || href || ')', chr(10) ORDER BY elem_seq)
FROM anchors GROUP BY page_id
""")
def build_chat_requests_q(spark, sf):
    """One request per page: our prompt + the links tail of its snapshot."""
    snap = H.page_snapshot(read_table(spark, sf, "pages"), exclude=H.FURNITURE_SELECTORS,
                           links_at_end=True)
    snap = snap.filter(F.size("links") > 0).withColumn("links_text",
                                                       H.links_section(F.col("snapshot")))
    req = X.build_chat_requests(snap, CATEGORY_PROMPT, text="links_text")
    return req.select("page_id", F.posexplode("messages").alias("msg_no", "m")).select(
        "page_id", F.col("msg_no").cast("int").alias("msg_no"),
        F.col("m.role").alias("role"), F.col("m.content").alias("content"))


QUESTION = "Is this a page of stories? Answer with a decision."
_DECISION_FORMAT = ('{"json_schema":{"name":"decision","schema":{"properties":{"decision":{"type":"boolean"}},'
                    '"required":["decision"],"type":"object"}},"type":"json_schema"}')


@register("chat_request_bodies", f"""
SELECT page_id, '{{"messages":[{{"role":"system","content":' || to_json({Q.lit(CATEGORY_PROMPT)})::VARCHAR
  || '}},{{"role":"user","content":' || to_json(url)::VARCHAR || '}},{{"role":"user","content":' || to_json({Q.lit(QUESTION)})::VARCHAR
  || '}}],"model":"local-model","response_format":{_DECISION_FORMAT},"temperature":0.0}}' AS request
FROM pages
""")
def chat_request_bodies_q(spark, sf):
    """Whole request bodies: messages with a question, model, temperature, answer schema."""
    df = read_table(spark, sf, "pages").select("page_id", "url")
    req = X.build_chat_requests(df, CATEGORY_PROMPT, text="url", question=QUESTION)
    return X.requests_json(req, kind="decision", model="local-model", temperature=0).select("page_id", "request")


# ---------------------------------------------------------------------------
# Vectors: E1, E2, E4, E5, E7, E8, A7, A8, Q4, Q5 over documents / embeddings

from pagetables.operators import merge as M  # noqa: E402
from pagetables.operators import vectors as V  # noqa: E402

# Sizes of the vector queries (the reference's 512-token cut,
# 128-wide merge vectors, 64 in its trial; chunk cap of our choosing).
MAX_TOKENS = 512
EMBED_DIM = 128
TRIAL_DIM = 64
CHUNK_CHARS = 2000
MERGE_TARGET = 5

_WS = Q.lit(TX.PY_SPACE + "+")


def _words_sql(table="documents", key="doc_id", text="text"):
    return f"""
    _wa AS (SELECT {key}, regexp_split_to_array({text}, {_WS}) AS arr FROM {table}),
    _wu AS (SELECT {key}, unnest(arr) AS token, unnest(range(len(arr))) AS idx FROM _wa),
    words AS (SELECT {key}, token, row_number() OVER (PARTITION BY {key} ORDER BY idx) - 1 AS pos
              FROM _wu WHERE token <> '')"""


def _bucket_sql(w, dim):
    return f"CAST(CAST(('0x' || substr(md5({w}), 1, 8)) AS BIGINT) % {dim} AS INTEGER)"


@register("tokenize_truncate", f"""
WITH {_words_sql()}
SELECT doc_id, CAST(pos AS INTEGER) AS pos, token FROM words WHERE pos < {MAX_TOKENS}
""")
def tokenize_truncate_q(spark, sf):
    """The first 512 words of every document."""
    t = V.tokenize_truncate(read_table(spark, sf, "documents"), "doc_id", "text", MAX_TOKENS)
    return t.select("doc_id", "pos", "token")


@register("embed_texts", f"""
WITH {_words_sql()},
c AS (SELECT doc_id, {_bucket_sql('token', EMBED_DIM)} AS dim, CAST(count(*) AS DOUBLE) AS cnt
      FROM words GROUP BY ALL)
SELECT doc_id, dim, round(cnt / sqrt(sum(cnt * cnt) OVER (PARTITION BY doc_id)), 6) AS value FROM c
""")
def embed_texts_q(spark, sf):
    """Hashed word-count vectors (normalised), long form."""
    v = V.embed_texts(read_table(spark, sf, "documents"), "doc_id", "text", EMBED_DIM)
    return v.select("doc_id", "dim", F.round("value", 6).alias("value"))


def _segments_sql(max_chars=CHUNK_CHARS):
    m = max_chars
    return f"""
    _ln AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                   unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS li
            FROM documents),
    _un AS (SELECT doc_id, li, j, CASE WHEN length(line) <= {m} THEN line
                                       ELSE substr(line, j * {m} + 1, {m}) END AS u
            FROM (SELECT doc_id, li, line,
                         unnest(range(CASE WHEN length(line) <= {m} THEN 1
                                           ELSE CAST(ceil(length(line) / {m}) AS BIGINT) END)) AS j
                  FROM _ln)),
    units AS (SELECT doc_id, u, length(u) AS ul,
                     row_number() OVER (PARTITION BY doc_id ORDER BY li, j) AS ui FROM _un),
    packed AS (
      WITH RECURSIVE p(doc_id, ui, chunk_no, cur) AS (
        SELECT doc_id, ui, 0, ul FROM units WHERE ui = 1
        UNION ALL
        SELECT u.doc_id, u.ui,
               CASE WHEN p.cur + 1 + u.ul <= {m} THEN p.chunk_no ELSE p.chunk_no + 1 END,
               CASE WHEN p.cur + 1 + u.ul <= {m} THEN p.cur + 1 + u.ul ELSE u.ul END
        FROM p JOIN units u ON u.doc_id = p.doc_id AND u.ui = p.ui + 1)
      SELECT * FROM p),
    chunks AS (SELECT p.doc_id, CAST(p.chunk_no AS INTEGER) AS chunk_no,
                      string_agg(u.u, chr(10) ORDER BY u.ui) AS chunk
               FROM packed p JOIN units u ON u.doc_id = p.doc_id AND u.ui = p.ui
               GROUP BY p.doc_id, p.chunk_no)"""


@register("segment_texts", f"""
WITH {_segments_sql()}
SELECT doc_id, chunk_no, CAST(length(chunk) AS INTEGER) AS n_chars, chunk FROM chunks
""")
def segment_texts_q(spark, sf):
    """E5: chunks of at most 2,000 characters, lines packed greedily."""
    ch = V.segment_texts(read_table(spark, sf, "documents"), "doc_id", "text", CHUNK_CHARS)
    return ch.select("doc_id", "chunk_no", "n_chars", "chunk")


_CHUNK_VEC_SQL = f"""
    _cw AS (SELECT doc_id, chunk_no, regexp_split_to_array(chunk, {_WS}) AS arr FROM chunks),
    cwords AS (SELECT doc_id, chunk_no, unnest(arr) AS token FROM _cw),
    ccnt AS (SELECT doc_id, chunk_no, {_bucket_sql('token', TRIAL_DIM)} AS dim,
                    CAST(count(*) AS DOUBLE) AS cnt
             FROM cwords WHERE token <> '' GROUP BY ALL),
    cnorm AS (SELECT doc_id, chunk_no, sqrt(sum(cnt * cnt)) AS nrm FROM ccnt GROUP BY ALL)"""


@register("embed_long_texts", f"""
WITH {_segments_sql()}, {_CHUNK_VEC_SQL},
w AS (SELECT doc_id, chunk_no, CAST(length(chunk) AS DOUBLE) AS w FROM chunks),
tw AS (SELECT doc_id, sum(w) AS tw FROM w GROUP BY doc_id),
sv AS (SELECT c.doc_id, c.dim, sum(w.w * c.cnt / n.nrm) AS sv
       FROM ccnt c JOIN cnorm n USING (doc_id, chunk_no) JOIN w USING (doc_id, chunk_no)
       GROUP BY c.doc_id, c.dim)
SELECT sv.doc_id, sv.dim, round(sv.sv / tw.tw, 6) AS value FROM sv JOIN tw USING (doc_id)
""")
def embed_long_texts_q(spark, sf):
    """Segment, embed chunks, length-weighted mean per document."""
    v = V.embed_long_texts(read_table(spark, sf, "documents"), "doc_id", "text",
                           CHUNK_CHARS, TRIAL_DIM)
    return v.select("doc_id", "dim", F.round("value", 6).alias("value"))


@register("adjacent_chunk_similarity", f"""
WITH {_segments_sql()}, {_CHUNK_VEC_SQL},
pairs AS (SELECT a.doc_id, a.chunk_no FROM chunks a JOIN chunks b
          ON b.doc_id = a.doc_id AND b.chunk_no = a.chunk_no + 1),
dots AS (SELECT a.doc_id, a.chunk_no, sum(a.cnt * b.cnt) AS dot FROM ccnt a JOIN ccnt b
         ON b.doc_id = a.doc_id AND b.chunk_no = a.chunk_no + 1 AND b.dim = a.dim GROUP BY ALL)
SELECT p.doc_id, p.chunk_no,
       round(CASE WHEN na.nrm > 0 AND nb.nrm > 0 THEN coalesce(d.dot, 0) / (na.nrm * nb.nrm) END, 6) AS sim
FROM pairs p LEFT JOIN dots d USING (doc_id, chunk_no)
LEFT JOIN cnorm na ON na.doc_id = p.doc_id AND na.chunk_no = p.chunk_no
LEFT JOIN cnorm nb ON nb.doc_id = p.doc_id AND nb.chunk_no = p.chunk_no + 1
""")
def adjacent_chunk_similarity_q(spark, sf):
    """Cosine of each chunk with the next one (64-wide hashed counts)."""
    ch = V.segment_texts(read_table(spark, sf, "documents"), "doc_id", "text", CHUNK_CHARS)
    cnt = V.embed_texts(ch, ["doc_id", "chunk_no"], "chunk", TRIAL_DIM, normalize=False)
    dense = V.to_dense(cnt, ["doc_id", "chunk_no"], TRIAL_DIM)
    # chunks without words have no bucket rows: give them a zero vector
    dense = ch.select("doc_id", "chunk_no").join(dense, ["doc_id", "chunk_no"], "left")
    sims = V.adjacent_similarity(dense, "doc_id", "chunk_no", "vec")
    w = ch.select("doc_id", F.col("chunk_no").alias("_c"))
    nxt = w.withColumn("chunk_no", F.col("_c") - 1).select("doc_id", "chunk_no")
    return (sims.join(nxt, ["doc_id", "chunk_no"], "left_semi")
                .select("doc_id", "chunk_no", F.round("sim", 6).alias("sim")))


_MERGE_COS = "CASE WHEN list_dot_product(vecs[k], vecs[k]) > 0 AND list_dot_product(vecs[k + 1], vecs[k + 1]) > 0 THEN round(list_dot_product(vecs[k], vecs[k + 1]) / (sqrt(list_dot_product(vecs[k], vecs[k])) * sqrt(list_dot_product(vecs[k + 1], vecs[k + 1]))), 12) ELSE 0.0 END"


@register("semantic_chunks", f"""
WITH {_segments_sql()},
_cw AS (SELECT doc_id, chunk_no, regexp_split_to_array(chunk, {_WS}) AS arr FROM chunks),
_cwd AS (SELECT doc_id, chunk_no, unnest(arr) AS token FROM _cw),
cc AS (SELECT doc_id, chunk_no, {_bucket_sql('token', EMBED_DIM)} AS dim, CAST(count(*) AS DOUBLE) AS cnt
       FROM _cwd WHERE token <> '' GROUP BY ALL),
dense AS (SELECT c.doc_id, c.chunk_no, list(coalesce(cc.cnt, 0.0) ORDER BY d.dim) AS vec
          FROM chunks c CROSS JOIN range({EMBED_DIM}) d(dim)
          LEFT JOIN cc ON cc.doc_id = c.doc_id AND cc.chunk_no = c.chunk_no AND cc.dim = d.dim
          GROUP BY c.doc_id, c.chunk_no),
docs AS (SELECT c.doc_id, list(c.chunk ORDER BY c.chunk_no) AS texts, list(d.vec ORDER BY c.chunk_no) AS vecs,
                list(c.chunk_no ORDER BY c.chunk_no) AS firsts, list(c.chunk_no ORDER BY c.chunk_no) AS lasts
         FROM chunks c JOIN dense d USING (doc_id, chunk_no) GROUP BY c.doc_id),
m AS (
  WITH RECURSIVE r(doc_id, texts, vecs, firsts, lasts) AS (
    SELECT * FROM docs
    UNION ALL
    SELECT doc_id,
      list_concat(list_slice(texts, 1, i - 1), [texts[i] || ' ' || texts[i + 1]],
                  list_slice(texts, i + 2, len(texts))),
      list_concat(list_slice(vecs, 1, i - 1),
                  [list_transform(list_zip(vecs[i], vecs[i + 1]), lambda x: x[1] + x[2])],
                  list_slice(vecs, i + 2, len(vecs))),
      list_concat(list_slice(firsts, 1, i), list_slice(firsts, i + 2, len(firsts))),
      list_concat(list_slice(lasts, 1, i - 1), [lasts[i + 1]], list_slice(lasts, i + 2, len(lasts)))
    FROM (SELECT *, list_position(sims, list_max(sims)) AS i
          FROM (SELECT *, list_transform(range(1, len(vecs)), lambda k: {_MERGE_COS}) AS sims
                FROM r WHERE len(texts) > {MERGE_TARGET})))
  SELECT doc_id, texts, firsts, lasts FROM r WHERE len(texts) <= {MERGE_TARGET})
SELECT doc_id, CAST(k - 1 AS INTEGER) AS chunk_no, CAST(firsts[k] AS INTEGER) AS first_chunk,
       CAST(lasts[k] AS INTEGER) AS last_chunk, texts[k] AS chunk
FROM (SELECT *, unnest(range(1, len(texts) + 1)) AS k FROM m)
""")
def semantic_chunks_q(spark, sf):
    """Merge neighbouring chunks by similarity until 5 remain."""
    ch = V.segment_texts(read_table(spark, sf, "documents"), "doc_id", "text", CHUNK_CHARS)
    return M.merge_adjacent_chunks(ch, MERGE_TARGET, EMBED_DIM)


@register("semantic_chunks_embedder", ORACLES["semantic_chunks"])
def semantic_chunks_embedder_q(spark, sf):
    """E11 with a batch embedder: merged pairs are re-embedded (word counts add up, so the
    result is that of the built-in sums)."""
    ch = V.segment_texts(read_table(spark, sf, "documents"), "doc_id", "text", CHUNK_CHARS)
    return M.merge_adjacent_chunks(ch, MERGE_TARGET, EMBED_DIM, embedder=M.hashed_embedder(EMBED_DIM))


@register("embed_long_texts_embedder", ORACLES["embed_long_texts"])
def embed_long_texts_embedder_q(spark, sf):
    """E4 / Q5 with a batch embedder: the same hashed counts, made in Python."""
    v = V.embed_long_texts(read_table(spark, sf, "documents"), "doc_id", "text",
                           CHUNK_CHARS, TRIAL_DIM, embedder=M.hashed_embedder(TRIAL_DIM))
    return v.select("doc_id", "dim", F.round("value", 6).alias("value"))


def _emb(spark, sf):
    return read_table(spark, sf, "embeddings")


@register("l2_normalize", """
WITH e AS (SELECT vec_id, unnest(CAST(embedding AS DOUBLE[])) AS v,
                  unnest(range(len(embedding))) AS dim FROM embeddings),
n AS (SELECT vec_id, sqrt(sum(v * v)) AS nrm FROM e GROUP BY vec_id)
SELECT vec_id, CAST(dim AS INTEGER) AS dim, round(v / greatest(nrm, 1e-12), 6) AS value
FROM e JOIN n USING (vec_id)
""")
def l2_normalize_q(spark, sf):
    """Every embedding scaled to unit length."""
    n = V.l2_normalize(_emb(spark, sf).select("vec_id", F.col("embedding").alias("vec")))
    return V.to_long(n, "vec_id").select("vec_id", "dim", F.round("value", 6).alias("value"))


@register("weighted_mean_vectors", """
WITH e AS (SELECT label, CAST(vec_id AS DOUBLE) AS w, unnest(CAST(embedding AS DOUBLE[])) AS v,
                  unnest(range(len(embedding))) AS dim FROM embeddings)
SELECT label, CAST(dim AS INTEGER) AS dim, round(sum(w * v) / sum(w), 6) AS value FROM e GROUP BY ALL
""")
def weighted_mean_vectors_q(spark, sf):
    """Per label, the mean of its vectors weighted by vec_id."""
    e = _emb(spark, sf).select("label", F.col("vec_id").cast("double").alias("w"),
                               F.posexplode("embedding").alias("dim", "value"))
    e = e.withColumn("dim", F.col("dim").cast("int")).withColumn("value", F.col("value").cast("double"))
    return V.weighted_mean_vectors(e, "label", "w").select(
        "label", "dim", F.round("value", 6).alias("value"))


@register("position_weighted_pool", """
WITH t AS (SELECT label, embedding,
                  CAST(row_number() OVER (PARTITION BY label ORDER BY vec_id) AS DOUBLE) AS w
           FROM embeddings),
e AS (SELECT label, w, unnest(CAST(embedding AS DOUBLE[])) AS v, unnest(range(len(embedding))) AS dim
      FROM t)
SELECT label, CAST(dim AS INTEGER) AS dim, round(sum(w * v) / sum(w), 6) AS value FROM e GROUP BY ALL
""")
def position_weighted_pool_q(spark, sf):
    """A label's vectors as the tokens of one text, position-weighted mean."""
    t = _emb(spark, sf).select(F.col("label"), F.col("vec_id").alias("pos"),
                               F.col("embedding").alias("hidden"), F.lit(1).alias("mask"))
    # ten labels over the whole table: groups grow with the data
    p = V.position_weighted_pool(t, "label", "pos", "hidden", "mask", large_groups=True)
    return p.select("label", "dim", F.round("value", 6).alias("value"))


@register("adjacent_similarity", """
WITH e AS (SELECT label, vec_id, CAST(embedding AS DOUBLE[]) AS v,
                  lead(CAST(embedding AS DOUBLE[])) OVER (PARTITION BY label ORDER BY vec_id) AS nv
           FROM embeddings)
SELECT label, vec_id,
       round(list_dot_product(v, nv) / (sqrt(list_dot_product(v, v)) * sqrt(list_dot_product(nv, nv))), 6)
         AS sim
FROM e WHERE nv IS NOT NULL
""")
def adjacent_similarity_q(spark, sf):
    """Cosine of each vector with the next one of its label."""
    s = V.adjacent_similarity(_emb(spark, sf), "label", "vec_id", "embedding",
                              large_groups=True)
    return s.filter(F.col("sim").isNotNull()).select("label", "vec_id",
                                                      F.round("sim", 6).alias("sim"))


# ---------------------------------------------------------------------------
# Sources and sinks: S2, S4 + K2, S6, K4

from pagetables.operators import content as C  # noqa: E402
from pagetables.session import scratch_path  # noqa: E402
from pagetables.sources import readers as R  # noqa: E402
from pagetables.sources import writers as W  # noqa: E402


@register("decode_pages", """
SELECT doc_id, CASE WHEN doc_id % 4 = 2 THEN text || chr(65533) ELSE text END AS html,
  CASE WHEN doc_id % 4 = 2 THEN 'replaced' WHEN doc_id % 20 = 0 THEN 'unknown_charset' ELSE 'ok' END AS status
FROM documents
""")
def decode_pages_q(spark, sf):
    """UTF-8, UTF-16, Latin-1, undeclared, unknown and damaged bodies (GBK: tests)."""
    d = read_table(spark, sf, "documents")
    k = F.col("doc_id") % 4
    raw = d.select("doc_id", F.when(k == 1, F.encode("text", "UTF-16")).when(
        k == 3, F.encode(F.regexp_replace("text", "[^\\x00-\\xFF]", "?"), "ISO-8859-1")).when(
        k == 2, F.concat(F.encode("text", "UTF-8"), F.unhex(F.lit("FF")))).otherwise(F.encode("text", "UTF-8")).alias("body"),
        F.when(F.col("doc_id") % 20 == 0, "x-none").when(k == 1, "UTF-16").when(k == 3, "latin-1").when(k == 2, "utf-8")
        .alias("charset"))
    return R.decode_pages(raw, status="status").select("doc_id", "html", "status")


@register("extract_anchors_hard", """
SELECT doc_id AS page_id, unnest([0, 1, 2, 3, 4])::INTEGER AS elem_seq,
  unnest(['/x' || doc_id, '/1', '/2?a=1&b=' || n_chars, '/3', '/q>' || doc_id]) AS href,
  unnest(['T — ' || doc_id || '’s café ' || lang, 'onetwothree-下一页> & <', 'two', 'three', '下一页']) AS text
FROM documents
""")
def extract_anchors_hard_q(spark, sf):
    """H2 on one page a document with very long tags, nested and unclosed anchors, split
    labels and named, numeric and unterminated character references."""
    d = read_table(spark, sf, "documents")
    i = F.col("doc_id").cast("string")
    long_tag = F.concat(F.lit("<a href='/x"), i, F.lit("' "), F.repeat(F.lit("data a = "), 3000 + F.pmod("doc_id", F.lit(7)).cast("int")),
                        F.repeat(F.lit('b="c > d" '), 400), F.lit(">"))
    html = F.concat(
        long_tag, F.lit("T &mdash; "), i, F.lit("&#8217;s caf&eacute; "), F.col("lang"),
        F.lit("</a><script><a href='/no'>no</a></script><A HREF=\"/1\">one<a href='/2?a=1&amp;b="),
        F.col("n_chars").cast("string"),
        F.lit("'>two</a><!-- <a href=/no> --><a title=\"href='/no'\" href=/3>three</a><a name=x>-</a>"),
        F.lit('<abbr href="/no"></abbr><a class=n href="/q&gt;'), i, F.lit('">&#19979;<b>一</b>&#x9875;</a>&gt &amp; &lt;'))
    return H.extract_anchors(d.select(F.col("doc_id").alias("page_id"), html.alias("html"))).select(
        "page_id", "elem_seq", "href", "text")


_STORY_ROWS_SQL = f"""
    fw AS (SELECT doc_id, text, lang, regexp_extract(text, {_TITLE}, 1) AS title FROM documents)"""


@register("stories_csv_round_trip", f"""
WITH {_STORY_ROWS_SQL}
SELECT title, text, lang AS category, '{SH}doc/' || doc_id AS story_url FROM fw
""")
def stories_csv_round_trip_q(spark, sf):
    """K2 + S4: a story table with commas, quotes, newlines written as CSV and read back."""
    d = read_table(spark, sf, "documents")
    st = d.select(F.regexp_extract("text", S.TITLE_RE, 1).alias("title"), "text",
                  F.col("lang").alias("category"),
                  F.concat(F.lit(SH + "doc/"), F.col("doc_id")).alias("story_url"))
    path = scratch_path(spark, "stories-csv")
    W.write_stories_csv(st, path, W.STORY_COLUMNS_B)
    return R.read_stories_csv(spark, path, W.STORY_COLUMNS_B)


@register("read_completions", f"""
WITH {_DOCS_SQL}
SELECT '{SH}' || lang || '/' || doc_id || '/' AS key, coalesce(quality = 1, false) AS decision FROM dl
""")
def read_completions_q(spark, sf):
    """Answers landed as JSON lines, read with an explicit schema, then parsed."""
    path = scratch_path(spark, "completions")
    _completions(spark, sf).write.mode("overwrite").json(path)
    c = R.read_completions(spark, path)
    return X.parse_decision(c.filter(F.col("kind") == "decision"))


@register("records_from_map", f"""
WITH {_DOCS_SQL}, {_TITLE_ROWS_SQL}
SELECT '{SH}' || lang || '/' || doc_id || '/' AS key, raw_title || ' (' || i || ')' AS title,
       '{SH}story/' || doc_id || '/' || i AS url, lang AS category
FROM tl
""")
def records_from_map_q(spark, sf):
    """K4: a map of records per listing (title -> {url, category}) turned into rows."""
    d = read_table(spark, sf, "documents")
    did = F.col("doc_id")
    m = F.map_from_entries(F.transform(S._lines(F.col("text")), lambda s: F.struct(
        F.concat(s["title"], F.lit(" ("), s["i"].cast("string"), F.lit(")")),
        F.struct(S.story_url(did, s["i"]).alias("url"), F.col("lang").alias("category")))))
    recs = d.select(S.cat_url(F.col("lang"), did).alias("key"), m.alias("stories"))
    return W.records_from_map(recs, "stories", "title", keep=["key"])


# ---------------------------------------------------------------------------
# Content and link odds and ends: F16, J1, F24, F18, F23, A6, L1–L3, J8, A10,
# F19, F20, J6, U1, F17/J5 + I3

@register("valid_urls", f"""
WITH {_LINES_SQL}
SELECT DISTINCT '{S.LABEL_HOST}c' || conv_id || '/' || conv_id || '_' || turn || '_' || i || '.html' AS url
FROM lines WHERE role <> 'system'
""")
def valid_urls_q(spark, sf):
    """F16: story links of the label site that lead to a landed page."""
    site, _ = _label(spark, sf)
    a = L.links_with_prefix(H.extract_anchors(site), "/c")
    urls = a.select(F.concat(F.lit(S.LABEL_HOST), F.substring("href", 2, 1 << 30)).alias("url"))
    return L.valid_urls(urls, site).distinct()


@register("fetch_pages", f"""
WITH {_LINES_SQL}
SELECT DISTINCT '{S.LABEL_HOST}c' || conv_id || '/' || conv_id || '_' || turn || '_' || i || '.html' AS url,
       role <> 'system' AS fetched
FROM lines
""")
def fetch_pages_q(spark, sf):
    """Every story link of the label site joined to the landed pages."""
    site, _ = _label(spark, sf)
    a = L.links_with_prefix(H.extract_anchors(site), "/c")
    urls = a.select(F.concat(F.lit(S.LABEL_HOST), F.substring("href", 2, 1 << 30))
                    .alias("url")).distinct()
    return C.fetch_pages(urls, site, "url", cols=("page_id",)).select("url", "fetched")


@register("missing_stories", f"""
WITH s AS (SELECT page_id, {_strip_sql()} AS h FROM pages),
t AS (SELECT page_id,
        {Q.py_strip(Q.strip_tags("regexp_extract(h, '(?s)<h1[^>]*>(.*?)</h1>', 1)"))} AS title,
        string_split(h, '<p>') AS segs FROM s WHERE regexp_matches(h, '<h1[^>]*>'))
SELECT page_id, title FROM t
WHERE NOT (len(segs) >= 3 AND contains({Q.strip_tags('segs[2]')}, title))
""")
def missing_stories_q(spark, sf):
    """pages whose h1 title is on no paragraph (reported instead of dropped)."""
    pages = read_table(spark, sf, "pages")
    titles = H.heading_title(H.page_elements(pages, tags=["h1"]))
    found = C.paragraph_after_title(titles, H.page_elements(pages, tags=["p"]))
    return C.missing_stories(titles, found.select("page_id", "title"), key="page_id") \
            .select("page_id", "title")


@register("with_full_page_fallback", f"""
WITH {Q.anchors_cte()},
pg AS (SELECT page_id, {Q.url_segment('url', 1)} AS category FROM pages),
n AS (SELECT pg.page_id, pg.category,
             count(a.href) FILTER (WHERE starts_with(a.href, '{PREFIX_TH}')) AS n_links,
             count(a.href) AS n_all
      FROM pg LEFT JOIN anchors a ON a.page_id = pg.page_id GROUP BY ALL),
s AS (SELECT *, max(CAST(n_links = 0 AS INTEGER)) OVER (PARTITION BY category ORDER BY page_id
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) = 1 AS full_page FROM n)
SELECT page_id, category, full_page, CAST(CASE WHEN full_page THEN n_all ELSE n_links END AS INTEGER) AS n_used
FROM s
""")
def with_full_page_fallback_q(spark, sf):
    """links-only input ('/th' links) unless empty; after the first empty page of a
    category the whole page is used for the rest of it (page_id order)."""
    pages = read_table(spark, sf, "pages")
    a = H.extract_anchors(pages)
    g = a.groupBy("page_id").agg(
        F.collect_list(F.when(F.col("href").startswith(PREFIX_TH), F.col("href"))).alias("links"),
        F.collect_list("href").alias("full"))
    p = pages.select("page_id", TX.url_path_segment("url", 1).alias("category")) \
             .join(g, "page_id", "left")
    f = C.with_full_page_fallback(p, "links", "full", part=("category",), order=("page_id",))
    return f.select("page_id", "category", "full_page",
                    F.coalesce(F.size("input"), F.lit(0)).cast("int").alias("n_used"))


@register("with_page_note", f"""
WITH {Q.anchors_cte()},
lt AS (SELECT page_id, url,
  'Links/Buttons:' || chr(10) || string_agg('- [' || {Q.collapse_space('text')} || '](' ||
      {Q.url_origin('url')} || href || ')', chr(10) ORDER BY elem_seq) AS links_text
  FROM anchors GROUP BY page_id, url)
SELECT page_id, links_text || chr(10) || 'Current Page Number: ' ||
       row_number() OVER (PARTITION BY {Q.url_segment('url', 1)} ORDER BY page_id) AS snapshot
FROM lt
""")
def with_page_note_q(spark, sf):
    """H10 (JVM links summary) + F23: the page number appended to each page's text."""
    pages = read_table(spark, sf, "pages")
    s = H.links_summary(H.extract_anchors(pages)).withColumnRenamed("links_text", "snapshot")
    s = s.join(pages.select("page_id", TX.url_path_segment("url", 1).alias("category")),
               "page_id")
    # page number within the category without sorting a category in one task
    from pagetables.operators.ordering import with_positions
    s = with_positions(s, ["category"], ["page_id"], "page_no")
    return C.with_page_note(s).select("page_id", "snapshot")


@register("frame_shape", "SELECT count(*) AS n_rows, 3 AS n_cols FROM pages")
def frame_shape_q(spark, sf):
    """Rows and columns of the page table."""
    return C.frame_shape(read_table(spark, sf, "pages")).withColumn(
        "n_cols", F.col("n_cols").cast("int"))


@register("head_rows", f"""
WITH {Q.anchors_cte()}, {_LINKS_SQL},
r AS (SELECT *, row_number() OVER (PARTITION BY title ORDER BY page_id, elem_seq) AS rn FROM links)
SELECT title, story_url FROM r WHERE rn = 1 ORDER BY page_id, elem_seq LIMIT 5
""")
def head_rows_q(spark, sf):
    """L1/L2: the first five title/url pairs (top-n is the feature)."""
    d = L.dedup_first(_page_links(spark, sf), "title", order=["page_id", "elem_seq"],
                      values=["story_url", "category"])
    return C.head_rows(d, ["first_ord"], 5).select("title", "story_url")


@register("sample_first", f"""
WITH {_LINES_SQL}, {_NUMBER_SQL},
st AS (SELECT k.conv_id, w.page_no, k.elem_seq, k.title, k.i, k.turn FROM kept k
       JOIN nwalk w ON w.conv_id = k.conv_id AND w.page_no = k.turn + 1 WHERE k.dig = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY title ORDER BY conv_id, page_no, elem_seq) AS rn FROM st)
SELECT title, '{S.NUMBER_HOST}/news/c' || conv_id || '/' || conv_id || '_' || turn || '_' || i || '.htm' AS url
FROM r WHERE rn = 1 ORDER BY conv_id, page_no, elem_seq LIMIT 20
""")
def sample_first_q(spark, sf):
    """L3: the trial run on the first 20 stories of the numbered crawl, in crawl order."""
    site, seeds = _number(spark, sf)
    t = PL.number_links(site, seeds, NUMBER_IGNORE)
    return C.sample_first(t, ["first_ord"], 20).select("title", "url")


# Fixed value: the title looked up by J8.
LOOKUP = "Les"


@register("lookup_title", f"""
WITH {_LINES_SQL}, {_NUMBER_SQL},
st AS (SELECT k.conv_id, w.page_no, k.elem_seq, k.title, k.i, k.turn FROM kept k
       JOIN nwalk w ON w.conv_id = k.conv_id AND w.page_no = k.turn + 1 WHERE k.dig = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY title ORDER BY conv_id, page_no, elem_seq) AS rn FROM st)
SELECT title, 'num' || conv_id AS category FROM r WHERE rn = 1 AND title = '{LOOKUP}'
""")
def lookup_title_q(spark, sf):
    """One known title looked up in the numbered crawl's title table."""
    site, seeds = _number(spark, sf)
    t = PL.number_links(site, seeds, NUMBER_IGNORE)
    return C.lookup_title(t, LOOKUP).select("title", "category")


@register("titles_map", f"""
WITH {_LINES_SQL}, {_LABEL_WALK_SQL},
pl AS (SELECT w.conv_id, w.page_no, l.k AS o, l.title, l.turn, l.i
       FROM walk w JOIN lines l ON l.conv_id = w.conv_id AND l.turn = w.turn
       UNION ALL
       SELECT w.conv_id, w.page_no, 100000 + l.k, l.title, l.turn, l.i
       FROM walk w JOIN turns t ON t.conv_id = w.conv_id AND t.turn = 0 AND w.turn = 0
       JOIN lines l ON l.conv_id = w.conv_id AND l.turn = t.last_turn),
r AS (SELECT *, row_number() OVER (PARTITION BY conv_id, page_no, title ORDER BY o DESC) AS rn FROM pl)
SELECT CAST(conv_id AS INTEGER) AS category_no, CAST(page_no AS INTEGER) AS page_no, title,
       '{S.LABEL_HOST}c' || conv_id || '/' || conv_id || '_' || turn || '_' || i || '.html' AS url
FROM r WHERE rn = 1
""")
def titles_map_q(spark, sf):
    """A10: {title: (url, category)} of each listing page of the labelled walk."""
    site, seeds = _label(spark, sf)
    chain = P.follow_next(site, seeds)
    listing = site.join(chain.select("page_id", "category_no", "category", "page_no"), "page_id")
    a = H.extract_anchors(listing, keep_cols=("category_no", "category", "page_no"))
    a = a.filter(F.col("href").startswith("/c")).withColumn("title", F.col("text")) \
         .withColumn("url", F.concat(F.lit(S.LABEL_HOST), F.substring("href", 2, 1 << 30)))
    m = L.titles_map(a)
    e = m.select("category_no", "page_no", F.explode("titles").alias("title", "v"))
    return e.select("category_no", "page_no", "title", F.col("v.url").alias("url"))


@register("clean_content", f"""
SELECT doc_id, translate({Q.py_rstrip("'　' || replace(text, chr(10), chr(13) || chr(10)) || ' 　' || chr(13)")},
                         chr(13) || '　', '') AS content
FROM documents
""")
def clean_content_q(spark, sf):
    """content with carriage returns and ideographic spaces cleaned."""
    d = read_table(spark, sf, "documents")
    dirty = F.concat(F.lit("　"), F.replace(F.col("text"), F.lit("\n"), F.lit("\r\n")),
                     F.lit(" 　\r"))
    return C.clean_content(d.select("doc_id", dirty.alias("content")))


@register("newlines_to_spaces", "SELECT doc_id, replace(text, chr(10), ' ') AS text FROM documents")
def newlines_to_spaces_q(spark, sf):
    """newlines to blanks before embedding."""
    d = read_table(spark, sf, "documents")
    return d.select("doc_id", C.newlines_to_spaces("text").alias("text"))


# Fixed value: the category seeds of the landed pages (S3), in order.
PAGE_CATEGORIES = {"en": "http://example/en/", "fr": "http://example/fr/",
                   "de": "http://example/de/", "es": "http://example/es/"}


@register("attach_category", f"""
SELECT page_id, CAST(CASE {Q.url_segment('url', 1)} WHEN 'en' THEN 0 WHEN 'fr' THEN 1
                        WHEN 'de' THEN 2 WHEN 'es' THEN 3 END AS INTEGER) AS category_no,
       {Q.url_segment('url', 1)} AS category
FROM pages WHERE {Q.url_segment('url', 1)} IN ('en', 'fr', 'de', 'es')
""")
def attach_category_q(spark, sf):
    """S3 + J6: category seeds from a literal map, broadcast-joined to the pages."""
    seeds = R.category_seeds(spark, PAGE_CATEGORIES)
    p = read_table(spark, sf, "pages").select(
        "page_id", TX.url_path_segment("url", 1).alias("category"))
    return p.join(seeds.select("category", "category_no"), "category") \
            .select("page_id", "category_no", "category")


@register("union_links", f"""
WITH {_LINES_SQL}, {_NUMBER_SQL}
SELECT 'label' AS site, count(*) AS n FROM lines
UNION ALL SELECT 'number', count(*) FROM kept WHERE dig = 0
""")
def union_links_q(spark, sf):
    """Story links of both sites in one table, counted per site.

    A label-site story is counted on its own turn's page (the recent block
    repeats some of them on page 1)."""
    conv = read_table(spark, sf, "conversations")
    lab = H.extract_anchors(S.label_site(conv)).filter(
        F.col("href").rlike("^/c[0-9]+/[0-9]+_[0-9]+_[0-9]+\\.html$"))
    story_turn = F.regexp_extract("href", "_([0-9]+)_[0-9]+\\.html$", 1).cast("int")
    page_turn = F.coalesce(
        F.regexp_extract("url", "list_[0-9]+_([0-9]+)\\.html$", 1).try_cast("int") - 1,
        F.lit(0))
    lab = lab.filter(story_turn == page_turn)
    nb = P.numbered_page_links(S.number_site(conv), S.number_categories(conv), NUMBER_IGNORE) \
          .filter(~F.col("is_index"))
    u = L.union_links(lab.select(F.lit("label").alias("site"), "href"),
                      nb.select(F.lit("number").alias("site"), F.col("link_url").alias("href")))
    return u.groupBy("site").agg(F.count(F.lit(1)).alias("n"))


_VALIDATED_SQL = f"""
    vedges AS (SELECT e.conv_id, e.u, e.v FROM edges e JOIN turns t ON t.conv_id = e.conv_id AND t.turn = e.u
               WHERE e.v IS NOT NULL AND NOT (t.role = 'user' AND t.turn >= 2)),
    vwalk AS (
      WITH RECURSIVE w(conv_id, node, d, seen) AS (
        SELECT conv_id, 0, 0, [0] FROM turns WHERE turn = 0
        UNION ALL
        SELECT w.conv_id, e.v, w.d + 1, list_append(w.seen, e.v)
        FROM w JOIN vedges e ON e.conv_id = w.conv_id AND e.u = w.node
        WHERE NOT list_contains(w.seen, e.v))
      SELECT conv_id, node AS turn, d + 1 AS page_no FROM w)"""


def _answers_for_label_site(site):
    """One "next_page" answer per listing page: the page's real next link, except
    on user turns from the third page on, where the answer names a page the
    listing does not link to (a made-up url the validation must reject)."""
    a = H.extract_anchors(site)
    nxt = L.next_page_link(a, S.NEXT_LABEL, part=("url",))
    real = TX.resolve_href("url", "next_href")
    turn = F.coalesce(F.regexp_extract("url", "list_[0-9]+_([0-9]+)\\.html$", 1)
                      .try_cast("int") - 1, F.lit(0))
    return nxt.select("url", real.alias("real"), turn.alias("turn"))


@register("follow_validated", f"""
WITH {_LINES_SQL}, {_LABEL_WALK_SQL}, {_VALIDATED_SQL}
SELECT CAST(conv_id AS INTEGER) AS category_no, CAST(page_no AS INTEGER) AS page_no,
       {_label_url('conv_id', 'turn')} AS url
FROM vwalk
""")
def follow_validated_q(spark, sf):
    """I3 + F17/J5: follow the next page an answer names only if the page links to it."""
    conv = read_table(spark, sf, "conversations")
    site, seeds = S.label_site(conv), S.label_categories(conv)
    nx = _answers_for_label_site(site)
    roles = conv.select(F.col("conv_id").cast("int").alias("category_no"), "turn", "role")
    cat = F.regexp_extract("url", "/c([0-9]+)/", 1).cast("int")
    ans = (nx.withColumn("category_no", cat)
             .join(roles, ["category_no", "turn"], "left")
             .select("url", F.when((F.col("role") == "user") & (F.col("turn") >= 2),
                                   F.concat(F.regexp_replace("url", "[^/]*$", ""),
                                            F.lit("list_999.html")))
                              .otherwise(F.col("real")).alias("next_page")))
    return P.follow_validated(site, seeds, ans).select("category_no", "page_no", "url")


# Fixed value: the story-link threshold of the discovery query (the reference
# asks for "more than 10"; the derived listing pages are shorter).
DISCOVER_MIN = 3


@register("discover_categories", f"""
WITH {_LINES_SQL},
nav AS (  -- pager links of each seed page that lead to a landed listing page
  SELECT conv_id, turn + 1 AS tgt, '{S.NEXT_LABEL}' AS lab FROM turns
  WHERE turn = 0 AND turn < last_turn AND role <> 'system'
  UNION ALL
  SELECT conv_id, last_turn, '{S.LAST_LABEL}' FROM turns WHERE turn = 0 AND last_turn >= 1),
nl AS (SELECT conv_id, turn, count(DISTINCT i) AS n FROM lines GROUP BY ALL)
SELECT nav.lab AS category, {_label_url('nav.conv_id', 'nav.tgt')} AS url, nl.n AS n_links
FROM nav JOIN nl ON nl.conv_id = nav.conv_id AND nl.turn = nav.tgt
WHERE nl.n > {DISCOVER_MIN}
""")
def discover_categories_q(spark, sf):
    """listing pages that seed pages link to, landed and holding > 3 story links."""
    site, seeds = _label(spark, sf)
    home = site.join(sized(seeds.select("url")), "url")
    a = H.extract_anchors(home).filter(~F.col("href").startswith("/"))
    return L.discover_categories(a, site, "/c", DISCOVER_MIN)


@register("story_csv_from_answers", ORACLES["story_table_from_answers"])
def story_csv_from_answers_q(spark, sf):
    """Q3 + K3: the answer-driven story table written as CSV (fixed field order) and read back."""
    from pagetables.plans.pipelines import story_table_from_answers
    st = story_table_from_answers(_answers(spark, sf))
    path = scratch_path(spark, "stories-k3")
    W.write_stories_csv(st, path, W.STORY_COLUMNS_C)
    return R.read_stories_csv(spark, path, W.STORY_COLUMNS_C)


@register("follow_numbered_stepwise", ORACLES["follow_numbered"])
def follow_numbered_stepwise_q(spark, sf):
    """I2 one round per page number (the twin the fixpoint walk is checked against)."""
    site, seeds = _number(spark, sf)
    return P.follow_numbered_stepwise(site, seeds, NUMBER_IGNORE).select(
        "category_no", "page_no", "url")


@register("requests_from_prompt_file", ORACLES["build_chat_requests"])
def requests_from_prompt_file_q(spark, sf):
    """S5 + X1: the system prompt read from a file (one row, bounded), then one
    request per page with the links tail of its snapshot."""
    path = scratch_path(spark, "prompt") + ".md"
    spark.createDataFrame([(CATEGORY_PROMPT,)], "value string").coalesce(1) \
         .write.mode("overwrite").text(path)
    prompt = R.read_prompt(spark, path).first()["prompt"].rstrip("\n")
    snap = H.page_snapshot(read_table(spark, sf, "pages"), exclude=H.FURNITURE_SELECTORS,
                           links_at_end=True)
    snap = snap.filter(F.size("links") > 0).withColumn("links_text",
                                                       H.links_section(F.col("snapshot")))
    req = X.build_chat_requests(snap, prompt, text="links_text")
    return req.select("page_id", F.posexplode("messages").alias("msg_no", "m")).select(
        "page_id", F.col("msg_no").cast("int").alias("msg_no"),
        F.col("m.role").alias("role"), F.col("m.content").alias("content"))


@register("element_tag_counts_sql", ORACLES["element_tag_counts"])
def element_tag_counts_sql_q(spark, sf):
    """H1 from SQL: the shredder as a LATERAL table function, counted per page and tag."""
    from pagetables.functions.sql import register_sql_functions
    register_sql_functions(spark)
    read_table(spark, sf, "pages").createOrReplaceTempView("_pt_pages_sql")
    return spark.sql("""
        SELECT p.page_id, e.tag, count(*) AS n
        FROM _pt_pages_sql p, LATERAL shred_html(p.html, NULL) e
        GROUP BY p.page_id, e.tag""")


from pagetables.plans import catalog_crawls, catalog_pages, catalog_values  # noqa: E402,F401
