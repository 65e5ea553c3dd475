"""Links: filters, predicates, dedup, set operations.

Order is data here: the crawlers' dicts are first-wins or last-wins in
arrival order, so every operator that depends on order takes the order
columns explicitly (``category_no, page_no, phase, elem_seq``).

Dedup is an aggregate (``min_by``/``max_by`` over a struct of order
columns), not a window: partial aggregation collapses a hot title on the
map side before the shuffle, so a title seen on every page costs one row
per partition, not one row per page.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagetables.functions.text import is_digits, py_strip

ORDER_COLS = ["category_no", "page_no", "phase", "elem_seq"]


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def links_with_prefix(anchors: DataFrame, prefix, href: str = "href") -> DataFrame:
    """``href.startswith(prefix)``; NULL href drops. ``prefix`` is a str or Column."""
    p = F.lit(prefix) if isinstance(prefix, str) else prefix
    return anchors.filter(F.col(href).startswith(p))


def pagination_links(anchors: DataFrame, href: str = "href", prefix: str = "list_") -> DataFrame:
    """the pager's links (``list_…``)."""
    return anchors.filter(F.col(href).startswith(prefix))


def drop_ignored_titles(links: DataFrame, ignore, title: str = "title") -> DataFrame:
    """Titles not in the stop list.

    A Python list is a literal of bounded size: ``NOT IN`` (an InSet on the
    JVM).  A DataFrame stop list is an anti join; AQE turns it into a
    broadcast join only when its measured size is under the threshold.  A NULL
    title is on no list and stays.
    """
    if isinstance(ignore, DataFrame):
        ig = ignore.select(F.col(ignore.columns[0]).alias("_ignored")).distinct()
        return links.join(ig, F.col(title) == F.col("_ignored"), "left_anti")
    return links.filter(F.col(title).isNull() | ~F.col(title).isin(list(ignore)))


def split_index_links(links: DataFrame, title: str = "title") -> DataFrame:
    """flag page-number links (``title.isdigit()``)."""
    return links.withColumn("is_index", is_digits(title))


def through_index(links: Column, title: str = "title") -> Column:
    """F6 / N5 on a page's links as an array in document order: those up to the first story
    that follows the index run, that story included; all, if there is none.

    Run the stop list (F4) first: ignored titles never stop the scan."""
    digit = F.transform(links, lambda x: is_digits(x[title]))

    def upto(d):
        run = F.array_position(d, F.lit(True))                          # 1-based; 0: no index
        rest = F.slice(d, F.greatest(run, F.lit(1)).cast("int"), F.size(d))
        stop = F.array_position(rest, F.lit(False))
        return F.when((run > 0) & (stop > 0), run + stop - 1).otherwise(F.size(d)).cast("int")
    return F.slice(links, F.lit(1), F.transform(F.array(digit), upto)[0])


def take_through_index(links: DataFrame, part=("page_id",), order: str = "elem_seq",
                       title: str = "title") -> DataFrame:
    """``through_index`` for links that are rows already: two running windows, one sort per
    ``part`` (which has to be bounded, such as a page).
    """
    w = Window.partitionBy(*part).orderBy(order)
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    d = is_digits(title).cast("int")
    flagged = links.withColumn("_dig", d)
    seen = F.coalesce(F.max("_dig").over(before), F.lit(0))
    flagged = flagged.withColumn("_stop", ((seen == 1) & (F.col("_dig") == 0)).cast("int"))
    stopped_before = F.coalesce(F.sum("_stop").over(before), F.lit(0))
    return (flagged.withColumn("_sb", stopped_before)
                   .filter(F.col("_sb") == 0)
                   .drop("_dig", "_stop", "_sb"))


def recent_links(anchors: DataFrame, suffix, href: str = "href") -> DataFrame:
    """recent-block links of the current section: ``href.split('/')[-2] == suffix``."""
    s = F.lit(suffix) if isinstance(suffix, str) else suffix
    second_last = F.try_element_at(F.split(F.col(href), "/"), F.lit(-2))
    return anchors.filter(second_last == s)


def next_page_link(anchors: DataFrame, label: str = "下一页", part=("page_id",),
                   href: str = "href", text: str = "text") -> DataFrame:
    """first link whose stripped text is the label, per page -> (part..., next_href)."""
    return (anchors.filter(py_strip(text) == label)
                   .groupBy(*part)
                   .agg(F.min_by(href, "elem_seq").alias("next_href")))


def categories_with_min_links(links: DataFrame, threshold: int = 10,
                              category: str = "category", key: str = "url") -> DataFrame:
    """Categories whose pages hold more than ``threshold`` distinct story links."""
    return (links.groupBy(category)
                 .agg(F.countDistinct(key).alias("n_links"))
                 .filter(F.col("n_links") > threshold))


def valid_urls(df: DataFrame, pages: DataFrame, url: str = "url") -> DataFrame:
    """F16: rows whose url is a landed page (semi join)."""
    live = pages.select(F.col("url").alias("_live_url"))
    return df.join(live, F.col(url) == F.col("_live_url"), "left_semi")


def validate_next_page(candidates: DataFrame, anchors: DataFrame,
                       page: str = "page_id", href: str = "next_href") -> DataFrame:
    """Keep a next link only if the page really holds it."""
    held = anchors.select(F.col("page_id").alias("_pid"), F.col("href").alias("_href"))
    return candidates.join(held, (F.col(page) == F.col("_pid")) & (F.col(href) == F.col("_href")),
                           "left_semi")


def drop_home_links(links: DataFrame, url: str = "url", page_url: str | None = None) -> DataFrame:
    """trim, then drop links that lead back to a home page.

    A home link has an empty or ``/`` path (a relative link's path is the link
    itself); with ``page_url`` given, links to another host are dropped too.
    """
    u = py_strip(url)
    path = F.regexp_extract(u, "^(?:[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)?([^?#]*)", 1)
    out = links.withColumn(url, u).filter(~path.isin("", "/"))
    if page_url:
        host = F.regexp_extract(F.col(url), "^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]*)", 1)
        phost = F.regexp_extract(F.col(page_url), "^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]*)", 1)
        out = out.filter(~F.col(url).rlike("^[A-Za-z][A-Za-z0-9+.-]*://") | (host == phost))
    return out


def _order_struct(order: Sequence[str]) -> Column:
    return F.struct(*[F.col(c) for c in order])


def dedup_first(links: DataFrame, key="title", order: Sequence[str] = ORDER_COLS,
                values: Sequence[str] = ("url", "category")) -> DataFrame:
    """A1: one row per key, the first seen wins (``if t not in d: d[t] = v``).

    -> (key..., values..., first_ord struct).
    """
    keys = [key] if isinstance(key, str) else list(key)
    o = _order_struct(order)
    agg = links.groupBy(*keys).agg(
        F.min_by(F.struct(*values), o).alias("_v"), F.min(o).alias("first_ord"))
    return agg.select(*keys, *[F.col("_v")[v].alias(v) for v in values], "first_ord")


def dedup_last(links: DataFrame, key="title", order: Sequence[str] = ORDER_COLS,
               values: Sequence[str] = ("url", "category")) -> DataFrame:
    """A2: one row per key, the last write wins, the first position is kept
    (``d[t] = v`` on a Python dict).  -> (key..., values..., first_ord)."""
    keys = [key] if isinstance(key, str) else list(key)
    o = _order_struct(order)
    agg = links.groupBy(*keys).agg(
        F.max_by(F.struct(*values), o).alias("_v"), F.min(o).alias("first_ord"))
    return agg.select(*keys, *[F.col("_v")[v].alias(v) for v in values], "first_ord")


def page_index(index_links: DataFrame, category: str = "category_no",
               order: Sequence[str] = ("page_no", "elem_seq")) -> DataFrame:
    """A3: first-wins map page number -> url, per category.

    ``index_links`` has (category, number, url, order...).
    """
    return dedup_first(index_links, key=[category, "number"], order=order, values=("url",))


def count_titles(links: DataFrame, by: Sequence[str] = (), title: str = "title") -> DataFrame:
    """A4: number of distinct titles (per group when ``by`` is given)."""
    if by:
        return links.groupBy(*by).agg(F.countDistinct(title).alias("n_titles"))
    return links.agg(F.countDistinct(title).alias("n_titles"))


def titles_map(links: DataFrame, by: Sequence[str] = ("category_no", "page_no"),
               title: str = "title", values: Sequence[str] = ("url", "category")) -> DataFrame:
    """A10: ``{title: (url, category)}`` per listing page (bounded by one page's links).

    Last write wins within the page, as for a Python dict.
    """
    per = links.groupBy(*by, title).agg(
        F.max_by(F.struct(*values), F.col("elem_seq")).alias("_v"))
    return per.groupBy(*by).agg(F.map_from_entries(F.collect_list(
        F.struct(F.col(title), F.col("_v")))).alias("titles"))


def union_links(*frames: DataFrame) -> DataFrame:
    """One table of links from many sources (columns matched by name)."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def union_recent(page_links: DataFrame, recent: DataFrame) -> DataFrame:
    """Page links (phase 0) plus recent-block links (phase 1)."""
    return union_links(page_links.withColumn("phase", F.lit(0)),
                       recent.withColumn("phase", F.lit(1)))


def first_block(recent: DataFrame, category: str = "category_no") -> DataFrame:
    """The links of the first category, in category order, whose recent block has any.

    The block is read again with the next category while none was found.  The category is an
    aggregate of one row, joined back by its number."""
    return recent.join(recent.agg(F.min(category).alias(category)), category)


def exclude_recent(links: DataFrame, recent: DataFrame, title: str = "title",
                   from_page: int = 2, by: Sequence[str] = (), since: str | None = None) -> DataFrame:
    """On pages >= ``from_page``, drop titles listed in the recent block
    (within the same ``by`` group, e.g. per category, when given; with ``since``, only in
    rows whose ``since`` column is not before the block's: the categories read after it)."""
    keys = list(by)
    r = recent.select(*[F.col(k).alias("_r_" + k) for k in [*keys, *([since] if since else [])]],
                      F.col(title).alias("_rt")).distinct()
    cond = (F.col(title) == F.col("_rt")) & (F.col("page_no") >= from_page)
    for k in keys:
        cond = cond & (F.col(k) == F.col("_r_" + k))
    if since:
        cond = cond & (F.col(since) >= F.col("_r_" + since))
    return links.join(r, cond, "left_anti")


def attach_category(df: DataFrame, categories: DataFrame, on: str = "category_no") -> DataFrame:
    """Page -> category (the seed table's size in bytes decides the kind of join)."""
    return df.join(categories.select(on, "category"), on)


def linked_pairs(pages: DataFrame) -> DataFrame:
    """``(u, v)``: which url links to which, for every landed page.  Narrow: pages are parsed
    where they are, and only url pairs travel on."""
    from pagetables.functions.text import resolve_href
    from pagetables.operators.html import extract_anchors
    a = extract_anchors(pages.select("page_id", "url", "html"))
    return a.select(F.col("url").alias("u"), resolve_href("url", "href").alias("v"))


def leading_to_stories(categories: DataFrame, pairs: DataFrame, stories: DataFrame,
                       home: str = "key", url: str = "url") -> DataFrame:
    """the categories that their home page really links to and that link to a story page.

    ``pairs``: ``linked_pairs``; ``stories``: (url) of pages that are stories.  Two hops, each
    a semi join on url pairs; a category that leads to no story page is dropped."""
    hop = pairs.select(F.col("u").alias("_u"), F.col("v").alias("_v"))
    out = categories.join(hop, (F.col(home) == F.col("_u")) & (F.col(url) == F.col("_v")), "left_semi")
    told = hop.join(stories.select(F.col("url").alias("_s")), F.col("_v") == F.col("_s"), "left_semi")
    return out.join(told, F.col(url) == F.col("_u"), "left_semi")


def discover_categories(home_anchors: DataFrame, pages: DataFrame, story_prefix,
                        min_links: int = 10) -> DataFrame:
    """F15 (+ F16, F14): categories a home page really links to and that lead to
    listing pages with more than ``min_links`` distinct story links.

    home_anchors: (page_id, url, elem_seq, href, text) of the home page(s);
    story_prefix: a str or Column (over the candidate page's url) that story
    hrefs start with.  Pages are parsed where they are; anchors meet the candidates,
    html does not.  -> (category, url, n_links)
    """
    from pagetables.functions.text import resolve_href
    from pagetables.operators.html import extract_anchors
    cand = home_anchors.select(F.col("text").alias("category"),
                               resolve_href("url", "href").alias("cat_url"))
    cand = valid_urls(cand, pages, "cat_url")
    a = extract_anchors(pages.select("page_id", "url", "html"))
    p = F.lit(story_prefix) if isinstance(story_prefix, str) else story_prefix
    n = (a.filter(F.col("href").startswith(p))
          .groupBy(F.col("url").alias("cat_url"))
          .agg(F.countDistinct("href").alias("n_links"))
          .filter(F.col("n_links") > min_links))
    return cand.join(n, "cat_url").select("category", F.col("cat_url").alias("url"), "n_links")
