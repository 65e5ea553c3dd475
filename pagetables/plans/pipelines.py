"""Composed pipelines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagetables.functions.text import category_prefix, clean_content, py_strip, url_origin, url_suffix
from pagetables.operators import html as H
from pagetables.operators.content import fetch_pages, paragraph_after_title
from pagetables.operators.links import (dedup_first, dedup_last, drop_ignored_titles,
                                        exclude_recent, first_block, leading_to_stories, linked_pairs,
                                        recent_links, union_recent)
from pagetables.plans.paginate import follow_next, follow_numbered, numbered_page_links, walk_chains
from pagetables.session import cut_lineage, sized
from pagetables.sources.writers import STORY_COLUMNS_A, STORY_COLUMNS_B


def _pages_by_id(pages: DataFrame, ids: DataFrame) -> DataFrame:
    """(page_id, html) of the pages in ``ids``: a semi join.  The ids are written
    first, so their size in bytes is known: html stays where it is unless they
    are beyond Spark's own broadcast threshold."""
    return pages.select("page_id", "html").join(sized(ids), "page_id", "left_semi")


def label_links(pages: DataFrame, seeds: DataFrame, ignore=(), label: str = "下一页",
                recent_marker: str = "最新发布", suffix_overrides: dict | None = None,
                url_base: str | None = None, recent_from: str = "first") -> DataFrame:
    """Q1 up to the de-duplicated title table: (title, url, category, first_ord).

    ``recent_from``: 'first' reads the recent block on page 1 of the categories
    in turn until one has links, and keeps its titles off the later pages of
    that category and of those after it (the reference's behaviour); 'each'
    reads every category's block and applies it to that category only.
    """
    if recent_from not in ("first", "each"):
        raise ValueError("recent_from is 'first' or 'each'")
    # one extraction serves the walk and the titles; anchor rows, not html, meet the walk, and only
    # those that either reads: next links and links from the site's root
    anchors = H.extract_anchors(pages.select("page_id", "url", "html"))
    anchors = sized(anchors.filter((py_strip("text") == label) | F.col("href").startswith("/")))
    chain = sized(follow_next(pages, seeds, label, anchors=anchors))
    cat = seeds.select("category_no", "category", F.col("url").alias("seed_url"))
    cat = cat.withColumn("prefix", F.concat(
        F.lit("/"), category_prefix("seed_url", "category", suffix_overrides), F.lit("/")))
    cat = cat.withColumn("suffix", category_prefix("seed_url", "category", suffix_overrides))
    base = F.lit(url_base) if url_base else F.concat(url_origin("seed_url"), F.lit("/"))
    a = anchors.drop("url").join(chain.select("page_id", "category_no", "page_no"), "page_id")
    a = a.join(cat, "category_no")
    a = a.filter(F.col("href").startswith(F.col("prefix")))
    a = a.withColumn("title", F.col("text"))
    a = drop_ignored_titles(a, list(ignore))
    a = a.withColumn("url", F.concat(base, F.substring("href", 2, 1 << 30)))
    page_links = a.select("title", "url", "category", "category_no", "page_no", "elem_seq")

    # the recent block on page 1 of each category: one page per category at most, of a size known in bytes
    p1 = chain.filter(F.col("page_no") == 1).select("page_id", "category_no")
    p1_pages = pages.join(sized(p1), "page_id").select("page_id", "html", "category_no")
    el = H.shred_elements(p1_pages, tags=["span", "a"])
    rec = H.anchors_after_marker(el, "span", recent_marker, ".html")
    rec = rec.join(p1, "page_id").join(cat, "category_no")
    rec = recent_links(rec, F.col("suffix")).withColumn("title", py_strip("text"))
    rec = drop_ignored_titles(rec, list(ignore))
    rec = rec.select("title", F.concat(base, F.substring("href", 2, 1 << 30)).alias("url"),
                     "category", "category_no", F.lit(1).alias("page_no"), "elem_seq")
    if recent_from == "first":
        rec = first_block(sized(rec))
        links = exclude_recent(union_recent(page_links, rec), rec.select("category_no", "title"), since="category_no")
    else:
        links = union_recent(page_links, rec)
        links = exclude_recent(links, rec.select("category_no", "title"), by=["category_no"])
    return dedup_last(links, "title", values=("url", "category"))


def story_table_by_label(pages: DataFrame, seeds: DataFrame, ignore=(), **kw) -> DataFrame:
    """Q1: S3 -> I1 -> H2 -> F1, F4 -> U2, J2 -> A2 -> J1 -> H4 -> F19 -> K1 columns.

    -> (name, url, category, content); content is NULL for a story page
    that is not landed or has no ``div.content``.
    """
    titles = sized(label_links(pages, seeds, ignore, **kw))
    fetched = fetch_pages(titles, pages, "url", cols=("page_id",))
    story_pages = _pages_by_id(pages, fetched.filter("fetched").select("page_id"))
    content = H.first_by_class(H.page_elements(story_pages, only=["div.content"]), "div", "content")
    out = fetched.join(content, "page_id", "left")
    return out.select(F.col("title").alias(STORY_COLUMNS_A[0]), "url", "category",
                      clean_content("text").alias("content"))


def number_links(pages: DataFrame, seeds: DataFrame, ignore=(), max_pages: int | None = None,
                 site_prefix: str = "/news/") -> DataFrame:
    """Q2 up to the first-wins title table: (title, url, category, first_ord)."""
    every = cut_lineage(numbered_page_links(pages, seeds, ignore, site_prefix))
    walked = cut_lineage(follow_numbered(pages, seeds, ignore, max_pages, site_prefix, links=every))
    links = every.filter(~F.col("is_index"))
    w = walked.select("url", "category_no", "category", "page_no",
                      url_suffix(F.col("url")).alias("_s"))
    sfx = seeds.select("category_no", url_suffix("url").alias("suffix"))
    got = (links.join(w.drop("_s"), "url").join(sfx, ["category_no", "suffix"])
                .select("title", F.col("link_url").alias("url"), "category", "category_no",
                        "page_no", "elem_seq"))
    return dedup_first(got, "title", order=("category_no", "page_no", "elem_seq"),
                       values=("url", "category"))


def story_table_by_number(pages: DataFrame, seeds: DataFrame, ignore=(), max_pages: int | None = None,
                          site_prefix: str = "/news/") -> DataFrame:
    """Q2: S3 -> I2 -> H2 -> F4, F6, F5 -> A1 -> J1 -> J4 -> K2 columns.

    -> (title, text, category, story_url); stories whose title is on no
    paragraph give no row (F24 reports them).
    """
    titles = number_links(pages, seeds, ignore, max_pages, site_prefix)
    fetched = sized(fetch_pages(titles, pages, "url", cols=("page_id",)).filter("fetched"))
    story_pages = _pages_by_id(pages, fetched.select("page_id"))
    paras = H.page_elements(story_pages, tags=["p"])
    found = paragraph_after_title(fetched.select("title", "url", "category", "page_id"), paras)
    return found.select("title", "text", "category", F.col("url").alias(STORY_COLUMNS_B[3]))


def listing_walk(titles: DataFrame, full: DataFrame, seeds: DataFrame, pairs: DataFrame | None = None) -> DataFrame:
    """F18 + N6 + I3: which answers a crawl reads, category by category.

    titles, full: (key, rows, next_page), the answers about a listing page's links and about
    its whole text; seeds: (url).  A walk stands on (page, mode).  An answer about links
    without any title sends it to the same page's whole text, and from there on it asks for
    whole texts only (the switch is per category, so categories are walked side by side).
    It follows the next page its answer names, if that has an answer; with ``pairs`` (u, v),
    only where the page really links there (F17).  Pointer doubling over the product of
    pages and modes.  -> (seed, page_no, mode, key)
    """
    def node(mode, url):
        return F.concat(F.lit(mode + " "), url)
    both = titles.withColumn("mode", F.lit("links")).unionByName(full.withColumn("mode", F.lit("full")))
    empty = (F.col("mode") == "links") & (F.size("rows") == 0)
    step = both.filter(~empty).select("mode", F.col("key").alias("a"), py_strip("next_page").alias("b")).filter("b <> ''").distinct()
    if pairs is not None:
        step = step.join(pairs, (F.col("a") == F.col("u")) & (F.col("b") == F.col("v")), "left_semi")
    again = both.filter(empty).select(node("links", F.col("key")).alias("u"), node("full", F.col("key")).alias("v")).distinct()
    edges = step.select(F.concat_ws(" ", "mode", "a").alias("u"), F.concat_ws(" ", "mode", "b").alias("v")).unionByName(again)
    asked = both.select(F.concat_ws(" ", "mode", "key").alias("url"), F.lit(0).cast("long").alias("page_id")).distinct()
    starts = seeds.select(F.col("url").alias("seed"), node("links", F.col("url")).alias("url"))
    on = asked.select(F.col("url").alias("_on"))
    edges = edges.join(on, F.col("v") == F.col("_on"), "left_semi")
    walked = walk_chains(starts, edges, asked, key="seed")
    return walked.select("seed", "page_no", F.substring_index("url", " ", 1).alias("mode"),
                         F.expr("substr(url, instr(url, ' ') + 1)").alias("key"))


def story_table_from_answers(completions: DataFrame, pages: DataFrame | None = None,
                             checked_categories: bool = False) -> DataFrame:
    """Q3: F15/X2a -> F14/X2b -> X2c, F18 -> I3 -> A2 -> X2d -> X4 -> K3 columns.

    completions: (key, kind, content), kinds categories / decision / titles / titles_full /
    story; ``titles`` answers a listing page's links, ``titles_full`` its whole text, which is
    read where the former names no title, and on all pages after (``listing_walk``).
    Listings are followed along the ``next_page`` that their answers name, to pages that have
    an answer.  With ``pages`` (page_id, url, html) given, a next page counts only where the
    page really links there (F17), and with ``checked_categories`` a category only if its home
    page links to it and it links to a page with a good story answer (F15).  Of several answers of one kind for a url
    the smallest content counts.  Order: category url, page, then the answer's order.
    """
    from pagetables.operators import answers as X
    c = X.one_answer_each(completions)      # written: each kind is read on its own
    cats = X.parse_categories(c.filter(F.col("kind") == "categories"))
    dec = X.parse_decision(c.filter(F.col("kind") == "decision")).filter("decision")
    ok = cats.join(dec.select(F.col("key").alias("url")), "url", "left_semi")
    stories = X.parse_story(c.filter(F.col("kind") == "story"))
    pairs = None
    if pages is not None:
        pairs = sized(linked_pairs(pages))
    if checked_categories:
        ok = leading_to_stories(ok, pairs, stories.filter("status = 'ok'").select(F.col("key").alias("url")))
    ok = sized(ok)
    # parsed once: read by every step of the walk
    titles = sized(X.parse_listing(c.filter(F.col("kind") == "titles")))
    full = sized(X.parse_listing(c.filter(F.col("kind") == "titles_full")))
    walked = listing_walk(titles, full, ok.select("url").distinct(), pairs)
    listing = walked.join(ok.select(F.col("url").alias("seed"), "category"), "seed")
    answers = titles.withColumn("mode", F.lit("links")).unionByName(full.withColumn("mode", F.lit("full")))
    links = answers.join(listing, ["key", "mode"]).select("seed", "page_no", "category", F.posexplode("rows").alias("pos", "r"))
    links = links.select("seed", "page_no", "category", "pos", py_strip("r.url").alias("url"), py_strip("r.title").alias("title"))
    deduped = dedup_last(links, "title", order=("seed", "page_no", "pos"), values=("url", "category"))
    # of a known size: contents that no title leads to stay where they lie if the urls are small
    deduped = sized(deduped.select("title", "url", "category"))
    stories = stories.join(deduped.select(F.col("url").alias("key")), "key", "left_semi")
    return X.assemble_stories(deduped, stories)
