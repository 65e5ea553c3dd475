"""Walking listing pages.

The crawlers fetch page after page.  Here every landed page is already a
row, so a walk is a graph computation over ``edges(url -> next_url)``,
with all categories advancing together.

``walk_chains`` uses pointer doubling: after round k every walk knows its
first 2^k pages, so a 1,000-page chain costs about 11 rounds of joins
instead of 1,000.  Each round is checkpointed to the shared checkpoint
folder (the plan of round k would otherwise hold 2^k copies of the edge
table, and a lost executor would recompute everything).  A walk stops at
the end of its chain, at a page that is not landed, or at the first page it
has already visited (the reference has no such check and loops forever).

``walk_chains_recursive`` is the plain form (Spark's ``WITH RECURSIVE``),
kept to cross-check the doubling.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagetables.functions.text import (is_digits, py_strip, resolve_href,
                                       url_origin)
from pagetables.operators.html import extract_anchors, page_anchors
from pagetables.operators.links import next_page_link, through_index
from pagetables.session import cut_lineage, sized


# Fixed value: the recursion level that stands for none.
NO_LIMIT = 1_000_000


def _landed(df: DataFrame, pages: DataFrame, col: str) -> DataFrame:
    """Rows whose ``col`` is a landed page url (a semi join needs no distinct)."""
    live = pages.select(F.col("url").alias("_live"))
    return df.join(live, F.col(col) == F.col("_live"), "left_semi")


def _with_page_id(df: DataFrame, pages: DataFrame, keys) -> DataFrame:
    """Attach page_id by url; a url landed twice keeps its smallest page_id.

    The dedup runs on the (small) joined result, not on the page table."""
    j = df.join(pages.select("url", "page_id"), "url")
    return j.groupBy(*keys, "url").agg(F.min("page_id").alias("page_id"))


def label_edges(pages: DataFrame, label: str = "下一页", anchors: DataFrame | None = None) -> DataFrame:
    """I1's edges: the first link labelled ``label`` on each page, resolved
    against the page url, kept only when it leads to a landed page.

    ``anchors``: the pages' anchors (page_id, url, elem_seq, href, text), if
    they are at hand; the label is sought in the parsed text, so markup or
    references inside it do not hide it."""
    a = extract_anchors(pages.select("page_id", "url", "html")) if anchors is None else anchors
    nxt = next_page_link(a, label, part=("page_id", "url"))
    e = nxt.select(F.col("url").alias("u"), resolve_href("url", "next_href").alias("v"),
                   "page_id")
    return _landed(e, pages, "v")


def _one_edge_per_page(edges: DataFrame) -> DataFrame:
    """At most one successor per url: a url landed twice follows its smallest page_id."""
    if "page_id" in edges.columns:
        return edges.groupBy("u").agg(F.min_by("v", "page_id").alias("v"))
    return edges.groupBy("u").agg(F.min("v").alias("v"))


def walk_chains(seeds: DataFrame, edges: DataFrame, pages: DataFrame,
                max_pages: int | None = None, key: str = "category_no") -> DataFrame:
    """Pointer-doubling walk.

    seeds: (key, url) - page 1 of each walk; edges: (u, v), at most one per u.
    Returns (key, page_no, url, page_id) for every page visited, page_no from 1.
    """
    r = _landed(seeds.select(key, F.col("url").alias("node")), pages, "node") \
        .withColumn("d", F.lit(0).cast("long"))
    r = cut_lineage(r)
    # a walk stands only on seeds and on pages that some page leads to
    j = _one_edge_per_page(edges)
    stood = r.select(F.col("node").alias("_n")).union(j.select(F.col("v").alias("_n")))
    j = cut_lineage(j.join(stood, F.col("u") == F.col("_n"), "left_semi"))
    step = 1
    while True:
        cand = (r.join(j, F.col("node") == F.col("u"))
                 .select(key, F.col("v").alias("node"), (F.col("d") + step).alias("d")))
        if max_pages is not None:
            cand = cand.filter(F.col("d") < max_pages)
        cand = cand.groupBy(key, "node").agg(F.min("d").alias("d"))
        new = cand.join(r.select(key, "node"), [key, "node"], "left_anti")
        if max_pages is not None and 2 * step >= max_pages:
            new = cut_lineage(new)
            r = r.unionByName(new)
            break
        # J_{k+1}(u) = J_k(J_k(u)), written in one job with the pages reached; a page further on
        # than this round reaches is 2**k pages after another, so other jumps are not needed again
        hop = j.alias("a").join(j.alias("b"), F.col("a.v") == F.col("b.u")) \
               .select(F.col("a.u").alias("u"), F.col("b.v").alias("v"))
        wanted = r.select(F.col("node").alias("_n")).union(j.select(F.col("v").alias("_n")))
        hop = hop.join(wanted, F.col("u") == F.col("_n"), "left_semi")
        kind = seeds.schema[key].dataType
        both = cut_lineage(new.select(key, "node", "d", F.lit(None).cast("string").alias("to")).unionByName(
            hop.select(F.lit(None).cast(kind).alias(key), F.col("u").alias("node"), F.lit(None).cast("long").alias("d"),
                       F.col("v").alias("to"))))
        new = both.filter("d is not null").drop("to")
        if new.isEmpty():
            break
        # r stays a union of checkpointed pieces: its plan grows by one leaf per round
        r = r.unionByName(new)
        j = both.filter("d is null").select(F.col("node").alias("u"), F.col("to").alias("v"))
        step *= 2
    out = _with_page_id(r.withColumnRenamed("node", "url"), pages, [key, "d"])
    return out.select(key, (F.col("d") + 1).cast("int").alias("page_no"), "url", "page_id")


def walk_chains_recursive(seeds: DataFrame, edges: DataFrame, pages: DataFrame,
                          max_pages: int | None = None, key: str = "category_no") -> DataFrame:
    """The same walk as a recursive CTE (one join per page; for cross-checks).

    Seeds and edges are written first: each level of the recursion runs its join anew, and
    would read every page for its links again."""
    spark = seeds.sparkSession
    level = NO_LIMIT if max_pages is None else max_pages
    # Spark refuses a recursion of more rows than this in all; a walk has a row for each page
    spark.conf.set("spark.sql.cteRecursionRowLimit", "-1")
    sized(_landed(seeds.select(key, F.col("url").alias("node")), pages, "node")) \
        .createOrReplaceTempView("_pt_seeds")
    sized(_one_edge_per_page(edges)).createOrReplaceTempView("_pt_edges")
    pages.select("url", "page_id").createOrReplaceTempView("_pt_pages")
    out = spark.sql(f"""
      WITH RECURSIVE w({key}, node, d, seen) MAX RECURSION LEVEL {level + 1} AS (
        SELECT {key}, node, 0L, array(node) FROM _pt_seeds
        UNION ALL
        SELECT w.{key}, e.v, w.d + 1, concat(w.seen, array(e.v))
        FROM w JOIN _pt_edges e ON w.node = e.u
        WHERE NOT array_contains(w.seen, e.v) AND w.d + 1 < {level}
      )
      SELECT w.{key}, CAST(w.d + 1 AS INT) AS page_no, w.node AS url, min(p.page_id) AS page_id
      FROM w JOIN _pt_pages p ON p.url = w.node
      GROUP BY w.{key}, w.d, w.node
    """)
    return out


def follow_next(pages: DataFrame, seeds: DataFrame, label: str = "下一页",
                max_pages: int | None = None, method: str = "doubling",
                anchors: DataFrame | None = None) -> DataFrame:
    """Follow the labelled next link from each category seed.

    seeds: (category_no, category, url).  -> (category_no, category, page_no, url, page_id).
    """
    edges = label_edges(pages, label, anchors)
    s = seeds.select("category_no", "url")
    if method == "recursive":
        w = walk_chains_recursive(s, edges, pages, max_pages)
    else:
        w = walk_chains(s, edges, pages, max_pages)
    return w.join(seeds.select("category_no", "category"), "category_no")


def follow_validated(pages: DataFrame, seeds: DataFrame, answers: DataFrame,
                     max_pages: int | None = None) -> DataFrame:
    """Follow the next page an answer names, only if the page really links to it.

    answers: (url, next_page) - one parsed answer per listing page (X2c).
    """
    asked = pages.select("page_id", "url", "html").join(
        answers.select(F.col("url").alias("_au")), F.col("url") == F.col("_au"), "left_semi")
    a = extract_anchors(asked)
    held = a.select(F.col("url").alias("_u"), resolve_href("url", "href").alias("_v"))
    cand = answers.select(F.col("url").alias("u"), py_strip("next_page").alias("v")) \
                  .filter(F.col("v") != "")
    valid = cand.join(held, (F.col("u") == F.col("_u")) & (F.col("v") == F.col("_v")),
                      "left_semi")
    edges = _landed(valid, pages, "v")
    w = walk_chains(seeds.select("category_no", "url"), edges, pages, max_pages)
    return w.join(seeds.select("category_no", "category"), "category_no")


# ---------------------------------------------------------------------------
# Numbered pages with a growing first-wins index

def numbered_page_links(pages: DataFrame, seeds: DataFrame, ignore=(),
                        site_prefix: str = "/news/", anchors: DataFrame | None = None) -> DataFrame:
    """Links of every landed page, read the way the numbered crawl reads them.

    Per category: links under ``{site_prefix}{suffix}/``, stop list applied,
    reading stops after the first story that follows the index run (F6),
    page numbers split from stories (F5).  The page-to-category relation is
    the href prefix, so this is computed once for all pages, before any walk;
    a page's links stay one array until they are read: no shuffle.
    ``anchors``: ``page_anchors`` of the pages, if at hand.
    -> (url, suffix, elem_seq, title, link_url, is_index)
    """
    a = page_anchors(pages.select("page_id", "url", "html")) if anchors is None else anchors
    pattern = "^" + site_prefix + "([^/]+)/"
    stop = list(ignore)
    links = F.filter(F.transform("anchors", lambda x: F.struct(
        x["elem_seq"].alias("elem_seq"), x["href"].alias("href"), x["text"].alias("title"),
        F.regexp_extract(x["href"], pattern, 1).alias("suffix"))),
        lambda x: (x["suffix"] != "") & (x["title"].isNull() | ~x["title"].isin(stop)))
    a = a.select("url", links.alias("links"))
    a = a.select("url", "links", F.explode(F.array_distinct(F.transform("links", lambda x: x["suffix"]))).alias("suffix"))
    read = through_index(F.filter("links", lambda x: x["suffix"] == F.col("suffix")))
    a = a.select("url", F.inline(read))
    return a.select("url", "suffix", "elem_seq", "title",
                    F.concat(url_origin("url"), F.col("href")).alias("link_url"),
                    is_digits("title").alias("is_index"))


def follow_numbered_stepwise(pages: DataFrame, seeds: DataFrame, ignore=(), max_pages: int | None = None,
                             site_prefix: str = "/news/", checkpoint_every: int = 8
                             ) -> DataFrame:
    """I2 the plain way: page n+1 is the url first listed under number n+1 on a
    page already read; one round per page number (kept to cross-check).

    All categories advance together, one round per page number.  The
    per-page link table is built once (JVM regex) and checkpointed; a round
    joins the current frontier (one row per live category) to it.
    seeds: (category_no, category, url).  -> (category_no, category, page_no, url, page_id)
    """
    from pagetables.functions.text import url_suffix
    links = cut_lineage(numbered_page_links(pages, seeds, ignore, site_prefix)
                        .filter("is_index"))
    cats = seeds.select("category_no", "category", "url",
                        url_suffix("url").alias("suffix"))
    live = pages.select(F.col("url").alias("_live"))
    front = cats.join(live, F.col("url") == F.col("_live"), "left_semi") \
                .select("category_no", "suffix", "url", F.lit(1).alias("page_no"))
    visited = cut_lineage(front)
    cats_b = cats.select("category_no", "suffix")
    index = None
    n = 1
    while max_pages is None or n < max_pages:
        # index entries listed on the pages reached in this round
        got = (links.join(front.select("url", "suffix", "page_no", "category_no"), ["url", "suffix"])
                    .select("category_no", F.col("title").alias("number"),
                            "link_url", F.col("page_no").alias("listed_on"), "elem_seq"))
        index = got if index is None else index.unionByName(got)
        if n % checkpoint_every == 0:
            index = cut_lineage(index)
        want = n + 1
        # only walks still going: a walk ends at its first missing number
        nxt = (index.filter(F.col("number") == str(want))
                    .join(front.select("category_no"), "category_no", "left_semi")
                    .groupBy("category_no")
                    .agg(F.min_by("link_url", F.struct("listed_on", "elem_seq")).alias("url")))
        nxt = nxt.join(live, F.col("url") == F.col("_live"), "left_semi")
        front = cut_lineage(nxt.join(cats_b,
                                     "category_no")
                               .select("category_no", "suffix", "url",
                                       F.lit(want).alias("page_no")))
        if front.isEmpty():
            break
        visited = visited.unionByName(front)
        n = want
    return (_with_page_id(visited.select("category_no", "page_no", "url"), pages,
                          ["category_no", "page_no"])
                   .join(seeds.select("category_no", "category"), "category_no")
                   .select("category_no", "category", "page_no", "url", "page_id"))


# Page numbers in a block of a walk (see _walk_prefix).
PAGE_BLOCK = 256


def _walk_prefix(cands: DataFrame, live: DataFrame) -> DataFrame:
    """Keep landed pages 1..K of each walk, K + 1 being its first missing number.

    No task holds a category: page numbers lie in blocks of ``PAGE_BLOCK``, a block is one row
    (its pages, at most one a number, up to its first missing number), and a complete block
    tells the next that it may go on.  A walk's first block that is not complete is an
    aggregate over blocks; later blocks are dropped."""
    c = cands.join(live, F.col("url") == F.col("_live"), "left_semi")
    b = c.groupBy("category_no", F.floor((F.col("page_no") - 1) / PAGE_BLOCK).alias("_b")).agg(
        F.array_sort(F.collect_list(F.struct("page_no", "url"))).alias("_ps"))
    # in a block without a gap the page in place i has number first + i
    b = b.withColumn("_ps", F.filter("_ps", lambda p, i: p["page_no"] == F.col("_b") * PAGE_BLOCK + 1 + i)) \
         .filter(F.size("_ps") > 0)
    b = cut_lineage(b)
    full = b.filter(F.size("_ps") == PAGE_BLOCK).select("category_no", (F.col("_b") + 1).alias("_b"))
    # the first block that a complete one promises and that is not complete itself, 0 if the first is not
    ends = full.join(full.select("category_no", (F.col("_b") - 1).alias("_b")), ["category_no", "_b"], "left_anti")
    last = ends.groupBy("category_no").agg(F.min("_b").alias("_end"))
    first_full = full.filter("_b = 1").select("category_no", F.lit(True).alias("_on"))
    last = last.join(first_full, "category_no", "left_semi")
    kept = b.join(last, "category_no", "left").filter(F.col("_b") <= F.coalesce("_end", F.lit(0)))
    return kept.select("category_no", F.inline("_ps")).select("category_no", "page_no", "url")


def follow_numbered(pages: DataFrame, seeds: DataFrame, ignore=(), max_pages: int | None = None,
                    site_prefix: str = "/news/", max_rounds: int | None = None,
                    links: DataFrame | None = None) -> DataFrame:
    """Page n+1 is the url first listed under number n+1 on a page already read;
    the walk ends at the first number not listed, or after ``max_pages`` pages if given.

    Solved as a fixpoint over whole walks instead of one round per page:
    start from a guess (any url a page of the category lists for each
    number), then repeat: read the index entries of the pages of the
    current walks, take for each number m the entry of the earliest page
    before m (first wins), cut each walk at its first gap.  The equations
    have one solution (page n depends only on pages < n), so the first
    repeat is the exact walk; each round fixes at least one more page, and
    when a site's numbering is consistent the guess is already right: two
    rounds whatever the length.  Each round is a few joins, checkpointed, and
    one count of the rows that changed.  ``links``: the result of
    ``numbered_page_links``, if it is at hand.
    seeds: (category_no, category, url).  -> (category_no, category, page_no, url, page_id)
    """
    from pagetables.functions.text import url_suffix
    if links is None:
        links = numbered_page_links(pages, seeds, ignore, site_prefix)
    links = links.filter("is_index")
    num = F.col("title").try_cast("int")
    links = cut_lineage(
        links.filter(num.isNotNull() & (num.cast("string") == F.col("title")))
             .select("url", "suffix", "elem_seq", num.alias("m"), "link_url"))
    cats = seeds.select("category_no", url_suffix("url").alias("suffix"))
    live = pages.select(F.col("url").alias("_live"))
    seed_rows = seeds.select("category_no", F.lit(1).alias("page_no"), "url")
    bounded = (F.col("m") >= 2) & (F.lit(True) if max_pages is None else F.col("m") <= max_pages)
    guess = (links.filter(bounded).join(cats, "suffix")
                  .groupBy("category_no", F.col("m").alias("page_no"))
                  .agg(F.min("link_url").alias("url")))
    cur = cut_lineage(_walk_prefix(seed_rows.unionByName(guess), live))
    rounds = 0
    while max_rounds is None or rounds < max_rounds:
        rounds += 1
        ent = (cur.join(cats, "category_no")
                  .join(links, ["url", "suffix"])
                  .filter(bounded & (F.col("page_no") < F.col("m"))))
        nxt = (ent.groupBy("category_no", F.col("m").alias("page_no"))
                  .agg(F.min_by("link_url", F.struct("page_no", "elem_seq")).alias("url")))
        new = cut_lineage(_walk_prefix(seed_rows.unionByName(nxt), live))
        both = new.unionByName(cur).groupBy("category_no", "page_no", "url").count()
        if both.filter("count = 1").isEmpty():
            break
        cur = new
    return (_with_page_id(cur, pages, ["category_no", "page_no"])
               .join(seeds.select("category_no", "category"), "category_no")
               .select("category_no", "category", "page_no", "url", "page_id"))


def page_index(pages: DataFrame, walked: DataFrame, ignore=(),
               site_prefix: str = "/news/", links: DataFrame | None = None) -> DataFrame:
    """A3: the first-wins map number -> url of each category, over the pages walked."""
    from pagetables.operators.links import page_index as first_wins_index
    if links is None:
        links = numbered_page_links(pages, walked, ignore, site_prefix)
    links = links.filter("is_index")
    w = walked.select("category_no", "url", "page_no")
    entries = (links.join(w, "url")
                    .select("category_no", F.col("title").alias("number"),
                            F.col("link_url").alias("url"), "page_no", "elem_seq"))
    return first_wins_index(entries)
