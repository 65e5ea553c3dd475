"""Pages to tables.

Two ways in:

* ``extract_anchors`` (H2) is pure JVM: one regex pass per page, no Python,
  no shuffle.  It is the fast path whenever only links are needed.
* ``page_spans`` (H1) runs the stdlib ``html.parser`` inside ``mapInArrow``
  and emits one row per page: the page's text once, and its elements in
  document order, each with its range of that text.  So a page leaves the
  worker about as long as it came, however its elements nest; the text of an
  element is cut on the JVM, for the elements that are asked for.  The parse
  is tolerant of bad markup (unclosed ``<p>``, ``</p>`` inside scripts,
  truncated pages) the way a tree builder is: a start tag opens an element,
  an end tag closes the most recent open element of that name (and everything
  opened after it), unmatched end tags are ignored, and whatever is open at
  the end of input is closed there.  Text of an element is the text of all its
  descendants, script/style/template contents and comments excluded.

Everything after H1/H2 (titles, paragraphs, main text, snapshots) is Spark
expressions over these rows.
"""

from __future__ import annotations

import bisect
from html.parser import HTMLParser

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagetables.functions.text import (collapse_space, py_strip, resolve_href,
                                       strip_tags, unescape_entities)

# ---------------------------------------------------------------------------
# Fixed values
#
# Removed before any regex extraction: scripts, styles and comments.
STRIP_RE = r"(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>|<!--.*?-->"
# The same with the "<" before the choice: only there are the three tried.
STRIP_FROM_RE = r"(?is)<(?:script\b.*?</script\s*>|style\b.*?</style\s*>|!--.*?-->)"
# Start and end tags of anchors; quoted attribute values are skipped whole, so
# a ">" inside one does not end the tag.  Possessive throughout: linear time,
# and no recursion however long a tag is.
ANCHOR_TAG_RE = r"(?is)<(?:a(?=[\s/>])(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>|/a\s*+>)"
# The href of a start tag, after any other attributes.
HREF_RE = (r"(?is)^<a(?:[\s/]++(?!href\s*+=)[^\s=>\"'/]*+(?:\s*+=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s\"'>]++))?+)*+"
           r"[\s/]*+href\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s\"'>]++))")
# Elements without an end tag.
VOID_TAGS = frozenset(["area", "base", "br", "col", "embed", "hr", "img", "input",
                       "link", "meta", "param", "source", "track", "wbr"])
# Elements whose contents are not text.
NON_TEXT_TAGS = frozenset(["script", "style", "template", "noscript"])
# Block elements: a line break in the rendered snapshot.
BLOCK_TAGS = frozenset(["address", "article", "aside", "blockquote", "br", "dd", "div",
                        "dl", "dt", "fieldset", "figcaption", "figure", "footer",
                        "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr",
                        "li", "main", "nav", "ol", "p", "pre", "section", "table",
                        "tr", "ul", "title"])
# Site furniture removed from snapshots by default (class selectors).
FURNITURE_SELECTORS = [
    ".ads", ".ad", ".advertisement", ".sponsored", ".promo", ".banner-ad", ".google-ad",
    ".ad-container",
    ".sidebar", ".widget", ".widget-container", ".sidebar-content", ".related-posts",
    ".recommendations", ".tag-cloud", ".sidebar-widget", ".right-sidebar", ".left-sidebar",
    ".modal", ".popup", ".overlay", ".pop-up", ".cookie-banner", ".consent-banner", ".alert",
    ".social", ".share", ".share-buttons", ".follow-us", ".social-links", ".social-widget",
    ".social-icons",
    ".search", ".search-bar", ".search-box", ".contact-form", ".newsletter", ".subscribe",
    ".logo", ".branding", ".terms", ".privacy-policy", ".faq", ".site-map",
]
# Page regions that are not main text.
NON_MAIN_TAGS = ["nav", "header", "footer", "aside", "form"]
# Snapshot layout.
LINKS_HEADER = "Links/Buttons:"
IMAGES_HEADER = "Images:"
# Bytes of html that a worker parses before it hands on what it made.
SLICE_BYTES = 1 << 18
# ---------------------------------------------------------------------------

_MAP = pa.map_(pa.string(), pa.string())


# ---------------------------------------------------------------------------
# Simple selectors: "tag", ".class", "#id", "tag.class" (what the crawlers use)

def _parse_selector(sel: str):
    sel = sel.strip()
    tag, ident, classes = None, None, []
    buf, kind = "", "tag"
    for ch in sel + "\0":
        if ch in ".#\0":
            if buf:
                if kind == "tag":
                    tag = buf.lower()
                elif kind == "class":
                    classes.append(buf)
                else:
                    ident = buf
            buf, kind = "", ("class" if ch == "." else "id")
        else:
            buf += ch
    return tag, ident, tuple(classes)


def _matches(parsed, tag: str, attrs: dict) -> bool:
    ptag, pid, pcls = parsed
    if ptag and ptag != tag:
        return False
    if pid and attrs.get("id") != pid:
        return False
    if pcls:
        have = set((attrs.get("class") or "").split())
        if not all(c in have for c in pcls):
            return False
    return True


class _Selectors:
    """A list of simple selectors, indexed: single-class selectors (the usual
    furniture list) are one set intersection per element."""

    def __init__(self, selectors):
        parsed = [_parse_selector(x) for x in selectors]
        self.classes = frozenset(p[2][0] for p in parsed
                                 if p[0] is None and p[1] is None and len(p[2]) == 1)
        self.others = [p for p in parsed
                       if not (p[0] is None and p[1] is None and len(p[2]) == 1)]
        self.empty = not parsed

    def __bool__(self):
        return not self.empty

    def match(self, tag: str, attrs: dict) -> bool:
        if self.empty:
            return False
        if self.classes:
            cls = attrs.get("class")
            if cls and not self.classes.isdisjoint(cls.split()):
                return True
        return any(_matches(p, tag, attrs) for p in self.others)


class _Shredder(HTMLParser):
    """Tree builder over stdlib html.parser, for one page."""

    def __init__(self, keep_tags=None, exclude=(), target=(), only=(), title_apart=False):
        super().__init__(convert_charrefs=True)
        self.keep_tags = keep_tags
        self.only = _Selectors(only)
        self.exclude = _Selectors(exclude)
        self.target = _Selectors(target)
        self.title_apart = title_apart
        self.rows = []          # (seq, parent, depth, outer, last, tag, attrs, start, stop)
        self.stack = []         # [seq, tag, attrs, start, excluded, targeted, outer]
        self.chunks = []        # the page's text, in UTF-8
        self.size = 0
        self.title = []
        self.seq = 0
        self.excluded_depth = 0
        self.target_depth = 0
        self.open_by_tag = {}   # tag -> seqs of its open elements, outermost first

    def _open(self, tag, attrs, void):
        attrs = {k: (v if v is not None else "") for k, v in attrs}
        excluded = self.exclude.match(tag, attrs)
        targeted = self.target.match(tag, attrs)
        seq = self.seq
        self.seq += 1
        # outermost open element with the same tag (-1: not nested in one)
        same = self.open_by_tag.get(tag)
        outer = same[0] if same else -1
        self.excluded_depth += excluded
        self.target_depth += targeted
        self.stack.append([seq, tag, attrs, self.size, excluded, targeted, outer])
        self.open_by_tag.setdefault(tag, []).append(seq)
        if void:
            self._close_top()

    def _close_top(self):
        seq, tag, attrs, start, excluded, targeted, outer = self.stack.pop()
        self.open_by_tag[tag].pop()
        parent = self.stack[-1][0] if self.stack else -1
        shown = not self.excluded_depth and (not self.title_apart or not self.target or self.target_depth)
        if shown and (self.keep_tags is None or tag in self.keep_tags) and (not self.only or self.only.match(tag, attrs)):
            self.rows.append((seq, parent, len(self.stack), outer, self.seq - 1, tag, attrs, start, self.size))
        self.excluded_depth -= excluded
        self.target_depth -= targeted

    def handle_starttag(self, tag, attrs):
        self._open(tag, attrs, tag in VOID_TAGS)

    def handle_startendtag(self, tag, attrs):
        self._open(tag, attrs, True)

    def handle_endtag(self, tag):
        same = self.open_by_tag.get(tag)
        if not same:
            return                      # nothing of that name is open: ignored
        i = bisect.bisect_left(self.stack, same[-1], key=lambda e: e[0])
        while len(self.stack) > i:
            self._close_top()

    def handle_data(self, data):
        if self.excluded_depth:
            return
        if self.title_apart and self.open_by_tag.get("title"):
            self.title.append(data)
            return
        if self.stack and self.stack[-1][1] in NON_TEXT_TAGS:
            return
        if self.target and not self.target_depth:
            return
        utf8 = data.encode("utf-8", "replace")
        self.chunks.append(utf8)
        self.size += len(utf8)

    def read(self, html):
        """Elements in document order, and the text that their ranges count bytes of."""
        if html is not None:
            self.feed(html)
        self.close()
        while self.stack:
            self._close_top()
        self.rows.sort(key=lambda r: r[0])
        return self.rows, b"".join(self.chunks)


_FIELDS = ("elem_seq", "parent_seq", "depth", "outer_seq", "last_seq")
ELEMS = ("array<struct<" + ",".join(f"{f}:int" for f in _FIELDS)
         + ",tag:string,attrs:map<string,string>,start:int,stop:int>>")


def _elems_array(pages: list[list]) -> pa.ListArray:
    """The elements of a batch of pages as one column."""
    rows = [r for p in pages for r in p]
    ints = [pa.array([r[k] for r in rows], pa.int32()) for k in (0, 1, 2, 3, 4, 7, 8)]
    attrs = pa.array([list(r[6].items()) for r in rows], _MAP)
    cols = [*ints[:5], pa.array([r[5] for r in rows], pa.string()), attrs, *ints[5:]]
    offsets = [0]
    for p in pages:
        offsets.append(offsets[-1] + len(p))
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()),
                                    pa.StructArray.from_arrays(cols, [*_FIELDS, "tag", "attrs", "start", "stop"]))


def _slices(batch: pa.RecordBatch):
    """The batch in runs of pages of ``SLICE_BYTES`` of html (a longer page alone), without a copy.

    A page's elements take many times its bytes while they are Python objects, and how many
    pages an Arrow batch holds is the session's to say."""
    sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column(batch.num_columns - 1)), 0).to_pylist()
    first = held = 0
    for i, n in enumerate(sizes):
        if i > first and held + n > SLICE_BYTES:
            yield batch.slice(first, i - first)
            first, held = i, 0
        held += n
    if first < len(sizes):
        yield batch.slice(first)


def page_spans(pages: DataFrame, tags=None, exclude=(), target=(), only=(), title_apart: bool = False,
               keep_cols=()) -> DataFrame:
    """H1: ``pages(page_id, html)`` -> one row per page ``(page_id, ..., buffer, title, elems)``.

    ``buffer`` is the page's text in UTF-8, once; ``elems`` are its elements in
    document order, ``start`` and ``stop`` their byte ranges of the buffer (see
    ``cut``), ``last_seq`` the last element inside.  ``tags`` and ``only`` (simple
    selectors) limit which elements are emitted, while parsing; ``exclude`` drops
    whole matching subtrees, also from ancestors' text; ``target`` keeps only
    text inside matching subtrees.  ``title_apart`` takes ``<title>`` text out of the
    buffer (column ``title``) and emits no element outside the targets.  A null or
    empty page has an empty buffer and no elements.  Narrow: no shuffle."""
    keep = None if tags is None else frozenset(t.lower() for t in tags)
    exclude, target, only = tuple(exclude), tuple(target), tuple(only)
    schema = pages.select(F.col("page_id").cast("long"), *keep_cols).schema
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)

    def run(batches):
        for b in (part for batch in batches for part in _slices(batch)):
            elems, texts, titles = [], [], []
            for html in b.column(b.num_columns - 1).to_pylist():
                p = _Shredder(keep, exclude, target, only, title_apart)
                rows, text = p.read(html)
                elems.append(rows)
                texts.append(text)
                titles.append("".join(p.title))
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:-1], pa.array(texts, pa.binary()), pa.array(titles, pa.string()), _elems_array(elems)],
                names=[*b.schema.names[:-1], "buffer", "title", "elems"])
    return pages.select(F.col("page_id").cast("long"), *keep_cols, "html").mapInArrow(
        run, f"{fields}, buffer binary, title string, elems {ELEMS}")


def cut(buffer, elem) -> Column:
    """The text of an element of ``page_spans``."""
    return F.substr(F.col(buffer) if isinstance(buffer, str) else buffer,
                    elem["start"] + 1, elem["stop"] - elem["start"]).cast("string")


def shred_elements(pages: DataFrame, tags=None, exclude=(), target=(),
                   with_text: bool = True) -> DataFrame:
    """H1 as a table, one row per element: ``(page_id, elem_seq, parent_seq, depth, outer_seq,
    tag, attrs, text)``; options as in ``page_spans``.

    An element's text is cut where the row is made, and only if it is used."""
    e = page_spans(pages, tags, exclude, target).select("page_id", "buffer", F.explode("elems").alias("e"))
    text = cut("buffer", F.col("e")) if with_text else F.lit(None).cast("string")
    return e.select("page_id", *[f"e.{f}" for f in _FIELDS if f != "last_seq"], "e.tag", "e.attrs", text.alias("text"))


def page_elements(pages: DataFrame, tags=None, exclude=(), target=(), only=()) -> DataFrame:
    """H1, one row per page: ``(page_id, buffer, elems)``, the elements in document order.

    What follows on one page (first heading, numbered paragraphs, joined text)
    is then array work in the row: nothing is regrouped by page, and text is
    cut for the elements that are kept."""
    return page_spans(pages, tags, exclude, target, only).drop("title")


def of_tag(elems, tag: str, cls: str | None = None) -> Column:
    """A page's elements of one tag (and class), in document order."""
    return F.filter(elems, lambda e: (e["tag"] == tag) & (F.lit(True) if not cls else F.array_contains(
        F.split(F.coalesce(e["attrs"].getItem("class"), F.lit("")), "\\s+"), cls)))


# Fixed value: marks the tags of a page (a control character that html forbids).
_MARK = "\x01"


def _page_anchors(parts: Column) -> Column:
    """Anchors ``(href, text)`` of a page cut at its anchor tags: text, tag, text, tag, ..., text.

    An anchor ends at its end tag; anchors that open inside it belong to its
    text, and one that is never closed runs to the end of the page."""
    n = ((F.size(parts) - 1) / 2).cast("int")

    def tag(i):
        return F.get(parts, 2 * i + 1)

    def after(i):
        return F.get(parts, 2 * i + 2)

    def is_end(i):
        return tag(i).startswith("</")

    def nested(i):
        start = F.struct(F.lit(1).alias("depth"), after(i).alias("text"))

        def step(acc, j):
            depth = acc["depth"] + F.when(is_end(j), -1).otherwise(1)
            return F.when(acc["depth"] == 0, acc).otherwise(F.struct(
                depth.alias("depth"),
                F.when(depth == 0, acc["text"]).otherwise(F.concat(acc["text"], after(j))).alias("text")))
        return F.aggregate(F.sequence(i + 1, n - 1), start, step, lambda acc: acc["text"])

    def anchor(i):
        plain = (i + 1 >= n) | is_end(i + 1)
        href = F.concat(*[F.regexp_extract(tag(i), HREF_RE, g) for g in (1, 2, 3)])
        return F.struct(F.when(tag(i).rlike(HREF_RE), href).alias("href"),
                        F.when(plain, after(i)).otherwise(nested(i)).alias("text"))
    starts = F.filter(F.sequence(F.lit(0), n - 1), lambda i: ~is_end(i))
    return F.when(n > 0, F.filter(F.transform(starts, anchor), lambda a: a["href"].isNotNull()))


def _raw_anchors() -> Column:
    """H2's anchors of a page before references are decoded: array of (href, text)."""
    h = F.replace(F.regexp_replace(F.col("html"), STRIP_FROM_RE, ""), F.lit(_MARK), F.lit(""))
    parts = F.split(F.regexp_replace(h, ANCHOR_TAG_RE, f"{_MARK}$0{_MARK}"), _MARK, -1)
    # bound once: the parts are named many times
    return F.transform(F.array(parts), _page_anchors)[0]


def page_anchors(pages: DataFrame, keep_cols=("url",)) -> DataFrame:
    """H2, one row per page: ``(page_id, ..., anchors)``, an array of ``(elem_seq, href, text)`` in
    document order; what reads a page's links in order is then array work in the row."""
    keep = [c for c in keep_cols if c in pages.columns]
    one = F.transform(_raw_anchors(), lambda a, i: F.struct(
        i.alias("elem_seq"), unescape_entities(a["href"]).alias("href"), py_strip(strip_tags(a["text"])).alias("text")))
    return pages.select("page_id", *keep, one.alias("anchors"))


def extract_anchors(pages: DataFrame, keep_cols=("url",)) -> DataFrame:
    """H2: every ``<a href>`` in document order -> (page_id, elem_seq, href, text, ...).

    JVM only: scripts/styles/comments removed, then one pass finds the anchor
    tags and the page is cut there; ``posexplode`` keeps the order.
    ``elem_seq`` is the 0-based position among the page's anchors.  Unclosed
    and nested anchors are kept, as in the tree (H1).
    """
    keep = [c for c in keep_cols if c in pages.columns]
    exploded = pages.select("page_id", *keep, F.posexplode(_raw_anchors()).alias("elem_seq", "m"))
    return exploded.select(
        "page_id", *keep,
        F.col("elem_seq").cast("int").alias("elem_seq"),
        unescape_entities(F.col("m.href")).alias("href"),
        py_strip(strip_tags(F.col("m.text"))).alias("text"),
    )


def anchors_from_elements(elements: DataFrame) -> DataFrame:
    """H1 anchors in the H2 shape (for the H1 = H2 cross-check)."""
    a = elements.filter((F.col("tag") == "a") & F.col("attrs").getItem("href").isNotNull())
    w = Window.partitionBy("page_id").orderBy("elem_seq")
    return a.select("page_id", (F.row_number().over(w) - 1).cast("int").alias("elem_seq"),
                    F.col("attrs").getItem("href").alias("href"),
                    py_strip("text").alias("text"))


def has_class(cls: str) -> Column:
    return F.array_contains(F.split(F.coalesce(F.col("attrs").getItem("class"), F.lit("")),
                                    "\\s+"), cls)


def first_by_class(elements: DataFrame, tag: str, cls: str | None = None) -> DataFrame:
    """H4: ``soup.find(tag, class_=cls).text`` per page -> (page_id, text).

    ``elements``: H1's table, or ``page_elements`` (then nothing is shuffled)."""
    if "elems" in elements.columns:
        first = F.get(of_tag("elems", tag, cls), F.lit(0))
        return elements.select("page_id", "buffer", first.alias("e")).filter("e is not null") \
            .select("page_id", cut("buffer", F.col("e")).alias("text"))
    e = elements.filter(F.col("tag") == tag)
    if cls:
        e = e.filter(has_class(cls))
    return (e.groupBy("page_id")
             .agg(F.min_by("text", "elem_seq").alias("text")))


def paragraphs(elements: DataFrame) -> DataFrame:
    """H5: all ``<p>`` in document order -> (page_id, p_no, text), p_no 0-based.

    ``elements``: H1's table, or ``page_elements`` (then nothing is shuffled)."""
    if "elems" in elements.columns:
        return elements.select("page_id", "buffer", F.posexplode(of_tag("elems", "p")).alias("p_no", "e")).select(
            "page_id", "p_no", "e.elem_seq", cut("buffer", F.col("e")).alias("text"))
    w = Window.partitionBy("page_id").orderBy("elem_seq")
    return (elements.filter(F.col("tag") == "p")
                    .select("page_id", (F.row_number().over(w) - 1).cast("int").alias("p_no"),
                            "elem_seq", "text"))


def anchors_after_marker(elements: DataFrame, marker_tag: str, marker_text: str,
                         suffix: str | None = None) -> DataFrame:
    """H6: ``find(marker_tag, string=marker_text).find_all_next('a', href=endswith)``.

    The marker is the first element of that tag whose whole text equals
    ``marker_text``; kept are anchors that start after it in document order.
    """
    marks = (elements.filter((F.col("tag") == marker_tag) & (F.col("text") == marker_text))
                     .groupBy("page_id").agg(F.min("elem_seq").alias("mark_seq")))
    a = elements.filter((F.col("tag") == "a") & F.col("attrs").getItem("href").isNotNull())
    if suffix:
        a = a.filter(F.col("attrs").getItem("href").endswith(suffix))
    return (a.join(marks, "page_id")
             .filter(F.col("elem_seq") > F.col("mark_seq"))
             .select("page_id", "elem_seq", F.col("attrs").getItem("href").alias("href"),
                     "text"))


def heading_title(elements: DataFrame) -> DataFrame:
    """Text of the first ``<h1>`` per page -> (page_id, title).

    ``elements``: H1's table, or ``page_elements`` (then nothing is shuffled)."""
    if "elems" in elements.columns:
        return first_by_class(elements, "h1").select("page_id", py_strip("text").alias("title"))
    return (elements.filter(F.col("tag") == "h1")
                    .groupBy("page_id")
                    .agg(py_strip(F.min_by("text", "elem_seq")).alias("title")))


# A byline ("By Jane Doe", "By: Jane van Doe"): one to six name words,
# each capitalised but for the usual particles; and where page metadata names the author.
_NAME = r"\p{Lu}[\p{L}\p{M}'’.-]*"
_NAME_WORD = rf"(?:{_NAME}|de|da|di|du|del|van|von|der|den|la|le|bin|al|y)"
BYLINE_RE = rf"^By:?\s+({_NAME}(?:\s+{_NAME_WORD}){{0,5}})$"
BYLINE_TAGS = ["p", "span", "div", "address", "small", "em", "i", "b", "strong"]
AUTHOR_META = ["author", "article:author"]


def byline_author(elements: DataFrame, pages: DataFrame | None = None) -> DataFrame:
    """Author from the page's metadata, else from the first element whose whole
    text is a byline (``BYLINE_RE``: a name, not running prose); '' if none.

    ``elements`` holds ``BYLINE_TAGS`` and, for metadata, ``meta``.  Returns one row per page of ``pages`` when given (blank author kept),
    else per page that has elements.
    """
    t = collapse_space("text")
    attrs = F.col("attrs")
    named = F.lower(F.coalesce(attrs.getItem("name"), attrs.getItem("property"), F.lit(""))).isin(AUTHOR_META)
    meta = F.when((F.col("tag") == "meta") & named, collapse_space(F.coalesce(attrs.getItem("content"), F.lit(""))))
    line = F.when(F.col("tag").isin(BYLINE_TAGS), F.regexp_extract(t, BYLINE_RE, 1))
    cand = (elements.select("page_id", F.struct(F.when(F.col("tag") == "meta", 0).otherwise(1).alias("k"), "elem_seq").alias("o"),
                            F.coalesce(meta, line).alias("a"))
                    .filter(F.col("a") != "")
                    .groupBy("page_id").agg(F.min_by("a", "o").alias("author")))
    base = (pages.select("page_id") if pages is not None
            else elements.select("page_id").distinct())
    return (base.join(cand, "page_id", "left")
                .select("page_id", F.coalesce("author", F.lit("")).alias("author")))


def main_text(pages: DataFrame, exclude=tuple(NON_MAIN_TAGS) + tuple(FURNITURE_SELECTORS)
              ) -> DataFrame:
    """Main text without header/footer/nav/aside/furniture -> (page_id, text).

    Texts of the outermost ``<p>`` elements (a paragraph inside another one,
    at any depth, is already part of its text), whitespace collapsed, joined
    in document order with a newline.  No shuffle: a page is one row.
    """
    outer = F.filter("elems", lambda e: e["outer_seq"] == -1)
    el = page_elements(pages, tags=["p"], exclude=exclude).filter(F.size(outer) > 0)
    return el.select("page_id", F.array_join(F.transform(outer, lambda e: collapse_space(cut("buffer", e))), "\n").alias("text"))


# ---------------------------------------------------------------------------
# Snapshots (H7–H14): expressions over a page's buffer and elements.
#
# What a format adds to the text is a list of insertions, each at a place of the
# buffer: before an element's first byte or after its last.

# Stand for the ends of a link until lines are put together
# (control characters that html forbids).
_LINK_START, _LINK_STOP = "\x01", "\x02"
FORMATS = ("default", "markdown", "text", "html")


def _insertions(elems: Column, opening, closing) -> Column:
    """``opening(e)`` and ``closing(e)`` of all elements, in document order, empty ones left out.

    An element closes after the last one inside it opened, inner ones first."""
    both = F.flatten(F.transform(elems, lambda e: F.array(
        F.struct(e["elem_seq"].alias("k"), F.lit(0).alias("closes"), F.lit(0).alias("inner"),
                 e["start"].alias("at"), opening(e).alias("add")),
        F.struct(e["last_seq"].alias("k"), F.lit(1).alias("closes"), (-e["elem_seq"]).alias("inner"),
                 e["stop"].alias("at"), closing(e).alias("add")))))
    return F.array_sort(F.filter(both, lambda x: x["add"] != ""))


def _woven(buffer, insertions: Column, start: Column, stop: Column, piece=lambda text, at, to: text) -> Column:
    """Bytes ``start`` to ``stop`` of the buffer with the insertions between them."""
    marks = F.concat(F.array(F.struct(start.alias("at"), F.lit("").alias("add"))),
                     F.transform(insertions, lambda x: F.struct(x["at"].alias("at"), x["add"].alias("add"))))

    def put(marks):
        def one(x, i):
            to = F.coalesce(F.get(marks, i + 1)["at"], stop)
            text = F.substr(F.col(buffer), x["at"] + 1, to - x["at"]).cast("string")
            return F.concat(x["add"], piece(text, x["at"], to))
        return F.array_join(F.transform(marks, one), "")
    return F.transform(F.array(marks), put)[0]      # bound once: the marks are named for each piece


def _escape(text: Column, quote: bool = False) -> Column:
    for ch, ref in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), *([('"', "&quot;")] if quote else [])):
        text = F.replace(text, F.lit(ch), F.lit(ref))
    return text


def _is_block(e) -> Column:
    return e["tag"].isin(sorted(BLOCK_TAGS))


def _has_href(e) -> Column:
    return (e["tag"] == "a") & e["attrs"].getItem("href").isNotNull()


def _attr(e, name: str) -> Column:
    return F.coalesce(e["attrs"].getItem(name), F.lit(""))


def _inside(x, e) -> Column:
    """Does the insertion ``x`` stand inside the element, its own ends left out?"""
    opener = F.when(x["closes"] == 1, -x["inner"]).otherwise(x["k"])
    return (opener > e["elem_seq"]) & (opener <= e["last_seq"])


def _link_text(e, breaks: Column) -> Column:
    """A link's text; block elements inside it part words."""
    inner = F.filter(breaks, lambda x: _inside(x, e))
    return collapse_space(F.when(e["last_seq"] == e["elem_seq"], cut("buffer", e))
                           .otherwise(_woven("buffer", inner, e["start"], e["stop"])))


def _body(fmt: str, remove_images: bool) -> Column:
    """The page's text in a format, from the columns ``buffer``, ``elems`` and ``wide`` (links
    that hold text of their own lines or elements)."""
    nothing = F.lit("")

    def opening(e):
        parts = [F.when(_is_block(e), "\n").otherwise(nothing)]
        if fmt == "markdown":
            level = F.regexp_extract(e["tag"], "^h([1-6])$", 1)
            parts.append(F.when(level != "", F.concat(F.repeat(F.lit("#"), F.coalesce(level.try_cast("int"), F.lit(0))), F.lit(" ")))
                          .otherwise(nothing))
            parts.append(F.when(_has_href(e), _LINK_START).otherwise(nothing))
            if not remove_images:
                image = F.concat(F.lit("!["), _attr(e, "alt"), F.lit("]("), _attr(e, "src"), F.lit(")"))
                parts.append(F.when(e["tag"] == "img", image).otherwise(nothing))
        if fmt == "html":
            attrs = F.transform(F.map_entries(e["attrs"]), lambda a: F.concat(
                F.lit(" "), a["key"], F.lit('="'), _escape(a["value"], quote=True), F.lit('"')))
            parts.append(F.concat(F.lit("<"), e["tag"], F.array_join(attrs, ""), F.lit(">")))
        return F.concat(*parts)

    def closing(e):
        parts = []
        if fmt == "markdown":
            parts.append(F.when(_has_href(e), F.concat(F.lit(_LINK_STOP + "]("), _attr(e, "href"), F.lit(")"))).otherwise(nothing))
        if fmt == "html":
            parts.append(F.concat(F.lit("</"), e["tag"], F.lit(">")))
        parts.append(F.when(_is_block(e), "\n").otherwise(nothing))
        return F.when(e["tag"].isin(sorted(VOID_TAGS)), nothing).otherwise(F.concat(*parts))

    def piece(text, at, to):
        if fmt == "html":
            return _escape(text)
        if fmt == "markdown":       # a link stays on one line
            linked = F.exists("wide", lambda a: (a["start"] <= at) & (to <= a["stop"]))
            return F.when(text.contains("\n") & linked, F.translate(text, "\n", " ")).otherwise(text)
        return text

    added = _insertions(F.col("elems"), opening, closing)
    if fmt == "markdown":
        added = F.transform(added, lambda x: F.when(
            x["add"].contains("\n") & F.exists("wide", lambda a: _inside(x, a)),
            x.withField("add", F.translate(x["add"], "\n", " "))).otherwise(x))
    raw = _woven("buffer", added, F.lit(0), F.octet_length("buffer"), piece)
    if fmt == "html":
        return py_strip(raw)
    if fmt == "markdown":
        raw = F.regexp_replace(raw, f"{_LINK_START}\\s+", _LINK_START)
        raw = F.translate(F.regexp_replace(raw, f"\\s+{_LINK_STOP}", _LINK_STOP), _LINK_START + _LINK_STOP, "[")
    lines = F.transform(F.split(raw, "\n"), collapse_space)
    return F.array_join(F.filter(lines, lambda x: x != ""), "\n")


def page_snapshot(pages: DataFrame, exclude=(), target=(), remove_images=False,
                  links_at_end=False, images_at_end=False, fmt="default",
                  as_struct=False) -> DataFrame:
    """Page -> ``(page_id, url, title, body_text, links, images, snapshot)``.

    ``exclude``/``target`` are simple selectors applied while parsing (the
    dropped subtrees never leave the Python worker).  ``fmt`` is
    default / markdown / text / html; all that a format adds, the lists of links
    and images and their resolved urls are Spark expressions over the page's
    text and elements (H1).  Block elements break lines, runs of white space are one blank, empty
    lines are dropped; html is written anew from tags and attributes.
    ``as_struct`` adds H13's record ``struct(url, title, content)``.  A null or
    empty page has an empty body and no links; a null url stays null in links.
    """
    if fmt not in FORMATS:
        raise ValueError(f"unsupported snapshot format: {fmt}")
    p = page_spans(pages, exclude=exclude, target=target, title_apart=True, keep_cols=("url",))
    breaks = _insertions(F.filter("elems", _is_block), lambda e: F.lit("\n"),
                         lambda e: F.when(e["tag"].isin(sorted(VOID_TAGS)), "").otherwise("\n"))
    p = p.withColumn("anchors", F.filter("elems", _has_href)) \
        .withColumn("wide", F.filter("anchors", lambda a: (a["last_seq"] > a["elem_seq"]) | cut("buffer", a).contains("\n"))) \
        .withColumn("breaks", F.when(F.exists("anchors", lambda a: a["last_seq"] > a["elem_seq"]), breaks)
                    .otherwise(F.slice(breaks, F.lit(1), F.lit(0))))
    links = F.transform("anchors", lambda a: F.struct(
        _link_text(a, F.col("breaks")).alias("text"), resolve_href("url", _attr(a, "href")).alias("href")))
    found = F.transform(F.filter("elems", lambda e: (e["tag"] == "img") & F.lit(not remove_images)), lambda e: F.struct(
        _attr(e, "alt").alias("alt"), resolve_href("url", _attr(e, "src")).alias("src")))
    p = p.select("page_id", "url", collapse_space("title").alias("title"), _body(fmt, remove_images).alias("body_text"),
                 links.alias("links"), found.alias("images"))

    parts = [F.col("body_text")]
    if fmt not in ("text", "html"):
        parts = [F.lit("Title: "), F.col("title"), F.lit("\n\nURL Source: "), F.coalesce("url", F.lit("")),
                 F.lit("\n\nMarkdown Content:\n"), F.col("body_text")]

    def listed(rows, mark, text, url):
        return F.array_join(F.transform(rows, lambda x: F.concat(
            F.lit(mark), x[text], F.lit("]("), F.coalesce(x[url], F.lit("")), F.lit(")"))), "\n")
    if links_at_end:
        parts += [F.lit("\n\n" + LINKS_HEADER + "\n"), listed("links", "- [", "text", "href")]
    if images_at_end:
        parts += [F.lit("\n\n" + IMAGES_HEADER + "\n"), listed("images", "- ![", "alt", "src")]
    snap = p.withColumn("snapshot", F.concat(*parts))
    if as_struct:
        snap = snap.withColumn("record", F.struct(F.col("url"), F.col("title"),
                                                  F.col("body_text").alias("content")))
    return snap


def links_section(snapshot: Column) -> Column:
    """The tail of a snapshot from ``Links/Buttons:`` on; NULL when absent."""
    pos = F.instr(snapshot, LINKS_HEADER)
    return F.when(pos > 0, F.substr(snapshot, pos))


def links_summary(anchors: DataFrame, base_url: str = "url") -> DataFrame:
    """H10 on the JVM: a page's links as ``Links/Buttons:`` lines, in document order.

    anchors: H2 output with the page url.  One row per page; a page's
    anchors are one group (bounded by the page).
    """
    a = anchors.select("page_id", "elem_seq", collapse_space("text").alias("t"),
                       resolve_href(base_url, "href").alias("h"))
    g = a.groupBy("page_id").agg(F.array_sort(F.collect_list(
        F.struct("elem_seq", "t", "h"))).alias("_l"))
    lines = F.transform("_l", lambda s: F.concat(F.lit("- ["), s["t"], F.lit("]("), s["h"],
                                                 F.lit(")")))
    return g.select("page_id", F.concat(F.lit(LINKS_HEADER + "\n"),
                                        F.array_join(lines, "\n")).alias("links_text"))
