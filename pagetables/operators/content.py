"""Story content: fetch joins, paragraph lookup, cleaning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagetables.functions.text import clean_content as _clean
from pagetables.functions.text import py_strip
from pagetables.operators.html import cut, of_tag
from pagetables.session import sized


def fetch_pages(links: DataFrame, pages: DataFrame, url: str = "url",
                cols: Sequence[str] = ("page_id", "html")) -> DataFrame:
    """J1: "fetch each url" = a left join on url; ``fetched`` tells landed pages apart.

    Only ``url`` and the requested page columns are read from ``pages``
    (column pruning reaches the scan).  A page that is not landed gives
    ``fetched = false`` and NULL columns (not an error string); of a url landed
    several times the smallest page_id counts.
    """
    first = pages.groupBy(F.col("url").alias("_purl")).agg(F.min("page_id").alias("_pid"))
    if list(cols) == ["page_id"]:
        p = first.withColumnRenamed("_pid", "page_id")
    else:
        p = pages.select(F.col("url").alias("_u"), F.col("page_id").alias("_id"), *cols).join(
            first, (F.col("_u") == F.col("_purl")) & (F.col("_id") == F.col("_pid"))).select("_purl", *cols)
    out = links.join(p, F.col(url) == F.col("_purl"), "left")
    return out.withColumn("fetched", F.col("_purl").isNotNull()).drop("_purl")


def paragraph_after_title(links: DataFrame, paras: DataFrame, title: str = "title",
                          page: str = "page_id") -> DataFrame:
    """The paragraph after the first paragraph containing the title.

    ``paras`` is ``page_elements`` (one row per page, with its ``p`` elements),
    or H5's (page_id, p_no, text), which is regrouped by page.  Each link row is
    joined to its page's row, and the first paragraph holding the title is
    found with a higher-order function: one row per link, no (link, paragraph)
    pairs.  Links whose title is on no paragraph (or on the last one) give no row.
    """
    if "elems" in paras.columns:
        per_page = paras.select(F.col("page_id").alias("_ppid"), F.col("buffer").alias("_buf"), of_tag("elems", "p").alias("_es"))
        j = links.join(per_page, F.col(page) == F.col("_ppid"))
        hit = F.array_position(F.transform("_es", lambda e: cut("_buf", e).contains(F.col(title))), F.lit(True))
        after = F.when(hit > 0, F.get("_es", hit.cast("int")))      # the one that follows, 0-based
        return (j.withColumn("_next", after).filter(F.col("_next").isNotNull())
                 .withColumn("text", py_strip(cut("_buf", F.col("_next")))).drop("_ppid", "_buf", "_es", "_next"))
    per_page = paras.groupBy(F.col("page_id").alias("_ppid")).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("p_no", "text"))), lambda p: p["text"]).alias("_ps"))
    j = links.join(per_page, F.col(page) == F.col("_ppid")).drop("_ppid")
    return (j.withColumn("_next", next_paragraph(F.col("_ps"), F.col(title))).drop("_ps")
             .filter(F.col("_next").isNotNull())
             .withColumn("text", py_strip("_next")).drop("_next"))


def next_paragraph(paragraphs: Column, title: Column) -> Column:
    """The paragraph after the first one that holds ``title``; null if there is none."""
    hit = F.array_position(F.transform(paragraphs, lambda p: p.contains(title)), F.lit(True))
    return F.when((hit > 0) & (hit < F.size(paragraphs)), F.element_at(paragraphs, (hit + 1).cast("int")))


def missing_stories(links: DataFrame, found: DataFrame, key: str = "title") -> DataFrame:
    """links whose story text was not found (reported, not silently lost)."""
    return links.join(found.select(key).distinct(), key, "left_anti")


def lookup_title(df: DataFrame, title: str, col: str = "title") -> DataFrame:
    """The row(s) of one title."""
    return df.filter(F.col(col) == F.lit(title))


def clean_content(df: DataFrame, col: str = "content") -> DataFrame:
    """right-strip, drop ``\\r`` and U+3000."""
    return df.withColumn(col, _clean(col))


def newlines_to_spaces(c) -> Column:
    """``text.replace('\\n', ' ')`` before embedding."""
    return F.replace(F.col(c) if isinstance(c, str) else c, F.lit("\n"), F.lit(" "))


def story_columns(df: DataFrame, mapping: dict) -> DataFrame:
    """project and rename, in the given order."""
    return df.select(*[F.col(src).alias(dst) for dst, src in mapping.items()])


def with_defaults(df: DataFrame, cols: Sequence[str], default: str = "") -> DataFrame:
    """``.get(k, '')`` -> coalesce."""
    for c in cols:
        df = df.withColumn(c, F.coalesce(F.col(c), F.lit(default)))
    return df


def with_page_note(df: DataFrame, text: str = "snapshot", page_no: str = "page_no") -> DataFrame:
    """``f"{snapshot}\\nCurrent Page Number: {page}"``."""
    return df.withColumn(text, F.concat(F.col(text), F.lit("\nCurrent Page Number: "),
                                        F.col(page_no).cast("string")))


def with_full_page_fallback(df: DataFrame, links_col: str, full_col: str,
                            part: Sequence[str] = ("category_no",),
                            order: Sequence[str] = ("page_no",),
                            out: str = "input") -> DataFrame:
    """use the links-only extraction unless it came back empty; once the
    full page was needed, keep using it for every later page (sticky switch).

    The switch holds from the first empty page of a chain on: that page is
    found by an aggregate per chain (combined map-side), written, and joined back
    at a size that is known (one row a chain: page texts stay where they are unless
    chains are beyond Spark's broadcast threshold), so no chain is sorted in one
    task, however long it is.  The reference keeps
    the switch across categories; here it is per chain (``part``), since one
    global order would need a global sort.
    """
    if not part:
        raise ValueError("with_full_page_fallback needs partition columns")
    keys = list(part)
    o = F.struct(*[F.col(c) for c in order])
    empty = F.coalesce(F.size(links_col), F.lit(0)) <= 0
    first = sized(df.filter(empty).groupBy(*keys).agg(F.min(o).alias("_first_empty")))
    j = df.join(first, keys, "left")
    full = F.coalesce(o >= F.col("_first_empty"), F.lit(False))
    return (j.withColumn("full_page", full)
             .withColumn(out, F.when(F.col("full_page"), F.col(full_col))
                               .otherwise(F.col(links_col)))
             .drop("_first_empty"))


def frame_shape(df: DataFrame) -> DataFrame:
    """One row (n_rows, n_cols) - the count runs as a distributed aggregate."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn(
        "n_cols", F.lit(len(df.columns)))


def head_rows(df: DataFrame, order: Sequence[str], n: int = 5) -> DataFrame:
    """L1/L2: first rows in an explicit order (the limit is the feature: top-n)."""
    return df.orderBy(*order).limit(n)


def sample_first(df: DataFrame, order: Sequence[str], n: int = 20) -> DataFrame:
    """L3: the trial run on the first ``n`` stories, in an explicit order."""
    return df.orderBy(*order).limit(n)
