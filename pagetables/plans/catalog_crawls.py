"""Queries over derived sites that ``catalog`` has no room for: answers in chains, late recent blocks."""

from __future__ import annotations

from pyspark.sql import functions as F

from pagetables.plans import pipelines as PL
from pagetables.plans import catalog_site as S
from pagetables.plans import sqlfrag as Q
from pagetables.plans.catalog import (_LABEL_WALK_SQL, _LINES_SQL, _TITLE, LABEL_IGNORE, SH, _label,
                                      read_table, register)

_CHAIN_SQL = rf"""
d AS (SELECT doc_id, text, lang, source, length(text) AS n FROM documents),
ln AS (SELECT doc_id, i, title, row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1 AS k FROM (
         SELECT doc_id, i, regexp_extract(line, {_TITLE}, 1) AS title FROM (
           SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS i FROM d))
       WHERE title <> ''),
st AS (SELECT doc_id, '{SH}story/' || doc_id || '/0' AS url, source, text FROM d
       WHERE n % 3 <> 0 AND doc_id IN (SELECT doc_id FROM ln)),
heads AS (SELECT doc_id FROM d WHERE doc_id % {S.CHAIN} = 0 AND n % 4 <> 1 AND n % 13 <> 4 AND n % 9 <> 1
          AND doc_id IN (SELECT doc_id FROM ln WHERE i = 0) AND doc_id IN (SELECT doc_id FROM st)),
pg AS (SELECT doc_id, n % 5 IN (2, 3) OR doc_id NOT IN (SELECT doc_id FROM ln) AS nothing, n % 11 <> 0 AS has_full,
         CASE WHEN doc_id % {S.CHAIN} <> {S.CHAIN - 1} AND n % 10 <> 7 THEN doc_id + 1 END AS nxt, n % 7 = 3 AS last_named FROM d),
walk AS (
  WITH RECURSIVE w(head, doc_id, mode, page_no) AS (
    SELECT doc_id, doc_id, 'links', 1 FROM heads
    UNION ALL
    SELECT w.head, t.doc_id, CASE WHEN w.mode = 'full' OR p.nothing THEN 'full' ELSE 'links' END, w.page_no + 1
    FROM w JOIN pg p ON p.doc_id = w.doc_id
    JOIN pg t ON t.doc_id = CASE WHEN w.mode = 'full' THEN p.nxt WHEN p.nothing THEN p.doc_id WHEN NOT p.last_named THEN p.nxt END
    WHERE t.has_full OR NOT (w.mode = 'full' OR p.nothing))
  SELECT * FROM w)"""


@register("story_table_from_chained_answers", f"""
WITH {_CHAIN_SQL},
lk AS (
  SELECT w.head, w.page_no, ln.k, {Q.py_strip("ln.title || CASE WHEN w.mode = 'full' THEN '*' ELSE '' END")} AS title,
    '{SH}story/' || ln.doc_id || '/' || ln.i AS url
  FROM walk w JOIN pg USING (doc_id) JOIN ln USING (doc_id) WHERE w.mode = 'full' OR (NOT pg.nothing AND ln.k < 2)),
r AS (SELECT *, row_number() OVER (PARTITION BY title ORDER BY '{SH}list/' || head DESC, page_no DESC, k DESC) AS rn FROM lk)
SELECT r.title, coalesce(st.source, '') AS author, coalesce(st.text, '') AS content, h.lang || '-' || r.head AS category, r.url
FROM r JOIN d h ON h.doc_id = r.head LEFT JOIN st ON st.url = r.url WHERE r.rn = 1
""")
def story_table_from_chained_answers_q(spark, sf):
    """Q3 whole: categories that home pages link to and that lead to stories (F15), listings walked
    along checked next pages (I3, F17), whole pages asked from the first empty answer on (F18, N6)."""
    docs = read_table(spark, sf, "documents")
    return PL.story_table_from_answers(S.chained_answers(docs), S.chained_pages(docs), checked_categories=True)


_IGN = ", ".join(Q.lit(w) for w in LABEL_IGNORE)


@register("dedup_last_by_late_block", f"""
WITH {_LINES_SQL}, {_LABEL_WALK_SQL},
block AS (SELECT l.conv_id, l.k, l.title, l.turn, l.i FROM lines l
          JOIN turns t ON t.conv_id = l.conv_id AND t.turn = 0 AND l.turn = t.last_turn WHERE l.conv_id % 3 = 2),
rc AS (SELECT * FROM block WHERE title NOT IN ({_IGN})
       AND conv_id = (SELECT min(conv_id) FROM block WHERE title NOT IN ({_IGN}))),
alll AS (
  SELECT w.conv_id, w.page_no, 0 AS phase, l.k AS o, l.title, l.turn, l.i FROM walk w JOIN lines l ON l.conv_id = w.conv_id AND l.turn = w.turn
  UNION ALL SELECT w.conv_id, w.page_no, 0, 100000 + b.k, b.title, b.turn, b.i FROM walk w JOIN block b ON b.conv_id = w.conv_id AND w.turn = 0
  UNION ALL SELECT conv_id, 1, 1, k, title, turn, i FROM rc),
f AS (SELECT * FROM alll WHERE title NOT IN ({_IGN})
      AND NOT (page_no >= 2 AND conv_id >= (SELECT coalesce(min(conv_id), 1 << 40) FROM rc) AND title IN (SELECT title FROM rc))),
r AS (SELECT *, row_number() OVER (PARTITION BY title ORDER BY conv_id DESC, page_no DESC, phase DESC, o DESC) AS rn FROM f)
SELECT title, '{S.LABEL_HOST}c' || conv_id || '/' || conv_id || '_' || turn || '_' || i || '.html' AS url, 'cat' || conv_id AS category
FROM r WHERE rn = 1
""")
def dedup_last_by_late_block_q(spark, sf):
    """J2 where only every third category has a recent block, the first two not: the first block
    found counts, for its category and those after it."""
    site, seeds = _label(spark, sf)
    c = F.regexp_extract("url", "^" + S.LABEL_HOST + "c([0-9]+)/", 1).try_cast("long")
    site = site.withColumn("html", F.when(c % 3 == 2, F.col("html")).otherwise(
        F.regexp_replace("html", '<div class="recent">.*?</div>', "")))
    return PL.label_links(site, seeds, LABEL_IGNORE).select("title", "url", "category")
