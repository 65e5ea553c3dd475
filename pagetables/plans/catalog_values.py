"""Queries over texts, answers and files that ``catalog`` has no room for."""

from __future__ import annotations

from pyspark.sql import functions as F

from pagetables.functions import text as TX
from pagetables.operators import answers as X
from pagetables.operators import html as H
from pagetables.operators import links as L
from pagetables.operators import merge as M
from pagetables.operators import vectors as V
from pagetables.plans import pipelines as PL
from pagetables.plans import catalog_site as S
from pagetables.plans import sqlfrag as Q
from pagetables.plans.catalog import (_DOCS_SQL, _LABEL_WALK_SQL, _LINES_SQL, _TITLE_ROWS_SQL, CATEGORY_PROMPT, CHUNK_CHARS, EMBED_DIM,
                                      LABEL_IGNORE, MERGE_TARGET, ORACLES, QUESTION, SH, _completions, _label,
                                      _words_sql, read_table, register)
from pagetables.session import scratch_path
from pagetables.sources import readers as R
from pagetables.sources import writers as W

# ---------------------------------------------------------------------------
# E1 with subwords, A8 over padding

# A small vocabulary for the query; ids are places in the list.
PIECES = ["[PAD]", "[UNK]", "the", "th", "t", "le", "l", "de", "d", "que", "qu", "en", "e", "un", "u", "an", "a", "s", "c", "i", "o", "r",
          "##ti", "##tion", "##t", "##en", "##ent", "##e", "##an", "##a", "##er", "##r", "##in", "##i", "##s", "##on", "##o", "##n", "##,"]
MAX_PIECES = 48
_ID = {p: i for i, p in enumerate(PIECES)}


def _longest_first(pieces):
    return "|".join(sorted((p.replace(".", "[.]") for p in pieces), key=len, reverse=True)) + "|."


_FIRST = _longest_first(p for p in PIECES[2:] if not p.startswith("##"))
_INNER = _longest_first(p[2:] for p in PIECES if p.startswith("##"))
_PIECES_SQL = f"""
WITH {_words_sql()},
v AS (SELECT unnest({[p for p in PIECES]}) AS piece, unnest(range({len(PIECES)})) AS id),
f AS (SELECT doc_id, pos, token, regexp_extract(token, '(?s)^({_FIRST})') AS a FROM words WHERE pos < {MAX_PIECES}),
p AS (SELECT doc_id, pos, 0 AS k, a AS piece FROM f
      UNION ALL SELECT doc_id, pos, unnest(range(1, len(m) + 1)), '##' || unnest(m) FROM (
        SELECT doc_id, pos, regexp_extract_all(substr(token, length(a) + 1), '(?s)({_INNER})') AS m FROM f)),
n AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY pos, k) - 1 AS at, coalesce(v.id, {_ID['[UNK]']}) AS id
      FROM p LEFT JOIN v USING (piece)),
t AS (SELECT d.doc_id, g.at::INT AS pos, coalesce(n.id, {_ID['[PAD]']})::INT AS token_id, (n.id IS NOT NULL)::INT AS mask
      FROM documents d CROSS JOIN (SELECT unnest(range({MAX_PIECES})) AS at) g LEFT JOIN n ON n.doc_id = d.doc_id AND n.at = g.at)
"""


@register("subword_tokens", _PIECES_SQL + "SELECT * FROM t")
def subword_tokens_q(spark, sf):
    """Longest pieces of a vocabulary, cut and padded to 48 a text."""
    return V.subword_tokens(read_table(spark, sf, "documents"), _ID, "doc_id", "text", MAX_PIECES)


@register("pooled_subwords", _PIECES_SQL + """,
w AS (SELECT doc_id, (mask * sum(mask) OVER (PARTITION BY doc_id ORDER BY pos))::DOUBLE AS w,
        unnest([token_id::DOUBLE, (token_id % 7)::DOUBLE, 1.0::DOUBLE]) AS v, unnest([0, 1, 2]) AS dim FROM t)
SELECT doc_id, dim, round(sum(w * v) / sum(w), 6) AS value FROM w GROUP BY ALL HAVING sum(w) > 0
""")
def pooled_subwords_q(spark, sf):
    """A8 / E6 over padded texts: tokens of mask 0 weigh nothing (stand-in states of three numbers)."""
    t = V.subword_tokens(read_table(spark, sf, "documents"), _ID, "doc_id", "text", MAX_PIECES)
    i = F.col("token_id").cast("double")
    t = t.withColumn("hidden", F.array(i, i % 7, F.lit(1.0)))
    p = V.position_weighted_pool(t, "doc_id", "pos", "hidden", "mask")
    return p.filter("value is not null").select("doc_id", "dim", F.round("value", 6).alias("value"))


# ---------------------------------------------------------------------------
# Vectors that do not add up, and length-weighted means

def presence_embedder(dim: int):
    """Which buckets a text's words fall into, not how often: of two texts joined, the larger of each."""
    return lambda texts: [(M.hashed_vector(t, dim) > 0).astype(float) for t in texts]


_ADDED = "list_transform(list_zip(vecs[i], vecs[i + 1]), lambda x: x[1] + x[2])"
_COUNTS = "CAST(count(*) AS DOUBLE) AS cnt"
assert _ADDED in ORACLES["semantic_chunks"] and _COUNTS in ORACLES["semantic_chunks"]


@register("semantic_chunks_presence", ORACLES["semantic_chunks"].replace(
    _ADDED, "list_transform(list_zip(vecs[i], vecs[i + 1]), lambda x: greatest(x[1], x[2]))").replace(_COUNTS, "1.0::DOUBLE AS cnt"))
def semantic_chunks_presence_q(spark, sf):
    """E11 with an embedder whose vectors do not add up: merged pairs are embedded again."""
    ch = V.segment_texts(read_table(spark, sf, "documents"), "doc_id", "text", CHUNK_CHARS)
    return M.merge_adjacent_chunks(ch, MERGE_TARGET, EMBED_DIM, embedder=presence_embedder(EMBED_DIM))


@register("semantic_chunks_mean", ORACLES["semantic_chunks"].replace(
    _ADDED, "list_transform(list_zip(vecs[i], vecs[i + 1]), lambda x: (x[1] * lens[i] + x[2] * lens[i + 1]) / greatest(lens[i] + lens[i + 1], 1.0))")
    .replace("list(c.chunk_no ORDER BY c.chunk_no) AS firsts", "list(length(c.chunk)::DOUBLE ORDER BY c.chunk_no) AS lens, list(c.chunk_no ORDER BY c.chunk_no) AS firsts")
    .replace("r(doc_id, texts, vecs, firsts, lasts)", "r(doc_id, texts, vecs, lens, firsts, lasts)")
    .replace("      list_concat(list_slice(firsts, 1, i), ", "      list_concat(list_slice(lens, 1, i - 1), [lens[i] + lens[i + 1]], list_slice(lens, i + 2, len(lens))),\n      list_concat(list_slice(firsts, 1, i), "))
def semantic_chunks_mean_q(spark, sf):
    """A merged pair's vector is the mean of the two, weighted by their lengths."""
    ch = V.segment_texts(read_table(spark, sf, "documents"), "doc_id", "text", CHUNK_CHARS)
    return M.merge_adjacent_chunks(ch, MERGE_TARGET, EMBED_DIM, revector="mean")


# ---------------------------------------------------------------------------
# S1, S2, K1, K4, F10, F17

@register("read_pages", "SELECT page_id, url, length(html)::INT AS n_chars FROM pages")
def read_pages_q(spark, sf):
    """The landed page table under its explicit schema."""
    return R.read_pages(spark, f"{sf}/pages.parquet").select("page_id", "url", F.length("html").alias("n_chars"))


_ASCII = "regexp_replace(text, '[^\\x00-\\x7F]', '?', 'g')"


@register("decode_pages_undeclared", f"""
SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN '<html><META name="x"><meta charset="GBK">' || {_ASCII} || '下一页'
  WHEN 1 THEN '<meta http-equiv=content-type content="text/html; charset=gb2312"/>' || {_ASCII} || '下一页'
  ELSE text END AS html, 'ok' AS status FROM documents
""")
def decode_pages_undeclared_q(spark, sf):
    """S2 without a declared charset: GBK and GB2312 named by the page, UTF-8 and UTF-16 by a byte-order mark."""
    d = read_table(spark, sf, "documents")
    k = F.col("doc_id") % 4
    plain = F.encode(F.regexp_replace("text", "[^\\x00-\\x7F]", "?"), "US-ASCII")
    phrase = F.unhex(F.lit("CFC2D2BBD2B3"))      # 下一页 in GBK
    raw = d.select("doc_id", F.when(k == 0, F.concat(F.lit(b'<html><META name="x"><meta charset="GBK">'), plain, phrase)).when(
        k == 1, F.concat(F.lit(b'<meta http-equiv=content-type content="text/html; charset=gb2312"/>'), plain, phrase)).when(
        k == 2, F.concat(F.unhex(F.lit("EFBBBF")), F.encode("text", "UTF-8"))).otherwise(
        F.concat(F.unhex(F.lit("FFFE")), F.encode("text", "UTF-16LE"))).alias("body"),
        F.when(k == 2, "").alias("charset"))
    return R.decode_pages(raw, status="status").select("doc_id", "html", "status")


@register("stories_csv_by_label", f"""
SELECT name, url, category, content FROM ({ORACLES["story_table_by_label"]})
""")
def stories_csv_by_label_q(spark, sf):
    """Q1 + K1 + S4: the labelled crawl's stories written in their layout and read back (no content stays null)."""
    site, seeds = _label(spark, sf)
    path = scratch_path(spark, "stories-k1")
    W.write_stories_csv(PL.story_table_by_label(site, seeds, LABEL_IGNORE), path, W.STORY_COLUMNS_A)
    return R.read_stories_csv(spark, path, W.STORY_COLUMNS_A)


@register("records_csv", f"""
WITH {_DOCS_SQL}, {_TITLE_ROWS_SQL}
SELECT raw_title || ' (' || doc_id || '.' || i || ')' AS title, '{SH}story/' || doc_id || '/' || i AS url, lang AS category,
  CASE WHEN i % 2 = 0 THEN '' ELSE 'line "' || i || '", end' END AS note FROM tl
""")
def records_csv_q(spark, sf):
    """K4: maps of records (title -> url, category, a field some lack) written as CSV with the key as
    its first column, and read back."""
    d = read_table(spark, sf, "documents")
    did = F.col("doc_id")
    m = F.map_from_entries(F.transform(S._lines(F.col("text")), lambda s: F.struct(
        F.concat(s["title"], F.lit(" ("), did.cast("string"), F.lit("."), s["i"].cast("string"), F.lit(")")),
        F.struct(S.story_url(did, s["i"]).alias("url"), F.col("lang").alias("category"),
                 F.when(s["i"] % 2 == 1, F.concat(F.lit('line "'), s["i"].cast("string"), F.lit('", end'))).alias("note")))))
    path = scratch_path(spark, "records")
    W.write_records_csv(d.select(m.alias("stories")), "stories", path, "title")
    return R.read_stories_csv(spark, path, ["title", "url", "category", "note"])


@register("resolve_relative", f"""
WITH {_LINES_SQL}, {_LABEL_WALK_SQL}
SELECT 'cat' || conv_id AS category, '{S.LABEL_HOST}c' || conv_id || '/list_' || conv_id || '_' || (v + 1) || '.html' AS next_url, count(*) AS n
FROM edges WHERE v IS NOT NULL GROUP BY ALL
""")
def resolve_relative_q(spark, sf):
    """F12 + F10: a listing's next link put behind its category's url."""
    site, seeds = _label(spark, sf)
    nxt = L.next_page_link(H.extract_anchors(site), part=("page_id", "url"))
    seed = F.regexp_extract("url", "^(.*/)[^/]*$", 1)
    j = nxt.withColumn("seed", seed).join(seeds.select("category", F.col("url").alias("seed")), "seed")
    return j.groupBy("category", TX.resolve_relative("seed", "next_href").alias("next_url")).agg(F.count("*").alias("n"))


@register("validate_next_page", f"""
WITH {_LINES_SQL}, {_LABEL_WALK_SQL}
SELECT CASE WHEN u = 0 THEN '{S.LABEL_HOST}c' || conv_id || '/' ELSE '{S.LABEL_HOST}c' || conv_id || '/list_' || conv_id || '_' || (u + 1) || '.html' END AS url,
  'list_' || conv_id || '_' || (u + 2) || '.html' AS next_href
FROM edges JOIN (SELECT DISTINCT conv_id, last_turn FROM turns) USING (conv_id) WHERE v = u + 1 OR u + 1 = last_turn
""")
def validate_next_page_q(spark, sf):
    """The next page guessed for every listing (its own number and one), kept where the page
    holds that link (as its next or its last page)."""
    site, _ = _label(spark, sf)
    listing = site.filter(F.col("url").rlike("^" + S.LABEL_HOST + "c[0-9]+/(list_[0-9_]+.html)?$"))
    c = F.regexp_extract("url", "/c([0-9]+)/", 1)
    no = F.coalesce(F.regexp_extract("url", "_([0-9]+).html$", 1).try_cast("int"), F.lit(1)) + 1
    guess = listing.select("page_id", "url", F.concat(F.lit("list_"), c, F.lit("_"), no.cast("string"), F.lit(".html")).alias("next_href"))
    return L.validate_next_page(guess, H.extract_anchors(site)).select("url", "next_href")


# ---------------------------------------------------------------------------
# X1, X3 with closed schemas

@register("split_refusals_by_schema", f"""
WITH {_DOCS_SQL},
s AS (SELECT 'categories' AS kind, CASE WHEN toxic = 1 THEN 'refused' ELSE 'ok' END AS status FROM dl
      UNION ALL SELECT 'decision', CASE WHEN quality IS NULL THEN 'schema:decision' ELSE 'ok' END FROM dl
      UNION ALL SELECT 'titles', CASE WHEN toxic = 1 THEN 'refused' WHEN coalesce(quality = 0 AND lang = 'de', false) THEN 'bad'
                                      WHEN lang IN ('en', 'fr') THEN 'schema:titles_and_urls' ELSE 'ok' END FROM dl
      UNION ALL SELECT 'story', CASE WHEN toxic = 1 THEN 'refused' WHEN lang = 'es' THEN 'schema:next_page' ELSE 'ok' END FROM dl)
SELECT kind, status, count(*) AS n FROM s GROUP BY ALL
""")
def split_refusals_by_schema_q(spark, sf):
    """Answers held against their schemas: the first fault's path."""
    return X.split_refusals(_completions(spark, sf), kind="kind").groupBy("kind", "status").agg(F.count(F.lit(1)).alias("n"))


@register("chat_request_bodies_strict", f"""
SELECT page_id, '{{"messages":[{{"role":"system","content":' || to_json({Q.lit(CATEGORY_PROMPT)})::VARCHAR
  || '}},{{"role":"user","content":' || to_json(url)::VARCHAR || '}},{{"role":"user","content":' || to_json({Q.lit(QUESTION)})::VARCHAR
  || '}}],"response_format":{{"json_schema":{{"name":"story","schema":{{"additionalProperties":false,"properties":{{'
  || '"content":{{"additionalProperties":false,"properties":{{"author":{{"type":"string"}},"content":{{"type":"string"}},"title":{{"type":"string"}}}},'
  || '"required":["title","author","content"],"type":"object"}},"next_page":{{"type":"string"}}}},"required":["content","next_page"],"type":"object"}}}},'
  || '"type":"json_schema"}}}}' AS request FROM pages
""")
def chat_request_bodies_strict_q(spark, sf):
    """Request bodies whose answer schema is closed."""
    df = read_table(spark, sf, "pages").select("page_id", "url")
    req = X.build_chat_requests(df, CATEGORY_PROMPT, text="url", question=QUESTION)
    return X.requests_json(req, kind="story", strict=True).select("page_id", "request")
