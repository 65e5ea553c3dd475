"""Registered queries of the operators, and the SQL that DuckDB can run for them."""

from __future__ import annotations

from pyspark.sql import functions as F

from pagetables.llm import (
    divergence, fingerprint, langid, lattice, merkle, minhash, mixing, nndescent, packing, quality, secrets, simhash, toolcalls)
from pagetables.llm.tables import read


def _held(mod: int, rest: int):
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(mod)) == rest


def op1_lattice(spark, sf_dir):
    return lattice.lattice_scores(read(spark, sf_dir, "documents"), _held(7, 2))


def op2_nndescent(spark, sf_dir):
    return nndescent.nearest(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op3_quality(spark, sf_dir):
    return quality.score(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"), _held(3, 1))


def op4_fingerprint(spark, sf_dir):
    return fingerprint.fingerprints(read(spark, sf_dir, "documents"))


#: Tools that the derived calls use: parameter -> (JSON type, required).
TOOLS = {"search": {"query": ("string", True), "limit": ("integer", True), "filter": ("object", False), "tags": ("array", False)},
         "lookup": {"key": ("string", True), "exact": ("boolean", False)},
         "measure": {"value": ("number", True), "unit": ("string", False)}}


def op5_tool_calls(spark, sf_dir):
    """Calls and results that Spark derives from ``conversations``: an assistant turn calls a
    tool (some with faulty arguments, a search with the whole turn as its query and nested
    arguments), after the call of two turns before; the next turn, whoever speaks, is the
    result (some under an id that no call has)."""
    c = read(spark, sf_dir, "conversations").selectExpr("conv_id", "turn", "role", "coalesce(text, '') AS text")
    calls = c.filter("role = 'assistant'").selectExpr(
        "conv_id", "turn", "concat('call_', conv_id, '_', turn) AS call_id",
        "IF(turn >= 2, concat('call_', conv_id, '_', turn - 2), NULL) AS parent_id",
        "elt(turn % 4 + 1, 'search', 'lookup', 'measure', 'browse') AS name",
        """CASE WHEN (conv_id + turn) % 13 = 5 THEN '{"query": '
           WHEN turn % 4 = 0 THEN concat('{ "query": ', substring(to_json(array(text)), 2, length(to_json(array(text))) - 2),
             ' , "tags":["\\\\u00e9 \\\\"x\\\\"", ', turn, '], "limit": ', IF(conv_id % 7 = 3, '"12"', CAST(length(text) AS STRING)),
             ', "filter": ', IF(conv_id % 11 = 5, '[]', concat('{"turns": [', turn, ', ', turn + 1, '], "role": "', role, '"}')), '}')
           WHEN turn % 4 = 1 THEN concat('{"key" : "k', length(text), '"',
             CASE conv_id % 5 WHEN 0 THEN ', "exact": true' WHEN 1 THEN ', "exact": null' WHEN 2 THEN ', "depth": 3' ELSE '' END, '}')
           WHEN turn % 4 = 2 THEN concat('{"unit": "m"', IF(conv_id % 3 = 0, '', concat(', "value": ', length(text), '.25')), '}')
           ELSE '{}' END AS arguments""")
    results = c.filter("turn >= 1").selectExpr(
        "conv_id", "turn", "concat('call_', conv_id, '_', IF((conv_id + turn) % 11 = 4, -1, turn - 1)) AS call_id",
        "text AS content")
    return toolcalls.link_calls(calls, results, TOOLS)


def op6_length_buckets(spark, sf_dir):
    return packing.pack(read(spark, sf_dir, "documents"))


def op7_minhash(spark, sf_dir):
    return minhash.near_duplicates(read(spark, sf_dir, "documents"))


def op8_secrets(spark, sf_dir):
    return secrets.secret_scan(read(spark, sf_dir, "documents"))


def op9_mixing(spark, sf_dir):
    return mixing.taken(read(spark, sf_dir, "documents"))


def op10_langid(spark, sf_dir):
    return langid.identify(read(spark, sf_dir, "documents"), _held(4, 2))


def op11_simhash(spark, sf_dir):
    return simhash.near_duplicates(read(spark, sf_dir, "documents"))


def op12_merkle(spark, sf_dir):
    return merkle.audited(read(spark, sf_dir, "documents"))


def op13_divergence(spark, sf_dir):
    return divergence.audit(read(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_lattice, op2_nndescent, op3_quality, op4_fingerprint, op5_tool_calls, op6_length_buckets, op7_minhash, op8_secrets,
    op9_mixing, op10_langid, op11_simhash, op12_merkle, op13_divergence)}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORD = r"[^\x20\x09-\x0D]+"

_OP6 = rf"""
WITH RECURSIVE sized AS (
  SELECT doc_id, len(regexp_extract_all(coalesce(text, ''), '{_WORD}'))::BIGINT AS n_tokens FROM documents
), celled AS (
  SELECT *, CASE WHEN n_tokens <= {packing.FINE} THEN n_tokens ELSE
    (floor(n_tokens / pow(2, floor(log2(n_tokens)) - 7)) * pow(2, floor(log2(n_tokens)) - 7))::BIGINT END AS cell FROM sized
), hist AS (
  SELECT row_number() OVER (ORDER BY cell) AS j, count(*) AS n, sum(n_tokens)::BIGINT AS t, max(n_tokens) AS l
  FROM celled GROUP BY cell
), cum AS (
  SELECT j, l, (sum(n) OVER (ORDER BY j))::BIGINT AS c, (sum(t) OVER (ORDER BY j))::BIGINT AS t FROM hist
  UNION ALL SELECT 0, 0, 0, 0
), dp AS (
  SELECT 0 AS k, 0::BIGINT AS j, 0::BIGINT AS cost, []::BIGINT[] AS bounds
  UNION ALL
  SELECT k, j, x.cost, x.bounds FROM (
    SELECT dp.k + 1 AS k, b.j, min({{'cost': dp.cost + b.l * (b.c - a.c) - (b.t - a.t), 'i': a.j,
                                    'bounds': list_append(dp.bounds, b.l)}}) AS x
    FROM dp JOIN cum a ON a.j = dp.j JOIN cum b ON b.j > a.j
    WHERE dp.k < {packing.BUCKETS} GROUP BY 1, 2)
), best AS (
  SELECT bounds FROM dp WHERE k > 0 AND j = (SELECT max(j) FROM cum) ORDER BY cost, k LIMIT 1
), placed AS (
  SELECT doc_id, n_tokens, len(list_filter(bounds, lambda b: b < n_tokens))::INT AS bucket, bounds FROM sized, best
), numbered AS (
  SELECT *, bounds[bucket + 1] AS bucket_len,
    row_number() OVER (PARTITION BY bucket ORDER BY md5(doc_id::VARCHAR), doc_id, n_tokens) - 1 AS pos FROM placed
)
SELECT doc_id, n_tokens, bucket, bucket_len,
  pos // greatest(1, {packing.BUDGET} // greatest(1, bucket_len)) AS batch,
  pos % greatest(1, {packing.BUDGET} // greatest(1, bucket_len)) AS slot
FROM numbered
"""

_OP7 = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, '{_WORD}') AS ws FROM documents
), sh AS (
  SELECT doc_id, unnest(CASE WHEN len(ws) = 0 THEN []::VARCHAR[] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
    ELSE list_distinct(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))) END) AS s FROM w
), n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY 1),
link AS (
  SELECT a.doc_id AS u, b.doc_id AS v FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id <> b.doc_id
  JOIN n x ON x.doc_id = a.doc_id JOIN n y ON y.doc_id = b.doc_id
  WHERE 100 * least(x.n, y.n) >= 75 * greatest(x.n, y.n)
  GROUP BY 1, 2 HAVING 100 * count(*) >= 75 * (any_value(x.n) + any_value(y.n) - count(*))
), reach AS (
  SELECT doc_id AS u, doc_id AS v FROM n
  UNION SELECT reach.u, link.v FROM reach JOIN link ON link.u = reach.v
)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, coalesce(r.c, d.doc_id) AS component_id,
  coalesce(r.c, d.doc_id) = d.doc_id AS kept
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT u, min(v) AS c FROM reach GROUP BY 1) r ON r.u = d.doc_id
"""


#: The scanner's rules restated for RE2: kind, pattern, group, least length of the group.
_SECRET_SQL = [
    ("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", r"AKIA[A-Z0-9]+", 0, 20), ("hex", r"[0-9a-f]+", 0, 24),
    ("pem", r"-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----(?:[A-Za-z0-9+/=:,\x20\t\r\n-]*?-----END [A-Z ]{0,30}PRIVATE KEY-----"
            r"|(?:[\x20\t\r\n]+[A-Za-z0-9+/=]{16,})*)", 0, 20),
    ("github", r"gh[pousr]_[A-Za-z0-9]+", 0, 40),
    ("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}", 0, 35)]


def _rule_sql(name, pattern, group, least):
    return f"""
  SELECT doc_id, '{name}' AS kind, {[r[0] for r in _SECRET_SQL].index(name)} AS k, s.start, s.stop FROM (
    SELECT doc_id, unnest(list_transform(range(1, len(m) + 1), lambda i: {{
      'start': list_sum(list_transform(g[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0),
      'stop': list_sum(list_transform(g[1:i], lambda x: length(x))) + list_sum(list_transform(m[1:i], lambda x: length(x))),
      'n': length(v[i])}})) AS s FROM (
      SELECT doc_id, regexp_extract_all(text, '{pattern}', 0) AS m, regexp_extract_all(text, '{pattern}', {group}) AS v,
        regexp_split_to_array(text, '{pattern}') AS g FROM documents WHERE regexp_matches(text, '{pattern}')))
  WHERE s.n >= {least}"""


_OP8 = "WITH f AS (" + " UNION ALL ".join(
    _rule_sql(n, p.replace("'", "''"), g, least) for n, p, g, least in _SECRET_SQL) + """
), per AS (
  SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
    count(*) FILTER (kind = 'hex') AS n_hex,
    coalesce(string_agg(kind || ':' || start::BIGINT || ':' || stop::BIGINT, ',' ORDER BY start, k, stop) FILTER (k < 3), '') AS base,
    string_agg(kind || ':' || start::BIGINT || ':' || stop::BIGINT, ',' ORDER BY start, k, stop) AS spans
  FROM f GROUP BY 1)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM documents d LEFT JOIN per USING (doc_id)
"""

_OP5 = """
WITH RECURSIVE c AS (SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations),
calls AS (
  SELECT conv_id, turn, 'call_' || conv_id || '_' || turn AS call_id,
    CASE WHEN turn >= 2 THEN 'call_' || conv_id || '_' || (turn - 2) END AS parent_id,
    ['search', 'lookup', 'measure', 'browse'][turn % 4 + 1] AS name,
    (conv_id + turn) % 13 = 5 AS broken, length(text) AS n, conv_id % 7 = 3 AS worded, conv_id % 5 AS v, conv_id % 3 = 0 AS bare,
    conv_id % 11 = 5 AS listed, to_json(text)::VARCHAR AS q, role
  FROM c WHERE role = 'assistant'
), results AS (
  SELECT conv_id, turn, 'call_' || conv_id || '_' || (CASE WHEN (conv_id + turn) % 11 = 4 THEN -1 ELSE turn - 1 END) AS call_id,
    text AS content FROM c WHERE turn >= 1
), depth AS (
  SELECT call_id, 0::BIGINT AS depth FROM calls WHERE parent_id IS NULL OR parent_id NOT IN (SELECT call_id FROM calls)
  UNION ALL SELECT k.call_id, d.depth + 1 FROM depth d JOIN calls k ON k.parent_id = d.call_id
), checked AS (
  SELECT calls.*, CASE WHEN name = 'browse' THEN 'unknown_tool' WHEN broken THEN 'not_an_object'
    WHEN name = 'search' AND listed THEN 'type:filter'
    WHEN name = 'search' AND worded THEN 'type:limit'
    WHEN name = 'lookup' AND v = 2 THEN 'unexpected:depth'
    WHEN name = 'measure' AND bare THEN 'missing:value' END AS error,
    CASE WHEN broken THEN NULL WHEN name = 'search' THEN '{"filter":' || CASE WHEN listed THEN '[]' ELSE '{"role":"' || role || '","turns":[' || turn || ',' || (turn + 1) || ']}' END
        || ',"limit":' || CASE WHEN worded THEN '"12"' ELSE n::VARCHAR END || ',"query":' || q || ',"tags":["é \\"x\\"",' || turn || ']}'
      WHEN name = 'lookup' THEN '{' || CASE v WHEN 0 THEN '"exact":true,' WHEN 1 THEN '"exact":null,' WHEN 2 THEN '"depth":3,' ELSE '' END || '"key":"k' || n || '"}'
      WHEN name = 'measure' THEN '{"unit":"m"' || CASE WHEN bare THEN '' ELSE ',"value":' || n || '.25' END || '}'
      ELSE '{}' END AS args
  FROM calls
), first AS (
  SELECT call_id, min({'turn': turn, 'content': content}) AS r, count(*) AS n FROM results GROUP BY 1
)
SELECT k.conv_id, k.turn, k.call_id, d.depth,
  CASE WHEN k.error IS NOT NULL THEN 'invalid' WHEN f.r IS NULL THEN 'no_result' ELSE 'ok' END AS status, k.error,
  coalesce(f.n, 0) AS n_results,
  '{' || CASE WHEN args IS NULL THEN '' ELSE '"arguments":' || args || ',' END || '"call_id":"' || k.call_id || '"'
    || CASE WHEN f.r IS NULL THEN '' ELSE ',"content":' || to_json(f.r.content)::VARCHAR END || ',"depth":' || d.depth
    || ',"name":"' || name || '"' || CASE WHEN parent_id IS NULL THEN '' ELSE ',"parent_id":"' || parent_id || '"' END || '}' AS line
FROM checked k JOIN depth d USING (call_id) LEFT JOIN first f USING (call_id)
UNION ALL
SELECT conv_id, turn, call_id, NULL, 'orphan', NULL, 1,
  '{"call_id":"' || call_id || '","content":' || to_json(content)::VARCHAR || '}'
FROM results WHERE call_id NOT IN (SELECT call_id FROM calls)
"""


def _leaf_sql(n_chars):
    fields = ("doc_id::VARCHAR", "source", "lang", f"({n_chars})::VARCHAR", "text")
    return "sha256(" + " || ".join(f"coalesce(strlen({c}) || ':' || {c}, '-')" for c in fields) + ")"


_OP12 = f"""
WITH RECURSIVE crc AS (   -- CRC-32 byte by byte, bit by bit
  SELECT *, xor(list_reduce(list_prepend(4294967295::UBIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::UBIGINT)),
    lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)::UBIGINT[]), lambda x, i: xor(x >> 1, 3988292384::UBIGINT * (x & 1)))),
    4294967295::UBIGINT) AS crc FROM documents
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY grp) AS n FROM (
    SELECT doc_id, coalesce('+' || lang, '') AS grp, {_leaf_sql('n_chars')} AS leaf,
      CASE WHEN crc % 7 = 0 AND n_chars IS NOT NULL THEN {_leaf_sql('n_chars::HUGEINT + 1')} END AS tampered FROM crc)
), tree AS (
  SELECT grp, 0 AS lvl, pos, leaf AS node, n FROM placed
  UNION ALL SELECT grp, lvl + 1, pos // 2, sha256(string_agg(node, '' ORDER BY pos)), (any_value(n) + 1) // 2
  FROM tree WHERE n > 1 GROUP BY grp, lvl, pos // 2
), tops AS (
  SELECT grp, node AS subroot, row_number() OVER (ORDER BY grp) - 1 AS pos, count(*) OVER () AS n FROM tree WHERE n = 1
), top AS (
  SELECT 0 AS lvl, pos, subroot AS node, n FROM tops
  UNION ALL SELECT lvl + 1, pos // 2, sha256(string_agg(node, '' ORDER BY pos)), (any_value(n) + 1) // 2
  FROM top WHERE n > 1 GROUP BY lvl, pos // 2
), low AS (
  SELECT p.grp, p.pos, list(CASE WHEN s.pos IS NULL THEN '-' WHEN s.pos < (p.pos >> l.lvl) THEN 'L' || s.node ELSE 'R' || s.node END ORDER BY l.lvl) AS path
  FROM placed p JOIN (SELECT DISTINCT grp, lvl FROM tree WHERE n > 1) l USING (grp)
  LEFT JOIN tree s ON s.grp = p.grp AND s.lvl = l.lvl AND s.pos = xor(p.pos >> l.lvl, 1) GROUP BY 1, 2
), high AS (
  SELECT p.grp, list(CASE WHEN s.pos IS NULL THEN '-' WHEN s.pos < (p.pos >> l.lvl) THEN 'L' || s.node ELSE 'R' || s.node END ORDER BY l.lvl) AS path
  FROM tops p CROSS JOIN (SELECT DISTINCT lvl FROM top WHERE n > 1) l
  LEFT JOIN top s ON s.lvl = l.lvl AND s.pos = xor(p.pos >> l.lvl, 1) GROUP BY 1
), whole AS (
  SELECT p.doc_id, p.leaf, p.tampered, t.subroot, (SELECT node FROM top WHERE n = 1) AS root,
    list_concat(coalesce(low.path, []::VARCHAR[]), coalesce(high.path, []::VARCHAR[])) AS path
  FROM placed p JOIN tops t USING (grp) LEFT JOIN low ON low.grp = p.grp AND low.pos = p.pos LEFT JOIN high ON high.grp = p.grp
), folded AS (
  SELECT *, list_reduce(list_prepend(coalesce(tampered, leaf), path), lambda a, s:
    CASE s[1] WHEN 'L' THEN sha256(s[2:] || a) WHEN 'R' THEN sha256(a || s[2:]) ELSE sha256(a) END) AS folded_root FROM whole
)
SELECT doc_id, leaf, subroot, root,
  sha256(array_to_string(list_transform(list_filter(path, lambda s: s <> '-'), lambda s: s[2:]), '')) AS proof_sha256,
  folded_root, folded_root = root AS verified FROM folded
"""

_OP13 = rf"""
WITH d AS (
  SELECT row_number() OVER () AS i, coalesce(text, '') AS text, coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents
), t AS (
  SELECT i, lang, source, unnest(regexp_extract_all({_LOWER}, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d
), kept AS (SELECT lang, term, count(*) AS total FROM t GROUP BY 1, 2 HAVING count(DISTINCT i) >= {divergence.LEAST_DOCS}
), langs AS (SELECT lang, count(*) AS v, sum(total) AS n FROM kept GROUP BY 1
), c AS (SELECT lang, source, term, count(*) AS n FROM t SEMI JOIN kept USING (lang, term) GROUP BY 1, 2, 3
), g AS (
  SELECT g.lang, g.source, coalesce(sum(c.n), 0) AS n FROM (SELECT DISTINCT lang, source FROM d) g LEFT JOIN c USING (lang, source) GROUP BY 1, 2
), p AS (
  SELECT g.lang, g.source, kept.term, coalesce(c.n, 0) AS n, 1 + 1000000000::HUGEINT * (coalesce(c.n, 0) + 2) // (g.n + 2 * v) AS p,
    1 + 1000000000::HUGEINT * (total + 2) // (langs.n + 2 * v) AS q
  FROM g JOIN kept USING (lang) JOIN langs USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = kept.term
), f AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY 1, 2, 3
), pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f.value, 0)::BIGINT AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
), terms AS (
  SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q) // (p + q))::BIGINT AS value FROM p WHERE n > 0 AND p > q
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms)
)
SELECT * FROM ranked WHERE part = 'pair' OR rank <= {divergence.TOP}
"""

ORACLES = {"op5_tool_calls": _OP5, "op6_length_buckets": _OP6, "op7_minhash": _OP7, "op8_secrets": _OP8,
           "op12_merkle": _OP12, "op13_divergence": _OP13}
