"""DuckDB SQL fragments for the oracle queries.

They restate the rules in DuckDB's dialect with patterns of their own: the
operators' patterns are not imported, so a wrong one shows as a difference.
"""

from __future__ import annotations

# Python's white space as an RE2 class.
PY_SPACE = ("[\\t-\\r\\x1C-\\x20\\x{85}\\x{A0}\\x{1680}\\x{2000}-\\x{200A}"
            "\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}]")
# References that occur in the driver's pages and the derived sites, "&amp" last.
ENTITIES = [("&lt;?", "<"), ("&gt;?", ">"), ("&quot;?", '"'), ("&#39;", "'"), ("&nbsp;?", "\u00a0"),
            ("&copy;?", "\u00a9"), ("&middot;?", "\u00b7"), ("&amp;?", "&")]
STRIP_RE = r"(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>|<!--.*?-->"
# A closed anchor with an href: the pages that oracles read have no others.
ANCHOR_RE = (r"(?is)<a\s(?:[^>\"']|\"[^\"]*\"|'[^']*')*?\bhref\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))"
             r"(?:[^>\"']|\"[^\"]*\"|'[^']*')*>(.*?)</a\s*>")


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def unescape(x: str) -> str:
    out = x
    for pattern, ch in ENTITIES:
        out = f"regexp_replace({out}, {lit(pattern)}, {lit(ch)}, 'g')"
    return out


def py_strip(x: str) -> str:
    return f"regexp_replace({x}, {lit(f'\\A{PY_SPACE}+|{PY_SPACE}+\\z')}, '', 'g')"


def py_rstrip(x: str) -> str:
    return f"regexp_replace({x}, {lit(f'{PY_SPACE}+\\z')}, '', 'g')"


def collapse_space(x: str) -> str:
    return py_strip(f"regexp_replace({x}, {lit(PY_SPACE + '+')}, ' ', 'g')")


def strip_tags(x: str) -> str:
    return unescape(f"regexp_replace({x}, '<[^>]*>', '', 'g')")


def url_segment(x: str, n: int = 1) -> str:
    pat = "^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*" + "/[^/?#]*" * (n - 1) + "/([^/?#]*)"
    return f"regexp_extract({x}, {lit(pat)}, 1)"


def url_origin(x: str) -> str:
    return f"regexp_extract({x}, {lit('^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)')}, 1)"


def anchors_cte(table: str = "pages") -> str:
    """(page_id, url, elem_seq, href, text) for every anchor, as H2 defines it."""
    a = lit(ANCHOR_RE)
    return f"""
    _m AS (
      SELECT page_id, url,
             regexp_extract_all(h, {a}, 1) AS g1, regexp_extract_all(h, {a}, 2) AS g2,
             regexp_extract_all(h, {a}, 3) AS g3, regexp_extract_all(h, {a}, 4) AS g4
      FROM (SELECT page_id, url, regexp_replace(html, {lit(STRIP_RE)}, '', 'g') AS h
            FROM {table})),
    _mi AS (SELECT *, unnest(range(1, len(g1) + 1)) AS i FROM _m),
    anchors AS (
      SELECT page_id, url, CAST(i - 1 AS INTEGER) AS elem_seq,
             {unescape("concat(coalesce(g1[i], ''), coalesce(g2[i], ''), coalesce(g3[i], ''))")} AS href,
             {py_strip(strip_tags('g4[i]'))} AS text
      FROM _mi)"""
