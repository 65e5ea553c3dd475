"""Text and url expressions (all Spark built-ins, code-generated).

Python string methods the crawlers rely on have no exact Spark twin;
these helpers pin the semantics down so that every operator agrees.
"""

from __future__ import annotations

import json
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values (must match the Python semantics being reproduced)
#
# The characters Python's str.isspace() accepts, as one regex class that
# both Java regex and RE2 read the same way.
PY_SPACE = ("[\\t\\n\\x0B\\f\\r\\x1C-\\x20\\x{85}\\x{A0}\\x{1680}"
            "\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}]")
# Characters dropped from story content (carriage return, ideographic space).
CONTENT_DROP = "\r\u3000"
# ---------------------------------------------------------------------------


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def py_strip(c) -> Column:
    """str.strip(): removes Unicode whitespace at both ends (trim() does not)."""
    return F.regexp_replace(_c(c), f"\\A{PY_SPACE}+|{PY_SPACE}+\\z", "")


def py_rstrip(c) -> Column:
    """str.rstrip()."""
    return F.regexp_replace(_c(c), f"{PY_SPACE}+\\z", "")


def collapse_space(c) -> Column:
    """Runs of whitespace to one blank, then strip."""
    return py_strip(F.regexp_replace(_c(c), f"{PY_SPACE}+", " "))


def _one_reference(p: Column) -> Column:
    """Text that followed an ``&``, with the character reference it may start with decoded."""
    names = F.from_json(F.lit(json.dumps(html5)), "map<string,string>")      # folded to a literal
    bare = "^(" + "|".join(sorted((n for n in html5 if not n.endswith(";")), key=len, reverse=True)) + ")"
    name = F.regexp_extract(p, "^[^\\t\\n\\f <&#;]{1,32};?", 0)
    prefix = F.regexp_extract(p, bare, 1)
    numeric = F.regexp_extract(p, "^#(?:[xX][0-9a-fA-F]+|[0-9]+);?", 0)
    digits = F.regexp_replace(F.regexp_replace(numeric, "^#[xX]?0*|;", ""), "^$", "0")
    is_hex = numeric.rlike("^#[xX]")
    n = F.when(F.length(digits) > 7, F.lit(0x110000).cast("long")).when(
        is_hex, F.conv(digits, 16, 10).cast("long")).otherwise(F.conv(digits, 10, 10).cast("long"))
    # 80-9F mean windows-1252, as in HTML5
    low = "".join(bytes([i]).decode("cp1252", "ignore") or chr(i) for i in range(0x80, 0xA0))
    char = (F.when((n == 0) | n.between(0xD800, 0xDFFF) | (n > 0x10FFFF), "\ufffd")
             .when(n.between(0x80, 0x9F), F.substr(F.lit(low), (n - 0x7F).cast("int"), F.lit(1)))
             .when(n == 13, "\r")
             .when(n.between(1, 8) | n.between(0xE, 0x1F) | (n == 0x7F) | n.between(0xFDD0, 0xFDEF) | (n == 0xB)
                   | (n.bitwiseAND(F.lit(0xFFFE).cast("long")) == 0xFFFE), "")
             .otherwise(F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32")))

    def rest(taken):
        return F.substr(p, F.length(taken) + 1, F.length(p))
    return (F.when(p.startswith("amp;"), F.concat(F.lit("&"), F.substr(p, F.lit(5), F.length(p))))
             .when(numeric != "", F.concat(char, rest(numeric)))
             .when(F.element_at(names, name).isNotNull(), F.concat(F.element_at(names, name), rest(name)))
             .when(prefix != "", F.concat(F.element_at(names, prefix), rest(prefix)))
             .otherwise(F.concat(F.lit("&"), p)))


def unescape_entities(c) -> Column:
    """``html.unescape``: every HTML5 character reference, named (the old names
    without a semicolon too) and numeric, decoded once, on the JVM."""
    x = _c(c)
    parts = F.split(x, "&")
    done = F.concat(F.get(parts, F.lit(0)), F.array_join(F.transform(
        F.slice(parts, F.lit(2), F.size(parts)), _one_reference), ""))
    return F.when(x.contains("&"), done).otherwise(x)


def strip_tags(c) -> Column:
    """Inner html to text: drop tags, decode entities."""
    return unescape_entities(F.regexp_replace(_c(c), "<[^>]*>", ""))


def clean_content(c) -> Column:
    """right-strip, then drop carriage returns and ideographic spaces."""
    return F.translate(py_rstrip(c), CONTENT_DROP, "")


def is_digits(c) -> Column:
    """str.isdigit() for decimal digits (full-width digits included)."""
    return _c(c).rlike("^\\p{Nd}+$")


def url_suffix(url) -> Column:
    """url.strip('/').split('/')[-1]."""
    return F.element_at(F.split(F.regexp_replace(_c(url), "\\A/+|/+\\z", ""), "/"), -1)


def category_prefix(url, category, overrides: dict | None = None) -> Column:
    """F7 + F8: the category suffix, with per-category overrides."""
    out = url_suffix(url)
    for cat, suffix in (overrides or {}).items():
        out = F.when(_c(category) == F.lit(cat), F.lit(suffix)).otherwise(out)
    return out


def url_origin(url) -> Column:
    """scheme://host of an absolute url (empty string if none)."""
    return F.regexp_extract(_c(url), "^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)


def url_host(url) -> Column:
    return F.regexp_extract(_c(url), "^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]*)", 1)


def url_path_segment(url, n: int = 1) -> Column:
    """n-th path segment of an absolute url (1-based), '' when absent."""
    return F.regexp_extract(
        _c(url), "^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*" + "/[^/?#]*" * (n - 1) + "/([^/?#]*)", 1)


def resolve_url(base, href) -> Column:
    """site + path, as ``url_base + href[1:]`` (base ends with '/')."""
    return F.concat(_c(base), F.substring(_c(href), 2, 1 << 30))


def resolve_relative(listing_url, href) -> Column:
    """``listing_url + href`` (NULL href gives NULL)."""
    return F.concat(_c(listing_url), _c(href))


def _no_dots(path) -> Column:
    """A path without ``.`` and ``..`` segments (a last one leaves its slash)."""
    segments = F.split(path, "/")
    last = F.get(segments, F.size(segments) - 1)

    def step(acc, x):
        up = F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.least(F.size(acc), F.lit(1))))
        return F.when(x == "..", up).when(x == ".", acc).otherwise(F.concat(acc, F.array(x)))
    kept = F.array_join(F.aggregate(segments, F.array().cast("array<string>"), step), "/")
    return F.when(path.rlike("(?:^|/)[.]{1,2}(?:/|$)"),
                  F.when(last.isin(".", ".."), F.concat(kept, F.lit("/"))).otherwise(kept)).otherwise(path)


def resolve_href(base, href) -> Column:
    """Resolve ``href`` against the page url ``base`` as ``urljoin`` does, without the
    fragment: absolute, scheme-relative, root-relative, query-only and
    path-relative forms, ``.`` and ``..`` segments, an empty base path."""
    b, h = F.regexp_replace(_c(base), "#.*$", ""), F.regexp_replace(_c(href), "#.*$", "")
    no_query = F.regexp_replace(b, "[?].*$", "")
    scheme = F.regexp_extract(b, "^([A-Za-z][A-Za-z0-9+.-]*):", 1)
    origin = url_origin(b)
    path = F.regexp_replace(h, "[?].*$", "")
    query = F.regexp_extract(h, "[?].*$", 0)
    folder = F.regexp_replace(F.substr(no_query, F.length(origin) + 1, F.length(no_query)), "[^/]*$", "")
    folder = F.when(folder == "", "/").otherwise(folder)
    return (F.when(h.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), h)
             .when(h.startswith("//"), F.concat(scheme, F.lit(":"), h))
             .when(h == "", b)
             .when(h.startswith("?"), F.concat(no_query, h))
             .when(h.startswith("/"), F.concat(origin, _no_dots(path), query))
             .otherwise(F.concat(origin, _no_dots(F.concat(folder, path)), query)))
