"""Plain-Python restatements and tables shared by the tests of this folder."""

import re

import pytest

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def words(t):
    return WORD.findall(lower(t))


def shingle_set(t):
    w = words(t)
    return {tuple(w)} if 0 < len(w) < 5 else {tuple(w[i:i + 5]) for i in range(len(w) - 4)}


DOCS = "doc_id long, text string, lang string, source string, n_chars int, cid string, bucket string, spans int, copies int"


@pytest.fixture(scope="session")
def docs_of(spark):
    """``(doc_id, text[, lang[, source]])`` rows as a table with extra columns whose names operators use inside."""
    def make(rows):
        full = [(*r, *[None] * (4 - len(r)), len(r[1] or ""), "x", "y", 1, 2) for r in rows]
        return spark.createDataFrame(full, DOCS).repartition(3)
    return make


@pytest.fixture(scope="session")
def odd(docs_of):
    """Nulls, empty and long texts, ties, repeated rows."""
    long = " ".join(f"w{i % 977}" for i in range(30_000))
    return docs_of([
        (1, "one two three four five six seven", "en", "a"), (2, None, None, None), (3, "", "en", "a"),
        (4, long, "de", "b"), (5, long, "de", "b"), (5, long, "de", "b"), (6, " \t\n ", None, "a"),
        (7, "Ünï 漢字 𝒳 ß", "fr", None), (8, "one", "en", "c"), (None, "one two three four five six seven", "en", "a"),
        (None, None, None, None), (9, "x" * 5000, "en", "a")])


@pytest.fixture(scope="session")
def no_docs(docs_of):
    return docs_of([])
