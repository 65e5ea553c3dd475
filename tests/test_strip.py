"""Scripts, styles and comments go the same way by the pattern that starts at "<"."""

import pytest
from pyspark.sql import functions as F

from conftest import pages_df, rows
from pagetables.operators import html as H

ODD = ["", "plain", "<a href=/1>x</a><SCRIPT>a<b</Script >y", "<scripts>z</scripts><style\n>q</style>r", "<!-- a --> b --><!---->c<!--d",
       "<<script x='>'>1</script>2</script>", "a\x01b<a href=/2>\x01c</a>\x01", "<style>u<script>v</style>w</script>", "<ſcript>k</ſcript>",
       "</a ><A\thref='/3'>n</A\n><abbr>m</abbr><a>", "<script>never closed <a href=/4>t</a>"]


def test_both_patterns_strip_alike(spark):
    df = pages_df(spark, [(i, "u", h) for i, h in enumerate([*ODD, None])])
    got = df.select("page_id", F.regexp_replace("html", H.STRIP_RE, "").alias("a"), F.regexp_replace("html", H.STRIP_FROM_RE, "").alias("b"))
    assert all(r.a == r.b for r in got.collect())


def test_anchors_of_odd_pages(spark):
    df = pages_df(spark, [(i, "u", h) for i, h in enumerate([*ODD, None])])
    assert rows(H.extract_anchors(df), "page_id", "elem_seq", "href", "text") == [
        (2, 0, "/1", "x"), (6, 0, "/2", "c"), (9, 0, "/3", "n"), (10, 0, "/4", "t")]


@pytest.mark.parametrize("pattern", [H.STRIP_FROM_RE, H.ANCHOR_TAG_RE])
def test_patterns_start_at_a_tag(pattern):
    """A choice between whole tags is tried at every character of a page."""
    assert pattern.startswith("(?is)<(?:") and pattern.endswith(")")
