"""SQL surface: the H1 shredder as a table function for ``LATERAL`` use.

    SELECT p.page_id, e.tag, e.text
    FROM pages p, LATERAL shred_html(p.html, 'a,p') e

The UDTF reuses the DataFrame operator's tree builder; rows travel to the
Python worker in Arrow batches.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.functions import udtf

from pagetables.operators.html import _Shredder

ELEMENT_ROW = ("elem_seq int, parent_seq int, depth int, outer_seq int, tag string, "
               "attrs map<string,string>, text string")


@udtf(returnType=ELEMENT_ROW, useArrow=True)
class ShredHtml:
    """shred_html(html, tags): one row per element; ``tags`` is a comma list or NULL."""

    def eval(self, html, tags=None):
        if html is None:
            return
        keep = None if not tags else frozenset(t.strip().lower() for t in tags.split(","))
        rows, text = _Shredder(keep).read(html)
        for seq, parent, depth, outer, _last, tag, attrs, start, stop in rows:
            yield seq, parent, depth, outer, tag, attrs, text[start:stop].decode()


def register_sql_functions(spark: SparkSession) -> None:
    spark.udtf.register("shred_html", ShredHtml)
