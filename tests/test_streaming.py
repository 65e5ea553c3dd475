"""The streaming title table equals the batch one."""

import os
import tempfile

from conftest import SF_SMALL, rows
import pytest

from pagetables.operators.links import dedup_last
from pagetables.streaming import ingest as S


@pytest.mark.skipif(not os.path.exists(SF_SMALL), reason="no test data")
def test_stream_equals_batch(spark):
    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet")
    root = tempfile.mkdtemp(prefix="pt-stream-")
    src = os.path.join(root, "in")
    # pages land in three files
    for k in range(3):
        pages.filter(f"page_id % 3 = {k}").write.parquet(os.path.join(src, f"part{k}"))
    stream = S.read_page_stream(spark, src + "/*", max_files_per_trigger=1)
    q = S.write_epochs(S.title_table(S.story_links(stream, "/", ["the"])),
                       os.path.join(root, "out"), os.path.join(root, "ckpt"))
    q.awaitTermination(300)
    got = S.latest_titles(spark, os.path.join(root, "out"))
    want = dedup_last(S.story_links(pages, "/", ["the"]), "title",
                      order=["page_id", "elem_seq"], values=["story_url", "category"])
    assert rows(got, "title", "story_url", "category") == rows(want, "title", "story_url", "category")


@pytest.mark.skipif(not os.path.exists(SF_SMALL), reason="no test data")
def test_stream_restarts_from_its_checkpoint(spark):
    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet")
    root = tempfile.mkdtemp(prefix="pt-restart-")
    src, out, ckpt = (os.path.join(root, d) for d in ("in", "out", "ckpt"))
    pages.filter("page_id % 2 = 0").write.parquet(os.path.join(src, "first"))
    q = S.write_epochs(S.title_table(S.story_links(S.read_page_stream(spark, src + "/*"), "/")),
                       out, ckpt)
    q.awaitTermination(300)
    # more pages land while the query is down; the restart reads only those
    pages.filter("page_id % 2 = 1").write.parquet(os.path.join(src, "second"))
    q = S.write_epochs(S.title_table(S.story_links(S.read_page_stream(spark, src + "/*"), "/")),
                       out, ckpt)
    q.awaitTermination(300)
    got = S.latest_titles(spark, out)
    want = dedup_last(S.story_links(pages, "/"), "title", order=["page_id", "elem_seq"],
                      values=["story_url", "category"])
    assert rows(got, "title", "story_url", "category") == rows(want, "title", "story_url", "category")
