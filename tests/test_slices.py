"""Pages are parsed in slices of bounded html, however many an Arrow batch holds."""

import pyarrow as pa

from conftest import pages_df
from pagetables.operators import html as H


def _batch(htmls):
    return pa.RecordBatch.from_arrays([pa.array(range(len(htmls)), pa.int64()), pa.array(htmls, pa.string())],
                                      names=["page_id", "html"])


def test_slices_are_bounded_and_whole():
    k = H.SLICE_BYTES
    htmls = ["x" * (k // 3), "é" * (k // 6), None, "", "y" * (k // 2), "z" * (3 * k), "w", None, "v" * k, "u"]
    parts = list(H._slices(_batch(htmls)))
    assert [h for p in parts for h in p.column(1).to_pylist()] == htmls
    assert [i for p in parts for i in p.column(0).to_pylist()] == list(range(len(htmls)))
    for p in parts:
        assert p.num_rows == 1 or sum(len((h or "").encode()) for h in p.column(1).to_pylist()) <= k
    assert len(parts) == 6
    assert list(H._slices(_batch([]))) == []


def test_one_arrow_batch_of_many_pages(spark):
    n = 300
    size = H.SLICE_BYTES // 40
    rows = [(i, "u", None if i % 7 == 0 else "<p>" + "w" * size + f"<b>{i}</b>") for i in range(n)]
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    old = spark.conf.get(key)
    spark.conf.set(key, "10000")
    try:
        got = {r.page_id: (r.n, r.size, r.last) for r in H.page_spans(pages_df(spark, rows).coalesce(1)).selectExpr(
            "page_id", "size(elems) AS n", "octet_length(buffer) AS size",
            "CAST(substring(buffer, get(elems, 1).start + 1) AS STRING) AS last").collect()}
    finally:
        spark.conf.set(key, old)
    assert got == {i: (0, 0, None) if i % 7 == 0 else (2, size + len(str(i)), str(i)) for i in range(n)}
