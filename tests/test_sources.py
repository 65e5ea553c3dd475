"""Sources and sinks: CSV round trip, charsets, maps of records."""

import tempfile

from conftest import rows
from pyspark.sql import functions as F

from pagetables.sources import readers as R
from pagetables.sources import writers as W


def test_csv_round_trip_with_awkward_text(spark):
    data = [("标题, \"引号\"", "第一行\n第二行, with comma", "童话", "http://x/1"),
            ("t2", "  leading and trailing  ", "c", "http://x/2")]
    df = spark.createDataFrame(data, ", ".join(f"{c} string" for c in W.STORY_COLUMNS_B))
    path = tempfile.mkdtemp(prefix="pt-csv-")
    W.write_stories_csv(df, path + "/out", W.STORY_COLUMNS_B)
    back = R.read_stories_csv(spark, path + "/out", W.STORY_COLUMNS_B)
    assert rows(back, *W.STORY_COLUMNS_B) == sorted(data)


def test_gbk_and_utf8_pages(spark):
    text = "<p>小猫钓鱼</p>"
    raw = spark.createDataFrame([(1, "u", bytearray(text.encode("gbk")), "gbk"),
                                 (2, "v", bytearray(text.encode("utf-8")), "utf-8")],
                                R.RAW_PAGES_SCHEMA)
    got = rows(R.decode_pages(raw), "page_id", "html")
    assert got == [(1, text), (2, text)]


def test_seeds_keep_order(spark):
    s = R.category_seeds(spark, {"晚安故事": "http://a/bedtime/", "童话合集": "http://a/fairy/"})
    assert rows(s, "category_no", "category") == [(0, "晚安故事"), (1, "童话合集")]


def test_records_from_map(spark):
    df = spark.createDataFrame([({"t1": ("a", "c")},)],
                               "stories map<string, struct<author:string, category:string>>")
    out = W.records_from_map(df, "stories", "title")
    assert rows(out, "title", "author", "category") == [("t1", "a", "c")]


def test_read_prompt(spark, tmp_path):
    p = tmp_path / "prompt.md"
    p.write_text("line one\nline two\n")
    got = R.read_prompt(spark, str(p)).select(F.col("prompt")).collect()
    assert got[0][0] == "line one\nline two\n"


def test_charsets_of_undeclared_pages(spark):
    gbk = "下一页 頁".encode("gbk")
    rows_ = [(1, b'<meta charset="gbk">' + gbk, None), (2, b"<META HTTP-EQUIV='Content-Type' CONTENT='text/html; charset=GB2312'>" + gbk, ""),
             (3, b"\xef\xbb\xbfabc", "gbk"), (4, "é".encode("utf-16"), None), (5, b"\xfe\xff" + "é".encode("utf-16-be"), "utf-8"),
             (6, b"<meta charset=utf-8>" + gbk, "gbk"), (7, b" " * 2000 + b"<meta charset=gbk>" + "é".encode(), None),
             (8, b"<meta name=x><meta charset=iso-8859-1>\x93", None), (9, b"", None), (10, None, None), (11, b"<meta charset=zz>a", None)]
    df = spark.createDataFrame(rows_, "page_id long, body binary, charset string")
    from pagetables.sources.readers import decode_pages
    got = {r.page_id: (r.html, r.status) for r in decode_pages(df, status="status").collect()}
    assert got[1] == ('<meta charset="gbk">下一页 頁', "ok") and got[2][0].endswith(">下一页 頁")
    assert got[3] == ("abc", "ok") and got[4] == ("é", "ok") and got[5] == ("é", "ok")
    assert got[6][0].endswith("下一页 頁") and got[7][0].endswith("é")
    assert got[8][0].endswith("“") and got[9] == ("", "ok") and got[10] == (None, None)
    assert got[11] == ("<meta charset=zz>a", "unknown_charset")
    assert decode_pages(df.drop("charset")).filter("page_id = 1").first().html.endswith("下一页 頁")


def test_records_csv_has_the_key_first(spark, tmp_path):
    from pagetables.sources.readers import read_stories_csv
    from pagetables.sources.writers import write_records_csv
    df = spark.createDataFrame([({"t,1": ("u", None), 't"2': ("", "c\nd")},)], "m map<string,struct<url:string,category:string>>")
    write_records_csv(df, "m", str(tmp_path / "r"), "title")
    got = read_stories_csv(spark, str(tmp_path / "r"), ["title", "url", "category"])
    assert rows(got, "title", "url", "category") == [('t"2', "", "c\nd"), ("t,1", "u", "")]
