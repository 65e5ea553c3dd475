"""Walks over listing pages: doubling = recursion, cycles end, growing index."""

from conftest import pages_df, rows

from pagetables.plans import paginate as P
from pagetables.sources.readers import category_seeds

BASE = "http://s.example/cat/"


def _page(items, nxt=None):
    a = "".join(f'<li><a href="/cat/{i}.html">{t}</a></li>' for i, t in items)
    n = f'<li><a href="{nxt}">下一页</a></li>' if nxt else ""
    return f'<html><body><ul>{a}</ul><div class="pages"><ul>{n}</ul></div></body></html>'


def _chain(spark, n, cycle_to=None, missing=None):
    pages = []
    for k in range(1, n + 1):
        url = BASE if k == 1 else f"{BASE}list_{k}.html"
        nxt = f"list_{k + 1}.html" if k < n else (f"list_{cycle_to}.html" if cycle_to else None)
        if missing and k == missing:
            continue
        pages.append((k, url, _page([(k, f"s{k}")], nxt)))
    return pages_df(spark, pages)


def test_doubling_equals_recursion_on_long_chain(spark):
    pages = _chain(spark, 37)
    seeds = category_seeds(spark, {"cat": BASE})
    a = P.follow_next(pages, seeds)
    b = P.follow_next(pages, seeds, method="recursive")
    assert rows(a, "page_no", "url") == rows(b, "page_no", "url")
    assert [r[0] for r in rows(a, "page_no")] == list(range(1, 38))


def test_cycle_ends_at_first_revisit(spark):
    pages = _chain(spark, 5, cycle_to=2)
    seeds = category_seeds(spark, {"cat": BASE})
    got = rows(P.follow_next(pages, seeds), "page_no", "url")
    assert len(got) == 5 and got[-1] == (5, f"{BASE}list_5.html")


def test_first_page_without_next_and_page_not_landed(spark):
    seeds = category_seeds(spark, {"cat": BASE})
    one = pages_df(spark, [(1, BASE, _page([(1, "a")]))])
    assert rows(P.follow_next(one, seeds), "page_no") == [(1,)]
    gap = _chain(spark, 6, missing=4)
    assert [r[0] for r in rows(P.follow_next(gap, seeds), "page_no")] == [1, 2, 3]


def test_max_pages_cap(spark):
    pages = _chain(spark, 12)
    seeds = category_seeds(spark, {"cat": BASE})
    got = rows(P.follow_next(pages, seeds, max_pages=5), "page_no")
    assert [r[0] for r in got] == [1, 2, 3, 4, 5]


NB = "http://n.example"


def _num_page(stories, numbers):
    s = "".join(f'<p><a href="/news/g/{x}.htm">{x}</a></p>' for x in stories)
    n = "".join(f'<a href="/news/g/{"" if m == 1 else f"list_{m}.htm"}">{m}</a>'
                for m in numbers)
    return f"<html><body>{s}<div>{n}</div><a href=\"/news/g/late.htm\">late</a></body></html>"


def test_numbered_walk_uses_index_of_pages_read(spark):
    # page 1 lists 2 and 3; page 2 lists 4 only via page 3, which lists 4 and 5;
    # page 6 is listed only on page 7, which is never reached
    pages = pages_df(spark, [
        (1, f"{NB}/news/g/", _num_page(["a"], [1, 2, 3])),
        (2, f"{NB}/news/g/list_2.htm", _num_page(["b"], [1, 2])),
        (3, f"{NB}/news/g/list_3.htm", _num_page(["c"], [3, 4, 5])),
        (4, f"{NB}/news/g/list_4.htm", _num_page(["d"], [4])),
        (5, f"{NB}/news/g/list_5.htm", _num_page(["e"], [5])),
        (6, f"{NB}/news/g/list_6.htm", _num_page(["f"], [6])),
        (7, f"{NB}/news/g/list_7.htm", _num_page(["g"], [6, 7])),
    ])
    seeds = category_seeds(spark, {"g": f"{NB}/news/g/"})
    got = rows(P.follow_numbered(pages, seeds), "page_no", "url")
    assert [r[0] for r in got] == [1, 2, 3, 4, 5]
    capped = rows(P.follow_numbered(pages, seeds, max_pages=3), "page_no")
    assert [r[0] for r in capped] == [1, 2, 3]
    links = P.numbered_page_links(pages, seeds)
    first = rows(links.filter("url = 'http://n.example/news/g/'"), "elem_seq", "title")
    # reading stops after the first story that follows the index run
    assert [t for _, t in first] == ["a", "1", "2", "3", "late"]


def test_numbered_fixpoint_equals_stepwise_with_inconsistent_numbers(spark):
    # number 3 points to two different pages; first wins by page order
    pages = pages_df(spark, [
        (1, f"{NB}/news/g/", _num_page(["a"], [1, 2])),
        (2, f"{NB}/news/g/list_2.htm",
         '<html><body><p><a href="/news/g/b.htm">b</a></p>'
         '<a href="/news/g/list_3b.htm">3</a><a href="/news/g/list_3.htm">3</a>'
         '<a href="/news/g/list_4.htm">4</a><a href="/news/g/z.htm">z</a></body></html>'),
        (3, f"{NB}/news/g/list_3.htm", _num_page(["c"], [5])),
        (4, f"{NB}/news/g/list_3b.htm", _num_page(["c2"], [3])),
        (5, f"{NB}/news/g/list_4.htm", _num_page(["d"], [4, 5])),
        (6, f"{NB}/news/g/list_5.htm", _num_page(["e"], [5])),
    ])
    seeds = category_seeds(spark, {"g": f"{NB}/news/g/"})
    a = rows(P.follow_numbered(pages, seeds), "page_no", "url")
    b = rows(P.follow_numbered_stepwise(pages, seeds), "page_no", "url")
    assert a == b
    assert a[2] == (3, f"{NB}/news/g/list_3b.htm") and [r[0] for r in a] == [1, 2, 3, 4, 5]


def _walk(spark, pages, live):
    c = spark.createDataFrame(pages, "category_no int, page_no int, url string").repartition(3)
    from pyspark.sql import functions as F
    return rows(P._walk_prefix(c, spark.createDataFrame([(u,) for u in live], "url string").select(F.col("url").alias("_live"))),
                "category_no", "page_no")


def test_walk_prefix_in_blocks(spark, monkeypatch):
    import random
    monkeypatch.setattr(P, "PAGE_BLOCK", 4)
    rng = random.Random(5)
    pages, want = [], []
    for cat in range(40):
        n = rng.randrange(1, 30)
        gone = {rng.randrange(1, 30) for _ in range(rng.randrange(3))}
        have = [k for k in range(1, n + 1) if k not in gone]
        pages += [(cat, k, f"u{cat}_{k}") for k in have]
        want += [(cat, k) for i, k in enumerate(have) if k == i + 1]
    pages.append((99, 1, "not landed"))
    assert _walk(spark, pages, [u for *_, u in pages[:-1]]) == sorted(want)


def test_walk_prefix_of_a_long_category_and_its_plan(spark):
    n = 10_000
    pages = [(0, k, f"u{k}") for k in range(1, n + 1) if k != 7_001]
    assert _walk(spark, pages, [u for *_, u in pages]) == [(0, k) for k in range(1, 7_001)]


def test_numbered_links_need_no_shuffle(spark):
    plan = P.numbered_page_links(pages_df(spark, [(1, "u", "")]), None)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan


def test_unreached_edges_leave_the_jumps(spark):
    """Chains that no seed leads to do not change a walk, whatever their length."""
    pages = _chain(spark, 9)
    other = pages_df(spark, [(100 + k, f"http://o.example/{k}", _page([], f"{k + 1}")) for k in range(1, 30)])
    seeds = category_seeds(spark, {"cat": BASE})
    a, b = P.follow_next(pages, seeds), P.follow_next(pages.union(other), seeds)
    assert rows(a, "page_no", "url") == rows(b, "page_no", "url") and a.count() == 9
