import random
import re
from collections import Counter

from llm_helpers import SF, docs_of, lower, no_docs, odd  # noqa: F401

from pagetables.llm import divergence, kernels

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def f(p, q):
    return (p - q) * (p - q) // (p + q)


def restated(rows, least=10):
    docs, count, of = Counter(), Counter(), {}
    for r in rows:
        lang, source = r.lang or "", r.source or ""
        terms = TERM.findall(lower(r.text))
        docs.update((lang, t) for t in set(terms))
        count.update((lang, source, t) for t in terms)
        of.setdefault(lang, set()).add(source)
    out = []
    for lang, sources in of.items():
        kept = [t for g, t in docs if g == lang and docs[g, t] >= least]
        total = {t: sum(count[lang, s, t] for s in sources) for t in kept}

        def prob(c):
            n = sum(c.values()) + 2 * len(kept)
            return {t: 1 + 10**9 * (c[t] + 2) // n for t in kept}
        q = prob(total)
        p = {s: prob({t: count[lang, s, t] for t in kept}) for s in sources}
        for s in sources:
            pair = sorted((-sum(f(p[s][t], p[o][t]) for t in kept), o.encode(), o) for o in sources if o != s)
            out += [(lang, s, "pair", o, -v, k + 1) for k, (v, _, o) in enumerate(pair)]
            term = sorted((-f(p[s][t], q[t]), t.encode(), t) for t in kept if count[lang, s, t] and p[s][t] > q[t])
            out += [(lang, s, "term", t, -v, k + 1) for k, (v, _, t) in enumerate(term[:10])]
    return sorted(out)


def check(docs, least=10):
    want = restated(docs.select("text", "lang", "source").collect(), least)
    got = divergence.audit(docs, least_docs=least)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(tuple(r) for r in got.collect()) == want
    return want


def test_whole_table(spark):
    check(spark.read.parquet(f"{SF}/documents.parquet"))


def test_odd_rows(odd, no_docs):
    for least in (1, 2, 10):
        check(odd, least)
    assert divergence.audit(no_docs).collect() == []


def test_ties_across_cells_and_many_equal_values(docs_of):
    rows = [(i, " ".join(f"t{chr(97 + k)}{chr(97 + i % 5)}" for k in range(26)) + " Zé É 漢字 a_b", "en", f"s{i % 4}") for i in range(60)]
    rows += [(100, None, "en", "empty"), (101, "12 34", "xx", "a"), (102, "", "xx", None), (103, "only once", "yy", "a")]
    want = check(docs_of(rows))
    assert ("xx", "a", "pair", "", 0, 1) in want


def test_random_counts(docs_of):
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choices([f"w{chr(97 + k)}" for k in range(20)], [1 / (k + 1) for k in range(20)], k=rng.randrange(40))),
             rng.choice(["a", "b"]), rng.choice(["x", "y", "z", "ý", None])) for i in range(300)]
    check(docs_of(rows), 3)


def test_counts_are_passed_on_in_parts_and_long_texts_in_pieces(docs_of, monkeypatch):
    import pyarrow as pa
    monkeypatch.setattr(divergence, "ENTRIES", 5)
    monkeypatch.setattr(kernels.cut, "__defaults__", (16,))
    texts = ["aa bb aa " * 20 + "cc " + "d" * 50 + " aa", "", "bb 1 cc"]
    out = pa.Table.from_batches(divergence._counts([pa.RecordBatch.from_pydict({"l": ["e"] * 3, "s": ["x"] * 3, "t": texts})]))
    n, docs = Counter(), Counter()
    for r in out.to_pylist():
        n[r["term"]] += r["n"]
        docs[r["term"]] += r["docs"]
    assert n == Counter(" ".join(texts).replace("1", "").split())
    assert docs == Counter({"aa": 1, "bb": 2, "cc": 2, "d" * 50: 1})


def test_probabilities_do_not_overflow(spark):
    row = spark.createDataFrame([(10**13, 2 * 10**13, 10**6)], "c long, n long, v long").select(divergence._p("c", "n", "v").alias("p")).first()
    assert row.p == 1 + 10**9 * (10**13 + 2) // (2 * 10**13 + 2 * 10**6)
