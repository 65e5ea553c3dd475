"""Secrets, fingerprints, tool calls, mixing and packing."""

import hashlib
import itertools
import math
import re
from collections import defaultdict

import numpy as np
from llm_helpers import docs_of, no_docs, odd, SF, shingle_set, words  # noqa: F401
from pyspark.sql import functions as F

from pagetables.llm import fingerprint, mixing, packing, queries, secrets, toolcalls
from pagetables.llm.tables import stored

KINDS = [("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 2, 6),
         ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 20), ("hex", re.compile(r"[0-9a-f]+"), 0, 24)]


def base_spans(t):
    out = [(m.start(), k, m.end()) for k, (_n, p, g, least) in enumerate(KINDS)
           for m in p.finditer(t or "") if len(m[g]) >= least]
    return ",".join(f"{KINDS[k][0]}:{a}:{b}" for a, k, b in sorted(out))


HARD = ["token=token = abcdefgh", "𝒳𝒳 token: abc SECRET = 'zyxwvu'!", "AKIAAKIA" + "A" * 20 + " AKIA" + "B" * 15,
        "a" * 23 + "g" + "0" * 24, 'api_key"  :  "k_k.k=k" apikey=123456', "ghp_" + "a1" * 20,
        "-----BEGIN RSA PRIVATE KEY-----", "password=" + "f" * 30 + "passwd=12345"]


def test_secrets_odd_rows(docs_of, odd, no_docs):
    docs = docs_of([(100 + i, t) for i, t in enumerate(HARD)]).unionByName(odd)
    got = secrets.secret_scan(docs).collect()
    text = {r.doc_id: r.text for r in docs.collect() if r.doc_id is not None}
    assert len(got) == len(HARD) + 12
    for r in got:
        want = base_spans(text.get(r.doc_id))
        assert r.base_sha256 == hashlib.sha256(want.encode()).hexdigest(), (r.doc_id, want, r.spans)
        assert set(filter(None, want.split(","))) <= set(r.spans.split(","))
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(want.count(k + ":") for k in ("assign", "access", "hex"))
    spans = {r.doc_id: r.spans for r in got}
    assert "github:0:44" in spans[105] and spans[106].startswith("pem:0:31")
    assert secrets.secret_scan(no_docs).collect() == []


def test_ledger_scans_unseen_pairs_only(docs_of):
    old, new = docs_of([(1, HARD[0]), (2, "clean")]), docs_of([(3, HARD[1]), (4, "clean"), (5, HARD[0])])
    ledger = stored(secrets.scan(old), "ledger")
    more = secrets.scan(old.unionByName(new), ledger).collect()
    assert len(more) == 1                                   # one blob is new
    assert secrets.scan(old, ledger, version="2").count() == 2   # another version scans all
    every = ledger.unionByName(secrets.scan(new, ledger))
    f = {r.path: r.spans for r in secrets.findings(new, every).collect()}
    assert f[5] == [r.spans for r in secrets.findings(old, ledger).collect() if r.path == 1][0] and f[4] == []
    red = {r.doc_id: r for r in secrets.redact(new, every).collect()}
    assert red[4].text == "clean" and red[3].text == "𝒳𝒳 token: abc [SECRET]'!" and red[3].spans == 1


def test_key_blocks_are_found_whole(docs_of, no_docs):
    body = "\n".join("MIIEow" + "Ab1+/" * 11 for _ in range(12))
    whole = f"-----BEGIN RSA PRIVATE KEY-----\n{body}\n-----END RSA PRIVATE KEY-----"
    cut = f"-----BEGIN PRIVATE KEY-----\n{body}"
    texts = [f"x {whole} y", f"x {cut} and so on", f"{whole}{whole}", "-----BEGIN EC PRIVATE KEY----- none", None, ""]
    docs = docs_of([(i, t) for i, t in enumerate(texts)] + [(None, texts[0]), (0, texts[0])])
    red = secrets.redact(docs, stored(secrets.scan(docs), "ledger"))
    assert red.columns == docs.columns
    got = sorted(((r.doc_id, r.text) for r in red.collect()), key=str)
    want = [(0, "x [SECRET] y"), (0, "x [SECRET] y"), (1, "x [SECRET] and so on"), (2, "[SECRET]"), (3, "[SECRET] none"),
            (4, None), (5, ""), (None, "x [SECRET] y")]
    assert got == sorted(want, key=str)
    assert secrets.redact(no_docs, secrets.scan(no_docs)).collect() == []


def test_ledger_over_versions_with_hot_blobs(docs_of, monkeypatch):
    """Scans in steps give what one scan gives, whatever is shared, seen or new."""
    from pagetables.llm import tables
    first = docs_of([(i, HARD[i % 3] if i % 2 else f"own {i} {HARD[3]}") for i in range(40)])
    second = docs_of([(i, HARD[i % 5] if i % 2 else f"own {i} {HARD[3]}") for i in range(20, 80)])
    for bits in (8, 1 << 22):
        monkeypatch.setattr(tables, "FILTER_BITS", bits)
        a = stored(secrets.scan(first), "a")
        b = stored(secrets.scan(second, a), "b")
        every = secrets.scan(first.unionByName(second))
        assert sorted(map(str, a.unionByName(b).collect())) == sorted(map(str, every.collect()))
        assert a.select("blob").intersect(b.select("blob")).count() == 0


def test_fingerprints(spark, docs_of, odd, no_docs, monkeypatch):
    monkeypatch.setattr(fingerprint, "PER_BLOCK", 16)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    d = sorted(((r.doc_id, r.text) for r in docs.collect()), reverse=True)
    got = {r.doc_id: r for r in fingerprint.fingerprints(docs).collect()}
    near, by_text = [], defaultdict(set)
    for i, (k, t) in enumerate(d):
        nxt = d[(i + 1) % len(d)][1]
        half = len(t) // 2
        e = t[:len(t) - half] + nxt[:half]
        r = got[k]
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(e.encode()).hexdigest())
        by_text[t].add(r.fingerprint)
        for a, b in ((r.near_edited, e), (r.near_next, nxt)):
            x, y = shingle_set(t), shingle_set(b)
            if len(x | y) > 400:
                near.append(a - len(x & y) / len(x | y))
    assert all(len(v) == 1 for v in by_text.values()) and len(got) == len(d)
    assert abs(np.mean(near)) < 0.02 and np.abs(near).max() < 0.25
    rows = fingerprint.fingerprints(odd).collect()
    assert len(rows) == 12 and all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in rows)
    assert [r.near_edited for r in rows if r.doc_id == 3] == [1.0] and all(r.fingerprint == "" for r in rows if r.doc_id in (2, 3, 6))
    one = fingerprint.fingerprints(docs_of([(4, "ab")])).first()
    assert one.edited_sha256 == hashlib.sha256(b"aa").hexdigest() and one.near_next == 1.0
    assert fingerprint.fingerprints(no_docs).collect() == []


def test_next_of_hot_ids(docs_of, monkeypatch):
    """A third of the rows under one id, another without: each row but one of a cycle follows each other."""
    monkeypatch.setattr(fingerprint, "PER_BLOCK", 8)
    rows = [(7, f"hot {i}") for i in range(60)] + [(None, f"none {i}") for i in range(60)] + [(i, f"own {i}") for i in range(100, 160)]
    docs = docs_of(rows).select("doc_id", "text")
    got = fingerprint.with_next(docs, ["text", "doc_id"]).collect()
    after = {r.text: r.next_text for r in got}
    assert len(got) == len(after) == len(set(after.values())) == 180
    seen, t = [], "own 159"
    while t not in seen:
        seen.append(t)
        t = after[t]
    assert len(seen) == 180 and t == "own 159"
    assert seen[:60] == [f"own {i}" for i in range(159, 99, -1)]
    assert all(x.startswith("hot") for x in seen[60:120]) and all(x.startswith("none") for x in seen[120:])


def test_sketches_merge(docs_of):
    a, b = " ".join(f"a{i}" for i in range(300)), "one two"
    r = docs_of([(1, a)]).select(
        fingerprint.merge(fingerprint.sketch(F.lit(a)), fingerprint.sketch(F.lit(b))).alias("m"),
        fingerprint.sketch(F.lit(a)).alias("a"), fingerprint.sketch(F.lit(b)).alias("b")).first()
    assert r.m == r.a and len(r.b) == 1        # the guard hash of the short one is above the threshold
    assert all((h & (2**64 - 1)) < 2**64 >> fingerprint.SCALE_BITS for h in r.a)


def test_tool_calls(spark):
    calls = spark.createDataFrame([
        (1, 0, "a", None, "search", '{"limit": 2, "query": "x"}', "z"), (1, 2, "b", "a", "search", '{"query":"x"}', "z"),
        (1, 4, "c", "b", "search", '{"query":1,"limit":2}', "z"), (1, 6, "d", "gone", "lookup", '{"key":"k","key":"l"}', "z"),
        (2, 0, "p", "q", "lookup", '{"key":"k"}', "z"), (2, 1, "q", "p", "lookup", '{"key":"k"}', "z"),
        (2, 2, "s", "q", "lookup", '{"key":"k"}', "z"), (3, 0, None, "a", "measure", '{"value":1.5,"zip":1}', "z"),
        (3, 1, "a", None, "nothing", None, "z"), (3, 2, "e", "c", "measure", '{"value":2}', "z")],
        "conv_id long, turn long, call_id string, parent_id string, name string, arguments string, r string")
    results = spark.createDataFrame([(1, 3, "a", "late"), (1, 1, "a", 'fi"rst'), (9, 1, None, "lost"), (9, 2, "zz", None)],
                                    "conv_id long, turn long, call_id string, content string")
    rows = toolcalls.link_calls(calls, results, queries.TOOLS).collect()
    got = {(r.conv_id, r.turn): r for r in rows}
    assert {k: (r.depth, r.status, r.error, r.n_results) for k, r in got.items()} == {
        (1, 0): (0, "ok", None, 2), (1, 2): (1, "invalid", "missing:limit", 0), (1, 4): (2, "invalid", "type:query", 0),
        (1, 6): (0, "invalid", "not_an_object", 0), (2, 0): (None, "cycle", None, 0), (2, 1): (None, "cycle", None, 0),
        (2, 2): (None, "cycle", None, 0), (3, 0): (0, "invalid", "unexpected:zip", 0),
        (3, 1): (0, "invalid", "unknown_tool", 2), (3, 2): (3, "no_result", None, 0),
        (9, 1): (None, "orphan", None, 1), (9, 2): (None, "orphan", None, 1)}
    assert got[1, 0].line == '{"arguments":{"limit":2,"query":"x"},"call_id":"a","content":"fi\\"rst","depth":0,"name":"search"}'
    none = toolcalls.link_calls(calls.limit(0), results.limit(0), queries.TOOLS)
    assert none.collect() == []


def shared(sizes):
    """The target rule as stated: share by weight, stop at 3 times, share the excess again."""
    order = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    target, open_, left = {}, set(order), float(sum(sizes.values()))
    while open_:
        w = sum(weight[s] for s in open_)
        over = {s for s in open_ if left * weight[s] / w > 3 * sizes[s] + 1e-9}
        if not over:
            target |= {s: left * weight[s] / w for s in open_}
            break
        for s in over:
            target[s] = 3.0 * sizes[s]
            left -= target[s]
        open_ -= over
    return target


def test_mixing(spark, odd, no_docs):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    docs = docs.withColumn("source", F.when(F.col("doc_id") % 3 == 0, "hot").when(F.col("doc_id") < 20, None).otherwise(F.col("source")))
    size = {r.doc_id: (r.source, len(words(r.text))) for r in docs.collect()}
    per = defaultdict(int)
    for s, n in size.values():
        per[s] += n
    want = shared(per)
    got = mixing.taken(docs).collect()
    again = mixing.taken(docs.repartition(7)).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again)) and len(got) == len(size)
    taken = defaultdict(int)
    for r in got:
        s, n = size[r.doc_id]
        assert r.size == n and r.source_size == per[s] and math.isclose(r.target, want[s]) and r.taken <= 3 * n
        assert n == 0 or r.taken / n in (math.floor(r.target / per[s]), math.floor(r.target / per[s]) + 1, round(r.target / per[s]))
        taken[s] += r.taken
    longest = max(n for _s, n in size.values())
    assert all(abs(taken[s] - want[s]) <= longest / 4 for s in want)
    rows = mixing.taken(odd).collect()
    assert len(rows) == 12 and all(r.taken <= 3 * r.size for r in rows)
    assert mixing.taken(no_docs).collect() == [] and mixing.resample(no_docs).collect() == []
    out = mixing.resample(odd)
    assert out.columns == odd.columns


def test_pivot_keeps_expected_copies(spark):
    """Over many blocks each unit is taken with its fraction, and a block's words stay but for one unit."""
    n = 4000
    u = spark.range(n).select(F.array(*[F.struct(
        (F.col("id") * 10 + i).alias("doc_id"), F.lit(s).cast("long").alias("size"), F.lit(1).cast("long").alias("m"),
        F.lit(0).alias("whole"), F.lit(0.3).alias("p")) for i, s in enumerate((5, 8, 40, 3, 11))]).alias("u"))
    rows = u.select(mixing._pivot(F.col("u"), 0).alias("r")).collect()
    share = np.zeros(5)
    for r in rows:
        left = {x.doc_id % 10: x.copies for x in r.r.done}
        words_now = sum(x.copies * x.size for x in r.r.done)
        if r.r.carry is not None:
            left[r.r.carry.doc_id % 10] = r.r.carry.p
            words_now += r.r.carry.p * r.r.carry.size
        assert len(left) == 5 and math.isclose(words_now, 0.3 * 67)
        share += [left[i] for i in range(5)]
    assert np.abs(share / n - 0.3).max() < 0.035


def test_best_boundaries_against_all_cuts():
    rng = np.random.default_rng(1)
    for _ in range(60):
        lengths = np.sort(rng.choice(40, rng.integers(1, 9), replace=False)) + 1
        n = rng.integers(1, 9, len(lengths))
        k = int(rng.integers(1, 5))

        def padding(bounds):
            return sum(c * (min(b for b in bounds if b >= x) - x) for x, c in zip(lengths, n))
        best = min(padding([*cut, lengths[-1]]) for r in range(k) for cut in itertools.combinations(lengths[:-1], r))
        got = packing.best_boundaries(n, n * lengths, lengths, k)
        assert padding(got) == best and len(got) <= k and got[-1] == lengths[-1]


def test_packing_with_a_hot_id(docs_of, monkeypatch):
    """A third of all rows under one id, another third without one: positions stay gapless, in key order."""
    monkeypatch.setattr(packing, "PART", 7)
    monkeypatch.setattr(packing, "PER_BLOCK", 16)
    rows = [(5, "w " * (i % 9)) for i in range(60)] + [(None, "w " * (i % 3)) for i in range(60)] + [(i, "w " * (i % 20)) for i in range(100, 160)]
    got = packing.pack(docs_of(rows), buckets=3, budget=40).collect()
    assert len(got) == len(rows) and sorted(str((r.doc_id, r.n_tokens)) for r in got) == sorted(str((i, len(words(t)))) for i, t in rows)
    per = defaultdict(list)
    for r in got:
        per[r.bucket].append((r.batch * max(1, 40 // max(1, r.bucket_len)) + r.slot, r.doc_id, r.n_tokens))
    for v in per.values():
        v.sort()
        assert [p for p, *_ in v] == list(range(len(v)))
        order = [(hashlib.md5(str(i if i is not None else "").encode()).hexdigest(), i or 0, n) for _, i, n in v]
        assert order == sorted(order)


def test_packing_odd_rows(odd, no_docs):
    rows = packing.pack(odd, buckets=3, budget=20).collect()
    assert len(rows) == 12 and sorted(r.n_tokens for r in rows)[-1] == 30_000
    held = defaultdict(list)
    for r in rows:
        assert r.n_tokens <= r.bucket_len
        held[r.bucket, r.batch].append(r)
    for (b, _), v in held.items():
        size = max(1, 20 // max(1, v[0].bucket_len))
        assert sorted(x.slot for x in v) == list(range(len(v))) and len(v) <= size
    assert packing.pack(no_docs).collect() == []
