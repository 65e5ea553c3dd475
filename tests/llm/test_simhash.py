import random

import numpy as np
from llm_helpers import SF, docs_of, no_docs, odd, words  # noqa: F401
from xxhash import xxh64_intdigest

from pagetables.llm import kernels, simhash


def fingerprint(text):
    w = words(text)
    sh = [" ".join(w)] if 0 < len(w) < 3 else [" ".join(w[i:i + 3]) for i in range(len(w) - 2)]
    hs = [xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def groups(fps):
    """{fingerprint: smallest fingerprint reachable} by comparing all pairs."""
    fps = sorted(set(fps))
    label = {f: f for f in fps}

    def find(x):
        while label[x] != x:
            x = label[x]
        return x
    for i, a in enumerate(fps):
        for b in fps[i + 1:]:
            if (a ^ b).bit_count() <= 3:
                x, y = find(a), find(b)
                label[max(x, y)] = min(x, y)
    return {f: find(f) for f in fps}


def check(docs):
    got = simhash.near_duplicates(docs).collect()
    rows = docs.select("doc_id", "text").collect()
    fp = [fingerprint(r.text) for r in rows]
    assert sorted((str(r.doc_id), r.fingerprint) for r in got) == sorted((str(r.doc_id), f"{f:016x}") for r, f in zip(rows, fp))
    of, low = groups(fp), {}
    for r, f in zip(rows, fp):
        if r.doc_id is not None:
            low[of[f]] = min(low.get(of[f], r.doc_id), r.doc_id)
    for r in got:
        assert r.component_id == low.get(of[int(r.fingerprint, 16)])


def test_whole_table_against_all_pairs(spark):
    check(spark.read.parquet(f"{SF}/documents.parquet"))


def test_odd_rows(odd, no_docs):
    check(odd)
    assert simhash.near_duplicates(no_docs).collect() == []


def test_rows_without_words_are_linked_with_each_other(docs_of):
    check(docs_of([(5, None), (3, ""), (4, " \n"), (None, ""), (9, "a b"), (8, "A B"), (7, "a b c")]))


def test_null_id_alone(docs_of):
    assert [r.component_id for r in simhash.near_duplicates(docs_of([(None, "just this text here")])).collect()] == [None]


def test_white_space_and_pieces(docs_of, monkeypatch):
    monkeypatch.setattr(kernels.cut, "__defaults__", (32,))
    monkeypatch.setattr(simhash, "HASHES", 7)
    text = "Ünï\tA\x0bb\x0cc\r\nd  e " + "x" * 90 + " " + " ".join(f"w{i % 13}" for i in range(600)) + "\x1cy z\x85k"
    assert simhash._fingerprints is not None
    import pyarrow as pa
    out = next(simhash._fingerprints([pa.RecordBatch.from_pydict({"d": [1, 2, 3], "t": [text, None, text[:40]]})]))
    assert [f % 2**64 for f in out.column(1).to_pylist()] == [fingerprint(text), 0, fingerprint(text[:40])]


def near(rng, n, base, most):
    out = []
    for _ in range(n):
        f = base
        for b in rng.sample(range(64), rng.randrange(most + 1)):
            f ^= 1 << b
        out.append(f)
    return out


def test_links_of_a_task_against_all_pairs():
    rng = random.Random(1)
    fps = np.array(sorted({f for k in range(4) for f in near(rng, 90, rng.getrandbits(64), 4)}), dtype=np.uint64)
    for radius in (1, 2, 3, 5):
        own = np.zeros(len(fps), np.int64)
        u, v = simhash._links(own, own, fps, radius)
        want = {frozenset((int(a), int(b))) for i, a in enumerate(fps) for b in fps[i + 1:] if (int(a) ^ int(b)).bit_count() <= radius}
        assert together(fps, zip(u, v)) == together(fps, map(tuple, want))
    assert len(u) < len(fps)       # a forest, not all pairs


def together(fps, links):
    label = {int(f): int(f) for f in fps}

    def find(x):
        while label[x] != x:
            x = label[x]
        return x
    for a, b in links:
        a, b = find(int(a)), find(int(b))
        label[max(a, b)] = min(a, b)
    return {f: find(f) for f in label}


def test_tasks_do_not_mix_and_two_blocks_meet_each_other_only():
    f = np.array([0, 1, 2, 0, 1], dtype=np.uint64)
    u, v = simhash._links(np.array([1, 1, 1, 2, 2]), np.array([0, 0, 1, 0, 0]), f)
    assert {frozenset(map(int, x)) for x in zip(u, v)} <= {frozenset(x) for x in ((0, 1), (0, 2), (1, 2))}
    u, v = simhash._links(np.array([1, 1, 2]), np.array([0, 0, 0]), np.array([0, 255, 1], dtype=np.uint64))
    assert not len(u)


def test_hot_bucket_is_split_and_blocked(spark, monkeypatch):
    for name, value in (("LARGE", 4), ("BLOCK", 16), ("ROWS", 64), ("PAIRS", 50)):
        monkeypatch.setattr(simhash, name, value)
    rng = random.Random(2)
    fps = {f for f in near(rng, 300, 0x0123456789ABCDEF, 5)} | {rng.getrandbits(26) for _ in range(300)} | \
        {rng.getrandbits(64) for _ in range(100)}
    df = spark.createDataFrame([(f - 2**64 if f >= 2**63 else f,) for f in fps], "fp long").repartition(5)
    got = together(fps, ((r.u % 2**64, r.v % 2**64) for r in simhash.links(df).collect()))
    assert got == groups(fps)
