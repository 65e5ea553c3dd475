import random

from llm_helpers import docs_of, no_docs, odd, SF, shingle_set  # noqa: F401

from pagetables.llm import minhash, tables


def components(sets):
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    ids = [i for i in sorted(sets) if sets[i]]
    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            both = len(sets[a] & sets[b])
            if 100 * both >= 75 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in sets}


def check(df, docs):
    sets = {r.doc_id: shingle_set(r.text) for r in docs.select("doc_id", "text").collect()}
    want = components(sets)
    got = {r.doc_id: r for r in df.collect()}
    assert {i: r.component_id for i, r in got.items()} == want
    assert all(r.n_shingles == len(sets[i]) and r.kept == (want[i] == i) for i, r in got.items())


def near_group(n, rng):
    base = [f"w{rng.randrange(50)}" for _ in range(120)]
    for i in range(n):
        t = list(base)
        for _ in range(rng.choice([0, 1, 2, 3, 4])):
            t[rng.randrange(len(t))] = f"n{rng.randrange(10**6)}"
        yield " ".join(t)


def test_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    check(minhash.near_duplicates(docs), docs)


def test_hot_group_in_blocks(spark, docs_of, monkeypatch):
    for name, value in (("BLOCK", 8), ("ASKED", 4), ("MEMBERS", 8), ("LEADERS", 1), ("LARGE", 6), ("SMALL_BUCKET", 5)):
        monkeypatch.setattr(minhash, name, value)
    rng = random.Random(3)
    rows = [(i, t) for i, t in enumerate([*near_group(60, rng), *near_group(30, rng), "a b", "a b", "c"])]
    docs = docs_of(rows)
    check(minhash.near_duplicates(docs), docs)


def test_guarantee_of_the_keys():
    import numpy as np
    import pyarrow as pa
    rng = np.random.default_rng(0)
    for _ in range(200):
        a = rng.integers(0, 1 << 16, minhash.SYMBOLS).astype(np.uint16)
        b = a.copy()
        b[rng.choice(minhash.SYMBOLS, minhash.GUARANTEED, replace=False)] ^= 1
        batch = pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array([a.tobytes(), b.tobytes()])], names=["cid", "sig"])
        out = next(minhash._keys([batch])).to_pandas()
        assert set(out[out.cid == 1].key) & set(out[out.cid == 2].key)


def test_odd_rows(odd, no_docs):
    rows = minhash.near_duplicates(odd).collect()
    assert len(rows) == 12
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r)
    assert by[2][0].n_shingles == by[3][0].n_shingles == by[6][0].n_shingles == 0 and by[2][0].kept
    assert [r.component_id for r in by[5]] == [4, 4] and by[4][0].kept
    assert sorted((r.n_shingles, r.component_id) for r in by[None]) == [(0, None), (3, 1)]
    assert by[8][0].n_shingles == 1
    assert minhash.near_duplicates(no_docs).collect() == []


def test_texts_that_meet_no_other_stay_where_they_are(spark, docs_of, monkeypatch):  # noqa: F811
    """Shingles are shuffled only of classes that share a key with another, found under null ids too."""
    dealt = []

    def spy(df, key, keys):
        asked, rest = tables.split(df, key, keys)
        dealt.append((sorted((r.doc_id for r in asked.collect()), key=str), rest.count()))
        return asked, rest
    monkeypatch.setattr(minhash, "split", spy)
    apart = [(i, " ".join(f"t{i}x{j}" for j in range(30))) for i in range(40)]
    base = [f"w{j}" for j in range(60)]
    near = [(100, " ".join(base)), (101, " ".join(base[:-1])), (None, " ".join(base[:-2])), (102, " ".join(base))]
    got = sorted(((r.doc_id, r.component_id) for r in minhash.near_duplicates(docs_of([*apart, *near, (200, None)])).collect()), key=str)
    assert got == sorted([*((i, i) for i in range(40)), (100, 100), (101, 100), (None, 100), (102, 100), (200, 200)], key=str)
    assert dealt == [([100, 101, None], 42)]


def test_sets_of_classes_that_are_settled_stay_where_they_are(spark, docs_of, monkeypatch):  # noqa: F811
    read = []

    def spy(df, key, keys):
        left = tables.among(df, key, keys)
        read.append((df.count(), left.count()))
        return left
    monkeypatch.setattr(minhash, "among", spy)
    base = [[f"g{g}w{j}" for j in range(80)] for g in range(12)]
    docs = [(10 * g + c, " ".join(b[c:])) for g, b in enumerate(base) for c in range(4)]
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(docs_of(docs)).collect()}
    assert got == {10 * g + c: 10 * g for g in range(12) for c in range(4)}
    (all_sets, left), = read
    assert all_sets == 48 and left < 12     # all are linked to a leader first
