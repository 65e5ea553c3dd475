import hashlib
import random
import zlib

from llm_helpers import SF, docs_of, no_docs, odd  # noqa: F401

from pagetables.llm import merkle


def h(s):
    return hashlib.sha256(s.encode()).hexdigest()


def leaf(r, more=0):
    values = [r.doc_id, r.source, r.lang, None if r.n_chars is None else r.n_chars + more, r.text]
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(nodes):
    """Levels from the nodes up to one root."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        x = levels[-1]
        levels.append([h("".join(x[i:i + 2])) for i in range(0, len(x), 2)])
    return levels


def path(levels, i):
    out = []
    for x in levels[:-1]:
        out.append(None if i ^ 1 >= len(x) else ("L" if i & 1 else "R", x[i ^ 1]))
        i //= 2
    return out


def folded(node, p):
    for e in p:
        node = h(node) if e is None else h(e[1] + node) if e[0] == "L" else h(node + e[1])
    return node


def restated(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r.lang, []).append(r)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in order:
        groups[g].sort(key=lambda r: (r.doc_id is not None, r.doc_id or 0, leaf(r)))
        trees[g] = tree([leaf(r) for r in groups[g]])
    top = tree([trees[g][-1][0] for g in order])
    out = []
    for k, g in enumerate(order):
        for i, r in enumerate(groups[g]):
            p = path(trees[g], i) + path(top, k)
            hit = r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 7 == 0
            root = folded(leaf(r, int(hit)), p)
            out.append((r.doc_id, leaf(r), trees[g][-1][0], top[-1][0], h("".join(e[1] for e in p if e)), root, root == top[-1][0]))
    return sorted(out, key=str)


def check(docs):
    rows = docs.select("doc_id", "source", "lang", "n_chars", "text").collect()
    got = sorted((tuple(r) for r in merkle.audited(docs).collect()), key=str)
    want = restated(rows)
    assert got == want
    return want


def test_whole_table(spark):
    want = check(spark.read.parquet(f"{SF}/documents.parquet"))
    assert {r[-1] for r in want} == {True, False}


def test_odd_rows(odd, no_docs):
    check(odd)
    assert merkle.audited(no_docs).collect() == []


def test_single_row_and_null_sizes(docs_of, spark):
    want = check(docs_of([(3, "one")]))
    assert want[0][1] == want[0][2] == want[0][3]
    df = spark.createDataFrame([(0, None, None, None, None), (i := 10, "t", "en", "s", None)],
                               "doc_id long, text string, lang string, source string, n_chars long")
    check(df)


def test_blocks_of_blocks(docs_of, monkeypatch):
    """A hot group of more than two steps, groups of all small sizes, more groups than a block."""
    monkeypatch.setattr(merkle.manifest, "__defaults__", (*merkle.manifest.__defaults__[:-1], 2))
    rng = random.Random(1)
    rows = [(i, f"t{i % 5}", "hot") for i in range(77)] + [(1, "same", "hot")] * 9
    rows += [(rng.randrange(1000), "x", f"l{g}") for g in range(19) for _ in range(g)]
    rng.shuffle(rows)
    check(docs_of(rows))


def test_append_and_fold():
    for n in range(1, 40):
        nodes = [hashlib.sha256(bytes([i])).digest() for i in range(n)]
        paths, root = merkle.append(nodes, (n - 1).bit_length())
        assert root.hex() == tree([x.hex() for x in nodes])[-1][0]
        assert all(merkle.fold(x, bytes(p)) == root for x, p in zip(nodes, paths))
        assert n == 1 or merkle.fold(nodes[0], bytes(paths[-1])) != root
