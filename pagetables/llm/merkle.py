"""Merkle manifest with incremental witnesses (operator 12).

A group's leaves lie in id order and are dealt into aligned blocks of
``2**LEVELS``.  A block's task appends its leaves one by one: open subtrees stand
on a stack, a new one of equal height completes its sibling, and the witness of
each leaf on either side grows by the other side's digest.  The block's root is
then an append itself, to blocks of blocks, until each group has one root; the
groups' roots, in group order, are the appends of the tree on top.  A leaf's
path is its own block's witness, then that of its block's root, and so on:
paths above a block are kept once a block.

A digest is the SHA-256 of its children's lower-case hex digests, concatenated; a
node without a sibling is the digest of itself alone.  Digests travel as 32 bytes.
A witness is a byte string of entries, from the leaf up: ``L`` or ``R`` and the
sibling on that side, or ``-`` where there is none.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from pagetables.llm.tables import stored

LEVELS = 10     # a block has at most 2**LEVELS nodes
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")

def _up(*children: bytes) -> bytes:
    return hashlib.sha256("".join([c.hex() for c in children]).encode()).digest()


def append(nodes: list[bytes], levels: int) -> tuple[list[bytearray], bytes]:
    """Witnesses of a block's nodes and its root, ``levels`` above them."""
    paths = [bytearray() for _ in nodes]
    open_: list[tuple[int, bytes, int, int]] = []     # height, digest, first and end of the subtree's nodes

    def grow(first, end, entry):
        for k in range(first, end):
            paths[k] += entry

    def close(right):
        """The subtree joins its open sibling, if that is complete."""
        height, digest, first, end = right
        _, left, start, _ = open_.pop()
        grow(start, first, b"R" + digest)
        grow(first, end, b"L" + left)
        return height + 1, _up(left, digest), start, end

    for k, node in enumerate(nodes):
        tree = (0, node, k, k + 1)
        while open_ and open_[-1][0] == tree[0]:
            tree = close(tree)
        open_.append(tree)
    tree = open_.pop()
    while tree[0] < levels:                           # the block is complete: what stands alone is lifted
        if open_ and open_[-1][0] == tree[0]:
            tree = close(tree)
        else:
            grow(tree[2], tree[3], b"-")
            tree = (tree[0] + 1, _up(tree[1]), tree[2], tree[3])
    return paths, tree[1]


def fold(node: bytes, path: bytes) -> bytes:
    """The root that a node and its path give."""
    at = 0
    while at < len(path):
        side = path[at:at + 1]
        if side == b"-":
            node, at = _up(node), at + 1
        else:
            other = path[at + 1:at + 33]
            node, at = _up(other, node) if side == b"L" else _up(node, other), at + 33
    return node


def siblings(path: bytes) -> list[bytes]:
    """The digests of a path, from the leaf up."""
    out, at = [], 0
    while at < len(path):
        alone = path[at:at + 1] == b"-"
        if not alone:
            out.append(path[at + 1:at + 33])
        at += 1 if alone else 33
    return out


def _append_blocks(levels: int):
    """Rows sorted by group and position: each with its witness in its block, and each block's root."""
    def run(batches):
        held, now = [], None

        def out():
            t = pa.Table.from_batches(held).combine_chunks()
            total = t.column("total")[0].as_py()
            paths, root = append(t.column("node").to_pylist(), min(levels, (total - 1).bit_length()))
            t = t.append_column("root", pa.array([False] * t.num_rows)) \
                .append_column("path", pa.array(map(bytes, paths), pa.binary()))
            one = {"grp": now[0], "pos": now[1], "total": -(-total // (1 << levels)), "node": root, "root": True}
            yield from t.to_batches()
            yield pa.RecordBatch.from_arrays([pa.array([one.get(f.name)], f.type) for f in t.schema], schema=t.schema)

        for b in batches:
            where = list(zip(b.column(0).to_pylist(), (b.column(1).to_numpy() >> levels).tolist()))
            i = 0
            while i < len(where):
                j = i + 1
                while j < len(where) and where[j] == where[i]:
                    j += 1
                if where[i] != now:
                    if held:
                        yield from out()
                    held, now = [], where[i]
                held.append(b.slice(i, j - i))
                i = j
        if held:
            yield from out()
    return run


def _grown(nodes: DataFrame, levels: int) -> tuple[DataFrame, DataFrame]:
    """One step over ``(grp, pos, total, node, ...)``: each node's witness in its block, and the blocks' roots as nodes."""
    nodes = nodes.select("grp", "pos", "total", "node", *[c for c in nodes.columns if c not in ("grp", "pos", "total", "node")])
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in nodes.schema)
    done = stored(nodes.withColumn("block", F.shiftright("pos", levels))
                  .repartition("grp", "block").sortWithinPartitions("grp", "pos").drop("block")
                  .mapInArrow(_append_blocks(levels), f"{schema}, root boolean, path binary"), "witnesses")
    return done.filter("not root").drop("root"), done.filter("root").select("grp", "pos", "total", "node")


def placed(rows: DataFrame, order: list[str]) -> DataFrame:
    """``pos`` (from 0, in ``order`` inside ``grp``) and the group's ``total``, without a group in one task.

    Rows are sorted by range, which splits a group of any size (``order`` has to tell rows apart); a
    row's place is its place in its part of the group and the rows of the group in the parts before."""
    s = rows.repartitionByRange("grp", *order).sortWithinPartitions("grp", *order) \
        .withColumn("part", F.spark_partition_id()) \
        .withColumn("at", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1))
    s = stored(s, "sorted")
    before = W.partitionBy("grp").orderBy("part").rowsBetween(W.unboundedPreceding, -1)     # one row a part
    parts = s.groupBy("grp", "part").agg(F.min("at").alias("lo"), F.count("*").alias("n")) \
        .withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))) \
        .withColumn("total", F.sum("n").over(W.partitionBy("grp")))
    return s.join(parts, ["grp", "part"]) \
        .withColumn("pos", F.col("before") + F.col("at") - F.col("lo")).drop("part", "at", "lo", "n", "before")


def _tree(nodes: DataFrame, levels: int) -> tuple[list[DataFrame], DataFrame]:
    """Every step's witnesses (at least one step is made), and one root a group."""
    steps = []
    while not steps or nodes.filter("total > 1").take(1):
        own, nodes = _grown(nodes, levels)
        steps.append(own.drop("node") if steps else own)
    return steps, nodes


def field(c: str) -> Column:
    """A value as it enters a leaf: ``-`` for null, else its UTF-8 length, a colon and the value."""
    v = F.col(c).cast("string")
    return F.when(v.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v))


def manifest(docs: DataFrame, columns=COLUMNS, id_col: str = "doc_id", group_col: str = "lang",
             more: dict[str, Column] | None = None, levels: int = LEVELS) -> DataFrame:
    """One row per row: the id, ``leaf, subroot, root`` (32 bytes each), ``path``, and the columns ``more``.

    A leaf is the SHA-256 of the ``columns``, each as ``field`` writes it.  In a group
    leaves ascend by id (null first), rows of one id by leaf, equal rows among
    themselves in any order.  Groups are ordered by their UTF-8 bytes, null first.
    A table of one row has itself as subroot and root and an empty path; an empty
    table gives no rows.  Texts are hashed whole; other columns are ignored.
    """
    grp = F.when(F.col(group_col).isNull(), F.lit("")).otherwise(F.concat(F.lit("+"), F.col(group_col).cast("string")))
    leaf = F.unhex(F.sha2(F.concat(*map(field, columns)), 256))
    keep = more or {}
    rows = stored(docs.select(grp.alias("grp"), F.col(id_col).cast("long").alias("doc_id"), leaf.alias("node"),
                              *[c.alias(f"more_{n}") for n, c in keep.items()])
                  .withColumn("row", F.monotonically_increasing_id()), "leaves")
    leaves = placed(rows, ["doc_id", "node", "row"]).drop("row")
    steps, roots = _tree(leaves, levels)
    tops = placed(roots.select(F.lit("").alias("grp"), F.col("grp").alias("of"), "node"), ["of"])
    above, root = _tree(tops, levels)
    top = root.first()

    def down(steps: list[DataFrame], path: DataFrame) -> DataFrame:
        """The first step's nodes with their whole paths, given the path above the last step's blocks."""
        for own in reversed(steps):
            at = own.withColumn("block", F.shiftright("pos", levels)).withColumnRenamed("path", "lower")
            path = at.join(path.withColumnRenamed("pos", "block"), ["grp", "block"]) \
                .withColumn("path", F.concat("lower", "path")).drop("block", "lower", "total")
        return path

    upper = down(above, root.select("grp", "pos", F.lit(b"").alias("path"))) \
        .select(F.col("of").alias("grp"), F.lit(0).cast("long").alias("pos"), "path", F.col("node").alias("subroot"))
    out = down(steps, stored(upper, "upper"))
    return out.select("doc_id", F.col("node").alias("leaf"), "subroot",
                      F.lit(bytes(top.node) if top else None).cast("binary").alias("root"), "path",
                      *[F.col(f"more_{n}").alias(n) for n in keep])


def _check(batches):
    for b in batches:
        col = {n: b.column(i).to_pylist() for i, n in enumerate(b.schema.names)}
        found = [fold(t or x, p) for x, t, p in zip(col["leaf"], col["tampered"], col["path"])]
        proof = [hashlib.sha256("".join([s.hex() for s in siblings(p)]).encode()).hexdigest() for p in col["path"]]
        text = {n: [x.hex() for x in col[n]] for n in ("leaf", "subroot", "root")}
        yield pa.RecordBatch.from_pydict(
            {"doc_id": b.column(b.schema.get_field_index("doc_id")), **text, "proof_sha256": proof,
             "folded_root": [x.hex() for x in found], "verified": [x == r for x, r in zip(found, col["root"])]})


def audited(docs: DataFrame) -> DataFrame:
    """The manifest of ``documents`` and a check of every witness against rows some of which were tampered with.

    Where 7 divides the unsigned CRC-32 of the decimal id, ``n_chars`` is one more
    (a null stays); a null id has no CRC and is left alone."""
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    more = F.concat(*[field(c) if c != "n_chars" else _longer(c) for c in COLUMNS])
    tampered = F.when(hit & F.col("n_chars").isNotNull(), F.unhex(F.sha2(more, 256)))
    rows = manifest(docs, more={"tampered": tampered})
    return rows.select("doc_id", "leaf", "tampered", "subroot", "root", "path").mapInArrow(
        _check, "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean")


def _longer(c: str) -> Column:
    v = (F.col(c).cast("decimal(20, 0)") + 1).cast("string")
    return F.concat(F.octet_length(v).cast("string"), F.lit(":"), v)
