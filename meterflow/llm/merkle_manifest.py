"""Merkle manifest of a table: one tree per group, and one over the groups' roots.

Rows are ranked inside their group by a range-partitioned sort, and each aligned block of
4096 ranks is a tree of its own, so that no group, however large, meets in one task. Blocks'
roots are the leaves of the next tier, and so on up to the group's root; the groups' roots,
ranked likewise, give the root of all.

A block's tree is persistent: a changed leaf makes a version that copies the leaf's
ancestors inside the block and shares all other nodes. The version's block root goes on in
the tiers above along its block's path, which is worked out once for all the block's leaves.

Leaves are read twice, for the blocks' roots and, when the paths above are known, for the
proofs and versions; no list of siblings is ever shuffled with them.

Defined results: null is a group of its own and comes first, as do null ids; equal ids are
ordered by their leaves, and equal leaves may change places without a change in the tree.
A last node without a neighbour is hashed alone. One leaf alone is its group's root, one
group's root alone the root; a leaf without any sibling has the digest of nothing as proof.
No rows give no rows. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterflow.llm.common import kept

#: Levels of an aligned block: 2 to this power leaves.
LEVELS = 12


# -- a block's persistent tree -------------------------------------------------

def digest(*parts: str) -> str:
    return sha256("".join(parts).encode()).hexdigest()


class Node:
    """A digest over one or two nodes; never changed once made."""

    __slots__ = ("digest", "left", "right")

    def __init__(self, told: str, left: Node | None = None, right: Node | None = None):
        self.digest, self.left, self.right = told, left, right


def parent(left: Node, right: Node | None) -> Node:
    return Node(digest(left.digest, right.digest if right else ""), left, right)


def levels_of(total: int, most: int = LEVELS) -> int:
    """Levels that a block has in a row of ``total`` nodes: as many as make one of them."""
    return min(most, max(0, total - 1).bit_length())


def built(leaves: Iterable[str], levels: int) -> Node:
    """The block's tree."""
    nodes = [Node(x) for x in leaves]
    for _ in range(levels):
        pairs = iter(nodes)
        nodes = [parent(left, next(pairs, None)) for left in pairs]
    return nodes[0]


def path(root: Node, at: int, levels: int) -> list[str]:
    """What a leaf meets on its way up: R or L with a sibling's digest, or nothing."""
    met = []
    for level in reversed(range(levels)):
        if at >> level & 1:
            met.append("L" + root.left.digest)
            root = root.right
        else:
            met.append("R" + root.right.digest if root.right else "")
            root = root.left
    return met[::-1]


def version(root: Node, at: int, levels: int, leaf: str) -> Node:
    """The tree with another leaf: ancestors are copied, all other nodes are shared."""
    if not levels:
        return Node(leaf)
    if at >> (levels - 1) & 1:
        return parent(root.left, version(root.right, at, levels - 1, leaf))
    return parent(version(root.left, at, levels - 1, leaf), root.right)


def continued(told: str, met: Iterable[str]) -> str:
    """A node's version carried on along the path above it."""
    for sibling in met:
        told = digest(sibling[1:], told) if sibling.startswith("L") else digest(told, sibling[1:])
    return told


# -- ranks and tiers -----------------------------------------------------------

def ranked(rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The rows with ``at``, their place in the key's order from 0, and ``total``, its rows.

    Rows are sorted by ranges; a range holds few keys or a slice of one. Counts per range
    and key, not rows, are added up in order.
    """
    placed = rows.repartitionByRange(key, *order).sortWithinPartitions(key, *order)
    placed = kept(placed.withColumn("_place", F.monotonically_increasing_id()), "ranges")
    placed = placed.withColumn("_range", F.shiftright("_place", 33))
    slices = placed.groupBy(key, "_range").agg(F.min("_place").alias("_first"), F.count("*").alias("_n"))
    so_far = Window.partitionBy(key).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    slices = slices.select(key, "_range", "_first", F.coalesce(F.sum("_n").over(so_far), F.lit(0)).alias("_before"),
                           F.sum("_n").over(Window.partitionBy(key)).alias("total"))
    return placed.join(slices, [key, "_range"]).withColumn("at", F.col("_place") - F.col("_first") + F.col("_before")) \
        .drop("_place", "_range", "_first", "_before")


def _blocks(nodes: DataFrame, levels: int) -> DataFrame:
    return nodes.withColumn("block", F.shiftright("at", levels))


def _column(table: pa.Table, name: str) -> list:
    return table.column(name).to_pylist()


def _above(total: Column, levels: int) -> Column:
    return F.ceil(total / F.lit(1 << levels)).cast("long")


def block_roots(nodes: DataFrame, levels: int) -> DataFrame:
    """key, at, node and total of the next tier: each block's root."""

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        found = sorted(zip(_column(table, "at"), _column(table, "node"), strict=True))
        total = table.column("total")[0].as_py()
        root = built([n for _, n in found], levels_of(total, levels))
        return pa.table({"key": [key[0].as_py()], "at": [key[1].as_py()], "node": [root.digest], "total": [total]})

    roots = _blocks(nodes.select("key", "at", "node", "total"), levels).groupBy("key", "block").applyInArrow(
        run, "key string, at long, node string, total long")
    return roots.withColumn("total", _above(F.col("total"), levels))


def block_paths(nodes: DataFrame, levels: int) -> DataFrame:
    """key, at, block and path of every node inside its block."""

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        found = sorted(zip(_column(table, "at"), _column(table, "node"), strict=True))
        height = levels_of(table.column("total")[0].as_py(), levels)
        root, mask = built([n for _, n in found], height), (1 << levels) - 1
        return pa.table({"key": [key[0].as_py()] * len(found), "at": [a for a, _ in found], "block": [key[1].as_py()] * len(found),
                         "path": pa.array([path(root, a & mask, height) for a, _ in found], type=pa.list_(pa.string()))})

    return _blocks(nodes.select("key", "at", "node", "total"), levels).groupBy("key", "block").applyInArrow(
        run, "key string, at long, block long, path array<string>")


def _climbed(nodes: DataFrame, levels: int) -> tuple[DataFrame, DataFrame]:
    """key and node of each key's root; key, at and whole path of the given nodes to it."""
    tiers = [nodes]
    while (tiers[-1].agg(F.max("total")).first()[0] or 0) > 1:
        tiers.append(kept(block_roots(tiers[-1], levels), "nodes"))
    paths = tiers[-1].select("key", "at", F.array().cast("array<string>").alias("path"))
    for tier in reversed(tiers[:-1]):
        above = paths.select("key", F.col("at").alias("block"), F.col("path").alias("above"))
        paths = block_paths(tier, levels).join(above, ["key", "block"]).select("key", "at", F.concat("path", "above").alias("path"))
    return tiers[-1].select("key", "node"), paths


# -- the manifest --------------------------------------------------------------

def manifest(leaves: DataFrame, order: list[str], levels: int = LEVELS) -> DataFrame:
    """Each row of leaves with its subroot, root, proof and the root of its version.

    leaves: key (a group's name; groups are ordered by it), leaf, changed (the leaf of its
    changed version or null), and columns to carry on, those of ``order`` among them.
    Returns what is carried, leaf, subroot, root, proof (digests of the siblings, from the
    leaf up) and folded_root, worked out from the changed leaf, or else from the leaf.
    """
    carried = [c for c in leaves.columns if c not in ("key", "leaf", "changed")]
    placed = kept(ranked(leaves, "key", [*order, "leaf"]), "ranked-leaves")
    nodes = kept(block_roots(placed.withColumnRenamed("leaf", "node"), levels), "block-roots")
    subroots, paths = _climbed(nodes, levels)
    subroots = kept(subroots, "subroots")
    groups = ranked(subroots.select(F.lit("").alias("key"), F.col("key").alias("group"), "node"), "key", ["group"])
    groups = kept(groups, "groups")
    roots, group_paths = _climbed(groups.select("key", "at", "node", "total"), levels)
    of_group = groups.join(group_paths, ["key", "at"]).join(roots.withColumnRenamed("node", "root"), "key").select(
        F.col("group").alias("key"), F.col("node").alias("subroot"), "root", F.col("path").alias("top"))
    upper = kept(paths.join(of_group, "key").select(
        "key", F.col("at").alias("block"), "subroot", "root", F.concat("path", "top").alias("above")), "upper-paths")

    told = placed.select(*carried).schema
    mask = (1 << levels) - 1

    def run(table: pa.Table, block: pa.Table) -> pa.Table:
        table = table.sort_by("at")
        at, own, changed = _column(table, "at"), _column(table, "leaf"), _column(table, "changed")
        height = levels_of(table.column("total")[0].as_py(), levels) if at else 0
        above, subroot, root = ([_column(block, c)[0] for c in ("above", "subroot", "root")] if at else ([], None, None))
        top = [a[1:] for a in above if a]
        tree = built(own, height) if at else None
        proofs, folded = [], []
        for a, leaf, other in zip(at, own, changed, strict=True):
            proofs.append([p[1:] for p in path(tree, a & mask, height) if p] + top)
            if other is None:
                folded.append(root if continued(tree.digest, above) == root else None)
            else:
                folded.append(continued(version(tree, a & mask, height, other).digest, above))
        out = table.select([*carried, "leaf"])
        for name, values, kind in (("subroot", [subroot] * len(at), pa.string()), ("root", [root] * len(at), pa.string()),
                                   ("proof", proofs, pa.list_(pa.string())), ("folded_root", folded, pa.string())):
            out = out.append_column(name, pa.array(values, type=kind))
        return out

    schema = T.StructType([*told, *(T.StructField(c, T.ArrayType(T.StringType()) if c == "proof" else T.StringType())
                                    for c in ("leaf", "subroot", "root", "proof", "folded_root"))])
    return _blocks(placed, levels).groupBy("key", "block").cogroup(upper.groupBy("key", "block")).applyInArrow(run, schema)


def field(value: Column) -> Column:
    """A field as it enters a leaf: its bytes' number and its text, or a dash for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_of(**replaced: Column) -> Column:
    """The leaf of a row of documents, with some columns replaced."""
    fields = [field(replaced.get(c, F.col(c))) for c in ("doc_id", "source", "lang", "n_chars", "text")]
    return F.sha2(F.concat(*fields), 256)


def documents_manifest(docs: DataFrame, levels: int = LEVELS) -> DataFrame:
    """The manifest of documents by language, where every row whose id's crc32 is divisible
    by 7 is changed by adding 1 to n_chars.

    Returns doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.
    """
    tampered = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0, F.lit(False))
    more = (F.col("n_chars").cast("decimal(20,0)") + 1).cast("string")
    leaves = docs.select(
        F.coalesce(F.concat(F.lit("="), F.col("lang").cast("string")), F.lit("")).alias("key"), F.col("doc_id").cast("long").alias("doc_id"),
        F.monotonically_increasing_id().alias("row"), leaf_of().alias("leaf"), F.when(tampered, leaf_of(n_chars=more)).alias("changed"))
    found = manifest(kept(leaves, "leaves"), ["doc_id"], levels)
    return found.select("doc_id", "leaf", "subroot", "root", F.sha2(F.array_join("proof", ""), 256).alias("proof_sha256"),
                        "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


_FIELDS = " || ".join(f"coalesce(strlen({c}::VARCHAR) || ':' || {c}::VARCHAR, '-')" for c in ("doc_id", "source", "lang", "n_chars", "text"))
_CHANGED = _FIELDS.replace("n_chars::VARCHAR", "(n_chars::HUGEINT + 1)::VARCHAR")
_CRC = """xor(4294967295, list_reduce(list_concat([4294967295], list_transform(range(length(doc_id::VARCHAR)), lambda i: unicode(substr(doc_id::VARCHAR, i + 1, 1))::BIGINT)),
  lambda c, b: list_reduce(list_concat([xor(c, b)], range(8)), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))))"""


def _tree(name: str, leaves: str) -> str:
    """Recursive levels of all groups' trees: grp, level, pos, node."""
    return f"""{name} AS (SELECT grp, 0 AS level, pos, node, total FROM {leaves}
 UNION ALL SELECT grp, any_value(level) + 1, pos // 2, sha256(string_agg(node, '' ORDER BY pos)), any_value(total + 1) // 2
  FROM {name} WHERE total > 1 GROUP BY grp, pos // 2)"""


#: The same as SQL.
ORACLE = f"""WITH RECURSIVE
leaf AS (SELECT doc_id, CASE WHEN lang IS NULL THEN '' ELSE '=' || lang END AS grp, sha256({_FIELDS}) AS node,
  CASE WHEN coalesce({_CRC} % 7 = 0, false) THEN sha256({_CHANGED}) END AS changed FROM documents),
placed AS (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, node) - 1 AS pos, count(*) OVER (PARTITION BY grp) AS total FROM leaf),
{_tree("low", "placed")},
subroot AS (SELECT grp, node FROM low WHERE total = 1),
ordered AS (SELECT '' AS grp, grp AS lang, node, row_number() OVER (ORDER BY encode(grp)) - 1 AS pos, count(*) OVER () AS total FROM subroot),
{_tree("high", "ordered")},
way AS (
 SELECT p.doc_id, p.grp, p.pos AS leaf_pos, l.level, p.pos >> l.level AS pos, s.node AS sibling
 FROM placed p JOIN (SELECT DISTINCT grp, level FROM low WHERE total > 1) l USING (grp)
 LEFT JOIN low s ON s.grp = p.grp AND s.level = l.level AND s.pos = xor(p.pos >> l.level, 1)
 UNION ALL
 SELECT p.doc_id, p.grp, p.pos, 1000 + l.level, o.pos >> l.level, s.node
 FROM placed p JOIN ordered o ON o.lang = p.grp CROSS JOIN (SELECT DISTINCT level FROM high WHERE total > 1) l
 LEFT JOIN high s ON s.level = l.level AND s.pos = xor(o.pos >> l.level, 1)),
step AS (SELECT *, row_number() OVER (PARTITION BY grp, leaf_pos ORDER BY level) AS k FROM way),
fold AS (SELECT grp, pos AS leaf_pos, 0 AS k, coalesce(changed, node) AS node FROM placed
 UNION ALL SELECT f.grp, f.leaf_pos, f.k + 1, sha256(CASE WHEN s.pos % 2 = 1 THEN s.sibling || f.node ELSE f.node || coalesce(s.sibling, '') END)
 FROM fold f JOIN step s ON s.grp = f.grp AND s.leaf_pos = f.leaf_pos AND s.k = f.k + 1),
folded AS (SELECT grp, leaf_pos, arg_max(node, k) AS folded_root FROM fold GROUP BY ALL),
proof AS (SELECT grp, leaf_pos, sha256(coalesce(string_agg(sibling, '' ORDER BY k), '')) AS proof_sha256 FROM step GROUP BY ALL)
SELECT p.doc_id, p.node AS leaf, r.node AS subroot, h.node AS root, coalesce(proof_sha256, sha256('')) AS proof_sha256, folded_root, folded_root = h.node AS verified
FROM placed p JOIN subroot r USING (grp) CROSS JOIN (SELECT node FROM high WHERE total = 1) h
JOIN folded f ON f.grp = p.grp AND f.leaf_pos = p.pos LEFT JOIN proof q ON q.grp = p.grp AND q.leaf_pos = p.pos"""
