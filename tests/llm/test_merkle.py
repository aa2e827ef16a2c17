"""The manifest against a plain tree and its SQL."""

import zlib
from hashlib import sha256

import pytest

from meterflow.llm import merkle_manifest as m
from meterflow.llm.common import table
from tests.compare import compare, duck

DOCS = "doc_id long, source string, lang string, n_chars long, text string"


def H(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def plain(rows):
    """(doc_id, leaf, subroot, root, proof, folded, verified) of every row, tree by tree."""
    def leaf(r, more=0):
        told = [r[0], r[1], r[2], None if r[3] is None else r[3] + more, r[4]]
        return H("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in told))

    def climb(nodes):
        """Levels of a tree and, of each leaf, its siblings with their side."""
        levels = [list(nodes)]
        while len(levels[-1]) > 1:
            levels.append([H(*levels[-1][i:i + 2]) for i in range(0, len(levels[-1]), 2)])
        ways = []
        for i in range(len(nodes)):
            ways.append([])
            for level in levels[:-1]:
                j = i ^ 1
                ways[-1].append((j < i, level[j]) if j < len(level) else (False, ""))
                i //= 2
        return levels[-1][0], ways

    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append(r)
    order = sorted(groups, key=lambda k: (k is not None, (k or "").encode()))
    trees = []
    for k in order:
        found = sorted(groups[k], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees.append((found, *climb([leaf(r) for r in found])))
    root, tops = climb([t[1] for t in trees]) if trees else (None, [])
    out = []
    for (found, subroot, ways), top in zip(trees, tops, strict=True):
        for r, way in zip(found, ways, strict=True):
            told = leaf(r, int(r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0))
            for left, sibling in way + top:
                told = H(sibling, told) if left else H(told, sibling)
            out.append((r[0], leaf(r), subroot, root, H(*[s for _, s in way + top]), told, told == root))
    return sorted(out, key=repr)


COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


@pytest.mark.parametrize("levels", [1, 3, 12])
def test_odd_rows_against_a_plain_tree(spark, levels):
    rows = [(i, f"s{i % 3}", ["en", "fr", None, "é", ""][i % 5], i * 7, "text é" * (i % 4)) for i in range(83)]
    rows += [(5, "s", "en", None, None), (5, "s", "en", None, None), (None, None, None, None, None), (None, None, "de", 3, "x" * 100_000)]
    docs = spark.createDataFrame([(*r, "a", "b", 1) for r in rows], DOCS + ", leaf string, key string, at int").repartition(4)
    got = m.documents_manifest(docs, levels)
    assert sorted(map(tuple, got.select(*COLUMNS).collect()), key=repr) == plain(rows)


def test_few_rows(spark):
    for rows in ([], [(7, "a", "en", 1, "x")], [(7, "a", "en", 1, "x"), (8, "a", None, 1, "y")]):
        got = m.documents_manifest(spark.createDataFrame(rows, DOCS))
        assert sorted(map(tuple, got.select(*COLUMNS).collect()), key=repr) == plain(rows)


def test_the_given_table_equals_its_sql_and_the_plain_tree(spark, sf_dir):
    assert compare(spark, duck(sf_dir), "op12", lambda s, d: m.documents_manifest(table(s, d, "documents"), 4), m.ORACLE, sf_dir) is None
    docs = table(spark, sf_dir, "documents")
    rows = [tuple(r) for r in docs.select("doc_id", "source", "lang", "n_chars", "text").collect()]
    got = sorted(map(tuple, m.documents_manifest(docs).select(*COLUMNS).collect()), key=repr)
    assert got == plain(rows) and 0 < sum(not r[-1] for r in got) < len(got) / 3


def test_versions_share_what_they_do_not_change():
    leaves = [H(str(i)) for i in range(13)]
    tree = m.built(leaves, 4)

    def nodes(n):
        return {id(n)} | nodes(n.left) | (nodes(n.right) if n.right else set()) if n.left else {id(n)}

    for at in range(13):
        other = m.version(tree, at, 4, H("other"))
        assert len(nodes(other) - nodes(tree)) == 5
        changed = m.built([H("other") if i == at else x for i, x in enumerate(leaves)], 4)
        assert other.digest == changed.digest == m.continued(H("other"), m.path(tree, at, 4))
        assert m.continued(leaves[at], m.path(other, at, 4)) != other.digest


def test_a_large_group_is_dealt_out(spark):
    """Ranks of one group come from ranges, and no block holds more than its leaves."""
    rows = spark.range(3000).selectExpr("'g' AS key", "id % 1500 AS doc_id", "sha2(cast(id AS string), 256) AS leaf")
    placed = m.ranked(rows, "key", ["doc_id", "leaf"])
    assert sorted(r.at for r in placed.collect()) == list(range(3000))
    blocks = m.block_roots(placed.withColumnRenamed("leaf", "node"), 5)
    assert blocks.count() == 94 and blocks.first().total == 94
