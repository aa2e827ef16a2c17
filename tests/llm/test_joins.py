"""Near-copy groups, components and exact search against brute force."""

import random
import re
import time
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from meterflow.llm import common, components, jaccard_groups, knn_kdtree
from meterflow.llm.common import table
from tests.helpers import plan


def words_of(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [w for w in re.split(r"[\x20\x09-\x0D]+", lower) if w]


def sets_of(text, k):
    w = words_of(text)
    return frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])


def labels(nodes, pairs):
    parent = {x: x for x in nodes}

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {x: root(x) for x in nodes}


def expected(rows, k, num, den):
    sets = [sets_of(t, k) for _, t in rows]
    having = defaultdict(list)
    for i, s in enumerate(sets):
        for t in s:
            having[t].append(i)
    pairs = []
    for i, s in enumerate(sets):
        common = Counter(j for t in s for j in having[t] if j < i)
        pairs += [(j, i) for j, o in common.items() if den * o >= num * (len(s) + len(sets[j]) - o)]
    label = labels(range(len(rows)), pairs)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[label[i]] = min(least.get(label[i], doc_id), doc_id)
    return sorted(((d, len(sets[i]), least.get(label[i])) for i, (d, _) in enumerate(rows)), key=str)


def found(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_shingles", "component_id").collect()), key=str)


def test_shingles_equal_sets_of_words():
    rng = random.Random(2)
    texts = [None, "", " \n", "One", "one two", "É é", "a b c d", "A B c d e", "a b c d e a b c d e"] + [
        " ".join(rng.choice("ab cd EF g\th i\nj k\x0bl".split(" ")) for _ in range(rng.randint(0, 40))) for _ in range(300)]
    for k in (1, 4, 5):
        got = jaccard_groups.shingles(*jaccard_groups.hashed(pa.array(texts)), k)
        names = {}
        for text, tokens in zip(texts, got, strict=True):
            want = sets_of(text, k)
            assert len(tokens) == len(want), repr(text)
            assert names.setdefault(tokens.tobytes(), want) == want
        assert len(names) == len({sets_of(t, k) for t in texts})


def test_six_bytes_keep_order_and_overlap():
    rng = np.random.default_rng(1)
    a, b = (np.unique(rng.integers(0, 1 << 63, 300, dtype=np.uint64)) for _ in range(2))
    b = np.unique(np.concatenate((b, a[:120])))
    one, two = jaccard_groups.long(jaccard_groups.short(a)), jaccard_groups.long(jaccard_groups.short(b))
    assert (np.diff(one.astype(np.int64)) > 0).all() and (one == a >> np.uint64(16)).all()
    assert jaccard_groups.overlap(one, two) == jaccard_groups.overlap(two, one) == 120
    assert jaccard_groups.overlap(one, one[:0]) == 0


def test_groups_of_near_copies(spark):
    """One large group of near copies, chains, exact copies, a passage that all share."""
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7)))
    passage = " ".join(word() for _ in range(30))
    rows = []
    base = [word() for _ in range(120)]
    for _ in range(150):
        copy = list(base)
        for _ in range(rng.randint(0, 4)):
            copy[rng.randrange(len(copy))] = word()
        rows.append(" ".join(copy))
    for _ in range(60):
        rows.append(passage + " " + " ".join(word() for _ in range(rng.randint(30, 90))))
    chain = [word() for _ in range(200)]
    for _ in range(12):
        rows.append(" ".join(chain))
        chain = chain[3:] + [word() for _ in range(3)]
    rows += [rows[3]] * 5 + [passage] * 3 + [None, "", "one two", "one two", "ONE two", "x " * 30_000]
    rng.shuffle(rows)
    docs = [(i * 3 % 1009, t) for i, t in enumerate(rows)] + [(None, rows[0]), (5000, rows[0]), (5000, rows[0])]
    df = spark.createDataFrame([(i, t, 1, 2) for i, t in docs], "doc_id long, text string, n_shingles int, key int").repartition(5)
    for k, num, den in ((4, 85, 100), (5, 4, 5)):
        assert found(jaccard_groups.linked(df, k, num, den)) == expected(docs, k, num, den)


def test_odd_tables(spark):
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "a b")], "doc_id long, text string")
    assert found(jaccard_groups.linked(odd)) == [(1, 0, 1), (2, 0, 2), (3, 1, 3)]
    assert jaccard_groups.linked(odd.limit(0)).count() == 0


def test_one_of_each_group_stays(spark):
    text = " ".join(f"word{i}" for i in range(40))
    rows = [(4, text, "s"), (2, text, "s"), (2, text, "s"), (7, text + " more", "s"), (9, "other text of its own here", "s"), (10, None, "s"), (None, "no id", "s")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    kept = jaccard_groups.one_of_each(df)
    assert kept.columns == df.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == [10, 2, 9, None]


def test_one_of_each_without_ids_or_with_repeated_ones(spark):
    near = " ".join(f"word{i}" for i in range(40))
    other = " ".join(f"else{i}" for i in range(40))
    rows = [(None, near, "a"), (None, near + " more", "b"), (5, near + " again", "c"), (5, other, "d"), (3, other + " x", "e"), (7, other, "f"),
            (None, "lone words without an id here", "g"), (None, None, "h"), (8, "", "i"), (9, near + " y", "j")]
    df = spark.createDataFrame(rows, "doc_id long, text string, row_0 string")
    kept = jaccard_groups.one_of_each(df)
    assert kept.columns == df.columns and sorted(r.row_0 for r in kept.collect()) == ["c", "e", "g", "h", "i"]
    without = df.where("doc_id is null and text like 'word%'")
    assert jaccard_groups.one_of_each(without).count() == 1 and jaccard_groups.one_of_each(df.limit(0)).count() == 0


def test_a_cluster_of_many_variants_is_one_component(spark, sf_dir):
    """Members differ from a common text in places of their own: few pairs link, all are reachable."""
    rng = random.Random(9)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(400):
        words = list(base)
        for at in rng.sample(range(120), rng.choice([1, 1, 2])):
            words[at] = f"x{i}_{at}"
        rows.append((i, " ".join(words)))
    passage = [f"p{i}" for i in range(60)]
    rows += [(1000 + i, " ".join(passage + [f"own{i}_{j}" for j in range(60)])) for i in range(400)]     # half in common: no link
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    got = {r.doc_id: r.component_id for r in jaccard_groups.linked(df, 4, 85, 100).collect()}
    sets = {i: {tuple(t.split()[j:j + 4]) for j in range(len(t.split()) - 3)} for i, t in rows}
    pairs = [(a, b) for a in sets for b in sets if a < b < 1000 and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])]
    assert got == labels(set(sets), pairs) | {i: i for i in sets if i >= 1000}


@pytest.mark.parametrize("seed", [1, 2])
def test_components_equal_union_find(spark, seed):
    rng = random.Random(seed)
    pairs = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)] + [(i, i + 1) for i in range(1000, 1100)] + [(7, 2000 + i) for i in range(300)] + [(5, 5)]
    got = {r.node: r.label for r in components.components(spark.createDataFrame(pairs, "a long, b long"), "a", "b").collect()}
    linked = {x for a, b in pairs if a != b for x in (a, b)}
    want = labels(linked, [p for p in pairs if p[0] != p[1]])
    assert got == want
    assert components.components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


def test_links_of_many_tasks_and_of_one_have_the_same_components(spark, monkeypatch):
    rng = random.Random(3)
    pairs = [(rng.randrange(60), rng.randrange(60)) for _ in range(25)] + [(100 + i, 101 + i) for i in range(30)] + [(9, 200 + i) for i in range(20)]
    df = spark.createDataFrame(pairs, "a long, b long").repartition(8)
    want = labels({x for a, b in pairs if a != b for x in (a, b)}, [p for p in pairs if p[0] != p[1]])
    spark.sparkContext.setJobGroup("few links", "few links")
    got = components.components(df, "a", "b")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    tracker = spark.sparkContext.statusTracker()
    assert len(tracker.getJobIdsForGroup("few links")) <= 6    # turns of shuffles took more
    assert {r.node: r.label for r in got.collect()} == want
    monkeypatch.setattr(components, "FOREST", 16)
    several = components.components(df, "a", "b").collect()
    assert len(several) == len(want) and {r.node: r.label for r in several} == want


def test_only_wanted_texts_are_taken_to_sets_again(spark):
    texts = ["a b c d e", "A b c d E", "f g h i j", None, "", "k l m n o"]
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    wanted = jaccard_groups.marked(docs.where("text in ('A b c d E', 'k l m n o')")).select("mark")
    got = {r.key: r.n for r in jaccard_groups.full_sets(docs, 4, wanted).collect()}
    want = [jaccard_groups.key_of(t) for t in jaccard_groups.shingles(*jaccard_groups.hashed(pa.array(["a b c d e", "k l m n o"])), 4)]
    assert got == dict.fromkeys(want, 2)


def nearest(rows, k, every):
    usable = [(i, np.floor(256 * np.array(v, dtype=np.float64)).astype(object)) for i, v in rows
              if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for a, (i, q) in enumerate(usable):
        if i is None or i % every:
            continue
        scores = [(-int(q @ v), 1 << 62 if j is None else j, j) for b, (j, v) in enumerate(usable) if b != a and len(v) == len(q)]
        out += [(i, r + 1, j, -s) for r, (s, _, j) in enumerate(sorted(scores, key=lambda x: x[:2])[:k])]
    return sorted(out, key=str)


def test_search_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(knn_kdtree, "SHARD_ROWS", 150)
    monkeypatch.setattr(knn_kdtree, "LEAF", 8)
    rng = np.random.default_rng(3)
    rows = [(i, (rng.integers(-6, 7, 5) / 8).tolist()) for i in range(700)]
    rows += [(i, rows[3][1]) for i in range(1000, 1040)] + [(50, rows[50][1]), (None, [1.0] * 5), (800, None), (850, [1.0, None, 0.0, 0.0, 0.0]),
                                                           (900, [float("nan")] * 5), (950, [float("inf")] * 5), (600, [0.5, 0.25]), (2000, []), (2050, [])]
    df = spark.createDataFrame([(i, v, 1, 0) for i, v in rows], "vec_id long, embedding array<float>, row int, score int").repartition(4)
    assert sorted((tuple(r) for r in knn_kdtree.search(df, 5, 10).collect()), key=str) == nearest(rows, 5, 10)
    assert knn_kdtree.search(df.limit(0)).count() == 0
    few = df.where("vec_id in (10, 11)")
    assert sorted(tuple(r)[:3] for r in knn_kdtree.search(few, 5, 10).collect()) == [(10, 1, 11)]


def test_boxes_bound_and_leaves_hold_all_rows():
    rng = np.random.default_rng(4)
    v = rng.integers(-300, 300, (1000, 6))
    tree = knn_kdtree.Tree(np.arange(1000), np.arange(1000), v)
    leaves = [i for i in range(len(tree.nodes)) if tree.left[i] < 0]
    assert sorted(x for i in leaves for x in tree.rows[slice(*tree.nodes[i])]) == list(range(1000))
    for (a, b), low, high in zip(tree.nodes, tree.low, tree.high, strict=True):
        assert (tree.v[a:b].min(axis=0) == low).all() and (tree.v[a:b].max(axis=0) == high).all()


def test_large_values_are_exact(spark):
    rows = [(0, [3e6, 1.0]), (1, [3e6, 2.0]), (2, [3e6, 3.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted(tuple(r) for r in knn_kdtree.search(df, 2).collect())
    assert got == nearest(rows, 2, 50)


@pytest.mark.parametrize("query", [[1.0, 1.0], [1 / 256, 1 / 256], [-1 / 256, 1 / 256]])
def test_values_up_to_a_long_keep_rank_and_score(spark, query):
    rows = [(0, query), (1, [2.0**33, 2.0**33]), (2, [2.0**34, 2.0**34]), (3, [2.0**34, 2.0**33]), (4, [-2.0**34, 1.0]), (5, [0.5, 2.0**34 + 4])]
    if abs(query[0]) < 1:
        rows += [(6, [2.0**50, 2.0**50]), (7, [2.0**50, 2.0**50 + 1024]), (8, [-2.0**50, 2.0**50])]
    unusable = [(9, [2.0**56, 1.0]), (10, [1e300, -1e300])]     # no whole number of a long
    df = spark.createDataFrame(rows + unusable, "vec_id long, embedding array<double>")
    assert sorted((tuple(r) for r in knn_kdtree.search(df, 5).collect()), key=str) == nearest(rows, 5, 50)


def test_scores_beyond_a_long_are_the_nearest_long(spark):
    rows = [(0, [2.0**54, 0.0]), (1, [2.0**54, 1.0]), (2, [-2.0**54, 1.0]), (3, [1.0, 1.0])]
    got = knn_kdtree.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), 5).collect()
    assert [(r.vec_id, r.score) for r in sorted(got)] == [(1, 2**63 - 1), (3, 2**63 - 1), (2, -2**63)]


def test_search_sends_no_table_to_the_driver(spark, monkeypatch):
    """Queries that go to many shards were broadcast as often as there are shards."""
    monkeypatch.setattr(knn_kdtree, "SHARD_ROWS", 20)
    rng = np.random.default_rng(5)
    rows = [(i, (rng.integers(-6, 7, 4) / 8).tolist()) for i in range(3000)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    got = knn_kdtree.search(df, 5, 50)
    assert sorted((tuple(r) for r in got.collect()), key=str) == nearest(rows, 5, 50)
    assert "Broadcast" not in plan(got) and "collect_list" not in plan(got)


def test_queries_go_to_a_bounded_number_of_lanes(spark, monkeypatch):
    sent, searched = [], knn_kdtree._searched

    def told(queries, members, lanes, k):
        sent.append((queries.count(), members.count(), lanes))
        return searched(queries, members, lanes, k)

    for name, value in {"_searched": told, "SHARD_ROWS": 10, "GROUPS": 4, "CHUNK_ROWS": 8, "PART_BYTES": 400, "TASKS": 3}.items():
        monkeypatch.setattr(knn_kdtree, name, value)
    rng = np.random.default_rng(6)
    rows = [(i, (rng.integers(-6, 7, 3) / 8).tolist()) for i in range(400)] + [(i, (rng.integers(-6, 7, 2) / 8).tolist()) for i in range(400, 500)]
    rows += [(i, [0.5]) for i in range(501, 510)]    # no query has this length
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    assert sorted((tuple(r) for r in knn_kdtree.search(df, 5, 10).collect()), key=str) == nearest(rows, 5, 10)
    (first, _, chunks), (rest, members, lanes) = sent
    assert first == 50 and chunks == 5 + 2     # 40 and 10 queries
    assert rest <= 50 * 4 and lanes <= 4 * (3 + 1)
    assert members <= 3 * 400 + 100


@pytest.mark.parametrize("scale", [1, 1 << 17, 1 << 27, 1 << 40])
def test_blocks_of_queries_search_a_tree_exactly(monkeypatch, scale):
    """Ties, equal rows, bounds from elsewhere and candidates cut on the way, for every kind of number."""
    monkeypatch.setattr(knn_kdtree, "LEAF", 8)
    monkeypatch.setattr(knn_kdtree, "BLOCK_ROWS", 2)
    rng = np.random.default_rng(7)
    v = rng.integers(-4, 5, (300, 3)) * scale
    v[100:200] = v[100]
    rows, ids = rng.permutation(300), rng.integers(0, 120, 300)
    q, own = np.concatenate([v[90:110], -v[:20]]), np.concatenate([rows[90:110], np.full(20, -1)])
    scores = q.astype(object) @ v.T.astype(object)
    least = np.full(len(q), np.iinfo(np.int64).min)
    least[::3] = [max(-(1 << 63), min((1 << 63) - 1, sorted(x)[-9])) for x in scores[::3]]
    at, score, found_ids = knn_kdtree.Tree(rows, ids, v).search(own, q, least, 5)
    for i, (own_row, bound) in enumerate(zip(own, least, strict=True)):
        want = sorted((-s, j) for s, j, r in zip(scores[i], ids, rows, strict=True) if r != own_row and (bound == np.iinfo(np.int64).min or s >= bound))[:5]
        assert [(max(-(1 << 63), min((1 << 63) - 1, -s)), j) for s, j in want] == list(zip(score[at == i].tolist(), found_ids[at == i].tolist(), strict=True))


def test_whole_table_links(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert found(jaccard_groups.linked(docs)) == expected(rows, 5, 4, 5)
    assert docs.select(F.count("*")).first()[0] == len(rows)


def test_tables_of_steps_are_dropped_once_they_are_used(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(common, "shared_folder", lambda spark, name: f"{tmp_path}/{name}/{len(list(tmp_path.glob('*/*')))}-{time.time_ns()}")
    words = [f"w{i}" for i in range(60)]
    docs = [(i, " ".join(words[:-1] + [f"x{i % 7}"])) for i in range(40)] + [(i, f"a{i} b{i} c{i} d{i} e{i}") for i in range(40, 60)]
    got = jaccard_groups.linked(spark.createDataFrame(docs, "doc_id long, text string"), 4, 85, 100)
    assert {r.doc_id: r.component_id for r in got.collect()} == {i: 0 if i < 40 else i for i in range(60)}
    left = sorted(p.parent.name for p in tmp_path.glob("*/*"))
    assert left == ["answered-links", "far", "groups", "ids", "prefixes"]


def test_tables_of_steps_have_no_more_files_than_their_writers(spark, tmp_path, monkeypatch):
    """However many shuffle partitions there are; each table is looked at when it is written."""
    files, write = {}, common.kept

    def told(df, name, *more, **named):
        table = write(df, name, *more, **named)
        files[f"{name} {len(files)}"] = len(table.inputFiles())
        return table

    monkeypatch.setattr(jaccard_groups, "kept", told)
    monkeypatch.setattr(jaccard_groups, "writers", lambda docs: 3, raising=False)
    words = [f"w{i}" for i in range(60)]
    docs = [(i, " ".join(words[:-1] + [f"x{i % 7}"])) for i in range(40)] + [(i, f"a{i} b{i} c{i} d{i} e{i}") for i in range(40, 160)]
    df = spark.createDataFrame(docs, "doc_id long, text string").coalesce(2)
    before = {c: spark.conf.get(c) for c in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        for c, v in zip(before, ("24", "false"), strict=True):
            spark.conf.set(c, v)
        found = jaccard_groups.linked(df, 4, 85, 100)
        assert {r.doc_id: r.component_id for r in found.collect()} == {i: 0 if i < 40 else i for i in range(160)}
        stays = write(jaccard_groups.one_of_each(df, 4, 85, 100), "test-stays")
    finally:
        for c, v in before.items():
            spark.conf.set(c, v)
    assert max(files.values()) <= 3, files
    assert len(stays.inputFiles()) <= 3 and stays.count() == 121


def test_writers_grow_with_the_documents(spark, monkeypatch):
    cores = spark.sparkContext.defaultParallelism
    assert common.writers(spark.range(1000)) == cores
    monkeypatch.setattr(common, "WRITER_ROWS", 10)
    assert common.writers(spark.range(10 * cores + 70)) == cores + 7
