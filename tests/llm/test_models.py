"""Language identification and quality: codewords, trees, held-out accuracy, odd rows."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from meterflow.llm import language_ecoc, quality_gbt
from meterflow.llm.common import pieces, table

ODD = [(1, None), (2, ""), (3, " \n\t"), (4, "12 34 !!"), (5, "the the the"), (5, "the the the"), (6, "ab " * 60_000), (None, "für das und der")]


@pytest.fixture(scope="module")
def odd(spark):
    """Rows with nulls, empty and long texts, repeats, and columns with the results' names."""
    rows = [(i, t, "x", 1, 0.5, False) for i, t in ODD]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, predicted int, score double, held_out boolean")


def test_codewords_are_apart():
    for n in (2, 3, 4, 5, 9, 30):
        code = language_ecoc.codewords(n)
        distance = (code.shape[1] - code @ code.T) / 2 + np.eye(n) * 1e9
        assert set(np.unique(code)) <= {-1.0, 1.0} and distance.min() >= (1 if n < 4 else 4 if n < 6 else 8)
        assert n > 5 or (np.abs(code.sum(axis=0)) < n).all()
    assert language_ecoc.codewords(1).shape == (1, 0)


def test_languages_held_out(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    found = language_ecoc.predict(docs, language_ecoc.train(docs)).join(docs.select("doc_id", "lang"), "doc_id")
    counts = found.where("held_out").agg(F.count("*"), F.count_if(F.col("lang") == F.col("lang_pred")), F.min("score"), F.max("score")).first()
    assert counts[0] > 300 and counts[1] >= 0.98 * counts[0] and 0 <= counts[2] <= counts[3] <= 1


def test_language_of_odd_rows(spark, sf_dir, odd):
    model = language_ecoc.train(table(spark, sf_dir, "documents"))
    rows = language_ecoc.predict(odd, model).collect()
    assert sorted(str((r.doc_id, r.lang_pred == "und", r.score == 0)) for r in rows) == sorted(
        str((i, not language_ecoc.has_letter(t), not language_ecoc.has_letter(t))) for i, t in ODD)
    assert language_ecoc.predict(odd.limit(0), model).count() == 0
    kept = language_ecoc.keep_known(odd, model)
    assert kept.columns == odd.columns and kept.count() == 4
    none = language_ecoc.train(odd.where("doc_id is null"))
    assert none.languages == [] and {r.lang_pred for r in language_ecoc.predict(odd, none).collect()} == {"und"}
    one = language_ecoc.train(odd.withColumn("doc_id", F.lit(0).cast("long")))  # 0 is not held out
    assert one.languages == ["x"]


def test_unlearned_languages_go_and_clean_texts_stay(spark):
    """Nothing that the codes decoded could remove a text; with no language learned all of them went."""
    docs = table(spark, "/root/testdata/sf0.01", "documents").select("doc_id", "text", "lang")
    odd = ["Tämä on suomenkielinen teksti, jota kukaan ei ole opettanut mallille, ja se jatkuu vielä hetken aikaa.",
           "Bu metin Türkçe yazılmıştır ve model bunu hiç öğrenmemiştir, ama yine de uzun bir cümledir.",
           "qzx wvk jjq xxzk qpw vvkq zzjx kqwp xjzq wvxk qqzj " * 4, "Это русский текст, который никто не учил, и он довольно длинный."]
    more = docs.unionByName(spark.createDataFrame([(-i - 1, t, None) for i, t in enumerate(odd)], docs.schema))
    model = language_ecoc.train(docs)
    stay = language_ecoc.keep_known(more, model, lead=language_ecoc.LEAD, loss=model.blank_loss())
    assert sorted(r.doc_id for r in stay.select("doc_id").collect()) == sorted(r.doc_id for r in docs.select("doc_id").collect())
    none = docs.limit(20).withColumn("lang", F.lit(None).cast("string"))
    assert corpus_pipeline.known_language(spark, none, "").count() == 20


def test_a_language_never_comes_from_held_out_rows(spark):
    docs = spark.createDataFrame([(i, f"word{i} text", "aa" if i % 2 else "bb") for i in range(40)], "doc_id long, text string, lang string")
    spoilt = docs.withColumn("lang", F.when(language_ecoc.held_out(F.col("doc_id")), "zz").otherwise(F.col("lang")))
    assert language_ecoc.train(spoilt).languages == ["aa", "bb"]


def test_flat_trees_equal_walking_them():
    rng = np.random.default_rng(1)
    x = rng.random((600, 5)).round(2)
    y = ((x[:, 0] > 0.5) ^ (x[:, 3] > 0.3)).astype(float)
    trees = quality_gbt.fit(x, y, rounds=20)

    def walk(row):
        total = trees.base
        for at in trees.roots:
            while trees.left[at] != at:
                at = trees.left[at] if row[trees.feature[at]] <= trees.threshold[at] else trees.right[at]
            total += trees.value[at]
        return 1 / (1 + np.exp(-total))

    p = trees.probability(x)
    assert np.allclose(p, [walk(r) for r in x]) and ((p >= 0.5) == y).mean() > 0.97
    assert len(trees.probability(x[:0])) == 0


def test_quality_held_out(spark):
    docs, labels = (table(spark, "/root/testdata/sf0.01", n) for n in ("documents", "labels"))
    found = quality_gbt.score(docs, quality_gbt.train(docs, labels)).join(labels, "doc_id").where("held_out")
    total, right = found.agg(F.count("*"), F.count_if(F.col("predicted") == F.col("quality"))).first()
    assert total > 100 and right >= 0.97 * total


def test_quality_of_odd_rows(spark, sf_dir, odd):
    docs, labels = (table(spark, sf_dir, n) for n in ("documents", "labels"))
    trees = quality_gbt.train(docs, labels)
    rows = quality_gbt.score(odd, trees).collect()
    assert len(rows) == len(ODD) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    assert len({r.score for r in rows if r.doc_id in (1, 2, 3)}) == 1
    assert quality_gbt.score(odd.limit(0), trees).count() == 0
    blank = quality_gbt.train(docs, labels.limit(0))
    assert {r.score for r in quality_gbt.score(odd, blank).collect()} == {0.5}
    one_class = quality_gbt.train(docs, labels.where("quality = 1"))
    assert min(r.score for r in quality_gbt.score(odd, one_class).collect()) > 0.9
    assert quality_gbt.keep_good(odd, trees).columns == odd.columns


def test_pieces_are_bounded_and_whole():
    batch = pa.record_batch([pa.array(["a" * n for n in (5, 0, 30, 2, 2, 100)] + [None])], names=["t"])
    parts = [p.column(0).to_pylist() for p in pieces(iter([batch, batch.slice(0, 0)]), "t", 10)]
    assert [t for p in parts for t in p] == batch.column(0).to_pylist()
    assert all(len(p) == 1 or sum(map(len, filter(None, p))) <= 10 for p in parts)
