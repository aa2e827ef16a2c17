"""The stages one after another: what each keeps, on its own input."""

import corpus_pipeline
from meterflow.llm import jaccard_groups, language_ecoc, quality_gbt
from meterflow.llm.common import kept, table


def test_stages_keep_and_drop_what_their_operators_say(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    columns, before = docs.columns, docs
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        after = kept(stage(spark, before, sf_dir), f"test-{k}")
        assert after.columns == columns and 0 < after.count() <= before.count()
        ids = {r.doc_id for r in after.select("doc_id").collect()}
        if name == "quality classifier":
            trees = quality_gbt.train(before, table(spark, sf_dir, "labels"))
            assert ids == {r.doc_id for r in quality_gbt.score(before, trees).where("predicted = 1").collect()}
        elif name == "language id":
            found = language_ecoc.predict(before, language_ecoc.train(before))
            assert ids == {r.doc_id for r in found.where("lang_pred <> 'und'").collect()}
        elif name == "n-gram Jaccard join":
            groups = jaccard_groups.linked(before).collect()
            assert ids == {r.component_id for r in groups}
        else:
            assert ids == {r.doc_id for r in before.select("doc_id").collect()}
        before = after
    pieces = corpus_pipeline.STAGES[-1][1](spark, before, sf_dir)
    assert {r.doc_id for r in pieces.select("doc_id").distinct().collect()} == ids


def test_run_is_the_stages(spark, sf_dir):
    assert corpus_pipeline.run(spark, sf_dir).count() > 0
    assert len(corpus_pipeline.STAGES) == 5 and corpus_pipeline.ORACLE_SQL is None
