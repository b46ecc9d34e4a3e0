from __future__ import annotations

import corpus_pipeline
from barsmith.llm import jaccard, language, packing, quality
from barsmith.llm.common import written

from llm_helpers import SMALL, brute_components, empty, odd, with_clashes  # noqa: F401


def test_each_stage_works_on_what_the_one_before_kept(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns = docs.columns
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "language_id", "ngram_jaccard_join", "mixing_sources", "best_fit_packing"]
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, written(stage(spark, docs, SMALL), name)
        kept[name] = docs
        if name == "best_fit_packing":
            break
        assert docs.columns == columns
        if name == "quality_rules":
            good = before.select("doc_id", quality.verdict(before).alias("v")).filter("v.kept")
            assert {r.doc_id for r in docs.collect()} == {r.doc_id for r in good.collect()}
            assert docs.count() < before.count()
        elif name == "language_id":
            good = before.select("doc_id", language.identify(before).alias("v")).filter("v.lang_pred <> 'und'")
            assert {r.doc_id for r in docs.collect()} == {r.doc_id for r in good.collect()}
        elif name == "ngram_jaccard_join":
            rows = [(r.doc_id, r.text) for r in before.collect()]
            assert {r.doc_id for r in docs.collect()} == {c for _, _, c in brute_components(rows)}
        else:
            assert {r.doc_id for r in docs.collect()} <= {r.doc_id for r in before.collect()}
    mixed, packed = kept["mixing_sources"], kept["best_fit_packing"]
    assert packed.filter("piece = 0").count() == mixed.count()
    assert packed.groupBy("sequence_id").sum("length").filter(f"`sum(length)` > {packing.CAPACITY}").count() == 0


def test_run_is_repeatable(spark):
    first, second = (corpus_pipeline.run(spark, SMALL).select("doc_id", "piece", "length", "ids_crc32") for _ in range(2))
    assert sorted(map(tuple, first.collect())) == sorted(map(tuple, second.collect()))
    assert corpus_pipeline.ORACLE_SQL is None


def test_stages_take_any_columns_and_empty_tables(spark, odd, empty):
    for docs in (with_clashes(odd), empty):
        columns = docs.columns
        for name, stage in corpus_pipeline.STAGES:
            docs = written(stage(spark, docs, SMALL), name)
            if name != "best_fit_packing":
                assert docs.columns == columns
    assert jaccard.keep_one(empty).count() == 0
