"""The pipeline's rules stage learns from all labelled documents, whatever the stage before it left."""

import corpus_pipeline
from ledgerspark.llm.common import documents
from ledgerspark.llm.labels import HELD_OUT, fold, labelled
from ledgerspark.llm.quality_rules import kept_by_rules, ruled

SF2 = "/root/testdata/sf0.01"


def test_rules_stage_rejects_a_bad_document(spark):
    docs, labels = documents(spark, SF2), labelled(spark, SF2, "quality")
    rows, rules = ruled(docs.limit(0), labels, sample=docs)
    assert rules and rows.count() == 0
    seen = spark.read.parquet(f"{SF2}/labels.parquet").where(fold() == HELD_OUT).join(docs, "doc_id")
    bad, good = (kept_by_rules(seen.where(f"quality = {y}").select(*docs.columns), labels.limit(0)) for y in (0, 1))
    assert bad.count() > 0
    assert corpus_pipeline.quality_rules(spark, bad, SF2).count() < 0.6 * bad.count()
    assert corpus_pipeline.quality_rules(spark, good, SF2).count() > 0.97 * good.count()
