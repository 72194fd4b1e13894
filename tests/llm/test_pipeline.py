"""The stages one after another, and the registered queries on the smallest tables."""

import pytest

import __spark_entry__ as contract
import corpus_pipeline
from playbill.llm.support import stored, table
from llm.test_groups import kept_by_brute_force

SF_DIR = "/root/testdata/sf0.001"


def test_stages_keep_their_columns_and_only_drop_rows(spark):
    docs = table(spark, SF_DIR, "documents")
    columns, before = docs.columns, docs.count()
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF_DIR)
        assert docs.columns == columns
        now = docs.count()
        assert 0 < now <= before
        before = now


def test_pipeline_packs_what_the_stages_kept(spark):
    found = corpus_pipeline.run(spark, SF_DIR).toPandas()
    sums = found.groupby("doc_id").length.sum()
    assert (sums == found.groupby("doc_id").doc_tokens.first()).all()


def test_near_duplicates_in_the_pipeline_equal_brute_force(spark):
    docs = table(spark, SF_DIR, "documents")
    for name, stage in corpus_pipeline.STAGES:
        if name == "SimHash near-dedup":
            break
        docs = stage(spark, docs, SF_DIR)
    docs = stored(docs, "before-near-duplicates")
    rows = docs.orderBy("doc_id").select("doc_id", "text").collect()
    kept = sorted(rows[i].doc_id for i in kept_by_brute_force([r.text or "" for r in rows]))
    assert 0 < len(kept) < len(rows)
    assert sorted(r.doc_id for r in stage(spark, docs, SF_DIR).collect()) == kept


@pytest.mark.parametrize("name", sorted(contract.LLM_QUERIES))
def test_registered_queries_run(spark, name):
    assert contract.LLM_QUERIES[name](spark, SF_DIR).count() > 0
