"""The registered queries on the smallest tables, and the pipeline's stages."""

import os

import pytest
from oracle import connect, difference

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from surveylake.llm.common import table, written
from surveylake.llm.queries import ORACLE_SQL, QUERIES

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


def test_every_operator_is_registered_once():
    numbers = sorted(int(name[2:].split("_")[0]) for name in QUERIES)
    assert numbers == list(range(1, 14)) and QUERIES.keys() <= queries().keys() and "pipeline" in queries()
    assert ORACLE_SQL.items() <= oracle_sql().items()


@pytest.mark.parametrize("name", ORACLE_SQL)
def test_query_matches_sql(spark, name):
    assert difference(QUERIES[name](spark, SF_DIR), connect(SF_DIR), ORACLE_SQL[name]) is None


@pytest.mark.parametrize("name", sorted(QUERIES.keys() - ORACLE_SQL.keys() - {"op11_spelling_variants", "op12_embedding_whitening"}))
def test_query_has_a_row_for_each_document(spark, name):
    found = QUERIES[name](spark, SF_DIR)
    assert found.select("doc_id").distinct().count() == table(spark, SF_DIR, "documents").count()


def test_pipeline_equals_its_stages_in_plain_form(spark):
    """Every stage against the operator's own verdicts on the stage's input, in plain Python."""
    from surveylake.llm import exact_dedup, near_join, quality_rules

    docs = table(spark, SF_DIR, "documents")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF_DIR)
        if name == "best-fit packing":
            assert out.select("doc_id").distinct().count() == docs.count()
            break
        out = written(out, "stage")
        assert out.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        left = {r["doc_id"] for r in out.select("doc_id").collect()}
        verdicts = {
            "quality rules": lambda d: quality_rules.judged(d), "exact dedup": lambda d: exact_dedup.exact_groups(d),
            "n-gram Jaccard join": lambda d: near_join.linked_documents(d),
        }
        if name in verdicts:
            assert left == {r["doc_id"] for r in verdicts[name](docs).where("kept").select("doc_id").collect()}
        assert out.join(docs, docs.columns, "left_semi").count() == out.count()
        docs = out
    assert corpus_pipeline.run(spark, SF_DIR).count() == out.count()
