"""The registered queries: SQL where there is one, the pipeline stage by stage."""

import os

import duckdb
import pytest

import check
import corpus_pipeline
from energy_series.llm import oracles, queries
from energy_series.llm.common import table, written

SMALL = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="no test tables")


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for name in check.TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SMALL}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(oracles.ORACLES))
def test_query_equals_sql(spark, db, name):
    got = queries.QUERIES[name](spark, SMALL).toPandas()
    assert check.difference(got, db.execute(oracles.ORACLES[name]).df()) is None


def test_every_query_has_a_row_for_each_document(spark):
    n = table(spark, SMALL, "documents").count()
    for name in ("op1_fingerprints", "op2_personal_data", "op6_token_counts", "op8_token_files", "op9_bpe", "op10_licences"):
        assert queries.QUERIES[name](spark, SMALL).count() == n, name


def test_pipeline_stages(spark):
    docs = first = table(spark, SMALL, "documents")
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "jaccard_join", "decontamination", "bpe"]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = written(stage(spark, docs, SMALL), name)
        assert docs.columns == first.columns
    ids = {r.doc_id for r in docs.select("doc_id").collect()}
    got = corpus_pipeline.run(spark, SMALL).collect()
    assert {r.doc_id for r in got} == ids and len(got) == len(ids)


def test_stages_of_an_empty_table(spark):
    docs = table(spark, SMALL, "documents").limit(0)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = written(stage(spark, docs, SMALL), name)
        assert docs.count() == 0
