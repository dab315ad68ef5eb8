"""The registered queries and the pipeline on a folder of odd rows."""

from __future__ import annotations

import pytest

import corpus_pipeline
from tests.llm.conftest import odd_documents
from wattledger.llm import queries


@pytest.mark.parametrize("name", [n for n in queries.QUERIES if not n.startswith("op6")])
def test_query(spark, tables, name):
    got = queries.QUERIES[name](spark, tables)
    assert got.count() == len(odd_documents()) and got.columns[0] == "doc_id"


def test_stages_keep_columns_and_take_effect(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[1:]:
        got = stage(spark, docs, tables)
        if name != "encoding":
            assert sorted(got.columns) == sorted(docs.columns)
        ids = [x.doc_id for x in got.collect()]
        if name == "near_duplicates":
            assert ids.count(1) == 1 and 2 not in ids and ids.count(None) == 2
        elif name == "decontamination":
            assert 1 not in ids and 6 not in ids and 7 in ids  # 6 is a whole short item
        else:
            assert len(ids) == len(odd_documents())


def test_run(spark, tables):
    assert corpus_pipeline.run(spark, tables).columns == ["doc_id", "n_tokens", "ids", "decoded_sha256"]
