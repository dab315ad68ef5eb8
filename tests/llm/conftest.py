from __future__ import annotations

import os
import uuid

import pytest

DOCS = "doc_id long, text string, lang string, score double, row long"


def odd_documents():
    """Null ids and texts, empty, blank and very long texts, ties, repeated rows, extra columns
    whose names clash with those of results."""
    body = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"
    rows = [
        (1, f"{body} mail a.b@example.com and 10.0.0.1 or +1 (555) 555-0100 end", "en", 0.1, 1),
        (2, f"{body} mail a.b@example.com and 10.0.0.1 or +1 (555) 555-0100 end", "en", 0.2, 2),
        (2, f"{body} mail a.b@example.com and 10.0.0.1 or +1 (555) 555-0100 end", "en", 0.2, 2),
        (3, None, None, None, None), (4, "", "en", 0.0, 4), (5, " \n\t ", "en", 0.0, 5),
        (6, "x", "en", 0.0, 6), (None, body, "en", 0.0, 7), (None, None, None, None, None),
        (7, "Größe ñandú été 数字 " * 40, "de", 0.0, 8), (8, "word " * 30_000, "en", 0.0, 9),
        (9, "z" * 50_000, "en", 0.0, 10), (10, "Released under the MIT License.\nApache License", "en", 0.0, 11),
        (11, "4111 1111 1111 1111 is a card; 4111 1111 1111 1112 is not", "en", 0.0, 12),
    ]
    return rows


@pytest.fixture
def odd(spark):
    return spark.createDataFrame(odd_documents(), DOCS)


@pytest.fixture
def none(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture
def tables(spark, folder):
    """A folder with the odd documents, a benchmark, labels and embeddings."""
    documents = spark.createDataFrame(odd_documents(), DOCS).selectExpr("*", "concat('s', doc_id % 3) AS source", "length(text) AS n_chars")
    documents.repartition(3).write.parquet(f"{folder}/documents.parquet")
    body = odd_documents()[0][1]
    items = [(1, body[: body.index(" mail")], "x"), (2, "x", "short"), (3, None, None), (None, body, "y"), (4, "", "z")]
    spark.createDataFrame(items, "item_id long, text string, doc_id string").write.parquet(f"{folder}/benchmark.parquet")
    labels = [(i, int(i % 3 > 0), int(i % 4 == 0)) for i in range(1, 12)] + [(1, 0, 0), (None, 1, 1), (3, None, None)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return folder


@pytest.fixture
def run(spark):
    from wattledger.llm.common import Run

    return Run(spark, f"test-{os.getpid()}-{uuid.uuid4().hex[:6]}")
