"""Results that don't depend on how files are split, in any of an operator's jobs."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from wattledger.llm import substring_dedup


def test_repeats_while_splits_change(spark, run, folder, monkeypatch):
    r = random.Random(31)
    draw = lambda n: "".join(r.choice("abcdefgh \n") for _ in range(n))
    passages = [draw(n) for n in (150, 400, 900)]
    docs = [(i, draw(200) + r.choice(passages) + draw(100) + r.choice(passages)) for i in range(120)]
    docs += [(7, docs[7][1]), (7, docs[7][1]), (8, draw(300) + passages[0]), (None, passages[1]), (None, passages[1]), (None, "short")]
    spark.createDataFrame(docs, "doc_id long, text string").repartition(12).write.parquet(f"{folder}/docs")

    def answer():
        table = spark.read.parquet(f"{folder}/docs")
        got = substring_dedup.without_repeats(table, run).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256))
        return sorted(map(str, got.collect()))

    want = answer()
    assert len(want) == len(docs)
    sizes = iter([20_000, 3_000, 60_000, 1_000] * 20)
    real = run.store

    def store(df, name, *args, **options):  # another split size before every job
        out = real(df, name, *args, **options)
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(next(sizes)))
        spark.conf.set("spark.sql.files.openCostInBytes", "100")
        return out

    monkeypatch.setattr(run, "store", store)
    try:
        assert answer() == want
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
