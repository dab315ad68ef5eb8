"""Patterns that can find something are learned and used however many others there are."""

from __future__ import annotations

from tests.llm.test_operators import odd_documents
from wattledger.llm import pii

CARDS = ["4111111111111111", "4000000000000002", "4012888888881881", "4222222222222220", "4242424242424242", "4917610000000000"]


def test_barren_patterns_push_out_none(spark, run):
    """10,400 barren (cue, shape) and (cue, *) pairs stand before the one that takes in a stranger."""
    barren = [(i, "\n".join(f"cue{chr(97 + i // 26 // 26 % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i % 26)} +1 555 555 010{k}" for k in range(5))) for i in range(5200)]
    docs = [*barren, *((10_000 + k, f"pay card: {c} now") for k, c in enumerate(CARDS)), (20_000, "pay card: 4000000000000001 now"), (None, "pay card: 4000000000000001 now"), (20_001, None)]
    table = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    patterns = pii.learned(table, run)
    assert {(x.kind, x.cue, x.shape) for x in patterns.collect()} == {("card", "card:", "916"), ("card", "card:", "*")}
    got = [(x.doc_id, [tuple(s) for s in x.found]) for x in pii.extract(table, patterns, run).collect()]
    assert len(got) == len(docs) and sorted(str(x) for x in got if x[1]) == sorted(str((i, [("card", 10, 26)])) for i in (20_000, None))
    clean = pii.redacted(table, patterns, run).filter("doc_id = 20000").collect()
    assert clean[0].text == "pay card: <card> now"


def test_table_and_list_of_patterns_agree(spark, run, odd):
    patterns = [("card", "card;", "*"), ("phone", "and", "*"), ("ip", "1111", "94"), ("card", "^", "94")]
    table = spark.createDataFrame(patterns, "kind string, cue string, shape string")
    by_list, by_table = pii.extract(odd, patterns), pii.extract(odd, table, run)
    assert by_list.columns == by_table.columns and by_table.count() == len(odd_documents())
    assert sorted(map(str, by_list.collect())) == sorted(map(str, by_table.collect()))
