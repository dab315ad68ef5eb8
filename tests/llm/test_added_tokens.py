"""Texts that hold the content of an added token get the library's default ids."""

from __future__ import annotations

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from tests.llm.conftest import DOCS, odd_documents
from wattledger.llm import token_store

JSON = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|><|endoftext|> y  z \n", "a <|endoftext |> <|endoftext| > b", "one  two three"]


def test_added_tokens_in_texts():
    t = Tokenizer.from_file(JSON)
    encoder = token_store.Encoder(JSON)
    for texts in ([*TEXTS], TEXTS[:1], TEXTS[3:], []):
        got = [np.frombuffer(x, np.uint16).tolist() for x in encoder.encode(texts)]
        assert got == [t.encode(x, add_special_tokens=False).ids for x in texts]
    assert 50256 in t.encode(TEXTS[0], add_special_tokens=False).ids


def test_token_store_with_added_tokens(spark, run):
    t = Tokenizer.from_file(JSON)
    docs = [*odd_documents(), *((20 + i, x, "en", 0.0, 20 + i) for i, x in enumerate(TEXTS))]
    folder = f"{run.folder}/store"
    token_store.write(spark.createDataFrame(docs, DOCS), folder, run, JSON, segment_bytes=200)
    got = sorted(token_store.read(spark, folder).collect(), key=lambda x: x.start)
    at = 0
    for x, d in zip(got, sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0, len(d[1] or ""))), strict=True):
        ids = [*t.encode(d[1] or "", add_special_tokens=False).ids, 0]
        assert (x.doc_id, x.start, np.frombuffer(x.ids, np.uint32).tolist()) == (d[0], at, ids)
        at += len(ids)
