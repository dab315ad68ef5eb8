"""New pieces go to a tokenizer together, known ones not again, and ids are those of whole texts."""

from __future__ import annotations

import random

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from wattledger.llm import token_store
from wattledger.llm.pieces import Cut

JSON = public_tokenizers.path("byte_bpe_50k.json")
WORDS = ["the", "Größe", "数字", "don't", "“quoted”", "a\n", "\tb", " ", "  ", "", "\xa0", "\x1c", "\x85c", "　", " x", "🙂", "ﬁ", "\x00", "1234567"]


class Counting:
    """A tokenizer that counts the strings it is handed."""

    def __init__(self, inner):
        self.inner, self.strings = inner, 0

    def __getattr__(self, name):
        return getattr(self.inner, name)

    def encode_batch_fast(self, texts, **more):
        self.strings += len(texts)
        return self.inner.encode_batch_fast(texts, **more)


def odd_texts(seed, n):
    r = random.Random(seed)
    return ["".join(r.choice([" ", " ", "", "  "]) + r.choice(WORDS) for _ in range(r.randrange(12))) for _ in range(n)]


def many_words(n):
    return [" ".join(f"w{i * 7919 % 100003}" for i in range(k, k + 100)) for k in range(0, n, 100)]


def test_pieces_are_cut_before_words():
    texts = odd_texts(1, 500)
    cut = Cut(texts)
    pieces = [p.decode() for p in cut.pieces.to_pylist()]
    assert len(set(pieces)) == len(pieces)
    for text, a, e in zip(texts, cut.first, cut.first[1:]):
        got = [pieces[k] for k in cut.codes[a:e]]
        places = {i for i in range(len(text) - 1) if text[i] == " " and not text[i + 1].isspace()} | {0}
        assert "".join(got) == text
        assert not text or np.cumsum([0, *map(len, got)])[:-1].tolist() == sorted(places)
        for p, k in zip(got, cut.codes[a:e]):
            assert cut.led[k] == (len(p) > 1 and p[0] == " " and not p[1].isspace())


def test_new_pieces_go_to_the_tokenizer_together():
    encoder = token_store.Encoder(JSON)
    encoder.tokenizer = Counting(encoder.tokenizer)
    texts = many_words(5000)
    got = encoder.encode(texts)
    assert encoder.tokenizer.strings <= 100  # one for each word before
    handed = encoder.tokenizer.strings
    assert encoder.encode(texts) == got and encoder.tokenizer.strings == handed
    whole = Tokenizer.from_file(JSON)
    assert [np.frombuffer(x, np.uint16).tolist() for x in got] == [whole.encode(t, add_special_tokens=False).ids for t in texts]


def test_ids_are_those_of_whole_texts():
    whole = Tokenizer.from_file(JSON)
    for most in (0, 20, 1000):
        encoder = token_store.Encoder(JSON, most=most)
        for seed in range(3):
            texts = odd_texts(seed, 300)
            assert [np.frombuffer(x, np.uint16).tolist() for x in encoder.encode(texts)] == [whole.encode(t, add_special_tokens=False).ids for t in texts]
