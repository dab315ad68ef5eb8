"""Pre-tokens of a block: the pattern is asked only about pieces that aren't plain letters."""

from __future__ import annotations

import regex

from tests.llm.test_pieces import odd_texts
from wattledger.llm import byte_bpe


class Counting:
    def __init__(self, inner):
        self.inner, self.calls = inner, 0

    def findall(self, text):
        self.calls += 1
        return self.inner.findall(text)


def test_words_of_letters_need_no_pattern():
    block = byte_bpe.Block()
    block.pattern = Counting(block.pattern)
    letters = "abcdefghijéß"
    text = " ".join(a + b + c for a in letters for b in letters for c in letters)
    words, (sequence,) = block.cut([text + " don't"])
    assert block.pattern.calls == 1  # once for each word before
    assert [words[k] for k in sequence] == regex.findall(byte_bpe.PATTERN, text + " don't")


def test_blocks_of_odd_texts():
    for extra in ("", "a\n", " a\n", "ab \n", "aª", "'s", " 's", "x's", "a1", "ĳſ", "×", "÷"):
        texts = [t + extra for t in odd_texts(3, 200)]
        words, sequences = byte_bpe.Block().cut(texts)
        assert len(set(words)) == len(words)
        for t, s in zip(texts, sequences, strict=True):
            assert [words[k] for k in s] == regex.findall(byte_bpe.PATTERN, t)
