"""Hashes and anchors of a slice are worked out in parts, with the result of one go."""

from __future__ import annotations

import numpy as np
import pytest

from wattledger.llm import substring_dedup


@pytest.mark.parametrize("length", [92, 100, 400])
def test_parts_agree_with_one_go(length, monkeypatch):
    r = np.random.default_rng(7)
    texts = [r.integers(97, 100, n).astype(np.uint8).tobytes() for n in (5000, 3, 0, length, length - 1, 2000)] + [b"a" * 700, b"ab" * 900]
    slices = []
    for part in (1 << 30, 1000, 1):
        monkeypatch.setattr(substring_dedup, "PART", part, raising=False)
        slices.append(substring_dedup.Slice(texts, length, 0, 1))
    for s in slices[1:]:
        for name in ("first", "last", "anchor", "doc", "fp"):
            assert np.array_equal(getattr(s, name), getattr(slices[0], name))
    # Every window's anchor is the last place of the smallest hash in it.
    s, h = slices[0], substring_dedup.gram_hashes(slices[0].data, substring_dedup.GRAM)
    for first, last, anchor in zip(s.first.tolist(), s.last.tolist(), s.anchor.tolist()):
        for at in (first, last):
            window = h[at : at + length - substring_dedup.GRAM + 1]
            assert anchor == at + len(window) - 1 - int(window[::-1].argmin())


def test_passes_over_a_slice_stay_small(monkeypatch):
    """What hashing and anchoring hold at a time depends on the part, not on the slice."""
    most = []
    for name in ("gram_hashes", "anchors"):
        inner = getattr(substring_dedup, name)
        monkeypatch.setattr(substring_dedup, name, lambda x, k, f=inner: (most.append(len(x)), f(x, k))[1])
    substring_dedup.Slice([np.random.default_rng(1).integers(0, 256, 1 << 20).astype(np.uint8).tobytes()], 100, 0, 1)
    assert max(most) < 1 << 17  # the whole slice before
