"""Texts cut at spaces, and ids of the pieces, each distinct piece encoded once.

Cutting, numbering and looking up go by Arrow and numpy over all of a batch's pieces. New pieces
are handed to a tokenizer laid end to end; its ids are dealt out by the bytes that each stands for.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from wattledger.llm.common import spread

#: ASCII white space, and the bytes with which other white space begins in UTF-8.
BLANK, LEADS = (np.isin(np.arange(256), x) for x in ([*range(9, 14), *range(28, 33)], [0xC2, 0xE1, 0xE2, 0xE3]))
#: Pieces that go to a tokenizer at once.
TOGETHER = 512


class Cut:
    """``texts`` cut before every space that something other than white space follows.

    ``pieces`` are the distinct pieces (UTF-8, with that space), ``codes`` all texts' pieces by
    number, of which text k has those from ``first[k]`` to ``first[k + 1]``; ``led`` tells which
    pieces begin at such a space.
    """

    def __init__(self, texts: list[str]):
        column = pa.array(texts, pa.large_string())
        ends = np.frombuffer(column.buffers()[1], np.int64)[: len(texts) + 1] if texts else np.zeros(1, np.int64)
        total = int(ends[-1])
        buffer = column.buffers()[2] if total else pa.py_buffer(b"")
        data = np.frombuffer(buffer, np.uint8)[:total]
        space = np.flatnonzero(data == 32)
        after = data[np.minimum(space + 1, total - 1)] if total else data
        final = np.zeros(total + 1, bool)
        final[ends] = True
        before_word = ~BLANK[after] & ~final[space + 1]
        for k in np.flatnonzero(before_word & LEADS[after]):
            follows = data[space[k] + 1 : space[k] + 4].tobytes().decode(errors="ignore")
            before_word[k] = not follows[:1].isspace()
        starts = np.zeros(total + 1, bool)
        starts[ends[:-1]] = True
        starts[space[before_word]] = True
        at = np.flatnonzero(starts[:total])
        self.first = np.searchsorted(at, ends)
        found = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(at), [None, pa.py_buffer(np.append(at, total)), buffer]).dictionary_encode()
        self.pieces = found.dictionary
        self.codes = found.indices.to_numpy().astype(np.int64)
        led = np.zeros(total + 1, bool)
        led[space[before_word]] = True
        self.led = np.zeros(len(self.pieces), bool)
        self.led[self.codes] = led[at]


def laid(pieces: pa.Array) -> tuple[bytes, np.ndarray]:
    """The pieces' bytes end to end, and where each begins and the last ends."""
    if not len(pieces):
        return b"", np.zeros(1, np.int64)
    bounds = np.frombuffer(pieces.buffers()[1], np.int64)[pieces.offset :][: len(pieces) + 1]
    data = pieces.buffers()[2]
    return data[int(bounds[0]) : int(bounds[-1])].to_pybytes() if data is not None else b"", bounds - bounds[0]


#: Ids of pieces by one tokenizer: all of them, and how many each piece has.
Ids = tuple[np.ndarray, np.ndarray]


def dealt(ids: np.ndarray, sizes: np.ndarray, bounds: np.ndarray) -> np.ndarray | None:
    """How many of ``ids``, which stand for ``sizes`` bytes, belong to each of the pieces between
    ``bounds``; None if an id reaches over a bound or the bytes are not as many."""
    ends = np.cumsum(sizes[ids])
    wanted = bounds[1:] - bounds[0]
    if not len(ends) or ends[-1] != wanted[-1]:
        return None
    at = np.searchsorted(ends, wanted)
    return np.diff(at + 1, prepend=0) if (ends[at] == wanted).all() else None


def encoded(pieces: pa.Array, led: np.ndarray, together: Callable[[str, np.ndarray], list[Ids] | None], alone: Callable[[list[str]], list[Ids]]) -> list[Ids]:
    """Ids of pieces by each tokenizer. ``together`` has those of several pieces that begin with
    a space, laid end to end between the given bounds, or None if they can't be told apart;
    smaller groups are tried then, and at last ``alone``, as for pieces without that space."""
    order = np.argsort(~led, kind="stable")
    n = int(led.sum())
    raw, bounds = laid(pieces.take(pa.array(order)))
    parts: list[list[Ids]] = []

    def run(a: int, b: int) -> None:
        got = together(raw[bounds[a] : bounds[b]].decode(), bounds[a : b + 1] - bounds[a])
        if got is not None:
            parts.append(got)
        elif b - a > 8:
            run(a, (a + b) // 2)
            run((a + b) // 2, b)
        else:
            parts.append(alone([raw[x:y].decode() for x, y in zip(bounds[a:b], bounds[a + 1 : b + 1])]))

    for a in range(0, n, TOGETHER):
        run(a, min(a + TOGETHER, n))
    parts.append(alone([raw[x:y].decode() for x, y in zip(bounds[n:-1], bounds[n + 1 :])]))
    out = []
    for k in range(len(parts[0])):
        flat, counts = (np.concatenate([p[k][i] for p in parts]) for i in (0, 1))
        starts = np.cumsum(counts) - counts
        back = np.argsort(order)
        out.append((flat[spread(starts[back], counts[back])], counts[back]))
    return out


class Known:
    """Ids of pieces by ``tokenizers`` tokenizers; pieces stay known while they are fewer than ``most``."""

    def __init__(self, tokenizers: int, kind: type, most: int):
        self.most = most
        self.pieces = pa.array([], pa.large_binary())
        self.ids: list[Ids] = [(np.empty(0, kind), np.empty(0, np.int64)) for _ in range(tokenizers)]

    def of(self, cut: Cut, encode: Callable[[pa.Array, np.ndarray], list[Ids]]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Per tokenizer a table of ids, and where those of each of the cut's pieces begin in
        it and how many they are. ``encode`` has the ids of pieces that are new."""
        at = pc.index_in(cut.pieces, value_set=self.pieces)
        new = np.asarray(at.is_null())
        number = at.fill_null(0).to_numpy().astype(np.int64)
        number[new] = len(self.pieces) + np.arange(new.sum())
        pieces = cut.pieces.filter(pa.array(new))
        found = encode(pieces, cut.led[new])
        out = []
        for (flat, counts), (flat_new, counts_new) in zip(self.ids, found):
            counts = np.concatenate([counts, counts_new])
            out.append((np.concatenate([flat, flat_new]), (np.cumsum(counts) - counts)[number], counts[number]))
        if len(self.pieces) < self.most:
            self.pieces = pa.concat_arrays([self.pieces, pieces])
            self.ids = [tuple(np.concatenate(x) for x in zip(old, more)) for old, more in zip(self.ids, found)]
        return out
