"""Alignment of two tokenizers by lockstep merging of their token ends.

A batch's documents are laid end to end and cut into lanes at places where both tokenizations
end a token. One vector holds the two pointers of every lane; a step compares the ends they
point at, gives out a link and a cut where they are equal, moves the pointer behind (both where
equal) and drops the lanes that are through.
"""

from __future__ import annotations

import hashlib
import os
import re
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattledger.llm.byte_bpe import expanded, squeezed
from wattledger.llm.common import Run, arrow, ship, slices, spread
from wattledger.llm.pieces import Cut, Ids, Known, dealt, encoded

#: A space that white space or the text's end follows: A may join it with what is before it.
UNSAFE = re.compile(r" (?:\s|\Z)")
SPACE = "▁"
#: Tokens of A in a lane, and places probed for a common end where a lane should end.
LANE, PROBES = 256, 48


def _byte_of() -> dict[str, int]:
    """The byte for which each character of a byte-level vocabulary stands: printable Latin-1
    characters for themselves, the characters from U+0100 on for the other bytes in order."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Tables:
    """Bytes of every id of the two tokenizers and the ids of whole words, kept while there is room."""

    def __init__(self, a_path: str, b_path: str, most: int = 600_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a, self.b = Tokenizer.from_file(a_path), sentencepiece.SentencePieceProcessor(model_file=b_path)
        self.a.encode_special_tokens = True
        byte = _byte_of()
        self.a_bytes = [b""] * self.a.get_vocab_size(with_added_tokens=True)
        for token, i in self.a.get_vocab(with_added_tokens=True).items():
            self.a_bytes[i] = bytes(byte[c] for c in token) if all(c in byte for c in token) else token.encode()
        self.b_bytes = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            own = re.fullmatch(r"<0x([0-9A-F]{2})>", piece)
            self.b_bytes.append(bytes([int(own[1], 16)]) if own else piece.replace(SPACE, " ").encode())
        # A cut before a space is safe if no piece has a space behind another character.
        self.cuts = all(SPACE not in self.b.id_to_piece(i).lstrip(SPACE) for i in range(self.b.get_piece_size()))
        self.sizes = [np.fromiter(map(len, x), np.int64, len(x)) for x in (self.a_bytes, self.b_bytes)]
        if max(map(len, self.sizes)) > 1 << 16:
            raise ValueError("ids must fit in 16 bits")
        ends = {0: b",", 1: b"|"}, {0: b",", 1: b";"}
        self.texts = [b"%d%s" % (i, e[last]) for e, x in zip(ends, self.sizes) for i in range(len(x)) for last in (0, 1)]
        self.known = Known(2, np.uint16, most)

    def _fits(self, text: str, a: list[int], b: list[int]) -> bool:
        whole = b" " + text.encode()
        return b"".join(map(self.a_bytes.__getitem__, a)) == whole == b"".join(map(self.b_bytes.__getitem__, b))

    def _encoded(self, texts: list[str]) -> list[tuple[list[int], list[int]] | None]:
        """Ids of each text by A (after a space) and B; None where the bytes differ."""
        a = [x.ids for x in self.a.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)]
        b = self.b.encode(texts, num_threads=1) if texts else []
        return [(x, y) if self._fits(t, x, y) else None for t, x, y in zip(texts, a, b)]

    def _alone(self, texts: list[str]) -> list[Ids]:
        """Ids of words behind a space; none for those whose bytes differ."""
        pairs = [p or ([], []) for p in self._encoded([t[1:] for t in texts])]
        return [(np.array([*chain.from_iterable(x)], np.uint16), np.fromiter(map(len, x), np.int64, len(x))) for x in ([p[k] for p in pairs] for k in (0, 1))]

    def _together(self, text: str, bounds: np.ndarray) -> list[Ids] | None:
        (pair,) = self._encoded([text[1:]])
        ids = [np.array(x, np.uint16) for x in pair or ()]
        counts = [dealt(x, size, bounds) for x, size in zip(ids, self.sizes)]
        return None if pair is None or any(c is None for c in counts) else list(zip(ids, counts))

    def tokens(self, texts: list[str | None]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """16-bit ids of all texts by A and by B, and how many each text has: none if the bytes differ.

        A text without odd spaces is cut before every space: neither tokenizer joins what
        stands on its two sides. A word whose bytes differ sends its text the long way.
        """
        plain, whole = [], []
        for i, t in enumerate(texts):
            if t:
                safe = self.cuts and SPACE not in t and not t[0].isspace() and not UNSAFE.search(t)
                (plain if safe else whole).append(i)
        cut = Cut([" " + texts[i] for i in plain])
        found = self.known.of(cut, lambda new, led: encoded(new, led, self._together, self._alone))
        misfits = np.concatenate([[0], np.cumsum((found[0][2] == 0)[cut.codes])])[cut.first]
        long_way = np.diff(misfits) > 0
        whole += np.array(plain, np.int64)[long_way].tolist()
        pairs = self._encoded([texts[i] for i in whole])
        ids, counts = [], []
        for k, (table, starts, sizes) in enumerate(found):
            each = sizes[cut.codes]
            flat = table[spread(starts[cut.codes], each)]
            first = np.concatenate([[0], np.cumsum(each)])[cut.first]
            n = np.zeros(len(texts), np.int64)
            n[plain] = np.diff(first)
            n[whole] = [len(p[k]) if p else 0 for p in pairs]
            if whole:
                parts: list = [flat[:0]] * len(texts)
                for i, a, e in zip(plain, first.tolist(), first[1:].tolist()):
                    parts[i] = flat[a:e]
                for i, p in zip(whole, pairs):
                    parts[i] = np.array(p[k] if p else [], np.uint16)
                flat = np.concatenate(parts)
            ids.append(flat)
            counts.append(n)
        return ids, counts

    def encode(self, texts: list[str | None]) -> list[tuple[bytes, bytes] | None]:
        """Serialised 16-bit ids of both for each text; None for texts that have no tokens."""
        ids, counts = self.tokens(texts)
        cut = [[x[e - n : e].tobytes() for e, n in zip(np.cumsum(c), c)] for x, c in zip(ids, counts)]
        return [(a, b) if a else None for a, b in zip(*cut)]


@lru_cache(maxsize=1)
def tables_of(a_path: str, b_path: str) -> Tables:
    """One pair of tokenizers for all tasks of a worker."""
    return Tables(a_path, b_path)


def _lanes(end_a, end_b, first_a, first_b, lane: int) -> tuple[np.ndarray, ...]:
    """Pointers at which lanes begin and those of A at which they end; ``first_*`` are those of
    the documents. Lanes of a document follow one another."""
    counts = np.diff(first_a)
    steps = np.maximum(counts - PROBES - 1, 0) // lane
    at = spread(np.zeros(len(steps), np.int64), steps) + 1
    probe = (np.repeat(first_a[:-1], steps) + at * lane)[:, None] + np.arange(PROBES)
    found = np.empty((0, 2), np.int64)
    if len(probe):
        ends = end_a[probe]
        place = np.searchsorted(end_b, ends)
        hit = end_b[np.minimum(place, len(end_b) - 1)] == ends
        row, col = np.arange(len(probe)), hit.argmax(1)
        any_ = hit.any(1)
        found = np.stack([probe[row, col] + 1, place[row, col] + 1], 1)[any_]
    a = np.concatenate([first_a[:-1], found[:, 0]])
    b = np.concatenate([first_b[:-1], found[:, 1]])
    order = np.argsort(a, kind="stable")
    a, b = a[order], b[order]
    return a, b, np.append(a[1:], first_a[-1])


def lockstep(end_a: np.ndarray, end_b: np.ndarray, first_a: np.ndarray, first_b: np.ndarray, lane: int = LANE) -> np.ndarray:
    """Per token of A the token of B that ends with it, or -1.

    Ends ascend over all documents; those of one document have the same last end in both, and
    documents without tokens have none in either.
    """
    partner = np.full(len(end_a), -1, np.int64)
    i, j, stop = _lanes(end_a, end_b, first_a, first_b, lane)
    alive = i < stop
    i, j, stop = i[alive], j[alive], stop[alive]
    while len(i):
        x, y = end_a[i], end_b[j]
        same = x == y
        partner[i[same]] = j[same]
        i = i + (x <= y)
        j = j + (y <= x)
        alive = i < stop
        if not alive.all():
            i, j, stop = i[alive], j[alive], stop[alive]
    return partner


class Aligned:
    """Tokens, links and cuts of a batch of texts."""

    def __init__(self, texts: list[str | None], tables: Tables):
        ids, self.counts = tables.tokens(texts)
        self.ids = [x.astype(np.int64) for x in ids]
        self.first = [np.concatenate([[0], np.cumsum(c)]) for c in self.counts]
        ends = [np.cumsum(size[x]) for size, x in zip(tables.sizes, self.ids)]
        self.partner = lockstep(*ends, *self.first)
        self.link_a = np.flatnonzero(self.partner >= 0)
        self.link_b = self.partner[self.link_a]
        self.links = np.diff(np.searchsorted(self.link_a, self.first[0]))

    def keys(self) -> np.ndarray:
        """Per link its ids: B's in the upper half of 32 bits, A's in the lower."""
        return self.ids[1][self.link_b] << 16 | self.ids[0][self.link_a]

    def groups(self, tables: Tables) -> list[bytes]:
        """Per text its groups: A's ids, a bar, B's ids; a semicolon between groups."""
        (a, b), (n, m) = self.ids, map(len, self.ids)
        last_a, last_b = np.zeros(n, bool), np.zeros(m, bool)
        last_a[self.link_a] = True
        last_b[self.link_b] = True
        # Behind every group of A come its tokens of B; behind those the next group.
        ends_a, ends_b = self.link_a + 1, self.link_b + 1
        group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
        codes = np.empty(n + m, np.int64)
        before_b = np.concatenate([[0], ends_b])
        codes[np.arange(n) + before_b[group_a]] = 2 * a + last_a
        codes[np.arange(m) + ends_a[group_b]] = 2 * (len(tables.a_bytes) + b) + last_b
        parts = list(map(tables.texts.__getitem__, codes.tolist()))
        stops = (self.first[0] + self.first[1]).tolist()
        return [b"".join(parts[x:y])[:-1] for x, y in zip(stops, stops[1:])]


FIELDS = {
    "block": pa.int64(), "doc_id": pa.list_(pa.int64()), "n_a": pa.list_(pa.int64()), "n_b": pa.list_(pa.int64()),
    "n_links": pa.list_(pa.int64()), "digests": pa.list_(pa.string()), "sequence": pa.binary(),
    "a_ids": pa.list_(pa.binary()), "b_ids": pa.list_(pa.binary()), "a_links": pa.list_(pa.binary()), "b_links": pa.list_(pa.binary()),
    "keys": pa.list_(pa.int64()), "counts": pa.list_(pa.int64()),
}
DETAIL = ("a_ids", "b_ids", "a_links", "b_links")


def _blocks(documents: DataFrame, a_path: str, b_path: str, detail: bool, block_bytes: int) -> DataFrame:
    """A row for each block of texts: its documents' figures, the sequence of its links by their
    number in the block's list of distinct id pairs, and that list with counts."""
    schema, spark_schema = arrow(FIELDS)

    def run(batches):
        from pyspark import TaskContext

        block, tables = TaskContext.get().partitionId() << 32, tables_of(a_path, b_path)
        for b in batches:
            for first, texts in slices(b, 1, block_bytes):
                x = Aligned(texts, tables)
                keys, sequence, counts = np.unique(x.keys(), return_inverse=True, return_counts=True)
                digests = [hashlib.sha256(g).hexdigest() if n else "" for g, n in zip(x.groups(tables), x.counts[0].tolist())]
                more = [None] * 4
                if detail:
                    at = np.searchsorted(x.link_a, x.first[0])
                    cut = lambda v, f: [v[p:q].astype(np.uint32).tobytes() for p, q in zip(f, f[1:])]
                    base = [np.repeat(f[:-1], x.links) for f in x.first]
                    more = [cut(x.ids[0], x.first[0]), cut(x.ids[1], x.first[1]), cut(x.link_a - base[0], at), cut(x.link_b - base[1], at)]
                row = [block, b.column(0).slice(first, len(texts)).to_pylist(), x.counts[0], x.counts[1], x.links, digests, squeezed(sequence.astype(np.uint32).tobytes()), *more, keys, counts]
                yield pa.record_batch([pa.array([v], f.type) for v, f in zip(row, schema)], schema=schema)
                block += 1

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("t")).mapInArrow(run, spark_schema)


def align(documents: DataFrame, run: Run, a_path: str, b_path: str, detail: bool = False, block_bytes: int = 4 << 20) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of every row.

    A encodes a space and the text, B the text, both without special tokens. Null and empty
    texts, and those of which either tokenizer's bytes differ from a space and the text, have no
    tokens: zeros and an empty digest. A link is a pair of tokens that end together; its count is
    how many links of all documents have its ids, and it is a best one if no link of its B id has
    more. Repeated rows count as often as they stand; doc_id may be null or repeated.

    With ``detail``, also a_ids, b_ids (the tokens) and a_links, b_links (places of linked tokens),
    as unsigned 32-bit numbers. Counts go back to the block that asked, one row per block and
    distinct pair; no task holds more than a block.
    """
    ship(documents.sparkSession)
    blocks = run.store(_blocks(documents, a_path, b_path, detail, block_bytes), "blocks", "zstd")
    pairs = blocks.select("block", F.posexplode(F.arrays_zip("keys", "counts")).alias("at", "p")).select("block", "at", F.col("p.keys").alias("key"), F.col("p.counts").alias("c"))
    total = run.store(pairs.groupBy("key").agg(F.sum("c").alias("n")), "totals")
    own = F.shiftright("key", 16)
    most = total.groupBy(own.alias("b")).agg(F.max("n").alias("most"))
    known = run.store(total.join(most, own == F.col("b")).select("key", "n", (F.col("n") == F.col("most")).alias("best")), "known")
    head = [c for c in FIELDS if c not in ("block", "keys", "counts") and (detail or c not in DETAIL)]
    answers = pairs.select("block", "at", "key").join(known, "key").select("block", "at", "n", "best", F.lit(None).cast(blocks.select(F.struct(*head)).schema[0].dataType).alias("head"))
    heads = blocks.select("block", F.lit(-1).alias("at"), F.lit(None).cast("long").alias("n"), F.lit(None).cast("boolean").alias("best"), F.struct(*head).alias("head"))
    shares = int(run.spark.conf.get("spark.sql.shuffle.partitions"))
    both = answers.union(heads).repartition(shares, "block").sortWithinPartitions("block", "at")
    names = DETAIL if detail else ()
    schema, spark_schema = arrow({"doc_id": pa.int64(), **{c: pa.int64() for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")}, "groups_sha256": pa.string(), **{c: pa.binary() for c in names}})

    def answer(head, n, best):
        n, best = np.concatenate([*n, np.empty(0, np.int64)]), np.concatenate([*best, np.empty(0, np.int64)])
        sequence = expanded(head["sequence"]).astype(np.int64)
        stops = np.concatenate([[0], np.cumsum(head["n_links"])]).astype(np.int64)
        sums = [np.diff(np.concatenate([[0], np.cumsum(v[sequence])])[stops]) for v in (best, n)]
        columns = [head["doc_id"], head["n_a"], head["n_b"], head["n_links"], head["n_links"], *sums, head["digests"], *[head[c] for c in names]]
        return pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    def together(batches):
        head, n, best = None, [], []
        for b in batches:
            at = b.column(1).to_numpy()
            stops = np.append(np.flatnonzero(at < 0), len(at))
            for k, start in enumerate(np.concatenate([[0], stops[:-1] + 1])):
                if k:
                    if head is not None:
                        yield answer(head, n, best)
                    head, n, best = b.column(4)[int(stops[k - 1])].as_py(), [], []
                part = slice(int(start), int(stops[k]))
                if part.stop > part.start:
                    size = part.stop - part.start
                    n.append(b.column(2).slice(part.start, size).to_numpy(zero_copy_only=False).astype(np.int64))
                    best.append(b.column(3).slice(part.start, size).to_numpy(zero_copy_only=False).astype(np.int64))
        if head is not None:
            yield answer(head, n, best)

    return both.select("block", "at", "n", "best", "head").mapInArrow(together, spark_schema)
