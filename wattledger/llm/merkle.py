"""Merkle manifest of a dataset by bitmap ranks: no document is sorted.

Every group's doc_ids are merged into sparse bitmaps, one 64-bit word for each 64 ids that the
group has. A directory of population counts above the words, 4,096 entries to a range, gives
the rank of an id: its leaf's place in the group. From there on rows meet by (group, place of
the run): every run of 16 nodes is an array of slots that becomes one node of the next level.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattledger.llm.common import Run, numbered

FAN = 16
#: Columns of a leaf, in their order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
WORD, STEP = 6, 12
#: Directory levels above the words: 6 + 4 * 12 bits of an id, then its 10 upper bits as they are.
DEPTH = 4


def field(c: Column) -> Column:
    """``-`` for null, else the value's number of UTF-8 bytes, a colon and the value."""
    text = c.cast("string")
    return F.when(c.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(**replaced: Column) -> Column:
    """Digest of one row; ``replaced`` columns stand for the row's own."""
    return F.sha2(F.concat(*[field(replaced.get(c, F.col(c))) for c in FIELDS]), 256)


def _shifted(c: str, bits: int) -> Column:
    return F.shiftright(F.col(c), bits)


def ranks(ids: DataFrame, run: Run) -> DataFrame:
    """Words of the groups' bitmaps with their places, stored: (src, part, k, bits, n, before, n0).

    ``ids``: (src, part, id), one row per leaf; order in a group is by part, then id. ``k`` is
    id >> 6, ``bits`` has the word's ids, ``n`` its leaves (more than its bits where ids repeat),
    ``before`` the group's leaves in front of it and ``n0`` all of the group's. Every window
    here covers one range of the directory, 4,096 rows at most, 2,048 at the top.
    """
    one = F.expr("shiftleft(1L, cast(id & 63 as int))")
    words = run.store(ids.groupBy("src", "part", _shifted("id", WORD).alias("k")).agg(F.bit_or(one).alias("bits"), F.count(F.lit(1)).alias("n")), "words")
    levels = [words.select("src", "part", "k", "n")]
    for _ in range(DEPTH):
        levels.append(levels[-1].groupBy("src", "part", _shifted("k", STEP).alias("k")).agg(F.sum("n").alias("n")))
    levels[1] = run.store(levels[1], "directory")
    for i in range(2, DEPTH + 1):
        levels[i] = levels[i - 1].groupBy("src", "part", _shifted("k", STEP).alias("k")).agg(F.sum("n").alias("n"))
    earlier = lambda w: F.coalesce(F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    group = Window.partitionBy("src")
    above = levels[-1].select("src", "part", "k", earlier(group.orderBy("part", "k")).alias("before"), F.sum("n").over(group).alias("n0"))
    for level in reversed(levels[:-1]):
        up = above.select("src", "part", F.col("k").alias("up"), F.col("before").alias("start"), "n0")
        own = Window.partitionBy("src", "part", "up").orderBy("k")
        placed = level.withColumn("up", _shifted("k", STEP)).withColumn("inside", earlier(own))
        above = placed.join(up, ["src", "part", "up"]).select("src", "part", "k", (F.col("start") + F.col("inside")).alias("before"), "n0")
    return run.store(words.join(above, ["src", "part", "k"]), "ranks")


def placed(leaves: DataFrame, words: DataFrame) -> DataFrame:
    """``leaves`` (src, part, id, digest, ...) with ``at``, the place in the group, and ``n``, the
    group's size. Leaves of one id stand in order of their digests."""
    one = leaves.withColumn("k", _shifted("id", WORD)).join(words.withColumnRenamed("n", "held"), ["src", "part", "k"])
    lower = F.expr("bit_count(bits & ~shiftleft(-1L, cast(id & 63 as int)))")
    columns = [*leaves.columns, "before", "n0", "k"]
    single = F.col("held") == F.expr("bit_count(bits)")
    plain = one.filter(single).select(*columns, lower.cast("long").alias("inside"))
    word = Window.partitionBy("src", "part", "k").orderBy("id", "digest")
    tied = one.filter(~single).select(*columns, (F.row_number().over(word) - 1).cast("long").alias("inside"))
    return plain.union(tied).withColumn("at", F.col("before") + F.col("inside")).withColumnRenamed("n0", "n").drop("before", "inside", "k")


def _join(digests: Column) -> Column:
    return F.array_join(digests, "")


def reduced(nodes: DataFrame, run: Run) -> list[DataFrame]:
    """Levels of runs, the lowest first, until every group has one node.

    ``nodes``: (src, at, n, digest, ...); a run is (src, at, n, slots, digest) with ``n`` the
    nodes of its level and ``slots`` its nodes in order, with all further columns. A group's
    only leaf is a run of its own whose digest is the leaf's.
    """
    levels = []
    while True:
        further = [c for c in nodes.columns if c not in ("src", "at", "n", "digest")]
        slot = F.struct((F.col("at") % FAN).cast("int").alias("slot"), "digest", *further)
        runs = nodes.groupBy("src", F.expr(f"at div {FAN}").alias("at")).agg(F.first("n").alias("n"), F.array_sort(F.collect_list(slot)).alias("slots"))
        digest = F.when(F.col("n") == 1, F.col("slots")[0]["digest"]).otherwise(F.sha2(_join(F.col("slots.digest")), 256))
        levels.append(run.store(runs.withColumn("digest", digest), "level"))
        nodes = levels[-1].filter(F.col("n") > FAN).select("src", "at", F.ceil(F.col("n") / FAN).cast("long").alias("n"), "digest")
        if nodes.isEmpty():
            return levels


NO_PATH = "cast(array() as array<struct<left: string, right: string>>)"


def climbed(levels: list[DataFrame], base: DataFrame | None) -> DataFrame:
    """Every node of the lowest level with its further columns, ``top`` (its group's last digest)
    and ``path``: the siblings (left, right) of each level above it, then the group's ``path`` in
    ``base`` (src, path, further columns)."""
    given = [c for c in base.columns if c != "src"] if base is not None else ["path"]
    above = None
    for runs in reversed(levels):
        last = runs.filter(F.col("n") <= FAN).withColumn("top", F.col("digest"))
        last = last.join(base, "src") if base is not None else last.withColumn("path", F.expr(NO_PATH))
        columns = ["src", "at", "n", "slots", "top", *given]
        whole = last.select(*columns)
        if above is not None:
            whole = whole.union(runs.filter(F.col("n") > FAN).join(above.select("src", "at", "top", *given), ["src", "at"]).select(*columns))
        node = whole.select(*columns, F.explode("slots").alias("node"))
        side = lambda keep: _join(F.transform(F.filter("slots", keep), lambda s: s["digest"]))
        own = F.array(F.struct(
            side(lambda s: s["slot"] < F.col("node.slot")).alias("left"), side(lambda s: s["slot"] > F.col("node.slot")).alias("right")))
        path = F.when(F.col("n") == 1, F.col("path")).otherwise(F.concat(own, "path"))
        above = node.select("src", (F.col("at") * FAN + F.col("node.slot")).alias("at"), "node.*", "top", path.alias("path"), *[c for c in given if c != "path"]).drop("slot")
    return above


def folded(start: Column, path: Column) -> Column:
    """Root that a leaf's digest and its siblings give."""
    return F.aggregate(path, start, lambda acc, p: F.sha2(F.concat(p["left"], acc, p["right"]), 256))


def proof(path: Column) -> Column:
    """Digest of all siblings, level by level, left to right."""
    return F.sha2(_join(F.transform(path, lambda p: F.concat(p["left"], p["right"]))), 256)


@dataclass
class Manifest:
    """Stored levels: the runs of every group's tree, and of the tree over the groups."""

    levels: list[DataFrame]
    groups: list[DataFrame]
    words: DataFrame

    def nodes(self) -> DataFrame:
        """(source, level, at, digest) of all nodes above the leaves, the groups' first; the levels
        over the groups have source null and go on from -1 downwards."""
        def of(runs, level, source):
            return runs.filter("n > 1").select(source.alias("source"), F.lit(level).alias("level"), "at", "digest")

        own = F.when(F.col("src") != "", F.expr("substring(src, 2)"))
        parts = [of(x, i + 1, own) for i, x in enumerate(self.levels)]
        parts += [of(x, -1 - i, F.lit(None).cast("string")) for i, x in enumerate(self.groups)]
        out = parts[0]
        for p in parts[1:]:
            out = out.union(p)
        return out

    def rank(self, ids: DataFrame) -> DataFrame:
        """(source, doc_id, at) of those of ``ids`` (source, doc_id) that the dataset has, by the
        bitmaps alone; of leaves with one doc_id the first."""
        src = F.when(F.col("source").isNull(), "").otherwise(F.concat(F.lit("="), "source"))
        asked = ids.select("source", "doc_id", src.alias("src"), F.lit(1).alias("part"), _shifted("doc_id", WORD).alias("k"))
        found = asked.join(self.words, ["src", "part", "k"]).filter(F.expr("bits & shiftleft(1L, cast(doc_id & 63 as int)) <> 0"))
        lower = F.expr("bit_count(bits & ~shiftleft(-1L, cast(doc_id & 63 as int)))")
        return found.filter(F.col("n") == F.expr("bit_count(bits)")).select("source", "doc_id", (F.col("before") + lower).alias("at"))

    def proofs(self) -> DataFrame:
        """doc_id, digest (of the leaf), the carried columns, subroot, root, path."""
        over = climbed(self.groups, None).select(F.col("name").alias("src"), "path", F.col("top").alias("root"))
        return climbed(self.levels, over).withColumnRenamed("top", "subroot").drop("src", "at")


def build(documents: DataFrame, run: Run, **carried: Column) -> Manifest:
    """Manifest of ``documents`` (doc_id, source, lang, n_chars, text; other columns are not read).

    Leaves ascend by doc_id in each source; ``carried`` columns go along with them. Rows without
    doc_id come first, in order of their digests; those of one doc_id are ordered by digest too,
    and equal rows are a leaf each. The rows of one repeated doc_id are ordered in one task; rows
    without doc_id are not: the first 40 bits of the digest stand for the id. An empty table
    has no nodes. Null and empty texts, sources and languages have digests of their own.
    """
    src = F.when(F.col("source").isNull(), "").otherwise(F.concat(F.lit("="), "source"))
    rows = documents.select(src.alias("src"), F.col("doc_id").cast("long").alias("doc_id"), leaf().alias("digest"), *[c.alias(n) for n, c in carried.items()])
    part = F.col("doc_id").isNotNull().cast("int")
    stand_in = F.conv(F.substring("digest", 1, 10), 16, 10).cast("long")
    leaves = run.store(rows.withColumn("part", part).withColumn("id", F.coalesce("doc_id", stand_in)), "leaves")
    words = ranks(leaves.select("src", "part", "id"), run)
    levels = reduced(placed(leaves, words).drop("part", "id"), run)
    tops = None
    for runs in levels:
        last = runs.filter(F.col("n") <= FAN).select(F.col("src").alias("name"), "digest")
        tops = last if tops is None else tops.union(last)
    order = numbered(tops, ["name"], run, "sources")
    nodes = order.select(F.lit("").alias("src"), "at", F.lit(order.count()).cast("long").alias("n"), "digest", "name")
    return Manifest(levels, reduced(nodes, run), words)
