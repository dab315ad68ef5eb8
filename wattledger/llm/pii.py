"""Personal data: fixed rules find seeds, and lexical patterns learned from the seeds' contexts
find what the rules miss.

Patterns and instances form a graph. A pattern's confidence is the mean trust in the instances
that it finds; Spark computes both in turn, from all documents. Seeds are trusted fully, a
stranger as much as the best pattern with another cue that finds it too: what a pattern says
itself is no evidence for it.
"""

from __future__ import annotations

import re

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattledger.llm.common import Run, arrow, ship

KINDS = ("email", "ip", "card", "phone")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
CARD = re.compile(r"(?<![0-9])[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
#: Candidates for further instances: tokens with two digits at least, or around an @.
TOKEN = re.compile(r"[A-Za-z0-9+(@][A-Za-z0-9@._%+()-]*[A-Za-z0-9]")
TWO_DIGITS = re.compile(r"[0-9][^0-9]*[0-9]")
#: Longer texts stand for themselves by their digest.
LONG = 40


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by the fixed rules: leftmost, non-overlapping in each kind; matches
    that fail a rule's check are dropped. Linear in the text's length."""
    out = []
    at, last = text.find("@"), 0
    while at >= 0:
        start = at
        while start > last and text[start - 1] in LOCAL_CHARS:
            start -= 1
        if start < at and (m := DOMAIN.match(text, at + 1)):
            out.append(("email", start, m.end()))
            last = m.end()
        at = text.find("@", max(at + 1, last))
    if any(map(text.__contains__, "0123456789")):
        for m in IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
                out.append(("ip", *m.span()))
        for m in CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", *m.span()))
        if "+" in text:
            for m in PHONE.finditer(text):
                if 9 <= sum(c in "0123456789" for c in m[0]) <= 15:
                    out.append(("phone", *m.span()))
    return out


def rendered(spans) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1], s[2])))


def shape(value: str) -> str:
    """Kinds of characters with their counts, counts above three as ``+``."""
    out, i = [], 0
    while i < len(value):
        c = value[i]
        k = "9" if c.isdigit() else "A" if c.isupper() else "a" if c.isalpha() else c
        j = i + 1
        while j < len(value) and (x := value[j]) and ("9" if x.isdigit() else "A" if x.isupper() else "a" if x.isalpha() else x) == k:
            j += 1
        out.append(k + (str(j - i) if k == "9" else "+" if j - i > 3 else ""))
        i = j
    return brief("".join(out))


def brief(value: str) -> str:
    return value if len(value) <= LONG else f"#{len(value)}:{xxhash.xxh3_128_hexdigest(value.encode())}"


def cue(text: str, start: int) -> str:
    """Letters and digits, then other marks, before a place: in lower case, digits as 9; at the
    text's begin ^."""
    end = start
    while end and text[end - 1].isspace():
        end -= 1
    marks = end
    while marks and not (text[marks - 1].isalnum() or text[marks - 1].isspace()):
        marks -= 1
    word = marks
    while word and text[word - 1].isalnum():
        word -= 1
    return brief(re.sub(r"[0-9]", "9", text[word:end].lower())) or "^"


def mentions(text: str) -> list[tuple[str | None, str, str, str, int, int]]:
    """(kind or None, instance, cue, shape, start, end) of seeds and of candidates beside them."""
    seeds = base_spans(text)
    out = [(k, text[a:b], cue(text, a), shape(text[a:b]), a, b) for k, a, b in seeds]
    if any(map(text.__contains__, "0123456789@")):
        taken = sorted((a, b) for _, a, b in seeds)
        i = 0
        for m in TOKEN.finditer(text):
            if "@" not in m[0] and not TWO_DIGITS.search(m[0]):
                continue
            while i < len(taken) and taken[i][1] <= m.start():
                i += 1
            if i < len(taken) and taken[i][0] < m.end():
                continue
            out.append((None, m[0], cue(text, m.start()), shape(m[0]), *m.span()))
    return out


def found_mentions(documents: DataFrame) -> DataFrame:
    """(kind, instance as hash, pattern) of every mention, distinct within a batch of rows."""
    schema, spark_schema = arrow({"kind": pa.string(), "instance": pa.string(), "cue": pa.string(), "shape": pa.string(), "n": pa.int64()})

    def run(batches):
        for b in batches:
            seen: dict[tuple, int] = {}
            for text in b.column(0).to_pylist():
                for kind, instance, before, form, _, _ in mentions(text):
                    key = (kind, brief(instance), before, form)
                    seen[key] = seen.get(key, 0) + 1
            rows = list(zip(*((*k, n) for k, n in seen.items()))) or [[]] * 5
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(rows, schema)], schema=schema)

    return documents.select(F.coalesce("text", F.lit("")).alias("t")).mapInArrow(run, spark_schema)


def learned(documents: DataFrame, run: Run, rounds: int = 3, confidence: float = 0.8, support: int = 5) -> DataFrame:
    """High-confidence patterns (cue, shape, kind, confidence), found from all documents: a stored
    table with the best kind of each (cue, shape).

    A pattern is a kind with the word before it and the instance's shape, or with ``*`` for the
    shape. It needs ``support`` different seeds as instances. A stranger counts for a pattern with
    the confidence of the best pattern of another cue that finds it (leave one out), with nothing
    if there is none. Patterns that take in no stranger
    can find nothing in these documents and are left out; nothing else bounds their number.
    """
    edges = run.store(
        found_mentions(documents).groupBy("kind", "instance", "cue", "shape").agg(F.sum("n").alias("n")), "mentions")
    forms = edges.select("kind", "instance", F.explode(F.array(
        F.struct("cue", "shape"), F.struct("cue", F.lit("*").alias("shape")))).alias("p")).select("kind", "instance", "p.*").distinct()
    seeded = forms.filter("kind is not null").groupBy("kind", "cue", "shape").agg(F.count(F.lit(1)).alias("seeds"))
    seeded = seeded.filter(F.col("seeds") >= support)
    strange = forms.filter("kind is null").select("cue", "shape").distinct()
    # Patterns seeded by several kinds, and the strangers that they would take in.
    graph = run.store(
        seeded.join(strange, ["cue", "shape"], "left_semi").select("kind", "cue", "shape", "seeds").join(forms.withColumnRenamed("kind", "own"), ["cue", "shape"]), "graph")
    trust = F.when(F.col("own") == F.col("kind"), 1.0).when(F.col("own").isNotNull(), 0.0)
    scored = graph.select("kind", "cue", "shape", "instance", "own", F.coalesce(trust, F.lit(0.0)).alias("trust"))
    patterns = scored.groupBy("kind", "cue", "shape").agg(F.avg("trust").alias("confidence"))
    for _ in range(rounds):
        held = run.store(patterns, "patterns")
        believed = graph.filter("own is null").join(held, ["kind", "cue", "shape"]).groupBy("kind", "instance", "cue").agg(F.max("confidence").alias("t"))
        believed = run.store(believed, "believed")
        first = believed.groupBy("kind", "instance").agg(F.max(F.struct("t", "cue")).alias("top"))
        rest = believed.join(first, ["kind", "instance"]).filter("cue <> top.cue").groupBy("kind", "instance").agg(F.max("t").alias("next"))
        others = first.join(rest, ["kind", "instance"], "left")
        other = F.when(F.col("cue") != F.col("top.cue"), F.col("top.t")).otherwise(F.col("next"))
        again = graph.join(others, ["kind", "instance"], "left").select(
            "kind", "cue", "shape", F.coalesce(trust, other, F.lit(0.0)).alias("trust"))
        patterns = again.groupBy("kind", "cue", "shape").agg(F.avg("trust").alias("confidence"))
    best = patterns.filter(F.col("confidence") >= confidence).groupBy("cue", "shape").agg(F.min(F.struct((-F.col("confidence")).alias("c"), "kind")).alias("m"))
    return run.store(best.select("cue", "shape", "m.kind", (-F.col("m.c")).alias("confidence")), "learned")


def learn(documents: DataFrame, run: Run, rounds: int = 3, confidence: float = 0.8, support: int = 5) -> list[tuple[str, str, str]]:
    """The patterns of ``learned`` as a list (kind, cue, shape), the best first: all of them go to
    the driver, which suits small tables."""
    best = learned(documents, run, rounds, confidence, support).orderBy(F.desc("confidence"), "kind", "cue", "shape")
    return [(r.kind, r.cue, r.shape) for r in best.collect()]


def _found(rows: DataFrame, patterns: DataFrame, run: Run) -> DataFrame:
    """(__key, found) of the texts (__key, __text) in which patterns find strangers, stored: every
    stranger of a distinct text is joined to the patterns, with its shape, then with ``*``."""
    schema, spark_schema = arrow({"__key": pa.binary(), "cue": pa.string(), "shape": pa.string(), "start": pa.int64(), "end": pa.int64()})

    def run_(batches):
        for b in batches:
            out = [(i, c, s, a, e) for i, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()) for k, _, c, s, a, e in mentions(text) if not k]
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(list(zip(*out)) or [[]] * 5, schema)], schema=schema)

    exact = patterns.filter("shape != '*'").select("cue", "shape", F.col("kind").alias("k1"))
    star = patterns.filter("shape = '*'").select("cue", F.col("kind").alias("k2"))
    named = rows.mapInArrow(run_, spark_schema).distinct().join(exact, ["cue", "shape"], "left").join(star, "cue", "left")
    named = named.select("__key", F.coalesce("k1", "k2").alias("kind"), "start", "end").filter("kind is not null")
    spans = named.groupBy("__key").agg(F.array_sort(F.collect_list(F.struct("start", "end", "kind"))).alias("f"))
    return run.store(spans.select("__key", F.transform("f", lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"))).alias("found")), "found")


def _with_found(documents: DataFrame, patterns: DataFrame, run: Run | None) -> DataFrame:
    """``documents`` (without a column ``found``) and ``found``, what the patterns find in each text."""
    key = F.unhex(F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256))
    rows = documents.withColumn("__key", key)
    hits = _found(rows.select("__key", F.coalesce("text", F.lit("")).alias("__text")), patterns, run or Run(documents.sparkSession, "pii"))
    none = F.array().cast(hits.schema["found"].dataType)
    return rows.join(hits, "__key", "left").select(*documents.columns, F.coalesce("found", none).alias("found"))


def extract(documents: DataFrame, patterns: DataFrame | list[tuple[str, str, str]], run: Run | None = None) -> DataFrame:
    """The columns of ``documents`` and ``base`` and ``found``: lists of (kind, start, end) in
    code points, ends exclusive, by the fixed rules and by the patterns; both empty for null.

    A table of patterns is joined to the distinct texts, with what they find stored below ``run``;
    its number of rows is not bounded. A list goes to every task.
    """
    ship(documents.sparkSession)
    if isinstance(patterns, DataFrame):
        if patterns.isEmpty():
            return extract(documents, [])
        rest = [c for c in documents.columns if c.lower() not in ("base", "found")]
        rows = _with_found(documents.select(*rest), patterns, run).withColumnRenamed("found", "__found")
        return extract(rows, []).select(*rest, "base", F.col("__found").alias("found"))
    rest = [c for c in documents.columns if c.lower() not in ("base", "found")]
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
    spark_span = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
    schema = T.StructType([*documents.select(*rest).schema.fields, T.StructField("base", spark_span), T.StructField("found", spark_span)])
    known = {(c, s): k for k, c, s in reversed(patterns)}
    df = documents.select(*rest, F.coalesce("text", F.lit("")).alias("__text"))

    def run(batches):
        named = lambda x: [{"kind": k, "start": a, "end": b} for k, a, b in x]
        for b in batches:
            base, found = [], []
            for text in b.column(b.num_columns - 1).to_pylist():
                if known:
                    all_ = mentions(text)
                    base.append(named((k, a, e) for k, _, _, _, a, e in all_ if k))
                    more = ((known.get((c, s)) or known.get((c, "*")), a, e) for k, _, c, s, a, e in all_ if not k)
                    found.append(named(x for x in more if x[0]))
                else:
                    base.append(named(base_spans(text)))
                    found.append([])
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(base, pa.list_(span)), pa.array(found, pa.list_(span))], [*b.schema.names[:-1], "base", "found"])

    return df.mapInArrow(run, schema)


def joined(*lists: str):
    """kind:start:end of all spans by kind, start and end, comma-joined."""
    order = F.array_sort(F.transform(F.concat(*map(F.col, lists)), lambda s: F.struct(
        F.array_position(F.array(*map(F.lit, KINDS)), s["kind"]).alias("k"), s["start"].alias("a"), s["end"].alias("b"), s["kind"].alias("kind"))))
    return F.array_join(F.transform(order, lambda s: F.concat_ws(":", s["kind"], s["a"], s["b"])), ",")


def redacted(documents: DataFrame, patterns: DataFrame | list[tuple[str, str, str]], run: Run | None = None) -> DataFrame:
    """``documents`` with every span replaced by its kind in angle brackets; overlapping spans
    become one. Null stays null. All columns stay as they are, whatever their names; repeated
    rows and those without doc_id are treated like any others."""
    position = documents.columns.index("text")
    apart = documents.toDF(*["text" if i == position else f"__c{i}" for i in range(len(documents.columns))])
    plain = apart.schema
    ship(documents.sparkSession)
    known: dict[tuple[str, str], str] = {}
    if isinstance(patterns, DataFrame) and not patterns.isEmpty():
        df = _with_found(apart, patterns, run)
    else:
        known = {} if isinstance(patterns, DataFrame) else {(c, s): k for k, c, s in reversed(patterns)}
        df = apart.withColumn("found", F.lit(None).cast("array<struct<kind: string, start: bigint, end: bigint>>"))

    def run(batches):
        for b in batches:
            out = []
            for text, found in zip(b.column(position).to_pylist(), b.column(b.num_columns - 1).to_pylist()):
                if known:
                    named = ((k or known.get((c, s)) or known.get((c, "*")), x, y) for k, _, c, s, x, y in mentions(text or ""))
                    spans = sorted((x, y, k) for k, x, y in named if k)
                else:
                    spans = sorted([*((x, y, k) for k, x, y in base_spans(text or "")), *((s["start"], s["end"], s["kind"]) for s in found or ())])
                parts, last = [], 0
                for a, e, kind in spans:
                    if a >= last:
                        parts += [text[last:a], f"<{kind}>"]
                    last = max(last, e)
                out.append(text if not spans else "".join([*parts, text[last:]]))
            columns = [*b.columns[:-1]]
            columns[position] = pa.array(out, pa.string())
            yield pa.RecordBatch.from_arrays(columns, b.schema.names[:-1])

    return df.mapInArrow(run, plain).toDF(*documents.columns)
