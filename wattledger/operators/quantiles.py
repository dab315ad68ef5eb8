"""Exact order statistics and quantiles without gathering a group in one task.

``percentile`` keeps every distinct value of a group in one aggregation buffer. That is
fine for tables with one row per day and is used there. For feeds of any size the values
are tallied, cut in about equally full ranges, and only the ranges that hold a wanted rank
are sorted.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RANGES = 256


def _place(df: DataFrame, ranges: int) -> DataFrame:
    """Adds ``range``, the number of ``marks`` below ``value``, by binary search."""
    df = df.withColumn("range", F.lit(0))
    step = ranges // 2
    while step:
        probe = F.col("range") + step
        below = F.try_element_at("marks", probe) < F.col("value")
        df = df.withColumn("range", F.when(below, probe).otherwise(F.col("range")))
        step //= 2
    return df


def order_statistics(
    values: DataFrame,
    by: Sequence[str],
    targets: Callable[[Column], Column],
    few_groups: bool = False,
    ranges: int = RANGES,
) -> DataFrame:
    """Values at given 0-based ranks of each group.

    ``values`` has the ``by`` columns and ``value`` (no nulls in either); ``targets`` maps the row
    count of a group to an array of structs with a ``rank`` field. Returns ``by`` columns,
    the target's fields and ``value``. ``few_groups`` states that the groups are columns of
    the query, not data: then the range limits (``ranges`` numbers per group) are broadcast.
    Otherwise the join is left to adaptive execution, which broadcasts or splits by size.
    ``ranges`` is a power of two.
    """
    by = list(by)
    small = F.broadcast if few_groups else (lambda d: d)
    tally = values.groupBy(*by, "value").agg(F.count(F.lit(1)).alias("copies"))
    cuts = [i / ranges for i in range(1, ranges)]
    marks = tally.groupBy(*by).agg(
        F.percentile_approx("value", cuts, ranges * 20).alias("marks"),
        F.sum("copies").alias("total"),
    )
    placed = _place(tally.join(small(marks), by), ranges).drop("marks")
    # At most ``ranges`` rows per group, so this window is small whatever the input size.
    before = Window.partitionBy(*by).orderBy("range").rowsBetween(
        Window.unboundedPreceding, -1
    )
    filled = (
        placed.groupBy(*by, "range")
        .agg(F.sum("copies").alias("in_range"), F.max("total").alias("total"))
        .withColumn("before", F.coalesce(F.sum("in_range").over(before), F.lit(0).cast("long")))
    )
    wanted = filled.withColumn("target", F.explode(targets(F.col("total")))).filter(
        (F.col("target.rank") >= F.col("before"))
        & (F.col("target.rank") < F.col("before") + F.col("in_range"))
    )
    # Only ranges with a wanted rank are carried on; each is one sorted window partition.
    slots = wanted.groupBy(*by, "range").agg(
        F.first("before").alias("before"), F.collect_list("target").alias("targets")
    )
    running = Window.partitionBy(*by, "range").orderBy("value").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    return (
        placed.join(small(slots), [*by, "range"])
        .withColumn("upto", F.col("before") + F.sum("copies").over(running))
        .withColumn("target", F.explode("targets"))
        # The total is asked for here too: it keeps both uses of ``placed`` the same plan, so
        # that the tally is shuffled once and reused.
        .filter(
            (F.col("target.rank") < F.col("upto"))
            & (F.col("target.rank") >= F.col("upto") - F.col("copies"))
            & (F.col("target.rank") < F.col("total"))
        )
        .select(*by, "target.*", "value")
    )


def exact_quantiles(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float], by: Sequence[str] = ()
) -> DataFrame:
    """Linear-interpolation quantiles: (``by``…, column, prob, value), nulls ignored.

    Rows with a null group key belong to no group.
    """
    by = list(by)
    for key in by:
        df = df.filter(F.col(key).isNotNull())
    long = df.select(
        *by, *[F.col(c).cast("double").alias(c) for c in columns]
    ).unpivot(by, list(columns), "column", "value")
    long = long.filter(F.col("value").isNotNull() & ~F.isnan("value"))

    def targets(total: Column) -> Column:
        entries = []
        for p in probs:
            pos = (total - F.lit(1)).cast("double") * F.lit(float(p))
            for side, rank in (("lo", F.floor(pos)), ("hi", F.ceil(pos))):
                entries.append(
                    F.struct(
                        rank.cast("long").alias("rank"),
                        F.lit(float(p)).alias("prob"),
                        F.lit(side).alias("side"),
                        (pos - F.floor(pos)).alias("weight"),
                    )
                )
        return F.array(*entries)

    ends = order_statistics(long, [*by, "column"], targets, few_groups=not by)
    lo = F.max(F.when(F.col("side") == "lo", F.col("value")))
    hi = F.max(F.when(F.col("side") == "hi", F.col("value")))
    return ends.groupBy(*by, "column", "prob").agg(
        (lo + (hi - lo) * F.max("weight")).alias("value")
    )


def hash_threshold(df: DataFrame, ticket: Column, count: Callable[[Column], Column]) -> DataFrame:
    """One row: the 64-bit hash ``ticket`` at 1-based rank ``count(total rows)``.

    Hashes spread evenly over their upper 16 bits, so the first pass counts 65,536 slots and
    the second looks into the one slot that holds the rank. Equal hashes are tallied before
    they are ordered. No row when the count is zero.
    """
    rows = df.select(ticket.alias("ticket"), F.shiftright(ticket, 48).alias("slot"))
    everything = Window.partitionBy(F.lit(0))
    running = everything.orderBy("slot").rowsBetween(Window.unboundedPreceding, 0)
    rank = count(F.col("total")).cast("long")
    hit = (
        rows.groupBy("slot")
        .agg(F.count(F.lit(1)).alias("n"))
        .select(
            "slot",
            "n",
            F.sum("n").over(running).alias("upto"),
            F.sum("n").over(everything).alias("total"),
        )
        .filter((rank <= F.col("upto")) & (rank > F.col("upto") - F.col("n")))
        .select(F.struct("slot", (rank - F.col("upto") + F.col("n")).alias("rank")).alias("h"))
        .scalar()
    )
    inside = Window.partitionBy("slot").orderBy("ticket").rowsBetween(
        Window.unboundedPreceding, 0
    )
    return (
        rows.filter(F.col("slot") == hit["slot"])
        .groupBy("slot", "ticket")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("upto", F.sum("n").over(inside))
        .filter((F.col("upto") >= hit["rank"]) & (F.col("upto") - F.col("n") < hit["rank"]))
        .select("ticket")
    )


def daily_quantiles(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float]
) -> DataFrame:
    """Same result as :func:`exact_quantiles` for a table with one row per day.

    Such a table cannot outgrow the calendar, so the built-in exact ``percentile`` is used.
    """
    arr = F.array(*[F.lit(float(p)) for p in probs])
    packed = df.agg(*[F.percentile(F.col(c).cast("double"), arr).alias(c) for c in columns])
    return (
        packed.unpivot([], list(columns), "column", "values")
        .select("column", F.posexplode_outer("values").alias("i", "value"))
        .select("column", F.element_at(arr, F.col("i") + 1).alias("prob"), "value")
    )
