"""Windows: shares of a daily total and ordered fills."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from wattledger.functions.scalars import share_pct
from wattledger.session import materialize


def share_of_day(df: DataFrame, group: str, value: str, total: str, share: str) -> DataFrame:
    """Sum per (date, group) and its percentage of the date's sum.

    The rows are summed before the window runs, so a window partition holds one row per
    group of the date.
    """
    sums = df.groupBy("date", group).agg(F.sum(value).cast("double").alias(total))
    of_day = F.sum(total).over(Window.partitionBy("date"))
    return sums.withColumn(share, share_pct(F.col(total), of_day))


def latest_per_key(df: DataFrame, keys: Sequence[str], timestamp: str, tie: str) -> DataFrame:
    """Newest row of each key (null timestamps first, ties by ``tie`` descending).

    Stated as an aggregate, which combines before the shuffle; ``row_number`` would sort
    every row of a key in one task.
    """
    from wattledger.operators.joins import latest_order

    rest = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(
        F.max_by(F.struct(*rest), latest_order(timestamp, tie)).alias("_row")
    )
    return picked.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest])


def fill_in_order(
    df: DataFrame,
    columns: Sequence[str],
    order: str = "date",
    descending: bool = False,
    forward: bool = True,
    backward: bool = False,
    by: Sequence[str] = (),
) -> DataFrame:
    """Fill nulls with the nearest value before (``forward``) or after in row order.

    With both, what the forward fill leaves open is filled backward. Rows are ordered by a
    date column and windowed one month at a time; what a month takes over from other months
    comes from a table of one row per month. The frame may thus be as long as the calendar
    without ever being sorted in one task.
    """
    columns, by = list(columns), list(by)
    # True where values flow from older to newer dates.
    flows = [d for d, on in ((not descending, forward), (descending, backward)) if on]
    rows = df.withColumn("_month", F.trunc(order, "month"))

    def name(older: bool, c: str) -> str:
        return f"_{'old' if older else 'new'}_{c}"

    ends = rows.groupBy(*by, "_month").agg(
        *[
            (F.max_by if older else F.min_by)(
                F.col(c), F.when(F.col(c).isNotNull(), F.col(order))
            ).alias(name(older, c))
            for older in flows
            for c in columns
        ]
    )

    def outward(key: str, older: bool) -> WindowSpec:
        return Window.orderBy(F.col(key) if older else F.col(key).desc())

    carried = ends.select(
        *by,
        "_month",
        *[
            F.last(name(older, c), ignorenulls=True)
            .over(
                outward("_month", older)
                .partitionBy(*(by or [F.lit(0)]))
                .rowsBetween(Window.unboundedPreceding, -1)
            )
            .alias(name(older, c))
            for older in flows
            for c in columns
        ],
    )
    joined = rows.join(carried, [*by, "_month"], "left")

    def filled(c: str) -> Column:
        choices = []
        for older in flows:
            inside = (
                outward(order, older)
                .partitionBy(*by, "_month")
                .rowsBetween(Window.unboundedPreceding, Window.currentRow)
            )
            choices += [F.last(c, ignorenulls=True).over(inside), F.col(name(older, c))]
        return F.coalesce(*choices).alias(c)

    return joined.select(*[filled(c) if c in columns else F.col(c) for c in df.columns])


def forward_fill(df, columns, order="date", descending=False, by=()) -> DataFrame:
    return fill_in_order(df, columns, order, descending, True, False, by)


def backward_fill(df, columns, order="date", descending=False, by=()) -> DataFrame:
    return fill_in_order(df, columns, order, descending, False, True, by)


def scan_fill(
    df: DataFrame,
    columns: Sequence[str],
    order: Sequence[str],
    by: Sequence[str] = (),
    forward: bool = True,
    backward: bool = False,
) -> DataFrame:
    """The same fills for rows of any feed, many to a date: a prefix scan over ranges of rows.

    Rows are ordered by ``order`` (nulls first), those that tie by a hash of the whole row, so
    that only equal rows are interchangeable. They are dealt to ranges of that order and stored;
    a range is filled on its own, and what it takes over from other ranges comes from a table of
    one row per range and key. A range holds its share of the rows whatever the dates or keys.
    With both directions, what the forward fill leaves open is filled backward.
    """
    columns, by = list(columns), list(by)
    line = [*by, *order, "_tie"]
    tied = df.withColumn("_tie", F.xxhash64(*df.columns))
    ranged = tied.repartitionByRange(*line).sortWithinPartitions(*line)
    stored = materialize(ranged.withColumn("_id", F.monotonically_increasing_id()), "fill")
    rows = stored.withColumn("_range", F.shiftright("_id", 33))
    flows = [older for older, on in ((True, forward), (False, backward)) if on]

    def name(older: bool, c: str) -> str:
        return f"_{'old' if older else 'new'}_{c}"

    def outward(key: str, older: bool) -> WindowSpec:
        return Window.orderBy(F.col(key) if older else F.col(key).desc())

    known = {c: F.when(F.col(c).isNotNull(), F.col("_id")) for c in columns}
    ends = rows.groupBy(*by, "_range").agg(
        *[(F.max_by if older else F.min_by)(F.col(c), known[c]).alias(name(older, c)) for older in flows for c in columns]
    )
    carried = ends.select(
        *[F.col(c).alias(f"_by_{c}") for c in by],
        F.col("_range").alias("_at"),
        *[
            F.last(name(older, c), ignorenulls=True)
            .over(
                outward("_range", older)
                .partitionBy(*(by or [F.lit(0)]))
                .rowsBetween(Window.unboundedPreceding, -1)
            )
            .alias(name(older, c))
            for older in flows
            for c in columns
        ],
    )
    same = F.col("_range") == F.col("_at")
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"_by_{c}"))

    def filled(c: str) -> Column:
        choices = []
        for older in flows:
            inside = (
                outward("_id", older)
                .partitionBy(*by, "_range")
                .rowsBetween(Window.unboundedPreceding, Window.currentRow)
            )
            choices += [F.last(c, ignorenulls=True).over(inside), F.col(name(older, c))]
        return F.coalesce(*choices).alias(c)

    joined = rows.join(carried, same, "left")
    return joined.select(*[filled(c) if c in columns else F.col(c) for c in df.columns])
