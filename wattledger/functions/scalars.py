"""Scalar cleaning, text, date and index functions (Column → Column, all code-generated)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text Python reads as a float. Spark's cast alone also takes Java suffixes such as "12d".
_NUMBER = r"(?i)^\s*[+-]?(inf|infinity|nan|(\d+\.?\d*|\.\d+)(e[+-]?\d+)?)\s*$"


def as_date(value: str | dt.date | Column) -> Column:
    """A date literal from a date or ISO text; columns pass through."""
    return value if isinstance(value, Column) else F.lit(value).cast("date")


def clean_number(c: Column) -> Column:
    """Text → double; null, blank, ``.`` and anything unparsable → null."""
    return F.when(c.rlike(_NUMBER), F.trim(c)).try_cast("double")


def coerce_number(c: Column) -> Column:
    """Any column → double, null where the value does not convert."""
    return clean_number(c.cast("string"))


def prefix(c: Column, n: int) -> Column:
    return F.substring(c, 1, n)


def digits_number(c: Column) -> Column:
    """All digits of a text read as one integer ("9 to 14" → 914).

    0 when there are none, null when they do not fit 64 bits.
    """
    digits = F.coalesce(F.regexp_replace(c, "[^0-9]", ""), F.lit(""))
    return F.when(digits == "", F.lit(0).cast("bigint")).otherwise(digits.try_cast("bigint"))


def first_number(c: Column) -> Column:
    """First run of digits as double, null when there is none ("9 to 14" → 9)."""
    return F.regexp_extract(c, r"(\d+)", 1).try_cast("double")


def contains_any(c: Column, words: list[str]) -> Column:
    """Case-insensitive test for any of ``words``."""
    low = F.lower(c)
    hit = low.contains(words[0])
    for w in words[1:]:
        hit = hit | low.contains(w)
    return hit


def text_date(c: Column) -> Column:
    """Text with a leading ISO date (optionally a time) → date, null when it is none."""
    return F.substring(c.cast("string"), 1, 10).try_cast("date")


def week_start(c: Column) -> Column:
    return F.trunc(c, "week")


def month_start(c: Column) -> Column:
    return F.trunc(c, "month")


def days_between(start: Column, end: Column) -> Column:
    return F.datediff(end, start)


def weekday(c: Column) -> Column:
    """Monday 0 … Sunday 6."""
    return F.weekday(c)


def day_name(c: Column) -> Column:
    return F.date_format(c, "EEEE")


def is_weekend(c: Column) -> Column:
    return F.weekday(c) >= 5


def compact_date(c: Column) -> Column:
    return F.date_format(c, "yyyyMMdd")


def version_tag(c: Column) -> Column:
    return F.concat(F.lit("v"), compact_date(c))


def calendar(start: Column, end: Column) -> Column:
    """Array of the days from ``start`` to ``end``, both included."""
    return F.sequence(start, end, F.expr("interval 1 day"))


def seasonal_factor(
    c: Column, base: float = 1.0, amplitude: float = 0.2, shift_days: int = 0, period: int = 365
) -> Column:
    """``base + amplitude · sin(2π · (day of year − shift) / period)``."""
    angle = F.lit(2.0) * F.pi() * (F.dayofyear(c) - F.lit(shift_days)) / F.lit(float(period))
    return F.lit(float(base)) + F.lit(float(amplitude)) * F.sin(angle)


def cooling_degree_days(t: Column, base: float = 65.0) -> Column:
    return F.when(t.isNotNull(), F.greatest(t - F.lit(base), F.lit(0.0)))


def heating_degree_days(t: Column, base: float = 65.0) -> Column:
    return F.when(t.isNotNull(), F.greatest(F.lit(base) - t, F.lit(0.0)))


def wind_potential_index(w: Column, rated: float = 25.0) -> Column:
    return F.when(w.isNotNull(), F.least(w / F.lit(rated), F.lit(1.0)))


def epoch_day(c: Column) -> Column:
    return F.datediff(c, F.lit("1970-01-01").cast("date"))


def noise_from_date(c: Column, low: int = 50, high: int = 200) -> Column:
    """Repeatable integer in [low, high], a function of the date alone."""
    return F.pmod(epoch_day(c).cast("long") * F.lit(7919), F.lit(high - low + 1)) + F.lit(low)


def noise_random(low: int = 50, high: int = 200, seed: int | None = None) -> Column:
    """Uniform integer draw in [low, high]."""
    draw = F.rand(seed) if seed is not None else F.rand()
    return F.floor(draw * F.lit(high - low + 1)) + F.lit(low)


def map_lookup(c: Column, table: dict, default: Column | None = None) -> Column:
    """Literal dictionary lookup with a default."""
    entries = [F.lit(x) for pair in table.items() for x in pair]
    found = F.try_element_at(F.create_map(*entries), c)
    return found if default is None else F.coalesce(found, default)


def share_pct(part: Column, whole: Column) -> Column:
    """``part / whole · 100``, null when ``whole`` is zero."""
    return F.try_divide(part, whole) * F.lit(100)


def absolute_error(actual: Column, predicted: Column) -> Column:
    return F.abs(actual - predicted)


def percentage_error(actual: Column, predicted: Column) -> Column:
    """Signed error in percent of the actual value, null when that is zero."""
    return F.try_divide(actual - predicted, actual) * F.lit(100)


def liquidity_need(
    generation: Column,
    oil: Column,
    noise: Column,
    generation_weight: float = 0.05,
    oil_weight: float = 10.0,
    default_oil: float = 50.0,
) -> Column:
    """Target: weighted generation + weighted oil price (defaulted when missing) + noise."""
    return (
        generation.cast("double") * F.lit(float(generation_weight))
        + F.coalesce(oil.cast("double"), F.lit(float(default_oil))) * F.lit(float(oil_weight))
        + noise
    )
