"""Rounding as Python and numpy do it, in plain double arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_exact(x: Column, digits: int = 1) -> Column:
    """Round the exact binary value, exact ties to even (Python's ``round``).

    ``x · 2 · 10^digits`` is an odd integer only at a decimal tie or next to one; the
    rounding error of that product, found by splitting ``x`` in two halves, then tells on
    which side of the tie the binary value lies.
    """
    scale = float(10**digits)
    twice = F.lit(2.0 * scale)
    p = x * twice
    big = x * F.lit(134217729.0)
    high = big - (big - x)
    low = x - high
    err = (high * twice - p) + low * twice
    half = F.floor(p / 2).cast("double")
    at_tie = (p == F.floor(p)) & (p - half * 2 == 1)
    up = (err > 0) | ((err == 0) & (F.pmod(half, F.lit(2.0)) == 1))
    nearest = F.when(at_tie, half + up.cast("int")).otherwise(F.floor((p + 1) / 2))
    return nearest.cast("double") / F.lit(scale)


def round_product(x: Column, digits: int = 2) -> Column:
    """Scale, round half to even, scale back (numpy's ``round``)."""
    scale = F.lit(float(10**digits))
    return F.rint(x * scale) / scale
