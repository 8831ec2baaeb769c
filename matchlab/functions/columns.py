"""Scalar expressions: ratings, dates, buckets, defaults and labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

START_RATING = 1500.0

# The largest K factor's base, and the sets over which it falls to that base.
K_BASE, K_SETS = 32.0, 30.0

def elo_expected(ra: Column, rb: Column) -> Column:
    return 1 / (1 + F.pow(F.lit(10.0), (rb - ra) / 400))


def date_to_epoch(c: Column) -> Column:
    """Seconds at midnight UTC of a yyyy-MM-dd date; the session's time zone must be UTC."""
    return F.unix_timestamp(c, "yyyy-MM-dd")


def or_zero(c: Column) -> Column:
    return F.coalesce(c, F.lit(0))


def bucket(c: Column, edges: list[float], labels: list[str] | None = None) -> Column:
    """Right-closed bins (edges[i], edges[i+1]]; outside them null. The first edge itself lies outside."""
    out = None
    for i, (lo, hi) in enumerate(zip(edges, edges[1:])):
        value = F.lit(labels[i] if labels else f"({lo:g}, {hi:g}]")
        cond = (c > lo) & (c <= hi)
        out = F.when(cond, value) if out is None else out.when(cond, value)
    return out


def tier(attendees: Column) -> Column:
    return F.when(attendees >= 500, "Supermajor (500+)").when(attendees >= 200, "Major (200-499)").otherwise("Regional (100-199)")


def label(c: Column) -> Column:
    """A column's name as words: p1_sets_played is "Player 1 sets played"."""
    words = F.regexp_replace(F.regexp_replace(c, "^p([12])_", "player $1 "), "_", " ")
    return F.concat(F.upper(F.substring(words, 1, 1)), F.substring(words, 2, 200))


def ratio(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))
