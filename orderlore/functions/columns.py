"""Small column expressions. All of them stay inside built-in Spark functions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

ONE_MICROSECOND = dt.timedelta(microseconds=1)


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it is false or null."""
    return F.when(condition, 1).otherwise(0)


def weekday(time: Column) -> Column:
    """Day of the week with Sunday = 0 (Spark counts Sunday as 1)."""
    return F.dayofweek(time) - 1


def seconds_between(later: Column, earlier: Column) -> Column:
    """Exact seconds as a decimal.

    Interval arithmetic keeps zone-less timestamps zone-less; ``timestampdiff``
    would read them in the session time zone.
    """
    return (later - earlier).cast("interval second").cast("decimal(20,6)")


def micros_between(later: Column, earlier: Column) -> Column:
    return (seconds_between(later, earlier) * 1_000_000).cast("long")


def rounded_hours(later: Column, earlier: Column) -> Column:
    """Whole hours as a double, exact halves to the even hour, never -0.0."""
    return F.rint(seconds_between(later, earlier).cast("double") / 3600) + F.lit(0.0)


def within(later: Column, earlier: Column, limit: dt.timedelta) -> Column:
    """``later`` follows ``earlier`` by 0 to ``limit``, both ends included."""
    return (later - earlier).between(F.lit(dt.timedelta(0)), F.lit(limit))


def midnight(date: Column) -> Column:
    return date.cast("timestamp_ntz")


def share(part: Column, whole: Column, empty: Column) -> Column:
    """``part / whole`` as a double; ``empty`` where the whole is zero or null."""
    return F.when(whole != 0, part.cast("double") / whole.cast("double")).otherwise(empty)


def stable_bucket(key: Column, buckets: int, seed: int = 0) -> Column:
    """Deterministic integer bucket of a long key.

    A multiplicative mix in plain integer arithmetic, so it does not depend on
    partitioning and any SQL engine can repeat it.
    """
    # fixed values: two odd multipliers and the modulus keep products inside a long
    first = (F.pmod(key, F.lit(2147483647)) * 48271 + seed) % 2147483647
    return ((first * 69621) % 2147483647 % buckets).cast("int")
