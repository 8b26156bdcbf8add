"""Derived measures and flags."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F


def seconds_between(start: Column, end: Column) -> Column:
    """Second boundaries crossed from ``start`` to ``end``."""
    return F.unix_timestamp(end) - F.unix_timestamp(start)


def duration_minutes(start: Column, end: Column) -> Column:
    return F.round(seconds_between(start, end).cast("decimal(18,0)") / 60, 2)


def in_period(moment: Column, start: Column) -> Column:
    """Is ``moment`` in the month that begins at ``start``; NULL if either is."""
    return (moment >= start) & (moment < F.add_months(start, 1))


def outside(value: Column, low: int, high: int) -> Column:
    """A value is present and outside ``low``..``high``."""
    return value.isNotNull() & ((value < low) | (value > high))


def any_negative(*amounts: Column) -> Column:
    """At least one amount is below zero; NULL amounts are fine."""
    return reduce(or_, (F.coalesce(a < 0, F.lit(False)) for a in amounts))


def percentage(part: Column, whole: Column, digits: int = 2) -> Column:
    """``100 * part / whole``, NULL unless ``whole`` is positive."""
    return F.when(whole > 0, F.round(100 * part / whole, digits))


def iso_weekday(day: Column) -> Column:
    """1 for Monday to 7 for Sunday."""
    return F.weekday(day) + 1
