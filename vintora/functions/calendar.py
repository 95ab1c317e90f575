"""Month arithmetic and delinquency buckets."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from vintora.params import NOT_INFORMED


def year_month(d: Column) -> Column:
    return F.date_format(d, "yyyy-MM")


def vintage(d: Column) -> Column:
    """``YYYY-MM`` of origination, ``N/I`` when unknown."""
    return F.coalesce(year_month(d), F.lit(NOT_INFORMED))


def months_diff(start: Column, end: Column) -> Column:
    """Calendar months from start to end, ignoring days; may be negative."""
    return (F.year(end) - F.year(start)) * 12 + (F.month(end) - F.month(start))


def floor_month(d: Column) -> Column:
    return F.trunc(d, "MM")


def ceil_month(d: Column) -> Column:
    """First day of a month on or after the date."""
    first = floor_month(d)
    return F.when(d == first, first).otherwise(F.add_months(first, 1))


def month_range(lo: Column, hi: Column) -> Column:
    """Array of first-of-months lo..hi, empty when lo is after hi."""
    months = F.sequence(lo, hi, F.expr("interval 1 month"))
    return F.when(lo <= hi, months).otherwise(F.array().cast("array<date>"))


def int_range(lo: Column, hi: Column) -> Column:
    """Array lo..hi, empty when lo is above hi."""
    return F.when(lo <= hi, F.sequence(lo, hi)).otherwise(F.array().cast("array<int>"))


def dpd_bucket(days: Column) -> Column:
    """Bucket of a days-past-due number; up to 5 days counts as current, null as the last bucket."""
    return (
        F.when(days <= 5, "corrente")
        .when(days <= 30, "f5_30")
        .when(days <= 60, "f31_60")
        .when(days <= 90, "f61_90")
        .when(days <= 120, "f91_120")
        .when(days <= 150, "f121_150")
        .when(days <= 180, "f151_180")
        .otherwise("f180p")
    )
