"""Exact money sums, guarded ratios, export rounding and locale formatting."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F


def cents(money: Column) -> Column:
    """Two-decimal money as whole cents, so sums are exact in any order.

    An amount beyond the BIGINT range fails the job under ANSI mode instead of
    being dropped.
    """
    return F.rint(money * 100).cast("bigint")


def sum_cents(money: Column, where: Column | None = None) -> Column:
    """Sum of cents, 0 for an empty group."""
    value = cents(money)
    return F.coalesce(F.sum(value if where is None else F.when(where, value)), F.lit(0).cast("bigint"))


def exact(value: Column) -> Column:
    """The addend of ``exact_sum``."""
    return value.cast("decimal(28,10)")


def exact_sum(value: Column) -> Column:
    """Sum of numbers with any number of decimals as a double: ten of them are kept exactly, so neither the order of rows nor
    a retry can change it; null for an empty group. A sum of 28 digits before the point fails the job."""
    return F.sum(exact(value)).cast("double")


def from_cents(c: Column) -> Column:
    return c.cast("double") / 100


def ratio(num: Column, den: Column) -> Column:
    """num / den, 0 when the denominator is not positive."""
    return F.when(den > 0, num.cast("double") / den.cast("double")).otherwise(F.lit(0.0))


def pct(num: Column, den: Column) -> Column:
    return ratio(num, den) * 100


def rounded(c: Column, decimals: int) -> Column:
    """Half-up rounding through an exact decimal, back as double."""
    return F.round(c.cast("decimal(38,10)"), decimals).cast("double")


def round_columns(df: DataFrame, decimals: Mapping[str, int]) -> DataFrame:
    """Round result columns for export; calculations keep full precision."""
    return df.withColumns({n: rounded(F.col(n), d) for n, d in decimals.items() if n in df.columns})


def money_text(c: Column) -> Column:
    value = F.when(c.isNull() | F.isnan(c), F.lit(0.0)).otherwise(c)
    return F.concat(F.lit("R$ "), F.translate(F.format_number(value, 2), ",.", ".,"))


def pct_text(c: Column, decimals: int = 2) -> Column:
    return F.concat(F.translate(F.format_number(c * 100, decimals), ".,", ","), F.lit("%"))


def int_text(c: Column) -> Column:
    return F.translate(F.format_number(c.cast("bigint"), 0), ",", ".")


def format_locale(
    df: DataFrame,
    money: Sequence[str] = (),
    pct: Sequence[str] = (),
    ints: Sequence[str] = (),
    pct_decimals: int = 2,
) -> DataFrame:
    """Render numeric columns as ``R$ 1.234,56``, ``92,25%`` and ``1.234.567``."""
    return df.withColumns(
        {n: money_text(F.col(n)) for n in money}
        | {n: pct_text(F.col(n), pct_decimals) for n in pct}
        | {n: int_text(F.col(n)) for n in ints}
    )
