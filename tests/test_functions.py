from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from vintora.functions import calendar as cal
from vintora.functions import numbers as num
from vintora.functions import parsing as ps


def one(spark, value, expr, kind="string"):
    df = spark.createDataFrame([(value,)], f"v {kind}")
    return df.select(expr(F.col("v")).alias("r")).first()["r"]


def many(spark, values, expr, kind="string"):
    """Evaluate an expression over a list of values in one job, in order."""
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}").coalesce(1)
    return [r["r"] for r in df.select("i", expr(F.col("v")).alias("r")).orderBy("i").collect()]


def check_pairs(spark, pairs, expr, kind="string"):
    got = many(spark, [p[0] for p in pairs], expr, kind)
    for (value, want), have in zip(pairs, got):
        assert have == (pytest.approx(want) if isinstance(want, float) else want), value


NUMBERS = [
    ("1234.56", 1234.56),
    ("1.234,56", 1234.56),
    ("1234,56", 1234.56),
    ("1,234.56", 1234.56),
    ("1.234.567,89", 1234567.89),
    ("1,234,567.89", 1234567.89),
    ("1.234", 1.234),
    ("  42.5  ", 42.5),
    ("\t7\n", 7.0),
    ("-10,5", -10.5),
    ("+3", 3.0),
    (".5", 0.5),
    ("5.", 5.0),
    ("1e3", 1000.0),
    ("1,234,567", 0.0),
    ("1.234.567", 0.0),
    ("1.2,3.4", 0.0),
    ("not-a-number", 0.0),
    ("", 0.0),
    ("nan", 0.0),
    ("inf", 0.0),
    ("1.2d", 0.0),
    ("1_000", 0.0),
    (None, 0.0),
]


def test_norm_decimal(spark):
    check_pairs(spark, NUMBERS, ps.norm_decimal)


def test_norm_decimal_keeps_null_on_request(spark):
    assert one(spark, None, lambda c: ps.norm_decimal(c, null_as_zero=False)) is None
    assert one(spark, "x", lambda c: ps.norm_decimal(c, null_as_zero=False)) == 0.0


def test_norm_int_rounds_half_even(spark):
    pairs = [("1.5", 2), ("2.5", 2), ("1.9", 2), ("-2.5", -2), ("x", 0), ("12,0", 12)]
    check_pairs(spark, pairs, ps.norm_int, "string")


def test_norm_decimal_strict(spark):
    pairs = [("1.234,56", 1234.56), ("1.0", 10.0), ("12,5", 12.5), ("x", None), (None, None)]
    check_pairs(spark, pairs, ps.norm_decimal_strict, "string")


DATES = [
    ("15/03/2026", date(2026, 3, 15), "valid"),
    ("5/3/2026", date(2026, 3, 5), "valid"),
    ("2026-03-15", date(2026, 3, 15), "valid"),
    ("2026-3-5", date(2026, 3, 5), "valid"),
    (" 2026-03-15 12:30:45 ", date(2026, 3, 15), "valid"),
    ("2026-03-15 12:30:45.123", date(2026, 3, 15), "valid"),
    ("29/02/2024", date(2024, 2, 29), "valid"),
    ("", None, "absent"),
    ("   ", None, "absent"),
    ("nan", None, "absent"),
    ("None", None, "absent"),
    ("NaT", None, "absent"),
    (None, None, "absent"),
    ("NaN", None, "invalid"),
    ("not-a-date", None, "invalid"),
    ("13/13/2026", None, "invalid"),
    ("31/02/2026", None, "invalid"),
    ("29/02/2023", None, "invalid"),
    ("2026-13-45", None, "invalid"),
    ("2026-03-15 12:30:45x", None, "invalid"),
    ("2026-03-15 12:30:45 and more", None, "invalid"),
    ("2026-03-15 25:00:00", None, "invalid"),
    ("2026-03-15T12:30:45", None, "invalid"),
    ("15/03/2026 10:00", None, "invalid"),
    ("15/03/26", None, "invalid"),
    ("0000-01-01", None, "invalid"),
]


def test_integers_out_of_range_fail(spark):
    df = spark.createDataFrame([("99999999999",)], "t string")
    with pytest.raises(Exception, match="integer out of range"):
        df.select(ps.norm_int(F.col("t"))).collect()


def test_dates(spark):
    check_pairs(spark, [(t, v) for t, v, _ in DATES], ps.norm_date)
    check_pairs(spark, [(t, s) for t, _, s in DATES], ps.date_status)


def test_norm_rate(spark):
    pairs = [("1,5", 0.015), ("0.02", 0.02), ("1", 1.0), ("2", 0.02), ("x", 0.0), (None, 0.0)]
    check_pairs(spark, pairs, ps.norm_rate, "string")


def test_norm_category(spark):
    pairs = [(None, "N/I"), ("nan", "N/I"), ("NaN", "N/I"), ("None", "N/I"), ("", "N/I"), ("SP", "SP")]
    check_pairs(spark, pairs, ps.norm_category, "string")


REPORT = [
    ("R$ 1.234,56", "money", 1234.56),
    ("R$ 144.245.673,20 (70.63% do Principal)", "money", 144245673.20),
    ("307442757.64", "money", 307442757.64),
    ("1.234", "count", 1234.0),
    ("1.234.567", "money", 1234567.0),
    ("92,25%", "pct", 92.25),
    ("54.2", "decimal", 54.2),
    ("5000", "count", 5000.0),
    ("-", "money", None),
    ("N/A", "pct", None),
    ("#DIV/0!", "money", None),
    ("", "count", None),
    (None, "money", None),
]


def test_norm_report_value(spark):
    for kind in ("money", "pct", "decimal", "count"):
        pairs = [(t, v) for t, k, v in REPORT if k == kind]
        check_pairs(spark, pairs, lambda c: ps.norm_report_value(c, kind))


@pytest.mark.parametrize(
    "a,b,n",
    [("2025-12-01", "2026-01-01", 1), ("2024-03-15", "2026-05-01", 26), ("2026-06-01", "2026-05-01", -1), ("2026-05-01", "2026-05-31", 0)],
)
def test_months_diff(spark, a, b, n):
    assert one(spark, b, lambda c: cal.months_diff(F.lit(a).cast("date"), c.cast("date"))) == n


def test_month_ends_and_ceilings(spark):
    assert one(spark, "2024-01-31", lambda c: F.add_months(c.cast("date"), 1)) == date(2024, 2, 29)
    assert one(spark, "2024-01-01", lambda c: cal.ceil_month(c.cast("date"))) == date(2024, 1, 1)
    assert one(spark, "2024-01-02", lambda c: cal.ceil_month(c.cast("date"))) == date(2024, 2, 1)
    assert one(spark, "2024-01-02", lambda c: cal.vintage(c.cast("date"))) == "2024-01"
    assert one(spark, None, lambda c: cal.vintage(c.cast("date"))) == "N/I"


def test_ranges_are_empty_when_reversed(spark):
    lo, hi = F.lit("2024-03-01").cast("date"), F.lit("2024-01-01").cast("date")
    assert one(spark, "x", lambda c: cal.month_range(lo, hi)) == []
    assert one(spark, "x", lambda c: cal.int_range(F.lit(1), F.lit(0))) == []
    assert one(spark, "x", lambda c: cal.int_range(F.lit(1), F.lit(3))) == [1, 2, 3]


def test_dpd_bucket(spark):
    pairs = [
        (5, "corrente"), (6, "f5_30"), (30, "f5_30"), (31, "f31_60"), (60, "f31_60"), (61, "f61_90"), (90, "f61_90"),
        (120, "f91_120"), (150, "f121_150"), (180, "f151_180"), (181, "f180p"), (-3, "corrente"),
    ]
    check_pairs(spark, pairs, cal.dpd_bucket, "int")


def test_money_text(spark):
    pairs = [(204222608.95, "R$ 204.222.608,95"), (1234.56, "R$ 1.234,56"), (0.0, "R$ 0,00"), (None, "R$ 0,00"), (float("nan"), "R$ 0,00"), (-1234.5, "R$ -1.234,50")]
    check_pairs(spark, pairs, num.money_text, "double")


def test_pct_and_int_text(spark):
    assert one(spark, 0.9225, num.pct_text, "double") == "92,25%"
    assert one(spark, 0.922525, lambda c: num.pct_text(c, 4), "double") == "92,2525%"
    assert one(spark, 0.0, num.pct_text, "double") == "0,00%"
    assert one(spark, 12.5, num.pct_text, "double") == "1250,00%"
    assert one(spark, 1234567, num.int_text, "bigint") == "1.234.567"
    assert one(spark, 0, num.int_text, "bigint") == "0"


def test_cents_sum_is_exact(spark):
    df = spark.range(100000).select((F.lit(0.1) + F.col("id") * 0).alias("v"))
    assert df.agg(num.from_cents(num.sum_cents(F.col("v"))).alias("s")).first()["s"] == 10000.0


def test_cents_fail_loudly_outside_bigint(spark):
    with pytest.raises(Exception, match="CAST_OVERFLOW|overflow"):
        spark.sql("select 1e300 as v").select(num.cents(F.col("v"))).collect()


def test_format_locale_leaves_other_columns(spark):
    df = spark.sql("select 'a' as k, 1234.5D as m, 0.5D as p, 1000L as n")
    row = num.format_locale(df, money=["m"], pct=["p"], ints=["n"]).first()
    assert tuple(row) == ("a", "R$ 1.234,50", "50,00%", "1.000")
