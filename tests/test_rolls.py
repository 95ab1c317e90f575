from __future__ import annotations

import random
from collections import defaultdict
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from tests.books import inst, loan, make_inst, make_loans
from vintora.functions.calendar import month_range
from vintora.operators import rolls
from vintora.params import BUCKETS, Params

P = Params.at("2021-12")


def months(start: date, end: date):
    out = []
    while start <= end:
        out.append(start)
        start = date(start.year + start.month // 12, start.month % 12 + 1, 1)
    return out


def label(days: int) -> str:
    limits = (5, 30, 60, 90, 120, 150, 180)
    return next((b for b, top in zip(BUCKETS, limits) if days <= top), BUCKETS[-1])


def random_book(seed: int, contracts: int = 60):
    rng = random.Random(seed)
    loans, rows = [], []
    for i in range(contracts):
        aq = date(2019, 6, 1) + timedelta(days=rng.randrange(700))
        n = rng.choice([0, 3, 12, 24])
        loans.append(loan(str(i), pmt=float(rng.randrange(1, 400)), n=n, aq=str(aq)))
        for k in range(rng.choice([0, 1, 5, 30])):
            due = aq + timedelta(days=rng.randrange(-200, 900))
            if rng.random() < 0.3:
                due = due.replace(day=1)
            paid = None if rng.random() < 0.3 else due + timedelta(days=rng.randrange(-90, 400))
            if paid and rng.random() < 0.2:
                paid = paid.replace(day=1)
            rows.append(inst(str(i), k, str(due), None if paid is None else str(paid)))
    rows.append(inst("orphan", 1, "2020-05-05"))
    rows.append(inst(None, 1, "2020-05-05"))
    return loans, rows


def brute_force(loans, rows, p):
    """Contract x month states straight from the definitions."""
    spine = months(min(l[4] for l in loans).replace(day=1), p.snapshot)
    mine = defaultdict(list)
    for r in rows:
        mine[r[0]].append((r[3], r[4]))
    out = {}
    for l in loans:
        events = mine.get(l[0])
        if not events:
            continue
        first = min(min(due, paid or due) for due, paid in events).replace(day=1)
        first_due = min(due for due, _ in events)
        grid = [m for m in spine if m >= first]
        for m in grid:
            if m < first_due:
                continue
            paid_n = sum(1 for _, paid in events if paid and grid[0] <= ceil(paid) <= m)
            open_due = [due for due, paid in events if due <= m and (paid is None or paid > m)]
            bucket = label((m - min(open_due)).days) if open_due else "corrente"
            out[l[0], m] = (l[2] * max(l[3] - paid_n, 0), bucket, min(open_due) if open_due else None, paid_n)
    return spine, out


def ceil(day: date) -> date:
    return day if day.day == 1 else date(day.year + day.month // 12, day.month % 12 + 1, 1)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_states_equal_brute_force(spark, seed):
    raw_loans, raw_inst = random_book(seed)
    loans, rows = make_loans(spark, raw_loans), make_inst(spark, raw_inst)
    spine, want = brute_force(raw_loans, raw_inst, P)
    got = {(r.id_contrato, r.cal): (r.saldo, r.bucket) for r in rolls.outstanding_balance_bucket(loans, rows, P).collect()}
    assert got == {k: v[:2] for k, v in want.items()}
    oldest = {(r.id_contrato, r.cal): r.min_unpaid_due for r in rolls.oldest_unpaid_due(loans, rows, P).collect()}
    known = {k: v for k, v in oldest.items() if k in want}
    assert known == {k: v[2] for k, v in want.items() if v[2]}
    paid = {(r.id_contrato, r.cal): r.pagas for r in rolls.cumulative_payments(loans, rows, P).collect()}
    assert {k: paid[k] for k in want} == {k: v[3] for k, v in want.items()}
    grid = {(r.id_contrato, r.cal) for r in rolls.contract_month_grid(loans, rows, P).collect()}
    assert set(paid) == grid and set(want) <= grid
    aging = rolls.aging_balance(loans, rows, P).collect()
    assert sorted(r.cal for r in aging) == spine
    for r in aging:
        for b in BUCKETS:
            assert r[b] == sum(s for (_, m), (s, bucket, _, _) in want.items() if m == r.cal and bucket == b)


def test_one_contract_with_most_of_the_instalments(spark):
    """A third of all rows under one id: its rows are added up before any shuffle by id."""
    hot = spark.range(60000).select(
        F.lit("1").alias("id_contrato"),
        F.col("id").cast("string").alias("id_parcela"),
        (F.col("id") % 12 + 1).cast("int").alias("num_parcela"),
        F.add_months(F.lit(date(2020, 1, 10)), (F.col("id") % 12).cast("int")).alias("data_vencimento"),
        F.when(F.col("id") % 4 > 0, F.add_months(F.lit(date(2020, 1, 20)), (F.col("id") % 12).cast("int"))).alias("data_pagamento"),
        F.lit(1.0).alias("valor_parcela"),
        F.lit(1.0).alias("valor_pago"),
        F.lit(0.0).alias("dias_atraso"),
    )
    events = rolls.contract_events(hot, P)
    assert events.count() == 12
    assert events.agg(F.sum("n")).first()[0] == 60000
    loans = make_loans(spark, [loan("1", pmt=1.0, n=100000, aq="2020-01-01")])
    last = rolls.outstanding_balance_bucket(loans, hot, P).where("cal = '2021-12-01'").collect()
    assert [(r.saldo, r.bucket) for r in last] == [(100000.0 - 45000.0, "f180p")]


def test_payments_before_the_first_vintage_are_not_counted(spark):
    loans = make_loans(spark, [loan("1", pmt=10.0, n=5, aq="2020-03-10")])
    rows = make_inst(spark, [inst("1", 1, "2019-11-10", paid="2019-11-10"), inst("1", 2, "2020-04-10", paid="2020-04-10")])
    got = {r.cal: r.saldo for r in rolls.outstanding_balance_bucket(loans, rows, P).collect()}
    assert min(got) == date(2020, 3, 1)
    assert (got[date(2020, 3, 1)], got[date(2020, 4, 1)], got[date(2020, 5, 1)]) == (50.0, 50.0, 40.0)


def aging_frame(spark, rows):
    fields = "cal date, mes string, " + ", ".join(f"{b} double" for b in BUCKETS)
    return spark.createDataFrame([(date(2020, m, 1), f"2020-{m:02d}", *map(float, v)) for m, v in rows], fields)


def test_roll_rates(spark):
    aging = aging_frame(
        spark,
        [
            (1, (100, 50, 40, 30, 20, 10, 5, 8)),
            (2, (90, 20, 10, 20, 15, 10, 8, 6)),
            (3, (90, 0, 0, 0, 3, 0, 0, 10)),
        ],
    )
    rolls_df = rolls.chain_efficiency(rolls.roll_rates(aging)).orderBy("cal")
    feb, mar = rolls_df.collect()
    assert (feb.r5_30, feb.r31_60, feb.r61_90, feb.r91_120) == (0.2, 0.2, 0.5, 0.5)
    assert (feb.r121_150, feb.r151_180, feb.r180p) == (0.5, 0.8, -0.4)
    assert feb.effic90 == pytest.approx(0.5 * 0.5 * 0.8 * -0.4) and feb.effic60 == pytest.approx(feb.effic90 * 0.5)
    assert mar.r180p == 0.5 and mar.r91_120 == 0.15
    empty = aging_frame(spark, [(1, (1, 0, 0, 0, 0, 0, 0, 0)), (2, (1, 1, 1, 1, 1, 1, 1, 1))])
    row = rolls.chain_efficiency(rolls.roll_rates(empty)).first()
    assert row.r5_30 == 1.0 and row.r31_60 is None and row.r180p is None and row.effic60 is None


def chained_frame(spark, rows):
    names = ("r5_30", "r31_60", "r61_90", "r91_120", "r121_150", "r151_180", "r180p", "effic60", "effic90")
    data = [(date(2020 + i // 12, i % 12 + 1, 1), f"m{i}", 0.1234567, *[v] * 6, e60, e90) for i, (v, e60, e90) in enumerate(rows)]
    return spark.createDataFrame(data, "cal date, mes string, " + ", ".join(f"{n} double" for n in names))


def test_ltm_takes_the_last_twelve_rows_and_skips_nulls(spark):
    rows = [(9.0, 9.0, 9.0)] * 3 + [(0.5, 0.2, 0.4)] * 10 + [(0.7, None, 0.1), (0.6, 0.4, 0.8)]
    ltm = rolls.ltm_averages(chained_frame(spark, rows), P).first()
    assert ltm.meses == 11
    assert ltm.effic60 == pytest.approx((0.2 * 10 + 0.4) / 11) and ltm.effic90 == pytest.approx((0.4 * 10 + 0.8) / 11)
    assert ltm.r5_30_pct == pytest.approx(12.34567) and ltm.r31_60_pct == pytest.approx((50.0 * 10 + 60.0) / 11)
    none = rolls.ltm_averages(chained_frame(spark, [(0.5, None, None)]), P).first()
    assert (none.effic60, none.effic90, none.r5_30_pct, none.meses) == (0.0, 0.0, None, 0)


def test_roll_table_ends_with_the_mean(spark):
    chained = chained_frame(spark, [(0.5, 0.2, 0.4)] * 2)
    table = rolls.roll_table(chained, rolls.ltm_averages(chained, P)).collect()
    assert [r.mes for r in table][-1] != "" and len(table) == 3
    mean = next(r for r in table if r.mes == "Média LTM")
    assert (mean.r5_30, mean.r31_60, mean.r180p, mean.effic60, mean.effic90) == (12.35, 50.0, None, 20.0, 40.0)
    assert next(r for r in table if r.mes == "m0").r5_30 == 12.34567


def test_aging_cells_are_the_expanded_states(spark):
    draw = random.Random(5)
    days = [f"20{y}-{m:02d}-{n:02d}" for y in (19, 20) for m in range(1, 13) for n in (1, 15, 28)]
    loans = [loan(str(i), pmt=draw.choice([100.0, 0.0, 33.33, -20.0]), n=draw.randint(0, 6), aq=draw.choice(days)) for i in range(40)]
    rows = []
    for i in range(40):
        for k in range(draw.randint(0, 6)):
            rows.append(inst(str(i) if i % 9 else None, k, draw.choice([*days, None]), draw.choice([*days, None])))
    loans, rows, p = make_loans(spark, loans), make_inst(spark, rows), Params.at("2021-03")
    months = F.explode(month_range(F.col("de"), F.col("ate"))).alias("cal")
    want = (
        rolls.balance_states(loans, rows, p)
        .select(months, "saldo_c", "mais_antiga")
        .groupBy("cal", rolls.month_bucket().alias("bucket"))
        .agg(F.sum("saldo_c").alias("saldo_c"))
    )
    held = lambda df: {(r.cal, r.bucket): r.saldo_c for r in df.collect() if r.saldo_c}
    assert held(rolls.aging_cells(loans, rows, p)) == held(want) != {}
