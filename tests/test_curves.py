from __future__ import annotations

import random
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.books import loan, make_loans
from vintora.operators import curves
from vintora.operators.portfolio import book_totals
from vintora.params import Params
from vintora.sources.workspace import materialise

P = Params.at("2021-12")
GROUPS = ("alto", "medio", "baixo")


def cells_frame(spark, cells):
    rows = [(s, m, int(round(loss * 100)), float(rev), 1) for (s, m), (loss, rev) in cells.items()]
    return spark.createDataFrame(rows, "safra string, mob int, loss_c bigint, revenue double, observadas bigint")


def principals_frame(spark, principals):
    return spark.createDataFrame(
        [(s, int(round(v * 100))) for s, v in principals.items()], "safra string, principal_c bigint"
    )


def totals_frame(spark, term):
    return spark.createDataFrame([(term,)], "max_prazo int")


def chain(spark, cells, principals, term):
    totals = totals_frame(spark, term)
    months = materialise(
        curves.vintage_months(cells_frame(spark, cells), principals_frame(spark, principals), totals, P), "months"
    )
    groups = materialise(curves.risk_groups(months, P), "groups")
    decay = curves.revenue_decay(groups, P)
    shapes = materialise(curves.group_shapes(months, groups, totals, P), "shapes")
    return months, groups, decay, shapes, curves.project_curves(months, groups, shapes, P)


def brute_force(cells, principals, term):
    """Step-by-step evaluation of the curve definitions."""
    vintages = sorted(s for s, v in principals.items() if v > 0)
    last = {s: max([m for (v, m) in cells if v == s], default=0) for s in vintages}
    clean = {s: max(last[s] - 2, 1) for s in vintages}

    def inc(s, m, i):
        return cells.get((s, m), (0.0, 0.0))[i] / principals[s] * 100

    def cum(s, m):
        return sum(inc(s, k, 0) for k in range(1, m + 1))

    final = {s: cum(s, clean[s]) for s in vintages if clean[s] >= 6}
    if len(final) >= 3:
        low, high = np.percentile(list(final.values()), [33.33, 66.66])
        name = {s: "alto" if v >= high else "medio" if v >= low else "baixo" for s, v in final.items()}
        fed = {g: [s for s in final if name[s] == g] for g in GROUPS}
        group = {s: name.get(s, "medio") for s in vintages}
    else:
        fed = {g: vintages for g in GROUPS}
        group = {s: "alto" for s in vintages}
    decay = {}
    for g in GROUPS:
        own = [final[s] for s in fed[g] if s in final]
        overall = np.mean(list(final.values())) if final else 0
        power = (np.mean(own) / overall if overall > 0 else 1.0) ** 1.2 if own else 1.0
        decay[g] = 0.92**power
    shape = {}
    for g in GROUPS:
        for kind in (0, 1):
            held = None
            for m in range(1, term + 1):
                values = [
                    inc(s, m, 0) if kind == 0 else inc(s, m, 1) * max(1 - cum(s, m) / 100, 0.001)
                    for s in fed[g]
                    if m <= clean[s]
                ]
                v = statistics.median(values) if values else None
                if v is not None and v <= 0:
                    v = statistics.mean(values)
                    v = v if v > 0 else 0.001
                if v is None or v <= 0.001:
                    v = 0.001 if held is None else max(held * (0.85 if kind == 0 else decay[g]), 0.001)
                held = shape[g, kind, m] = v
    out = {}
    for s in vintages:
        scale = []
        for kind in (0, 1):
            real = sum(
                inc(s, m, 0) if kind == 0 else inc(s, m, 1) * max(1 - cum(s, m) / 100, 0.001)
                for m in range(1, clean[s] + 1)
            )
            base = sum(shape.get((group[s], kind, m), 0.0) for m in range(1, clean[s] + 1))
            scale.append(max(real / base if clean[s] >= 4 and base > 0 else 1.0, 0.2))
        total = [0.0, 0.0]
        for m in range(1, term + 1):
            for kind, floor in ((0, 0.001), (1, 0.0001)):
                if m <= clean[s]:
                    total[kind] += inc(s, m, kind)
                else:
                    total[kind] += max(shape[group[s], kind, m] * scale[kind], floor)
            out[s, m] = (*total, "realizado" if m <= clean[s] else "projetado")
    return group, decay, shape, out


def random_cells(seed, vintages, longest):
    rng = random.Random(seed)
    cells, principals = {}, {}
    for i in range(vintages):
        s = f"2020-{i + 1:02d}"
        principals[s] = 0.0 if i == 3 else round(rng.uniform(1000, 9000), 2)
        for m in range(1, rng.randrange(1, longest)):
            if rng.random() < 0.8:
                loss = 0.0 if rng.random() < 0.5 else round(rng.uniform(0, 300), 2)
                cells[s, m] = (loss, 0.0 if rng.random() < 0.3 else round(rng.uniform(0, 200), 4))
    return cells, principals


@pytest.mark.parametrize("seed,vintages,longest,term", [(1, 12, 20, 24), (2, 10, 30, 15), (3, 4, 7, 12)])
def test_curves_equal_brute_force(spark, seed, vintages, longest, term):
    cells, principals = random_cells(seed, vintages, longest)
    group, decay, shape, want = brute_force(cells, principals, term)
    months, groups, decay_df, shapes, curve = chain(spark, cells, principals, term)
    assert {r.safra: r.grupo_risco for r in groups.collect()} == group
    assert {r.grupo: r.decay_receita for r in decay_df.collect()} == pytest.approx(decay)
    got_shape = {(r.grupo, k, r.mob): (r.perda, r.receita)[k] for r in shapes.collect() for k in (0, 1)}
    assert got_shape == pytest.approx(shape)
    rows = {(r.safra, r.mob): r for r in curve.collect()}
    assert set(rows) == set(want)
    for key, (loss, revenue, kind) in want.items():
        assert rows[key].perda_acum_pct == pytest.approx(loss)
        assert rows[key].receita_acum_pct == pytest.approx(revenue)
        assert rows[key].tipo == kind
    summary = {r.safra: r for r in curves.vintage_summary(curve, decay_df).collect()}
    for s in group:
        assert summary[s].perda_acum_final_pct == pytest.approx(want[s, term][0])
        assert summary[s].principal == principals[s]


def groups_of(spark, losses):
    cells = {(s, m): ((loss if m == 1 else 0.0), 0.0) for s, loss in losses.items() for m in range(1, 11)}
    months, groups, *_ = chain(spark, cells, {s: 100.0 for s in losses}, 12)
    return {r.safra: (r.grupo_risco, tuple(r.alimenta)) for r in groups.collect()}


def test_two_mature_vintages_feed_every_group(spark):
    got = groups_of(spark, {"2020-01": 1.0, "2020-02": 2.0})
    assert got == {s: ("alto", GROUPS) for s in ("2020-01", "2020-02")}


def test_ties_at_the_percentile_go_up(spark):
    got = groups_of(spark, {"2020-01": 5.0, "2020-02": 5.0, "2020-03": 5.0, "2020-04": 5.0})
    assert {g for g, _ in got.values()} == {"alto"}
    got = groups_of(spark, {"2020-01": 1.0, "2020-02": 2.0, "2020-03": 3.0})
    assert [got[s][0] for s in sorted(got)] == ["baixo", "medio", "alto"]


def test_no_mature_vintage(spark):
    cells = {("2020-01", 1): (5.0, 1.0)}
    _, groups, decay, _, curve = chain(spark, cells, {"2020-01": 100.0}, 3)
    assert groups.first().grupo_risco == "alto"
    assert {r.decay_receita for r in decay.collect()} == {0.92}
    assert [r.perda_acum_pct for r in curve.orderBy("mob").collect()] == pytest.approx([5.0, 9.25, 12.8625])


def fill(spark, values, decay=0.9):
    raw = spark.createDataFrame([("alto", i + 1, v, v) for i, v in enumerate(values)], "grupo string, mob int, perda double, receita double")
    rates = spark.createDataFrame([("alto", decay)], "grupo string, decay_receita double")
    rows = curves.shape_decay_fill(raw, rates, P).orderBy("mob").collect()
    return [r.perda for r in rows], [r.receita for r in rows]


def test_decay_fill(spark):
    loss, revenue = fill(spark, [None, 0.001, 2.0, None, 0.0005, 3.0, None])
    assert loss == pytest.approx([0.001, 0.001, 2.0, 1.7, 1.445, 3.0, 2.55])
    assert revenue == pytest.approx([0.001, 0.001, 2.0, 1.8, 1.62, 3.0, 2.7])
    assert fill(spark, [None, None])[0] == [0.001, 0.001]
    assert fill(spark, [0.0011] + [None] * 3)[0] == pytest.approx([0.0011, 0.001, 0.001, 0.001])


def test_spine_runs_to_the_clean_mob_beyond_the_longest_term(spark):
    cells = {("2020-01", m): (1.0, 1.0) for m in range(1, 13)}
    months, _, _, _, curve = chain(spark, cells, {"2020-01": 100.0}, 4)
    assert curves.realised_loss_final(months, P).first().perda_realizada == pytest.approx(10.0)
    assert curve.agg(F.max("mob")).first()[0] == 4


def test_empty_book_has_no_curves(spark):
    loans = make_loans(spark, [loan("1", aq=None)])
    totals = book_totals(loans)
    months = curves.vintage_months(cells_frame(spark, {("x", 1): (0.0, 0.0)}).where("mob > 5"), principals_frame(spark, {"x": 0.0}), totals, P)
    groups = curves.risk_groups(months, P)
    shapes = curves.group_shapes(months, groups, totals, P)
    assert curves.project_curves(months, groups, shapes, P).count() == 0
