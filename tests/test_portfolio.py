from __future__ import annotations

from datetime import date

import pytest

from tests.books import loan, make_loans, rows_by
from vintora.operators import portfolio as pf
from vintora.params import Params
from vintora.sources.readers import renegotiated_ids

P = Params.at("2020-03")


@pytest.fixture(scope="module")
def book(spark):
    return make_loans(
        spark,
        [
            loan("1", principal=100.0, rate=0.01, dpd=0.0, n=12, rating="A", bhv="x", especie="E1", situacao="S", canal="C", uf="SP"),
            loan("2", principal=300.0, rate=2.0, dpd=61.0, n=13, rating="A", bhv="y", especie="E2", situacao="S", canal="C", uf="RJ"),
            loan("3", principal=600.0, rate=0.03, dpd=95.0, n=80, rating="B", bhv="x", especie="E1", situacao="T", canal="D", uf="SP"),
            loan("4", principal=0.0, rate=0.04, dpd=30.5, n=0, rating=None, bhv="x", aq=None, uf=None),
            loan("5", principal=0.0, dpd=None, n=10000, rating="B", bhv="x", aq="2021-06-30", uf=""),
        ],
    )


def test_kpis(spark, book):
    reneg = spark.createDataFrame([("1",), ("1",), (" 9 ",)], "id_contrato_origem string")
    k = pf.portfolio_kpis(book, renegotiated_ids(reneg)).first()
    assert (k.contratos, k.principal_total, k.ticket_medio, k.renegociacoes) == (5, 1000.0, 200.0, 2)
    assert k.taxa_media == pytest.approx((0.01 * 100 + 0.02 * 300 + 0.03 * 600) / 1000)
    assert k.prazo_medio == (12 + 13 + 80 + 0 + 10000) / 5
    assert (k.over30_n, k.over60_n, k.over90_n) == (3, 2, 1)
    assert (k.over30_pct, k.over60_pct, k.over90_pct) == (0.6, 0.4, 0.2)
    assert (k.safra_min, k.safra_max, k.safra_ni_n) == ("2020-01", "2021-06", 1)


def test_empty_book(spark, book):
    none = book.where("id_contrato = 'x'")
    reneg = renegotiated_ids(spark.createDataFrame([], "id_contrato_origem string"))
    k = pf.portfolio_kpis(none, reneg).first()
    assert (k.contratos, k.principal_total, k.ticket_medio, k.over60_pct, k.renegociacoes) == (0, 0.0, 0.0, 0.0, 0)
    assert tuple(pf.exposure_at_default(none).first()) == (0.0, 0.0)
    assert pf.all_rated_flag(none).first().todos_rated is True
    assert [r.contratos_n for r in pf.delinquency_bands(none).collect()] == [0] * 5
    assert pf.rating_profile(none).count() == 0


def test_delinquency_bands_show_loans_between_bands(book):
    got = pf.delinquency_bands(book).collect()
    assert [r.contratos_n for r in got] == [2, 0, 0, 1, 1, 1]
    assert [r.pct_carteira for r in got] == [40.0, 0.0, 0.0, 20.0, 20.0, 20.0]
    assert [r.acumulado for r in got] == pytest.approx([40.0, 40.0, 40.0, 60.0, 80.0, 100.0])
    assert got[0].faixa == "Corrente (0 dias)" and [r.faixa for r in got[-2:]] == ["Acima de 90 dias", "Sem faixa"]


def test_term_bands_cover_all_loans(book):
    got = pf.term_bands(book).collect()
    assert [r.contratos_n for r in got] == [1, 1, 0, 0, 0, 0, 2, 1]
    assert [r.principal for r in got] == [100.0, 300.0, 0.0, 0.0, 0.0, 0.0, 600.0, 0.0]
    assert [r.over60_pct for r in got] == [0.0, 100.0, 0.0, 0.0, 0.0, 0.0, 50.0, 0.0]


def test_rating_profile(book):
    got = rows_by(pf.rating_profile(book), "rating")
    assert set(got) == {"A", "B", "N/I"}
    assert (got["A"].contratos_n, got["A"].principal, got["A"].over60_n, got["A"].over60_pct) == (2, 400.0, 1, 50.0)
    assert got["A"].taxa_pond_pct == pytest.approx((0.01 * 100 + 0.02 * 300) / 400 * 100)
    assert (got["A"].part_pct, got["N/I"].taxa_pond_pct) == (40.0, 0.0)
    assert not pf.all_rated_flag(book).first().todos_rated


def test_profiles_are_sorted_by_principal(book):
    states = pf.state_profile(book).collect()
    assert [(r.uf, r.contratos_n) for r in states] == [("SP", 2), ("RJ", 1), ("N/I", 2)]
    assert states[0].part_pct == 70.0
    cross = pf.cross_profile(book, "especie").collect()
    assert [(r.especie, r.situacao, r.principal) for r in cross] == [
        ("E1", "T", 600.0), ("E2", "S", 300.0), ("E1", "S", 100.0), ("N/I", "N/I", 0.0)
    ]
    assert cross[0].over90_pct == 100.0


def test_segment_falls_back_to_profession(spark, book):
    assert {r.rotulo for r in pf.segment_profile(book).collect()} == {"especie"}
    jobs = make_loans(spark, [loan("1", profissao="P1"), loan("2", profissao="P2"), loan("3", profissao="P2")])
    got = pf.segment_profile(jobs).collect()
    assert [(r.rotulo, r.perfil, r.contratos_n) for r in got] == [("profissao", "P2", 2), ("profissao", "P1", 1)]


def test_matrix_is_the_full_product(book):
    m = {(r.rating, r.bhv): r for r in pf.rating_matrix(book).collect()}
    assert set(m) == {(a, b) for a in ("A", "B", "N/I") for b in ("x", "y")}
    assert (m["B", "y"].contratos_n, m["B", "y"].principal, m["B", "y"].over60_pct) == (0, 0.0, 0.0)
    assert (m["A", "y"].over60_pct, m["A", "y"].part_pct) == (100.0, 30.0)


def test_cube_has_the_same_cuts(book):
    cube = pf.loan_cube(book)
    for cut in pf.CUTS:
        want = pf.loan_cut(book, *cut).select(*cut, "contratos_n", "principal_c", "over60_n", "over90_n")
        got = pf.cube_cut(cube, *cut).select(*want.columns)
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())), cut


def test_due_schedule_clips_month_ends_and_starts_after_the_snapshot(spark):
    loans = make_loans(
        spark,
        [
            loan("1", pmt=10.0, n=3, aq="2020-01-31"),  # 29 Feb, 31 Mar, 30 Apr
            loan("2", pmt=5.0, n=2, aq="2020-01-01"),  # 1 Feb, 1 Mar: not after the snapshot
            loan("3", pmt=7.0, n=0, aq="2020-01-15"),
            loan("4", pmt=7.0, n=5, aq=None),
            loan("5", pmt=1.0, n=1, aq="2020-06-10"),
        ],
    )
    got = {r.mes: r.pmt_total for r in pf.future_due_schedule(loans, P).collect()}
    assert got == {"2020-03": 10.0, "2020-04": 10.0, "2020-07": 1.0}


@pytest.mark.parametrize(
    "snapshot,acquired,kept",
    [
        (date(2020, 2, 29), "2020-01-31", ["2020-03"]),  # due on the snapshot itself is not future
        (date(2020, 2, 28), "2020-01-31", ["2020-02", "2020-03"]),
        (date(2020, 2, 15), "2020-01-15", ["2020-03"]),
        (date(2020, 2, 15), "2020-01-16", ["2020-02", "2020-03"]),
        (date(2019, 12, 31), "2020-01-16", ["2020-02", "2020-03"]),
        (date(2020, 4, 1), "2020-01-16", []),
    ],
)
def test_due_schedule_at_any_snapshot_day(spark, snapshot, acquired, kept):
    flow = pf.future_due_schedule(make_loans(spark, [loan("1", n=2, aq=acquired)]), Params(snapshot=snapshot))
    assert [r.mes for r in flow.collect()] == kept


def test_due_schedule_equals_a_loop(spark):
    days = [date(2018 + i % 3, 1 + i % 12, 1 + (i * 7) % 28) for i in range(60)]
    rows = [loan(str(i), pmt=float(i), n=i % 40, aq=str(days[i])) for i in range(60)]
    want: dict[str, float] = {}
    for i in range(60):
        for k in range(1, i % 40 + 1):
            m = days[i].month - 1 + k
            due = date(days[i].year + m // 12, m % 12 + 1, days[i].day)
            if due > P.snapshot:
                want[due.strftime("%Y-%m")] = want.get(due.strftime("%Y-%m"), 0.0) + i
    got = {r.mes: r.pmt_total for r in pf.future_due_schedule(make_loans(spark, rows), P).collect()}
    assert got == {k: v for k, v in want.items() if v}


def test_exposure(book):
    e = pf.exposure_at_default(book).first()
    assert e.ead_total == 100.0 * (12 + 13 + 80 + 10000)
    assert e.ead_inadimplente == 100.0 * (13 + 80)
