from __future__ import annotations

import pytest

from tests.books import inst, loan, make_inst, make_loans, rows_by
from vintora.operators import cohorts as co
from vintora.params import Params

P = Params.at("2020-06")


def test_first_payment_default(spark):
    loans = make_loans(
        spark,
        [
            loan("1", principal=100.0),
            loan("2", principal=200.0),
            loan("3", principal=300.0),
            loan("4", principal=400.0),
            loan("5", principal=500.0, aq=None),
            loan(None, principal=50.0),
        ],
    )
    rows = make_inst(
        spark,
        [
            inst("1", 1, "2020-02-15", paid=None),  # unpaid
            inst("2", 1, "2020-02-15", paid="2020-03-20", late=34.0),  # late
            inst("2", 2, "2020-03-15", paid=None, late=99.0),
            inst("3", 1, "2020-02-15", paid="2020-02-15", late=30.0),  # 30 days is still fine
            inst("4", 2, "2020-03-15", paid=None),  # no first instalment
            inst("9", 1, "2020-02-15", paid=None),  # unknown loan
        ],
    )
    got = rows_by(co.first_payment_default(loans, rows), "safra")
    jan = got["2020-01"]
    assert (jan.contratos_n, jan.fpd_n, jan.sem_parcela1) == (5, 2, 2)
    assert jan.fpd_qtd_pct == 40.0 and jan.fpd_val_pct == pytest.approx(300 / 1050 * 100)
    assert jan.sinalizacao == "Alto"
    assert (got["N/I"].contratos_n, got["N/I"].fpd_n, got["N/I"].sinalizacao) == (1, 0, "Adequado")


def test_any_unpaid_copy_of_the_first_instalment_counts(spark):
    loans = make_loans(spark, [loan("1")])
    rows = make_inst(spark, [inst("1", 1, "2020-02-15", paid="2020-02-15", late=0.0), inst("1", 1, "2020-02-15")])
    assert co.first_payment_default(loans, rows).first().fpd_n == 1


def test_signal_levels(spark):
    pairs = [(80.01, "Dado incompleto"), (80.0, "Alto"), (20.0, "Elevado"), (10.0, "Moderado"), (5.0, "Adequado")]
    df = spark.createDataFrame(pairs, "p double, s string")
    assert df.where(co.fpd_signal(df.p) != df.s).count() == 0


@pytest.fixture(scope="module")
def book(spark):
    loans = make_loans(
        spark,
        [loan("1", principal=1200.0, n=12), loan("2", principal=0.0, aq="2020-02-10"), loan("3", principal=500.0, aq="2020-05-10"), loan("4", aq=None)],
    )
    rows = make_inst(
        spark,
        [
            inst("1", 1, "2020-02-15", paid="2020-02-10", value=120.0, paid_value=150.0),
            inst("1", 2, "2020-03-15", paid="2020-03-15", value=120.0, paid_value=90.0),
            inst("1", 3, "2020-04-15", paid="2020-06-20", value=120.0, paid_value=120.0),
            inst("1", 4, "2020-05-15", value=120.0, late=61.0),
            inst("1", 5, "2020-06-01", value=120.0, late=60.0),
            inst("1", 6, "2020-06-02", value=120.0, late=0.0),
            inst("1", 0, "2020-01-20", paid="2020-01-20", value=60.0, paid_value=200.0),
            inst("2", 1, "2020-03-15", value=10.0, late=90.0),
            inst("4", 1, "2020-03-15", value=10.0, late=90.0),
        ],
    )
    return loans, rows


def test_payment_behaviour(book):
    got = rows_by(co.payment_behaviour(*book, P), "safra")
    assert set(got) == {"2020-01", "2020-05"}
    jan = got["2020-01"]
    assert (jan.antecipado, jan.no_dia, jan.em_atraso, jan.a_receber, jan.perda) == (10.0, 15.0, 10.0, 10.0, 20.0)
    assert tuple(got["2020-05"])[1:] == (0.0,) * 5


def test_loss_and_revenue(book):
    got = {(r.safra, r.mob): (r.perda, r.receita) for r in co.loss_revenue_by_mob(*book, P).collect()}
    assert got == {
        ("2020-01", 1): (0.0, 50.0),
        ("2020-01", 2): (0.0, 0.0),
        ("2020-01", 3): (0.0, 20.0),
        ("2020-01", 4): (120.0, 0.0),
        ("2020-01", 5): (0.0, 0.0),
        ("2020-02", 1): (10.0, 0.0),
    }


def test_observed_mob(book):
    loans, rows = book
    cells = co.cohort_cells(loans, rows, P)
    got = {r.safra: (r.max_mob, r.mob_limpo) for r in co.observed_mob(cells, co.vintage_principal(loans), P).collect()}
    assert got == {"2020-01": (5, 3), "2020-02": (1, 1), "2020-05": (0, 1)}


def test_revenue_without_term_is_the_whole_payment(spark):
    loans = make_loans(spark, [loan("1", n=0)])
    rows = make_inst(spark, [inst("1", 1, "2020-02-15", paid="2020-02-15", paid_value=80.0)])
    assert co.loss_revenue_by_mob(loans, rows, P).first().receita == 80.0
