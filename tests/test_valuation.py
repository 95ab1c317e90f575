from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tests.books import inst, loan, make_inst, make_loans, rows_by
from vintora.operators import portfolio as pf
from vintora.operators import valuation as va
from vintora.params import Params
from vintora.plans.portfolio_run import run_from_files, run_portfolio
from vintora.sources.sinks import read_bundle

P = Params.at("2020-03")


@pytest.fixture(scope="module")
def parts(spark):
    loans = make_loans(
        spark,
        [
            loan("1", pmt=100.0, n=4, aq="2020-01-15", dpd=70.0),
            loan("2", pmt=50.0, n=3, aq="2020-01-20", dpd=0.0),
            loan("3", pmt=10.0, n=2, aq="2020-02-10", dpd=0.0),
        ],
    )
    ltm = spark.createDataFrame([(0.3, 0.5)], "effic60 double, effic90 double")
    return loans, pf.future_flow(loans, P), va.pd_by_vintage(loans), ltm


# Flow after 2020-03-01: 2020-01 has 150 in March, 150 in April, 100 in May; 2020-02 has 10 in March, 10 in April.
FLOW = [(0.5, 0, 150.0), (0.5, 1, 150.0), (0.5, 2, 100.0), (0.0, 0, 10.0), (0.0, 1, 10.0)]


def test_npv_and_net_flow(parts):
    loans, flow, rates, ltm = parts
    assert {r.safra: r.pd for r in rates.collect()} == {"2020-01": 0.5, "2020-02": 0.0}
    got = {(round(r.taxa_am_pct, 6), r.cenario): r for r in va.npv_grid(flow, rates, ltm, F.lit(3000.0), P).collect()}
    assert len(got) == 6
    for rate in (0.01, 0.015):
        for name, stress in (("otimista", 0.8), ("base", 1.0), ("pessimista", 1.2)):
            want = sum(v * (1 - pd * 0.5 * stress) / (1 + rate) ** dp for pd, dp, v in FLOW)
            row = got[round(rate * 100, 6), name]
            assert row.vpl_valor == pytest.approx(want) and row.vpl_pct_principal == pytest.approx(want / 30)
    net = va.net_future_flow(flow, rates, ltm).first()
    assert net.pmt_bruto_futuro == 420.0 and net.perda_estimada == pytest.approx(400 * 0.25)
    assert net.fluxo_liquido == pytest.approx(net.pmt_bruto_futuro - net.perda_estimada)


def test_expected_loss_parameters(spark, parts):
    loans, _, _, ltm = parts
    kpis = pf.portfolio_kpis(loans, spark.createDataFrame([], "id_contrato string"))
    got = [r.valor for r in va.expected_loss(kpis, pf.exposure_at_default(loans), ltm).collect()]
    ead = 400.0 + 150.0 + 20.0
    assert got == pytest.approx([33.33, ead, 400.0, 50.0, round(ead / 3 * 0.5, 2), round(ead / 3 * 0.5 / 3000 * 100, 2)])


@pytest.fixture(scope="module")
def small_run(spark):
    loans = make_loans(spark, [loan(str(i), aq=f"2020-0{1 + i % 3}-10", dpd=float(i * 20), especie="E") for i in range(9)])
    rows = make_inst(spark, [inst(str(i), k, f"2020-0{2 + k}-10", paid=None if i % 3 else f"2020-0{2 + k}-10", paid_value=100.0) for i in range(9) for k in range(1, 4)])
    ids = spark.createDataFrame([("1",)], "id_contrato string")
    return loans, rows, ids


def test_run_gives_twenty_tables_either_way(small_run):
    p = Params.at("2020-08")
    stored, lazy = run_portfolio(*small_run, p), run_portfolio(*small_run, p, store=False)
    assert len(stored) == len(lazy) == 20
    for name in ("rating", "fpd_safras", "rolagens", "vpl_cenarios", "safras_meta", "matriz_saldo"):
        assert sorted(map(str, stored[name].collect())) == sorted(map(str, lazy[name].collect())), name
    kpis = {(r.categoria, r.chave): r.valor for r in stored["kpis"].collect()}
    assert len(kpis) == 42 and kpis["kpi", "contratos"] == "9" and kpis["meta", "data_base"] == "2020-08"
    assert kpis["kpi", "renegociacoes"] == "1" and "vpl_base_taxa0015_pct" in {k for _, k in kpis}
    assert {r.chave: r.valor for r in stored["meta_execucao"].collect()}["todos_rated"] == "True"


def test_run_invariants(small_run):
    p = Params.at("2020-08")
    out = run_portfolio(*small_run, p)
    assert sum(r.contratos_n for r in out["faixas_atraso"].collect()) == 9
    assert out["faixas_atraso"].collect()[-1].acumulado == 100.0
    assert sum(r.part_pct for r in out["rating"].collect()) == pytest.approx(100.0, abs=0.1)
    for name, col in (("perda_acumulada", "perda_acum_pct"), ("receita_acumulada", "receita_acum_pct")):
        rows = out[name].orderBy("safra", "mob").collect()
        assert all(a.safra != b.safra or b[col] >= a[col] for a, b in zip(rows, rows[1:]))
    assert set(rows_by(out["safras_meta"], "safra")) == {"2020-01", "2020-02", "2020-03"}


def test_run_without_instalments_or_vintages(spark, small_run):
    loans, rows, ids = small_run
    out = run_portfolio(loans, rows.where("id_contrato = 'none'"), ids, Params.at("2020-08"))
    assert {r.chave: r.valor for r in out["kpis"].collect()}["pe_valor"] == "0.00"
    assert out["perda_acumulada"].count() == 3 * 12
    unknown = make_loans(spark, [loan("1", aq=None)])
    out = run_portfolio(unknown, rows, ids, Params.at("2020-08"))
    assert out["perda_acumulada"].count() == 0 and out["vencimentario"].count() == 0
    assert out["vpl_cenarios"].count() == 0 and out["kpis"].count() == 30


def test_run_from_files(spark, tmp_path):
    write = lambda name, *lines: (tmp_path / name).write_text("\n".join(lines) + "\n", encoding="utf-8")
    write(
        "LOANS.csv",
        "Unique ID;principal;pmt;num_parcelas;data_aquisicao;taxa_cliente;rating_concessao;dias_maior_atraso",
        "1;1.200,00;100,00;12;10/01/2020;1,5;A;0",
        " 2 ;2400;200.00;12;2020-02-10;0.02;B;75",
    )
    write(
        "INSTALLMENTS.csv",
        "id_contrato;id_parcela;num_parcela;data_vencimento;data_pagamento;valor_parcela;valor_pago;dias_atraso",
        "1;a;1;10/02/2020;10/02/2020;100,00;110,00;0",
        "2;b;1;10/03/2020;;200,00;;75",
    )
    write("META.csv", "nome_cliente;data_base;analista;produto", "Banco;2020-06-30;Ana;Consignado")
    done = run_from_files(spark, str(tmp_path), str(tmp_path / "out"), "2020-06", fmt="csv")
    assert len(done) == 20 and all(done.values())
    kpis = read_bundle(spark, str(tmp_path / "out"))["kpis"]
    values = {(r.categoria, r.chave): r.valor for r in kpis.collect()}
    assert values["kpi", "principal_total"] == "3600.00" and values["meta", "nome_cliente"] == "Banco"
    assert values["ead", "ead_inadimplente"] == "2400.00" and values["kpi", "renegociacoes"] == "0"
