from __future__ import annotations

import pytest

from vintora.operators import quality as q
from vintora.params import Params
from vintora.sources import layouts

P = Params.at("2024-06")

LOANS = "id_contrato string, principal string, pmt string, num_parcelas string, data_aquisicao string, taxa_cliente string, rating_concessao string, dias_maior_atraso string"
INST = "id_contrato string, id_parcela string, num_parcela string, data_vencimento string, data_pagamento string, valor_pago string, valor_parcela string, dias_atraso string"


def loans(spark, rows):
    return spark.createDataFrame(rows, LOANS)


def inst(spark, rows):
    return spark.createDataFrame(rows, INST)


@pytest.fixture(scope="module")
def good(spark):
    l = loans(spark, [("1", "1.000,00", "100", "12", "15/01/2024", "1,5", "A", None)])
    i = inst(spark, [("1", "a", "1", "2024-02-15", None, None, "100,00", "0")])
    r = spark.createDataFrame([tuple(["N", "1"] + [None] * 9)], layouts.RENEGOTIATIONS.raw_schema)
    return l, i, r


def index(df):
    return {(r["dataset"], r["check"], r["column"]): (r["severity"], r["n_bad"], r["n_total"]) for r in df.collect()}


def test_clean_book_passes(spark, good):
    found = q.validate_book(spark, *good, P)
    gate = q.dq_gate(found).first()
    assert (gate.erros, gate.resultado) == (0, "APROVADO")
    assert gate.avisos == len(layouts.LOANS.optional) + len(layouts.INSTALLMENTS.optional)
    q.require_pass(found)


def test_loan_values(spark):
    l = loans(
        spark,
        [
            ("1", "x", "-1,0", "0", "31/02/2024", None, None, None),
            ("2", "1.0", "5", "abc", "", "1", "A", "3"),
            ("3", "-2", "1.234,50", "1.0", "2024-01-01", "1", "A", "3"),
        ],
    )
    got = index(q.dq_loans(l))
    assert got["LOANS", "nao_numerico", "principal"] == ("aviso", 1, 3)
    assert got["LOANS", "negativo", "principal"] == ("erro", 1, 3)
    assert got["LOANS", "nao_numerico", "pmt"] == ("ok", 0, 3)
    assert got["LOANS", "negativo", "pmt"] == ("erro", 1, 3)
    assert got["LOANS", "prazo_minimo", "num_parcelas"] == ("erro", 2, 3)
    assert got["LOANS", "data_invalida", "data_aquisicao"] == ("erro", 1, 3)
    nulls = index(q.dq_nulls(l, layouts.LOANS))
    assert nulls["LOANS", "nulos", "taxa_cliente"] == ("erro", 1, 3)
    assert nulls["LOANS", "nulos", "dias_maior_atraso"] == ("ok", 1, 3)


def test_instalment_values(spark):
    i = inst(
        spark,
        [
            ("1", "a", "2", "ontem", "hoje", None, "-5", "-1"),
            ("1", "b", "3", "", "NaT", None, "5", "1"),
        ],
    )
    got = index(q.dq_installments(i))
    assert got["INSTALLMENTS", "data_invalida", "data_vencimento"][:2] == ("erro", 1)
    assert got["INSTALLMENTS", "data_invalida", "data_pagamento"][:2] == ("aviso", 1)
    assert got["INSTALLMENTS", "negativo", "valor_parcela"][:2] == ("aviso", 1)
    assert got["INSTALLMENTS", "negativo", "dias_atraso"][:2] == ("aviso", 1)
    assert got["INSTALLMENTS", "sem_parcela_1", "num_parcela"][:2] == ("erro", 1)


def test_first_instalment_written_with_a_decimal_is_found(spark):
    i = inst(spark, [("1", "a", "1.0", "2024-01-01", None, None, "5", "1")])
    assert index(q.dq_installments(i))["INSTALLMENTS", "sem_parcela_1", "num_parcela"][0] == "ok"


def test_presence(spark, good):
    l, i, r = good
    tables = [(l.where("1 = 0"), layouts.LOANS), (None, layouts.INSTALLMENTS), (r.where("1 = 0"), layouts.RENEGOTIATIONS)]
    got = {r["dataset"]: r["severity"] for r in q.dq_presence(spark, tables).collect()}
    assert got == {"LOANS": "erro", "INSTALLMENTS": "erro", "RENEGOCIACAO": "aviso"}


def test_columns(spark):
    df = spark.createDataFrame([(1, 2, 3)], "id_contrato int, principal int, novidade int")
    got = index(q.dq_columns(df, layouts.LOANS))
    assert got["LOANS", "coluna_obrigatoria", "pmt"][0] == "erro"
    assert got["LOANS", "coluna_obrigatoria", "principal"][0] == "ok"
    assert got["LOANS", "coluna_opcional", "uf"][0] == "aviso"
    assert got["LOANS", "coluna_nao_mapeada", "novidade"][0] == "aviso"


@pytest.mark.parametrize("missing,severity", [(0, "ok"), (1, "ok"), (2, "aviso"), (5, "erro")])
def test_loans_without_instalments_thresholds(spark, missing, severity):
    l = spark.range(20).selectExpr("cast(id as string) as id_contrato")
    i = l.where(f"cast(id_contrato as int) >= {missing}")
    assert index(q.dq_cross(l, i))["LOANS", "contratos_sem_parcela", "id_contrato"][:2] == (severity, missing)


def test_cross_ids_are_trimmed_and_null_ids_ignored(spark):
    l = spark.createDataFrame([(" 1",), (None,)], "id_contrato string")
    i = spark.createDataFrame([("1 ",), ("9",), ("9",), (None,)], "id_contrato string")
    r = spark.createDataFrame([("1",), ("8",), (None,)], "id_contrato_origem string")
    got = index(q.dq_cross(l, i, r))
    assert got["INSTALLMENTS", "orfaos_parcelas", "id_contrato"] == ("aviso", 1, 2)
    assert got["LOANS", "contratos_sem_parcela", "id_contrato"] == ("ok", 0, 1)
    assert got["RENEGOCIACAO", "orfaos_renegociacao", "id_contrato_origem"] == ("aviso", 1, 2)
    assert [x.id_contrato for x in q.orphan_renegotiations(l, r).collect()] == ["8"]


def test_conditional_column(spark, good):
    l, i, _ = good
    payroll = l.selectExpr("*", "'Crédito CONSIGNADO' as tipo_produto")
    assert q.dq_conditional_column(l, i).count() == 0
    assert q.dq_conditional_column(payroll, i).first().severity == "erro"
    assert q.dq_conditional_column(payroll, i.selectExpr("*", "'x' as motivo_falha_repasse")).count() == 0
    personal = l.selectExpr("*", "'Pessoal' as tipo_produto")
    assert q.dq_conditional_column(personal, i).first().severity == "ok"


def test_snapshot(spark):
    l = spark.createDataFrame([("15/01/2024",), ("2024-06-01",), ("2024-07-02",), ("x",), (None,)], "data_aquisicao string")
    facts = q.snapshot_facts(l, P).first()
    assert tuple(facts) == ("2024-01", "2024-07", 3, 3, 1)
    assert q.dq_snapshot(l, P).first().severity == "aviso"
    assert q.dq_snapshot(l.where("data_aquisicao = 'x'"), P).first().severity == "aviso"
    assert q.dq_snapshot(l.where("data_aquisicao = '15/01/2024'"), P).first().severity == "ok"


def test_failed_gate_raises(spark, good):
    found = q.validate_book(spark, None, good[1], good[2], P)
    assert q.dq_gate(found).first().resultado == "REPROVADO"
    with pytest.raises(q.ValidationFailed, match="1 erros"):
        q.require_pass(found)


def test_every_required_column_of_the_book_is_counted(spark):
    from vintora.catalog.queries import QUERIES

    got = {(r["dataset"], r["column"]) for r in QUERIES["dq_required_columns"](spark, "/root/testdata/sf0.001").collect()}
    wanted = (layouts.LOANS, layouts.INSTALLMENTS, layouts.RENEGOTIATIONS)
    assert got == {(layout.dataset, c) for layout in wanted for c in layout.required}
