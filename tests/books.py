"""Small hand-made loan books for the tests."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession

from vintora.sources.normalise import canonical_loans

LOAN_FIELDS = (
    "id_contrato string, principal double, pmt double, num_parcelas int, data_aquisicao date, taxa_cliente double, "
    "dias_maior_atraso double, rating_concessao string, bhv_m string, especie_beneficio string, "
    "situacao_beneficio string, canal_originacao string, uf string, profissao string"
)
INST_FIELDS = (
    "id_contrato string, id_parcela string, num_parcela int, data_vencimento date, data_pagamento date, "
    "valor_parcela double, valor_pago double, dias_atraso double"
)


def d(text: str | None) -> date | None:
    return None if text is None else date.fromisoformat(text)


def loan(
    id, principal=1000.0, pmt=100.0, n=12, aq="2020-01-15", rate=0.02, dpd=0.0, rating="A", bhv="1",
    especie=None, situacao=None, canal=None, uf=None, profissao=None,
):
    return (id, principal, pmt, n, d(aq), rate, dpd, rating, bhv, especie, situacao, canal, uf, profissao)


def make_loans(spark: SparkSession, rows) -> DataFrame:
    return canonical_loans(spark.createDataFrame(list(rows), LOAN_FIELDS))


def inst(id, num, due, paid=None, value=100.0, paid_value=None, late=None):
    return (id, f"{id}-{num}", num, d(due), d(paid), value, paid_value, late)


def make_inst(spark: SparkSession, rows) -> DataFrame:
    return spark.createDataFrame(list(rows), INST_FIELDS)


def rows_by(df: DataFrame, key: str) -> dict:
    return {r[key]: r for r in df.collect()}
