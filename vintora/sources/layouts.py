"""Declared layouts of the four inputs; raw layers are text, nothing is inferred."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import StringType, StructField, StructType


@dataclass(frozen=True)
class Layout:
    """Columns of one input grouped by how strictly they are required."""

    dataset: str
    not_null: tuple[str, ...]
    nullable: tuple[str, ...] = ()
    optional: tuple[str, ...] = ()
    may_be_empty: bool = False

    @property
    def required(self) -> tuple[str, ...]:
        return self.not_null + self.nullable

    @property
    def columns(self) -> tuple[str, ...]:
        return self.required + self.optional

    @property
    def raw_schema(self) -> StructType:
        return StructType([StructField(c, StringType()) for c in self.columns])


# Input layouts.
LOANS = Layout(
    "LOANS",
    not_null=(
        "principal",
        "pmt",
        "num_parcelas",
        "data_aquisicao",
        "taxa_cliente",
        "rating_concessao",
    ),
    nullable=("id_contrato", "dias_maior_atraso"),
    optional=(
        "vencimento_primeira_parcela",
        "vencimento_ultima_parcela",
        "bhv_m",
        "regiao",
        "uf",
        "idade",
        "especie_beneficio",
        "situacao_beneficio",
        "canal_originacao",
        "competencia_averbacao",
        "competencia_inicio_desconto",
        "margem_consignavel_utilizada",
        "prazo_remanescente",
        "tipo_produto",
        "taxa_funding",
        "profissao",
    ),
)

INSTALLMENTS = Layout(
    "INSTALLMENTS",
    not_null=("num_parcela", "data_vencimento"),
    nullable=(
        "id_contrato",
        "id_parcela",
        "data_pagamento",
        "valor_pago",
        "valor_parcela",
        "dias_atraso",
    ),
    optional=("motivo_falha_repasse",),
)

RENEGOTIATIONS = Layout(
    "RENEGOCIACAO",
    not_null=("id_contrato_novo", "id_contrato_origem"),
    nullable=(
        "id_parcela_reneg",
        "data_renegociacao",
        "valor_refinanciado",
        "valor_troco",
        "num_parcela",
        "data_vencimento",
        "valor_parcela",
        "data_pagamento",
        "valor_pago",
    ),
    may_be_empty=True,
)

META = Layout("META", not_null=("nome_cliente", "data_base", "analista", "produto"))

# Headers that also name the contract id.
ID_ALIASES = ("unique id", "[srm] codigo operacao")

# Columns whose nulls the calculations read as zero.
NULL_MEANS_ZERO = ("dias_maior_atraso", "valor_parcela", "dias_atraso")

# Loan attributes that fall back to "N/I".
CATEGORIES = (
    "rating_concessao",
    "bhv_m",
    "especie_beneficio",
    "situacao_beneficio",
    "canal_originacao",
    "uf",
    "regiao",
    "profissao",
)
