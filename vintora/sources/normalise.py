"""Bulk text-to-typed cleaning, one projection per table, plus reject counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from vintora.functions.calendar import vintage
from vintora.functions.parsing import (
    blank_date,
    date_status,
    date_value,
    decimal_value,
    dotted_text,
    int_value,
    is_number,
    norm_category,
    norm_date,
    norm_decimal,
    norm_id,
    norm_int,
    norm_rate,
    plain_number,
    rate_fraction,
    trimmed_text,
)
from vintora.params import NOT_INFORMED
from vintora.sources.layouts import CATEGORIES, INSTALLMENTS, LOANS, RENEGOTIATIONS, Layout
from vintora.sources.readers import norm_id_alias
from vintora.sources.workspace import materialise

LOAN_COLUMNS = (
    "id_contrato",
    "principal",
    "pmt",
    "num_parcelas",
    "data_aquisicao",
    "taxa_cliente",
    "dias_maior_atraso",
    "safra",
) + CATEGORIES


class MissingColumns(ValueError):
    """An input lacks columns that its layout requires, as a file read with a wrong separator does."""


def require_columns(df: DataFrame, layout: Layout) -> DataFrame:
    missing = [c for c in layout.required if c not in df.columns]
    if missing:
        raise MissingColumns(f"{layout.dataset}: missing {', '.join(missing)}; found {', '.join(df.columns)}")
    return df


def _source(df: DataFrame, name: str) -> Column:
    """The column, or a null text when the input does not have it."""
    return F.col(f"`{name}`") if name in df.columns else F.lit(None).cast("string")


def with_parsed(raw: DataFrame, numbers: Sequence[str], dates: Sequence[str]) -> DataFrame:
    """Adds the plain number or the date of each text, read once for values and checks alike.

    Each step is a projection of its own: one for all of them would grow into a method too long to be compiled, and every use
    of a value would parse its text again.
    """
    texts = {f"_texto_{c}": trimmed_text(_source(raw, c)) for c in (*numbers, *dates)}
    dotted = {f"_texto_{c}": dotted_text(F.col(f"_texto_{c}")) for c in numbers}
    values = {f"_numero_{c}": plain_number(F.col(f"_texto_{c}")) for c in numbers}
    values |= {f"_data_{c}": date_value(F.col(f"_texto_{c}")) for c in dates}
    return raw.withColumns(texts).withColumns(dotted).withColumns(values)


def parsed_number(name: str) -> Column:
    """Locale-agnostic number that ``with_parsed`` has read, null when the text is not one."""
    return F.col(f"_numero_{name}")


def parsed_date_is_invalid(name: str) -> Column:
    return F.col(f"_data_{name}").isNull() & ~blank_date(F.col(f"_texto_{name}"))


def category_columns(df: DataFrame) -> dict[str, Column]:
    """All eight attributes with ``N/I`` for absent values; uf falls back to regiao."""
    out = {c: norm_category(_source(df, c)) for c in CATEGORIES}
    out["uf"] = F.when(out["uf"] != NOT_INFORMED, out["uf"]).otherwise(out["regiao"])
    return out


def canonical_loans(typed: DataFrame) -> DataFrame:
    """Derived columns and defaults on already typed loans."""
    return typed.select(
        norm_id(F.col("id_contrato")).alias("id_contrato"),
        *[F.coalesce(F.col(c), F.lit(0.0)).alias(c) for c in ("principal", "pmt")],
        F.coalesce(F.col("num_parcelas").cast("int"), F.lit(0)).alias("num_parcelas"),
        "data_aquisicao",
        rate_fraction(F.coalesce(F.col("taxa_cliente"), F.lit(0.0))).alias("taxa_cliente"),
        F.coalesce(F.col("dias_maior_atraso").cast("double"), F.lit(0.0)).alias("dias_maior_atraso"),
        vintage(F.col("data_aquisicao")).alias("safra"),
        *[c.alias(n) for n, c in category_columns(typed).items()],
    )


def parse_loans(raw: DataFrame, *extra: Column) -> DataFrame:
    """Text loans to the typed layer, duplicates kept; ``extra`` columns come from the text."""
    raw = require_columns(norm_id_alias(raw), LOANS)
    acquired = norm_date(_source(raw, "data_aquisicao"))
    return raw.select(
        norm_id(_source(raw, "id_contrato")).alias("id_contrato"),
        norm_decimal(_source(raw, "principal")).alias("principal"),
        norm_decimal(_source(raw, "pmt")).alias("pmt"),
        norm_int(_source(raw, "num_parcelas")).alias("num_parcelas"),
        acquired.alias("data_aquisicao"),
        norm_rate(_source(raw, "taxa_cliente")).alias("taxa_cliente"),
        norm_decimal(_source(raw, "dias_maior_atraso")).alias("dias_maior_atraso"),
        vintage(acquired).alias("safra"),
        *[c.alias(n) for n, c in category_columns(raw).items()],
        *extra,
    )


def normalise_loans(raw: DataFrame) -> DataFrame:
    """Text loans to one typed row per contract.

    The typed rows are written first: they are read twice, and only their text would be parsed twice otherwise.
    """
    return dedup_loans(materialise(parse_loans(raw), "parsed-loans"))


def dedup_loans(loans: DataFrame, order: Sequence[Column] | None = None) -> DataFrame:
    """One row per non-null id, rows without an id all kept.

    The default order is latest acquisition, then largest principal, then a hash of
    the row. ``row_number = 1`` is a window group limit, so each map task keeps one
    row per id before the shuffle and a heavily repeated id cannot fill one task.
    """
    if order is None:
        order = [
            F.col("data_aquisicao").desc_nulls_last(),
            F.col("principal").desc_nulls_last(),
            F.xxhash64(*loans.columns),
        ]
    first = Window.partitionBy("id_contrato").orderBy(*order)
    kept = (
        loans.where(F.col("id_contrato").isNotNull())
        .withColumn("_rn", F.row_number().over(first))
        .where("_rn = 1")
        .drop("_rn")
    )
    return kept.unionByName(loans.where(F.col("id_contrato").isNull()))


INSTALLMENT_NUMBERS = ("num_parcela", "valor_parcela", "valor_pago", "dias_atraso")
INSTALLMENT_DATES = ("data_vencimento", "data_pagamento")


def normalise_installments(raw: DataFrame, *extra: Column) -> DataFrame:
    """Text instalments to typed rows; null numbers stay null, garbage becomes 0.

    ``extra`` columns come from the text and from what ``with_parsed`` adds to it.
    """
    read = with_parsed(require_columns(raw, INSTALLMENTS), INSTALLMENT_NUMBERS, INSTALLMENT_DATES)

    def number(name: str) -> Column:
        return decimal_value(parsed_number(name), _source(raw, name), null_as_zero=False)

    return read.select(
        *[trimmed_text(_source(raw, c)).alias(c) for c in ("id_contrato", "id_parcela")],
        int_value(number("num_parcela"), _source(raw, "num_parcela")).alias("num_parcela"),
        *[F.col(f"_data_{c}").alias(c) for c in INSTALLMENT_DATES],
        *[number(c).alias(c) for c in ("valor_parcela", "valor_pago", "dias_atraso")],
        *extra,
    )


def normalise_renegotiations(raw: DataFrame, *extra: Column) -> DataFrame:
    """Text renegotiations to typed rows; ``extra`` columns come from the text."""
    numbers = ("valor_refinanciado", "valor_troco", "valor_parcela", "valor_pago")
    dates = ("data_renegociacao", "data_vencimento", "data_pagamento")
    read = with_parsed(require_columns(raw, RENEGOTIATIONS), ("num_parcela", *numbers), dates)

    def number(name: str) -> Column:
        return decimal_value(parsed_number(name), _source(raw, name), null_as_zero=False)

    return read.select(
        *[trimmed_text(_source(raw, c)).alias(c) for c in ("id_contrato_novo", "id_contrato_origem", "id_parcela_reneg")],
        *[F.col(f"_data_{c}").alias(c) for c in dates],
        int_value(number("num_parcela"), _source(raw, "num_parcela")).alias("num_parcela"),
        *[number(c).alias(c) for c in numbers],
        *extra,
    )


def cleaning_report(raw: DataFrame, dataset: str, numbers: Sequence[str], dates: Sequence[str]) -> DataFrame:
    """Per column: nulls, rejected texts and rows, counted in one scan."""
    rejects = {c: F.count_if(~is_number(F.col(c))) for c in numbers}
    rejects |= {c: F.count_if(date_status(F.col(c)) == "invalid") for c in dates}
    rows = F.array(
        *[
            F.struct(
                F.lit(c).alias("coluna"),
                F.count_if(F.col(c).isNull()).alias("nulos"),
                n.alias("rejeitados"),
                F.count(F.lit(1)).alias("linhas"),
            )
            for c, n in rejects.items()
        ]
    )
    return raw.agg(rows.alias("r")).select(F.lit(dataset).alias("dataset"), F.inline("r"))
