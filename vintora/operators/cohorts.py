"""Vintage cohorts: first-payment default, payment behaviour, loss and revenue by MOB."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from vintora.functions.calendar import months_diff
from vintora.functions.numbers import exact_sum, from_cents, pct, sum_cents
from vintora.operators.portfolio import loan_cut
from vintora.params import NOT_INFORMED, Params


def fpd_signal(share_pct: Column) -> Column:
    """Traffic light of a first-payment default share in percent."""
    return (
        F.when(share_pct > 80, "Dado incompleto")
        .when(share_pct > 20, "Alto")
        .when(share_pct > 10, "Elevado")
        .when(share_pct > 5, "Moderado")
        .otherwise("Adequado")
    )


def first_instalment_state(inst: DataFrame) -> DataFrame:
    """Per contract that has instalment 1: unpaid, and its worst days late.

    The filter keeps only first instalments, so it is applied by the scan and the
    shuffle moves one partial row per contract and map task.
    """
    return (
        inst.where(F.col("data_vencimento").isNotNull() & (F.col("num_parcela") == 1))
        .groupBy("id_contrato")
        .agg(
            F.bool_or(F.col("data_pagamento").isNull()).alias("p1_aberta"),
            F.max("dias_atraso").alias("p1_dias"),
        )
    )


def first_payment_default(loans: DataFrame, inst: DataFrame) -> DataFrame:
    """Share of contracts per vintage whose first instalment is unpaid or over 30 days late."""
    has_first = F.col("p1_aberta").isNotNull()
    is_fpd = has_first & (F.col("p1_aberta") | (F.col("p1_dias") > 30))
    n, value = F.count(F.lit(1)), F.col("principal")
    loans = loans.select("id_contrato", "safra", "principal")
    # Loans without an id match nothing; kept out of the join they cannot pile up in one task.
    matched = loans.where(F.col("id_contrato").isNotNull()).join(first_instalment_state(inst), "id_contrato", "left")
    anonymous = loans.where(F.col("id_contrato").isNull())
    per_vintage = (
        matched.unionByName(anonymous, allowMissingColumns=True)
        .groupBy("safra")
        .agg(
            n.alias("contratos_n"),
            F.count_if(is_fpd).alias("fpd_n"),
            sum_cents(value).alias("_v"),
            sum_cents(value, is_fpd).alias("_fv"),
            F.count_if(~has_first).alias("sem_parcela1"),
        )
    )
    share = pct(F.col("fpd_n"), F.col("contratos_n"))
    return per_vintage.select(
        "safra",
        "contratos_n",
        "fpd_n",
        share.alias("fpd_qtd_pct"),
        pct(F.col("_fv"), F.col("_v")).alias("fpd_val_pct"),
        "sem_parcela1",
        fpd_signal(share).alias("sinalizacao"),
    ).orderBy("safra")


def vintage_rows(cut: DataFrame) -> DataFrame:
    return cut.where(F.col("safra") != NOT_INFORMED).select("safra", "principal_c")


def vintage_principal(loans: DataFrame) -> DataFrame:
    """Cents of principal per known vintage."""
    return vintage_rows(loan_cut(loans, "safra"))


PAYMENT_CLASSES = ("antecipado", "no_dia", "em_atraso", "a_receber", "perda")


def cohort_cells(loans: DataFrame, inst: DataFrame, p: Params) -> DataFrame:
    """One pass over loans and instalments: every vintage x MOB measure.

    Payment classes cover all instalments with a due date; loss, revenue and
    ``observadas`` cover those due up to the snapshot.
    """
    base = F.lit(p.snapshot)
    due, paid = F.col("data_vencimento"), F.col("data_pagamento")
    matured = due <= base
    classes = {
        "antecipado": matured & (paid < due),
        "no_dia": matured & (paid == due),
        "em_atraso": matured & (paid > due),
        "a_receber": due > base,
        "perda": matured & paid.isNull(),
    }
    amortised = F.when(F.col("num_parcelas") > 0, F.col("principal") / F.col("num_parcelas")).otherwise(0.0)
    revenue = F.when(
        matured & paid.isNotNull() & (F.col("valor_pago") > 0),
        F.greatest(F.lit(0.0), F.col("valor_pago") - amortised),
    )
    loans = loans.where(F.col("data_aquisicao").isNotNull() & (F.col("safra") != NOT_INFORMED))
    terms = loans.select("id_contrato", "safra", "data_aquisicao", "principal", "num_parcelas")
    return (
        inst.where(due.isNotNull())
        .join(terms, "id_contrato")
        .groupBy("safra", months_diff(F.col("data_aquisicao"), due).alias("mob"))
        .agg(
            *[sum_cents(F.col("valor_parcela"), cond).alias(f"{name}_c") for name, cond in classes.items()],
            sum_cents(
                F.col("valor_parcela"), matured & (F.col("dias_atraso") > 60) & paid.isNull()
            ).alias("loss_c"),
            F.coalesce(exact_sum(revenue), F.lit(0.0)).alias("revenue"),
            F.count_if(matured).alias("observadas"),
        )
    )


def behaviour_from_cells(cells: DataFrame, principals: DataFrame) -> DataFrame:
    sums = cells.groupBy("safra").agg(*[F.sum(f"{c}_c").alias(c) for c in PAYMENT_CLASSES])
    return (
        principals.where(F.col("principal_c") != 0)
        .join(sums, "safra", "left")
        .select(
            "safra",
            *[
                (F.coalesce(F.col(c), F.lit(0)).cast("double") / F.col("principal_c") * 100).alias(c)
                for c in PAYMENT_CLASSES
            ],
        )
        .orderBy("safra")
    )


def payment_behaviour(loans: DataFrame, inst: DataFrame, p: Params) -> DataFrame:
    """Early, same-day, late, receivable and lost instalments as % of vintage principal."""
    return behaviour_from_cells(cohort_cells(loans, inst, p), vintage_principal(loans))


def mob_cells(cells: DataFrame) -> DataFrame:
    """Cells with a positive MOB and at least one instalment due up to the snapshot."""
    return cells.where((F.col("mob") > 0) & (F.col("observadas") > 0)).select("safra", "mob", "loss_c", "revenue")


def loss_revenue_by_mob(loans: DataFrame, inst: DataFrame, p: Params, cells: DataFrame | None = None) -> DataFrame:
    """Loss and revenue per vintage and MOB; ``cells`` are those of the same book where they are stored already."""
    return mob_cells(cohort_cells(loans, inst, p) if cells is None else cells).select(
        "safra", "mob", from_cents(F.col("loss_c")).alias("perda"), F.col("revenue").alias("receita")
    )


def observed_mob(cells: DataFrame, principals: DataFrame, p: Params) -> DataFrame:
    """Last observed MOB per vintage and the clean MOB left after the cut; at least 1."""
    seen = mob_cells(cells).groupBy("safra").agg(F.max("mob").alias("max_mob"))
    last = F.coalesce(F.col("max_mob"), F.lit(0))
    return principals.join(seen, "safra", "left").select(
        "safra",
        "principal_c",
        last.alias("max_mob"),
        F.greatest(last - p.mob_cut, F.lit(1)).alias("mob_limpo"),
    )
