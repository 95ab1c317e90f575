"""The valuation run: typed inputs to the twenty result tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from vintora.functions.numbers import round_columns
from vintora.functions.parsing import norm_id
from vintora.operators import cohorts, curves, portfolio, rolls, valuation
from vintora.operators.quality import (
    Check,
    conditional_checks,
    dq_columns,
    dq_cross,
    installment_row_checks,
    loan_checks,
    marks_of,
    missing_input,
    null_checks,
    renegotiation_checks,
    require_pass,
    staged_findings,
    staged_snapshot,
    union_all,
    validate_book,
)
from vintora.params import Params
from vintora.session import row_bytes, size_shuffles
from vintora.sources.layouts import INSTALLMENTS, LOANS, RENEGOTIATIONS
from vintora.sources.normalise import dedup_loans, parse_loans
from vintora.sources.readers import (
    MALFORMED,
    empty_raw,
    norm_id_alias,
    portfolio_meta,
    read_or_none,
    read_text_lines,
    renegotiated_ids,
)
from vintora.sources.sinks import export_bundle, mark_columns, staged_installments, text_bytes
from vintora.sources.workspace import materialise, run_scratch, together

# Decimals of the exported columns.
EXPORT_DECIMALS = {
    "pct_carteira": 2,
    "acumulado": 2,
    "principal": 2,
    "over60_pct": 2,
    "over90_pct": 2,
    "part_pct": 2,
    "taxa_pond_pct": 4,
    "fpd_qtd_pct": 2,
    "fpd_val_pct": 2,
    "pmt_total": 2,
    "antecipado": 2,
    "no_dia": 2,
    "em_atraso": 2,
    "a_receber": 2,
    "perda": 2,
    "vpl_valor": 2,
    "vpl_pct_principal": 2,
    "perda_acum_pct": 4,
    "receita_acum_pct": 4,
    "escala_perda": 4,
    "decay_receita": 4,
    "perda_acum_final_pct": 4,
    "receita_acum_final_pct": 4,
}


def export_rounded(df: DataFrame) -> DataFrame:
    return round_columns(df, EXPORT_DECIMALS)


@dataclass(frozen=True)
class Facts:
    """Shared intermediates of a run; their sizes are bounded by calendar and categories."""

    totals: DataFrame
    cube: DataFrame
    flow: DataFrame
    cells: DataFrame
    aging: DataFrame
    fpd: DataFrame


def book_facts(loans: DataFrame, inst: DataFrame, p: Params, store: bool = True) -> Facts:
    """Everything that reads the book: six jobs, three of them over the instalments.

    With ``store`` the results are kept on shared storage, so the result tables never go
    back to the book. The jobs do not depend on each other and are submitted together.
    """
    keep = materialise if store else (lambda df, name: df)
    totals = keep(portfolio.book_totals(loans), "totals")
    start = totals.select("primeiro_mes").scalar()
    spine = rolls.spine_rows(totals, p)
    plans = {
        "cube": lambda: portfolio.loan_cube(loans),
        "flow": lambda: portfolio.future_flow(loans, p),
        "cells": lambda: cohorts.cohort_cells(loans, inst, p),
        "aging": lambda: rolls.aging_from_cells(rolls.aging_cells(loans, inst, p, start), spine),
        "fpd": lambda: cohorts.first_payment_default(loans, inst),
    }
    return Facts(totals=totals, **together({n: lambda n=n: keep(plans[n](), n) for n in plans}))


def results(facts: Facts, reneg_ids: DataFrame, meta: DataFrame, p: Params, store: bool = True) -> dict[str, DataFrame]:
    """The twenty result tables, unrounded where rounding is left to the export."""
    keep = materialise if store else (lambda df, name: df)
    totals = facts.totals

    def cut(*keys: str) -> DataFrame:
        return portfolio.cube_cut(facts.cube, *keys)

    chained = rolls.chain_efficiency(rolls.roll_rates(facts.aging))
    vintages = cut("safra")
    everything = portfolio.cube_total(facts.cube)
    informed = totals.select("tem_especie").scalar()
    small = together(
        {
            "kpis": lambda: keep(portfolio.kpi_row(totals, reneg_ids), "kpis"),
            "ltm": lambda: keep(rolls.ltm_averages(chained, p), "ltm"),
            "months": lambda: keep(curves.vintage_months(facts.cells, cohorts.vintage_rows(vintages), totals, p), "months"),
        }
    )
    kpis, ltm, months = small["kpis"], small["ltm"], small["months"]
    groups = keep(curves.risk_groups(months, p), "groups")
    decay = curves.revenue_decay(groups, p)
    shapes = curves.shape_decay_fill(curves.group_shape_raw(months, groups, totals, p), decay, p)
    curve = keep(curves.project_curves(months, groups, shapes, p), "curves")
    principal = totals.select("principal_total").scalar()
    default_rates = valuation.default_rows(vintages)
    ead = portfolio.exposure_row(totals)
    npv = valuation.npv_grid(facts.flow, default_rates, ltm, principal, p)
    net = valuation.net_future_flow(facts.flow, default_rates, ltm)
    matrix = portfolio.matrix_rows(cut("rating", "bhv"), everything)
    return {
        "kpis": valuation.kpi_long(kpis, meta, ltm, ead, npv, net),
        "faixas_atraso": portfolio.delinquency_rows(cut("faixa_atraso")),
        "faixas_prazo": portfolio.term_rows(cut("faixa_prazo")),
        "rating": portfolio.rating_rows(cut("rating"), everything),
        "uf": portfolio.profile_rows(cut("uf"), everything, "uf"),
        "perfil": portfolio.segment_rows(cut("especie"), cut("profissao"), informed, everything),
        "especie_situacao": portfolio.cross_rows(cut("especie", "situacao"), "especie", everything),
        "canal_situacao": portfolio.cross_rows(cut("canal", "situacao"), "canal", everything),
        "fpd_safras": facts.fpd,
        "vencimentario": portfolio.due_schedule(facts.flow),
        "comportamento_pagamento": cohorts.behaviour_from_cells(facts.cells, cohorts.vintage_rows(vintages)),
        "rolagens": rolls.roll_table(chained, ltm),
        "vpl_cenarios": npv,
        "parametros_pe": valuation.expected_loss(kpis, ead, ltm),
        "perda_acumulada": curves.loss_curve(curve),
        "receita_acumulada": curves.revenue_curve(curve),
        "safras_meta": curves.vintage_summary(curve, decay),
        "matriz_over60": portfolio.matrix_over60(matrix),
        "matriz_saldo": portfolio.matrix_balance(matrix),
        "meta_execucao": valuation.run_metadata(totals, ltm, p),
    }


def run_portfolio(
    loans: DataFrame,
    inst: DataFrame,
    reneg_ids: DataFrame,
    p: Params,
    meta: DataFrame | None = None,
    store: bool = True,
) -> dict[str, DataFrame]:
    """All result tables of one book, rounded as exported.

    ``store`` writes the shared intermediates once; without it everything stays one
    lazy plan per table. With it the inputs are stored tables, whose rows size the shuffles.
    """
    if store:
        size_shuffles(loans.sparkSession, max(row_bytes(loans), row_bytes(inst)))
    if meta is None:
        meta = default_meta(loans.sparkSession, p)
    tables = results(book_facts(loans, inst, p, store), reneg_ids, meta, p, store)
    return {name: export_rounded(df) for name, df in tables.items()}


def default_meta(spark: SparkSession, p: Params) -> DataFrame:
    return portfolio_meta(spark, None, snapshot=p.snapshot.strftime("%Y-%m"))


def run_from_files(
    spark: SparkSession,
    folder: str,
    output: str,
    snapshot: str,
    client: str | None = None,
    sep: str = ";",
    fmt: str = "parquet",
    validate: bool = True,
    **overrides,
) -> dict[str, bool]:
    """Read the delimited inputs of a folder, pass the gate, run everything and write the bundle.

    A finding of severity ``erro`` stops the run with ``ValidationFailed`` unless ``validate`` is off. ``overrides`` are
    fields of ``Params``, such as ``max_term``. Intermediates are removed at the end, also after a failure.
    """
    folder, output = folder.rstrip("/"), output.rstrip("/")
    p = Params.at(snapshot, **overrides)
    with run_scratch(spark):
        size_shuffles(spark, text_bytes(spark, *[f"{folder}/{n}.csv" for n in ("LOANS", "INSTALLMENTS", "RENEGOCIACAO")]))
        book = stage_book(spark, folder, p, sep, validate)
        if validate:
            require_pass(book.findings(p))
        loans = materialise(dedup_loans(well_staged(book.loans)), "loans")
        ids = renegotiated_ids(well_staged(book.reneg))
        meta = portfolio_meta(spark, f"{folder}/META.csv", client, snapshot, sep)
        return export_bundle(run_portfolio(loans, well_staged(book.inst), ids, p, meta), output, fmt)


@dataclass(frozen=True)
class StagedBook:
    """Typed inputs with ``_fora`` and ``_falhas``, the checks behind these, and what the headers alone tell."""

    loans: DataFrame
    inst: DataFrame
    reneg: DataFrame
    checks: dict[str, list[Check]]
    columns: DataFrame

    def findings(self, p: Params) -> DataFrame:
        """All findings of ``validate_files``, from the staged rows."""
        parts = [
            staged_findings(self.loans, LOANS, self.checks["LOANS"], p.max_malformed),
            staged_findings(self.inst, INSTALLMENTS, self.checks["INSTALLMENTS"], p.max_malformed),
            staged_findings(self.reneg, RENEGOTIATIONS, self.checks["RENEGOCIACAO"], p.max_malformed),
            staged_snapshot(self.loans, p),
            dq_cross(well_staged(self.loans), well_staged(self.inst), well_staged(self.reneg)),
        ]
        return union_all([*parts, self.columns])


def well_staged(rows: DataFrame) -> DataFrame:
    return rows.where("NOT _fora").drop("_fora", "_falhas")


def stage_book(spark: SparkSession, folder: str, p: Params, sep: str = ";", validate: bool = True) -> StagedBook:
    """Parse every text input once, into typed rows that also carry what the gate counts.

    Missing inputs and columns show in the headers, so with ``validate`` they stop the run with ``ValidationFailed`` before
    anything is parsed; without it they raise as the readers do. Missing renegotiations count as none.
    """
    path = {n: f"{folder}/{n}.csv" for n in ("LOANS", "INSTALLMENTS", "RENEGOCIACAO")}
    loans, inst = (_lines(spark, path[n], sep) for n in ("LOANS", "INSTALLMENTS"))
    reneg = _lines(spark, path["RENEGOCIACAO"], sep)
    if reneg is None:
        reneg = empty_raw(spark, RENEGOTIATIONS).withColumn(MALFORMED, F.lit(None).cast("string"))
    inputs = ((loans, LOANS), (inst, INSTALLMENTS), (reneg, RENEGOTIATIONS))
    columns = union_all(
        [missing_input(spark, at) if df is None else dq_columns(df.drop(MALFORMED), at) for df, at in inputs]
    )
    if validate:
        require_pass(columns)
    if loans is None:
        loans = read_text_lines(spark, path["LOANS"], sep)  # raises
    conditional = [] if inst is None else conditional_checks(loans, inst)
    checks = {
        "LOANS": [*null_checks(loans, LOANS), *loan_checks(loans, p.max_term), *conditional],
        "INSTALLMENTS": installment_row_checks(),
        "RENEGOCIACAO": [*null_checks(reneg, RENEGOTIATIONS), *renegotiation_checks(reneg)],
    }

    def marks(name: str) -> list[Column]:
        return mark_columns(marks_of(checks[name]).bits)

    origin = norm_id(F.col("id_contrato_origem")).alias("id_contrato_origem")
    staged = together(
        {
            "loans": lambda: materialise(parse_loans(loans, *marks("LOANS")), "parsed-loans"),
            "inst": lambda: staged_installments(spark, path["INSTALLMENTS"], f"{folder}/INSTALLMENTS.parquet", sep),
            "reneg": lambda: materialise(reneg.select(origin, *marks("RENEGOCIACAO")), "parsed-reneg"),
        }
    )
    return StagedBook(**staged, checks=checks, columns=columns)


def _lines(spark: SparkSession, path: str, sep: str) -> DataFrame | None:
    df = read_or_none(spark, path, sep, read_text_lines)
    return None if df is None else norm_id_alias(df)


def validate_files(spark: SparkSession, folder: str, p: Params, sep: str = ";") -> DataFrame:
    """All findings of the delimited inputs of a folder, malformed lines included.

    As in the run, missing renegotiations count as none.
    """

    def lines(name: str) -> DataFrame | None:
        return _lines(spark, f"{folder}/{name}.csv", sep)

    reneg = lines("RENEGOCIACAO")
    return validate_book(
        spark, lines("LOANS"), lines("INSTALLMENTS"), empty_raw(spark, RENEGOTIATIONS) if reneg is None else reneg, p
    )
