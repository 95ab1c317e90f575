"""Data-quality gate: findings with a severity, counted in one scan per input.

Every check yields ``dataset, check, column, severity, n_bad, n_total, pct, message``.
Severities are ``ok``, ``aviso`` and ``erro``; the book passes without an ``erro``.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from vintora.functions.calendar import year_month
from vintora.functions.numbers import pct
from vintora.functions.parsing import (
    date_status,
    decimal_text,
    norm_date,
    norm_id,
    plain_number,
)
from vintora.operators.inline_tables import inline_table
from vintora.params import Params
from vintora.sources.layouts import INSTALLMENTS, LOANS, NULL_MEANS_ZERO, RENEGOTIATIONS, Layout
from vintora.sources.normalise import parsed_date_is_invalid, parsed_number
from vintora.sources.readers import MALFORMED, well_formed, with_data_column

OK, WARN, ERROR = "ok", "aviso", "erro"
FINDING = ("dataset", "check", "column", "severity", "n_bad", "n_total", "pct", "message")


class ValidationFailed(Exception):
    """The gate found at least one blocking error."""


@dataclass(frozen=True)
class Check:
    """One counted rule: rows counted, and the severity when there are any.

    ``row`` is the condition whose rows are counted, and ``finish`` makes their number the result; rules over the whole table have
    neither.
    """

    dataset: str
    name: str
    column: str
    bad: Column
    severity: Column | str
    message: str
    total: Column | None = None
    row: Column | None = None
    finish: Callable[[Column], Column] | None = None


def count_where(condition: Column) -> Column:
    return F.count_if(F.coalesce(condition, F.lit(False)))


def row_check(
    dataset: str, name: str, column: str, row: Column, severity: str, message: str, finish: Callable[[Column], Column] | None = None
) -> Check:
    bad = count_where(row)
    return Check(dataset, name, column, finish(bad) if finish else bad, severity, message, None, row, finish)


@dataclass(frozen=True)
class Marks:
    """Row conditions of checks as bits of one number, for staging text and checks in one pass."""

    names: list[str]
    bits: Column


def marks_of(checks: Sequence[Check]) -> Marks:
    rows = [c for c in checks if c.row is not None]
    bits = F.lit(0).cast("bigint")
    for i, c in enumerate(rows):
        bits = bits.bitwiseOR(F.when(F.coalesce(c.row, F.lit(False)), F.lit(1 << i)).otherwise(F.lit(0)).cast("bigint"))
    return Marks([f"{c.name}.{c.column}" for c in rows], bits)


def of_marks(checks: Sequence[Check]) -> list[Check]:
    """The same checks counted from ``_fora`` and ``_falhas`` instead of the text; those over whole tables must not need it."""
    out, i = [], 0
    inside = ~F.col("_fora")
    for c in checks:
        total = F.count_if(inside) if c.total is None else c.total
        if c.row is None:
            out.append(replace(c, total=total))
            continue
        n = F.count_if(inside & (F.col("_falhas").bitwiseAND(F.lit(1 << i)) != 0))
        out.append(replace(c, bad=c.finish(n) if c.finish else n, total=total))
        i += 1
    return out


def findings(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """Run all checks of one table in a single aggregation."""
    rows = []
    for c in checks:
        bad, total = c.bad.cast("bigint"), F.count(F.lit(1)) if c.total is None else c.total
        level = F.when(bad > 0, c.severity).otherwise(OK) if isinstance(c.severity, str) else c.severity
        rows.append(
            F.struct(
                F.lit(c.dataset).alias("dataset"),
                F.lit(c.name).alias("check"),
                F.lit(c.column).alias("column"),
                level.alias("severity"),
                bad.alias("n_bad"),
                total.alias("n_total"),
                pct(bad, total).alias("pct"),
                F.lit(c.message).alias("message"),
            )
        )
    return df.agg(F.array(*rows).alias("f")).select(F.inline("f"))


def number_of(name: str) -> Column:
    """Locale-agnostic number, null when it is not one."""
    return plain_number(decimal_text(F.col(name)))


def date_is_invalid(name: str) -> Column:
    return date_status(F.col(name)) == "invalid"


def no_findings(spark: SparkSession) -> DataFrame:
    return spark.range(0).select(
        *[F.lit(None).cast("string").alias(c) for c in FINDING[:4]],
        F.lit(0).cast("bigint").alias("n_bad"),
        F.lit(0).cast("bigint").alias("n_total"),
        F.lit(0.0).alias("pct"),
        F.lit(None).cast("string").alias("message"),
    )


def union_all(parts: Sequence[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def presence_check(layout: Layout) -> Check:
    no_rows = (F.count(F.lit(1)) == 0).cast("bigint")
    return Check(layout.dataset, "presenca", "", no_rows, WARN if layout.may_be_empty else ERROR, "linhas de dados")


def missing_input(spark: SparkSession, layout: Layout) -> DataFrame:
    row = (layout.dataset, "presenca", "", ERROR, 1, 0, 0.0, "arquivo nao encontrado")
    table = inline_table(spark, ", ".join(f"`{c}`" for c in FINDING), [row])
    return table.withColumns({c: F.col(c).cast("bigint") for c in ("n_bad", "n_total")})


def dq_presence(spark: SparkSession, tables: Sequence[tuple[DataFrame | None, Layout]]) -> DataFrame:
    """Missing input is an error; empty is an error unless the layout allows it."""
    return union_all(
        [
            missing_input(spark, layout) if df is None else findings(df, [presence_check(layout)])
            for df, layout in tables
        ]
    )


def dq_columns(df: DataFrame, layout: Layout) -> DataFrame:
    """Required, optional and unmapped columns; uses only the schema."""
    present = set(df.columns)
    rows = [
        (layout.dataset, "coluna_obrigatoria", c, OK if c in present else ERROR, int(c not in present))
        for c in layout.required
    ]
    rows += [
        (layout.dataset, "coluna_opcional", c, OK if c in present else WARN, int(c not in present))
        for c in layout.optional
    ]
    rows += [(layout.dataset, "coluna_nao_mapeada", c, WARN, 1) for c in sorted(present - set(layout.columns))]
    names = "`dataset`, `check`, `column`, `severity`, `n_bad`"
    return inline_table(df.sparkSession, names, rows).select(
        "dataset",
        "check",
        "column",
        "severity",
        F.col("n_bad").cast("bigint"),
        F.lit(1).cast("bigint").alias("n_total"),
        (F.col("n_bad") * 100.0).cast("double").alias("pct"),
        F.lit("layout").alias("message"),
    )


def rows_held(df: DataFrame, layout: Layout) -> DataFrame:
    """Rows with a value in each required column that the input has, from one scan."""
    rows = [
        F.struct(F.lit(layout.dataset).alias("dataset"), F.lit(c).alias("column"), F.count(c).alias("linhas"))
        for c in layout.required
        if c in df.columns
    ]
    return df.agg(F.array(*rows).alias("r")).select(F.inline("r"))


def null_checks(df: DataFrame | Header, layout: Layout) -> list[Check]:
    checks = []
    for c in layout.required:
        if c not in df.columns:
            continue
        if c in layout.nullable:
            severity = OK
        else:
            severity = WARN if c in NULL_MEANS_ZERO else ERROR
        checks.append(row_check(layout.dataset, "nulos", c, F.col(c).isNull(), severity, "valores nulos"))
    return checks


def dq_nulls(df: DataFrame, layout: Layout) -> DataFrame:
    """Nulls of all required columns in one scan."""
    return run_checks(df, null_checks(df, layout))


def invalid_date(dataset: str, column: str, severity: str, invalid: Callable[[str], Column] = date_is_invalid) -> Check:
    return row_check(dataset, "data_invalida", column, invalid(column), severity, "datas invalidas")


def negative(dataset: str, column: str, severity: str, number: Callable[[str], Column] = number_of) -> Check:
    return row_check(dataset, "negativo", column, number(column) < 0, severity, "negativos")


def loan_checks(df: DataFrame, max_term: int = Params.max_term) -> list[Check]:
    checks = []
    for c in ("principal", "pmt"):
        if c in df.columns:
            checks.append(row_check("LOANS", "nao_numerico", c, number_of(c).isNull(), WARN, "nao numericos"))
            checks.append(negative("LOANS", c, ERROR))
    if "num_parcelas" in df.columns:
        short = F.coalesce(number_of("num_parcelas"), F.lit(0.0)) < 1
        checks.append(row_check("LOANS", "prazo_minimo", "num_parcelas", short, ERROR, "num_parcelas < 1"))
        long = number_of("num_parcelas") > max_term
        checks.append(row_check("LOANS", "prazo_maximo", "num_parcelas", long, ERROR, "num_parcelas acima do limite"))
    if "data_aquisicao" in df.columns:
        checks.append(invalid_date("LOANS", "data_aquisicao", ERROR))
    return checks


def installment_checks(
    df: DataFrame | Header, number: Callable[[str], Column] = number_of, invalid: Callable[[str], Column] = date_is_invalid
) -> list[Check]:
    """Checks of dates, amounts and first instalments; ``number`` and ``invalid`` tell how a column's values are read."""
    name = "INSTALLMENTS"
    dates = (("data_vencimento", ERROR), ("data_pagamento", WARN))
    checks = [invalid_date(name, c, severity, invalid) for c, severity in dates if c in df.columns]
    checks += [negative(name, c, WARN, number) for c in ("valor_parcela", "dias_atraso") if c in df.columns]
    if "num_parcela" in df.columns:
        first, none = number("num_parcela") == 1, lambda n: (n == 0).cast("bigint")
        checks.append(row_check(name, "sem_parcela_1", "num_parcela", first, ERROR, "nenhuma parcela 1", none))
    return checks


def renegotiation_checks(df: DataFrame) -> list[Check]:
    name, checks = "RENEGOCIACAO", []
    if "data_renegociacao" in df.columns:
        checks.append(invalid_date(name, "data_renegociacao", WARN))
    if "valor_refinanciado" in df.columns:
        checks.append(negative(name, "valor_refinanciado", WARN))
    return checks


def run_checks(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    return findings(df, checks) if checks else no_findings(df.sparkSession)


def dq_loans(df: DataFrame, max_term: int = Params.max_term) -> DataFrame:
    """Numbers, terms and acquisition dates of raw loans."""
    return run_checks(df, loan_checks(df, max_term))


def dq_malformed_lines(lines: DataFrame, layout: Layout, max_share: float = Params.max_malformed) -> DataFrame:
    """Lines of ``read_text_lines`` that do not match the header; an error above the share ``max_share``."""
    bad, total = F.count_if(F.col(MALFORMED).isNotNull()), F.count(F.lit(1))
    level = F.when(bad > max_share * total, ERROR).when(bad > 0, WARN).otherwise(OK)
    return findings(with_data_column(lines), [Check(layout.dataset, "linhas_malformadas", "", bad, level, "linhas fora do cabecalho")])


def dq_installments(df: DataFrame) -> DataFrame:
    """Dates, amounts and first instalments of raw instalments in one scan."""
    return run_checks(df, installment_checks(df))


def dq_renegotiations(df: DataFrame) -> DataFrame:
    """Dates and amounts of raw renegotiations; never blocking."""
    return run_checks(df, renegotiation_checks(df))


def id_presence(loans: DataFrame, inst: DataFrame, reneg: DataFrame | None = None) -> DataFrame:
    """One row per non-null contract id with the inputs that mention it.

    One grouped union answers the anti-joins in both directions: each input is scanned
    once and map-side aggregation leaves one row per id and task, so an id that fills a
    third of the instalments still shuffles as single rows.
    """

    def tagged(df: DataFrame, column: str, tag: str) -> DataFrame:
        flags = [F.lit(tag == t).alias(t) for t in ("em_loans", "em_inst", "em_reneg")]
        return df.select(norm_id(F.col(column)).alias("id_contrato"), *flags)

    parts = [tagged(loans, "id_contrato", "em_loans"), tagged(inst, "id_contrato", "em_inst")]
    if reneg is not None:
        parts.append(tagged(reneg, "id_contrato_origem", "em_reneg"))
    return (
        union_all(parts)
        .where(F.col("id_contrato").isNotNull())
        .groupBy("id_contrato")
        .agg(*[F.bool_or(t).alias(t) for t in ("em_loans", "em_inst", "em_reneg")])
    )


def orphan_installments(loans: DataFrame, inst: DataFrame) -> DataFrame:
    return id_presence(loans, inst).where("em_inst and not em_loans").select("id_contrato")


def loans_without_installments(loans: DataFrame, inst: DataFrame) -> DataFrame:
    return id_presence(loans, inst).where("em_loans and not em_inst").select("id_contrato")


def orphan_renegotiations(loans: DataFrame, reneg: DataFrame) -> DataFrame:
    """Distinct origin ids without a loan."""
    ids = reneg.select(norm_id(F.col("id_contrato_origem")).alias("id_contrato")).where("id_contrato is not null")
    known = loans.select(norm_id(F.col("id_contrato")).alias("id_contrato"))
    return ids.distinct().join(known, "id_contrato", "left_anti")


def dq_cross(loans: DataFrame, inst: DataFrame, reneg: DataFrame | None = None) -> DataFrame:
    """Ids missing on either side of the three inputs."""
    seen = id_presence(loans, inst, reneg)
    loan_ids = F.count_if(F.col("em_loans"))
    without = F.count_if(F.col("em_loans") & ~F.col("em_inst"))
    share = pct(without, loan_ids)
    pairs = [
        ("INSTALLMENTS", "orfaos_parcelas", F.count_if(F.col("em_inst") & ~F.col("em_loans")), F.count_if(F.col("em_inst")), None),
        ("LOANS", "contratos_sem_parcela", without, loan_ids, F.when(share > 20, ERROR).when(share > 5, WARN).otherwise(OK)),
    ]
    if reneg is not None:
        pairs.append(
            ("RENEGOCIACAO", "orfaos_renegociacao", F.count_if(F.col("em_reneg") & ~F.col("em_loans")), F.count_if(F.col("em_reneg")), None)
        )
    rows = []
    for dataset, check, bad, total, severity in pairs:
        level = F.when(bad > 0, WARN).otherwise(OK) if severity is None else severity
        rows.append(
            F.struct(
                F.lit(dataset).alias("dataset"),
                F.lit(check).alias("check"),
                F.lit("id_contrato_origem" if dataset == "RENEGOCIACAO" else "id_contrato").alias("column"),
                level.alias("severity"),
                bad.alias("n_bad"),
                total.alias("n_total"),
                pct(bad, total).alias("pct"),
                F.lit("ids sem correspondencia").alias("message"),
            )
        )
    return seen.agg(F.array(*rows).alias("f")).select(F.inline("f"))


def conditional_checks(loans: DataFrame, inst: DataFrame) -> list[Check]:
    if "motivo_falha_repasse" in inst.columns or "tipo_produto" not in loans.columns:
        return []
    payroll = F.col("tipo_produto").rlike("(?i)consignado")
    return [row_check("INSTALLMENTS", "coluna_condicional", "motivo_falha_repasse", payroll, ERROR, "exigida por consignado")]


def dq_conditional_column(loans: DataFrame, inst: DataFrame) -> DataFrame:
    """Payroll products need ``motivo_falha_repasse`` among the instalments."""
    return run_checks(loans, conditional_checks(loans, inst))


def snapshot_facts(loans: DataFrame, p: Params) -> DataFrame:
    """Vintage range, distinct vintages and loans acquired after the snapshot."""
    acquired = norm_date(F.col("data_aquisicao"))
    month = year_month(F.col("d"))
    return (
        loans.select(acquired.alias("d"))
        .agg(
            year_month(F.min("d")).alias("safra_min"),
            year_month(F.max("d")).alias("safra_max"),
            F.countDistinct(month).alias("safras"),
            F.count("d").alias("datas_validas"),
            count_where(F.col("d") > F.lit(p.snapshot)).alias("posteriores"),
        )
    )


def dq_snapshot(loans: DataFrame, p: Params) -> DataFrame:
    """Loans acquired after the snapshot, or no usable acquisition date at all."""
    return run_checks(loans, snapshot_checks(loans, p))


def snapshot_checks(loans: DataFrame, p: Params) -> list[Check]:
    if "data_aquisicao" not in loans.columns:
        return []
    acquired = norm_date(F.col("data_aquisicao"))
    bad, total = count_where(acquired > F.lit(p.snapshot)), F.count(acquired)
    level = F.when((bad > 0) | (total == 0), WARN).otherwise(OK)
    return [Check("LOANS", "data_base", "data_aquisicao", bad, level, "posteriores a data_base", total)]


@dataclass(frozen=True)
class Header:
    """Columns of an input, where nothing else of it is needed."""

    columns: tuple[str, ...]


def installment_row_checks() -> list[Check]:
    """Checks of the staged instalments, which have all required columns; they read what ``with_parsed`` adds to the text."""
    header = Header(INSTALLMENTS.required)
    return [*null_checks(header, INSTALLMENTS), *installment_checks(header, parsed_number, parsed_date_is_invalid)]


def installment_marks() -> Marks:
    return marks_of(installment_row_checks())


def staged_findings(df: DataFrame, layout: Layout, checks: Sequence[Check], max_share: float = Params.max_malformed) -> DataFrame:
    """Malformed lines, presence and ``checks`` of a staged input from ``_fora`` and ``_falhas``, in one scan of these."""
    inside, bad = F.count_if(~F.col("_fora")), F.count_if(F.col("_fora"))
    level = F.when(bad > max_share * F.count(F.lit(1)), ERROR).when(bad > 0, WARN).otherwise(OK)
    whole = [
        Check(layout.dataset, "linhas_malformadas", "", bad, level, "linhas fora do cabecalho"),
        replace(presence_check(layout), bad=(inside == 0).cast("bigint"), total=inside),
    ]
    return findings(df, [*whole, *of_marks(checks)])


def staged_snapshot(loans: DataFrame, p: Params) -> DataFrame:
    """``dq_snapshot`` of staged loans."""
    acquired = F.when(~F.col("_fora"), F.col("data_aquisicao"))
    bad, total = count_where(acquired > F.lit(p.snapshot)), F.count(acquired)
    level = F.when((bad > 0) | (total == 0), WARN).otherwise(OK)
    return findings(loans, [Check("LOANS", "data_base", "data_aquisicao", bad, level, "posteriores a data_base", total)])


def validate_book(
    spark: SparkSession,
    loans: DataFrame | None,
    inst: DataFrame | None,
    reneg: DataFrame | None,
    p: Params | None = None,
) -> DataFrame:
    """All findings of the three raw inputs; None stands for a missing file.

    Presence, nulls, values, snapshot and conditional columns of an input share one aggregation, so each input is
    scanned once for its own checks and once for the checks across inputs. Inputs may hold the column of
    ``read_text_lines``; malformed lines then take one more scan, and only the others are checked.
    """
    max_term, max_share = (p.max_term, p.max_malformed) if p else (Params.max_term, Params.max_malformed)
    lines = ((loans, LOANS), (inst, INSTALLMENTS), (reneg, RENEGOTIATIONS))
    malformed = [
        dq_malformed_lines(df, layout, max_share) for df, layout in lines if df is not None and MALFORMED in df.columns
    ]
    loans, inst, reneg = (well_formed(df) if df is not None and MALFORMED in df.columns else df for df, _ in lines)

    def of_loans(df: DataFrame) -> list[Check]:
        return [
            *loan_checks(df, max_term),
            *(snapshot_checks(df, p) if p is not None else []),
            *(conditional_checks(df, inst) if inst is not None else []),
        ]

    inputs = (
        (loans, LOANS, of_loans),
        (inst, INSTALLMENTS, installment_checks),
        (reneg, RENEGOTIATIONS, renegotiation_checks),
    )
    parts = list(malformed)
    for df, layout, values in inputs:
        if df is None:
            parts.append(missing_input(spark, layout))
        else:
            checks = [presence_check(layout), *null_checks(df, layout), *values(df)]
            parts += [findings(df, checks), dq_columns(df, layout)]
    if loans is not None and inst is not None and "id_contrato" in loans.columns and "id_contrato" in inst.columns:
        usable = reneg if reneg is not None and "id_contrato_origem" in reneg.columns else None
        parts.append(dq_cross(loans, inst, usable))
    return union_all(parts)


def dq_gate(found: DataFrame) -> DataFrame:
    """One row: errors, warnings and the decision."""
    errors = F.count_if(F.col("severity") == ERROR)
    return found.agg(
        errors.alias("erros"),
        F.count_if(F.col("severity") == WARN).alias("avisos"),
        F.when(errors == 0, "APROVADO").otherwise("REPROVADO").alias("resultado"),
    )


def require_pass(found: DataFrame) -> None:
    """Raise ``ValidationFailed`` when the gate is not passed."""
    row = dq_gate(found).first()
    if row["erros"]:
        raise ValidationFailed(f"{row['erros']} erros, {row['avisos']} avisos")
