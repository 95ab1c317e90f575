"""The audit of a run: result tables against golden tables, curve shapes, totals and the decision."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from vintora.functions.numbers import round_columns
from vintora.operators import portfolio, reconcile
from vintora.operators.inline_tables import inline_table
from vintora.sources.sinks import read_bundle


@dataclass(frozen=True)
class Audited:
    """A result table that golden values exist for: key expression, and kind of each measure, by name or by row."""

    check: str
    table: str
    key: str
    measures: Mapping[str, str]
    kind: str | None = None


# Kinds of the scalars; texts such as dates and names are compared by checksum.
KPI_KIND = """CASE WHEN try_cast(valor AS double) IS NULL THEN 'count' WHEN chave LIKE 'vpl%valor' THEN 'rel'
    WHEN chave LIKE '%pct%' OR chave = 'prazo_medio' THEN 'pct'
    WHEN chave LIKE 'over%n' OR chave IN ('contratos', 'renegociacoes') THEN 'count' ELSE 'money' END"""
KPI_VALUE = "coalesce(try_cast(valor AS double), CAST(crc32(CAST(valor AS binary)) AS double))"
PE_KIND = "CASE WHEN parametro LIKE 'EAD%' OR parametro LIKE 'PE =%' THEN 'money' ELSE 'pct' END"

# What is compared, by table of the bundle.
AUDITED = (
    Audited("rating", "rating", "rating", {"contratos_n": "count", "principal": "money", "over60_n": "count"}),
    Audited("faixas", "faixas_atraso", "faixa", {"contratos_n": "count", "pct_carteira": "pct"}),
    Audited("fpd", "fpd_safras", "safra", {"fpd_qtd_pct": "pct", "fpd_val_pct": "pct"}),
    Audited("npv", "vpl_cenarios", "concat_ws('@', cenario, if(taxa_am_pct < 1.2, '1', '1.5'))", {"vpl_valor": "rel"}),
    Audited("kpi", "kpis", "concat_ws('.', categoria, chave)", {"valor": KPI_VALUE}, KPI_KIND),
    Audited("pe", "parametros_pe", "parametro", {"valor": "valor"}, PE_KIND),
    Audited("uf", "uf", "uf", {"contratos_n": "count", "principal": "money", "over60_n": "count"}),
)
# Tables whose sums must give the totals of the run.
ROLLUPS = {"rating": ("contratos_n", "principal"), "faixas_atraso": ("contratos_n", "acumulado"), "uf": ("contratos_n", "principal")}
ROLLUP_TOLERANCES = {"contratos_n": 0.0, "principal": 5.0, "acumulado": 0.01}
DEVIATIONS = ("fpd", "npv")
CURVES = (("perda_acumulada", "perda_acum_pct"), ("receita_acumulada", "receita_acum_pct"))


def _stack(df: DataFrame, audited: Audited) -> DataFrame:
    if audited.kind is None:
        return reconcile.long_values(df, F.expr(audited.key), audited.measures, audited.check)
    ((name, value),) = audited.measures.items()
    return df.select(
        F.lit(f"{audited.check} {name}").alias("check"),
        F.expr(audited.key).alias("key"),
        F.expr(value).cast("double").alias("value"),
        F.expr(audited.kind).alias("kind"),
    )


def curve_checks(bundle: Mapping[str, DataFrame]) -> DataFrame:
    """Vintages whose cumulative curve falls somewhere, per curve; none is right."""
    rows = []
    for table, value in CURVES:
        falling = reconcile.monotonic_curves(bundle[table], "safra", "mob", value)
        n: Column = F.count(F.lit(1)).cast("double")
        rows.append(
            falling.agg(n.alias("computed")).select(
                F.concat(F.lit("curva "), F.lit(table)).alias("check"),
                F.lit("").alias("key"),
                "computed",
                F.lit(0.0).alias("golden"),
                F.col("computed").alias("diff"),
                F.lit(0.0).alias("tol"),
                F.lit("count").alias("kind"),
                F.when(F.col("computed") == 0, "pass").otherwise("fail").alias("status"),
            )
        )
    return rows[0].unionByName(rows[1])


def rollup_checks(bundle: Mapping[str, DataFrame]) -> DataFrame | None:
    """Sums of the parts against the totals of the run, and the last cumulative share; none without ``kpis``."""
    if "kpis" not in bundle:
        return None

    def total(key: str) -> Column:
        rows = bundle["kpis"].where((F.col("categoria") == "kpi") & (F.col("chave") == key))
        return rows.select(F.expr("try_cast(valor AS double)")).scalar()

    known = {
        "contratos_n": lambda: (F.sum("contratos_n"), total("contratos")),
        "principal": lambda: (F.sum(F.col("principal").cast("decimal(28,2)")), total("principal_total")),
        "acumulado": lambda: (F.max("acumulado"), F.lit(100.0)),
    }
    out = None
    for table, names in ROLLUPS.items():
        if table not in bundle:
            continue
        row = reconcile.rollup_consistency(bundle[table], {n: known[n]() for n in names}, ROLLUP_TOLERANCES, f"soma {table}")
        part = row.select(
            "check",
            F.lit("").alias("key"),
            *["computed", "golden", "diff", "tol"],
            F.lit("sum").alias("kind"),
            F.when(F.col("passed"), "pass").otherwise("fail").alias("status"),
        )
        out = part if out is None else out.unionByName(part)
    return out


def coverage_checks(bundle: Mapping[str, DataFrame], golden: Mapping[str, DataFrame]) -> DataFrame | None:
    """Failing rows for tables that cannot be compared: no golden table, no result table, or no entry in ``AUDITED``."""
    audited = {a.table for a in AUDITED}
    rows = [(t, "missing_golden") for t in sorted(audited & set(bundle) - set(golden))]
    rows += [(t, "missing_actual") for t in sorted(audited & set(golden) - set(bundle))]
    rows += [(t, "fail") for t in sorted(set(golden) - audited)]
    if not rows:
        return None
    values = F.lit(None).cast("double")
    return inline_table(next(iter({**bundle, **golden}.values())).sparkSession, "key, status", rows).select(
        F.lit("tabela").alias("check"),
        "key",
        *[values.alias(c) for c in ("computed", "golden", "diff", "tol")],
        F.lit("table").alias("kind"),
        "status",
    )


def audit_checks(bundle: Mapping[str, DataFrame], golden: Mapping[str, DataFrame], loans: DataFrame | None = None) -> DataFrame:
    """Every keyed comparison that golden tables exist for, sums of parts against totals, and the shape of both curves.

    ``golden`` maps table names of the bundle to tables with the same key and measures; keys on one side only are reported.
    An audited table of the bundle without a golden table, and a golden table that is not audited or not in the bundle,
    fail as ``tabela``. Sums need the totals in ``kpis``. With ``loans``, golden tables that these can give are also held
    against them (``lineage_checks``).
    """
    both = [a for a in AUDITED if a.table in golden and a.table in bundle]
    parts = [reconcile.reconcile(_stack(bundle[a.table], a), _stack(golden[a.table], a)) for a in both]
    out = curve_checks(bundle)
    lineage = lineage_checks(loans, golden) if loans is not None and LINEAGE.keys() & golden.keys() else None
    for part in (*parts, rollup_checks(bundle), coverage_checks(bundle, golden), lineage):
        if part is not None:
            out = out.unionByName(part)
    return out


# Golden tables that are also recomputed from the loans, by the cut behind them.
LINEAGE = {"uf": "uf", "rating": "rating"}


def lineage_checks(loans: DataFrame, golden: Mapping[str, DataFrame]) -> DataFrame:
    """Golden tables against roll-ups of the loans themselves, whatever the run has made of them; groups on one side fail."""
    parts = []
    for a in AUDITED:
        if a.table in golden and a.table in LINEAGE:
            detail = round_columns(portfolio.profile(loans, LINEAGE[a.table]), {"principal": 2})
            check = f"linhagem {a.check}"
            stacked = [reconcile.long_values(df, F.expr(a.key), a.measures, check) for df in (detail, golden[a.table])]
            parts.append(reconcile.reconcile(*stacked))
    if not parts:
        raise ValueError(f"no golden table of {', '.join(LINEAGE)}")
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


# Money by which two stages of the same table are held against each other, and their keys.
STAGES = {"uf": ("principal", "uf"), "rating": ("principal", "rating"), "faixas_prazo": ("principal", "faixa")}


def stage_comparison(a: Mapping[str, DataFrame], b: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table that both stages have: totals and their ratio, which shows a wrong scale, and how far keys overlap."""
    out = None
    for table, (value, key) in STAGES.items():
        if table not in a or table not in b:
            continue
        keys = reconcile.overlap_coverage(a[table], b[table], key)
        row = reconcile.stage_scale_ratio(a[table], b[table], value).select(
            F.lit(table).alias("tabela"),
            "*",
            keys.select("comparadas").scalar().alias("comparadas"),
            keys.select("total_a").scalar().alias("total_chaves_a"),
            keys.select("total_b").scalar().alias("total_chaves_b"),
        )
        out = row if out is None else out.unionByName(row)
    if out is None:
        raise ValueError(f"no common table of {', '.join(STAGES)}")
    return out


def audit_folder(
    spark: SparkSession, path: str, golden: Mapping[str, DataFrame], loans: DataFrame | None = None
) -> DataFrame:
    """``audit_checks`` of the bundle that was committed last in a folder, in whatever format it was written."""
    return audit_checks(read_bundle(spark, path), golden, loans)


def audit_deviations(checks: DataFrame) -> DataFrame:
    """Largest deviation of first-payment default (points) and of NPV (relative), by kind."""
    return reconcile.max_deviation(checks.where(F.split("check", " ")[0].isin(*DEVIATIONS)))


def audit_summary(checks: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """Totals of the checks and the decision: GREEN when every failure is on the list ``known`` (check_name)."""
    if known is None:
        known = inline_table(checks.sparkSession, "check_name", [("",)])
    return reconcile.regression_gate(checks, known)
