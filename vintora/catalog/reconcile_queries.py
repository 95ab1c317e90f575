"""Reconciliation queries: results against golden tables with known deviations.

The golden tables are derived from the results themselves with a few shifted, dropped
and added rows, so that every status of a comparison occurs.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F

from vintora.catalog import book
from vintora.catalog import oracle as o
from vintora.catalog.queries import Curves, kpis, ltm, npv, portfolio_results, register
from vintora.catalog.book import PARAMS
from vintora.functions.numbers import round_columns
from vintora.operators import cohorts, curves, portfolio, reconcile, valuation
from vintora.operators.inline_tables import inline_table
from vintora.plans.audit_run import audit_checks, audit_folder, audit_summary, lineage_checks, stage_comparison
from vintora.plans.portfolio_run import export_rounded
from vintora.sources.sinks import export_bundle
from vintora.sources.workspace import materialise, new_folder


def long_sql(source: str, key: str, measures: Mapping[str, str], check: str) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{check} {m}' AS "check", CAST({key} AS VARCHAR) AS key, CAST({m} AS DOUBLE) AS value, '{kind}' AS kind FROM {source}"""
        for m, kind in measures.items()
    )


def compare_sql(actual: str, golden: str) -> str:
    return f"""
SELECT "check", key, computed, golden, diff, tol, kind, CASE WHEN na THEN 'missing_actual' WHEN ng THEN 'missing_golden'
    WHEN computed IS NULL AND golden IS NULL THEN 'pass' WHEN diff <= tol THEN 'pass' ELSE 'fail' END AS status
FROM (SELECT *, CASE kind WHEN 'count' THEN 0.0e0 WHEN 'money' THEN 1.0e0 WHEN 'pct' THEN 0.01e0 ELSE 0.001e0 END AS tol,
    {o.r("CASE WHEN kind = 'rel' THEN abs(computed - golden) / CASE WHEN golden = 0 THEN 1 ELSE abs(golden) END ELSE abs(computed - golden) END", 6)} AS diff
  FROM (SELECT "check", key, a.value AS computed, g.value AS golden, coalesce(g.kind, a.kind) AS kind,
          a.kind IS NULL AS na, g.kind IS NULL AS ng
        FROM ({actual}) a FULL JOIN ({golden}) g USING ("check", key)))"""


# --- rating ----------------------------------------------------------------

RATING = {"contratos_n": "count", "principal": "money", "over60_n": "count"}
o.CTES["b_golden_rating"] = """
SELECT rating, CASE WHEN rating = '3' THEN contratos_n + 1 ELSE contratos_n END AS contratos_n,
  principal + CASE rating WHEN '1' THEN 0.5e0 WHEN '2' THEN 2.0e0 ELSE 0 END AS principal,
  CASE WHEN rating <> '4' THEN over60_n END AS over60_n FROM b_rating WHERE rating <> '5'
UNION ALL SELECT 'X', contratos_n, principal, over60_n FROM b_rating WHERE rating = 'N/I'"""
o.CTES["b_check_rating"] = compare_sql(
    long_sql("b_rating", "rating", RATING, "rating"), long_sql("b_golden_rating", "rating", RATING, "rating")
)


def golden_rating(profile: DataFrame) -> DataFrame:
    rating = F.col("rating")
    extra = profile.where(rating == "N/I").withColumn("rating", F.lit("X"))
    shifted = profile.where(rating != "5").withColumns(
        {
            "contratos_n": F.when(rating == "3", F.col("contratos_n") + 1).otherwise(F.col("contratos_n")),
            "principal": F.col("principal") + F.when(rating == "1", 0.5).when(rating == "2", 2.0).otherwise(0.0),
            "over60_n": F.when(rating != "4", F.col("over60_n")),
        }
    )
    return shifted.unionByName(extra)


def rating_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    profile = export_rounded(portfolio.rating_profile(book.loans(spark, sf_dir)))
    sides = [reconcile.long_values(t, F.col("rating"), RATING, "rating") for t in (profile, golden_rating(profile))]
    return reconcile.reconcile(*sides)


@register("reconcile_rating", "SELECT * FROM b_check_rating")
def reconcile_rating(spark, sf_dir):
    return rating_checks(spark, sf_dir)


@register(
    "reconcile_values",
    """SELECT status, kind, count(*) AS n FROM b_check_rating GROUP BY ALL""",
)
def reconcile_values(spark, sf_dir):
    return rating_checks(spark, sf_dir).groupBy("status", "kind").agg(F.count(F.lit(1)).alias("n"))


# --- scalars ---------------------------------------------------------------

SCALARS = {
    "contratos": ("count", 0.0),
    "principal_total": ("money", 0.9),
    "over60_n": ("count", 1.0),
    "over60_pct": ("pct", 0.005),
    "ead_total": ("money", 1.5),
    "pe": ("money", 0.0),
}

o.CTES["b_scalars"] = f"""
SELECT contratos, principal_total, over60_n, {o.r('over60_pct * 100')} AS over60_pct, (SELECT ead_total FROM b_pe) AS ead_total,
  {o.r('(SELECT pe FROM b_pe)')} AS pe FROM b_kpis"""


@register(
    "reconcile_scalars",
    compare_sql(
        " UNION ALL ".join(
            f"""SELECT 'kpi {n}' AS "check", '' AS key, CAST({n} AS DOUBLE) AS value, '{k}' AS kind FROM b_scalars"""
            for n, (k, _) in SCALARS.items()
        ),
        " UNION ALL ".join(
            f"""SELECT 'kpi {n}' AS "check", '' AS key, CAST({n} AS DOUBLE) + {shift!r} AS value, '{k}' AS kind FROM b_scalars"""
            for n, (k, shift) in SCALARS.items()
        ),
    ),
)
def reconcile_scalars(spark, sf_dir):
    facts = kpis(spark, sf_dir)
    ead = portfolio.exposure_at_default(book.loans(spark, sf_dir))
    row = valuation.expected_loss_row(facts, ead, ltm(spark, sf_dir)).select(
        facts.select("contratos").scalar().alias("contratos"),
        "principal_total",
        facts.select("over60_n").scalar().alias("over60_n"),
        reconcile.rounded(F.col("pd") * 100, 2).alias("over60_pct"),
        "ead_total",
        reconcile.rounded(F.col("pe"), 2).alias("pe"),
    )
    kinds = {n: k for n, (k, _) in SCALARS.items()}
    shifted = row.select(*[(F.col(n) + shift).alias(n) for n, (_, shift) in SCALARS.items()])
    return reconcile.reconcile(*[reconcile.long_values(t, F.lit(""), kinds, "kpi") for t in (row, shifted)])


# --- bands, first-payment default, NPV -------------------------------------

BANDS = {"contratos_n": "count", "pct_carteira": "pct"}
o.CTES["b_bands_out"] = (
    f"SELECT faixa, contratos_n, {o.r('pct_raw')} AS pct_carteira, {o.r('acum_raw')} AS acumulado FROM b_bands"
)
BAND_SHIFT = (("Corrente (0 dias)", 0.005), ("1 a 30 dias", 0.02))


@register(
    "reconcile_bands",
    compare_sql(
        long_sql("b_bands_out", "faixa", BANDS, "faixas"),
        long_sql(
            "(SELECT faixa, contratos_n, pct_carteira + CASE faixa "
            + " ".join(f"WHEN '{n}' THEN {v!r}" for n, v in BAND_SHIFT)
            + " ELSE 0 END AS pct_carteira FROM b_bands_out)",
            "faixa",
            BANDS,
            "faixas",
        ),
    ),
)
def reconcile_bands(spark, sf_dir):
    bands = export_rounded(portfolio.delinquency_bands(book.loans(spark, sf_dir)))
    shift = F.lit(0.0)
    for name, value in BAND_SHIFT:
        shift = F.when(F.col("faixa") == name, value).otherwise(shift)
    golden = bands.withColumn("pct_carteira", F.col("pct_carteira") + shift)
    return reconcile.reconcile(*[reconcile.long_values(t, F.col("faixa"), BANDS, "faixas") for t in (bands, golden)])


FPD = {"fpd_qtd_pct": "pct", "fpd_val_pct": "pct"}
o.CTES["b_check_fpd"] = compare_sql(
    long_sql("b_fpd", "safra", FPD, "fpd"),
    long_sql(
        "(SELECT safra, fpd_qtd_pct + CASE WHEN safra LIKE '%-07' THEN 0.25e0 ELSE 0 END AS fpd_qtd_pct, fpd_val_pct "
        "FROM b_fpd WHERE safra NOT LIKE '%-12')",
        "safra",
        FPD,
        "fpd",
    ),
)


def fpd_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return export_rounded(cohorts.first_payment_default(book.loans(spark, sf_dir), book.installments(spark, sf_dir)))


def fpd_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    fpd = fpd_table(spark, sf_dir)
    golden = fpd.where(~F.col("safra").like("%-12")).withColumn(
        "fpd_qtd_pct", F.col("fpd_qtd_pct") + F.when(F.col("safra").like("%-07"), 0.25).otherwise(0.0)
    )
    return reconcile.reconcile(*[reconcile.long_values(t, F.col("safra"), FPD, "fpd") for t in (fpd, golden)])


@register("reconcile_fpd", "SELECT * FROM b_check_fpd")
def reconcile_fpd(spark, sf_dir):
    return fpd_checks(spark, sf_dir)


o.CTES["b_npv_out"] = f"SELECT cenario || '@' || CASE WHEN taxa_am_pct < 1.2 THEN '1' ELSE '1.5' END AS k, {o.r('vpl')} AS vpl FROM b_npv"
o.CTES["b_check_npv"] = compare_sql(
    long_sql("b_npv_out", "k", {"vpl": "rel"}, "npv"),
    long_sql(
        "(SELECT k, vpl * CASE WHEN k = 'otimista@1.5' THEN 1.002e0 ELSE 1.0005e0 END AS vpl FROM b_npv_out)", "k", {"vpl": "rel"}, "npv"
    ),
)


def npv_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    rate = F.when(F.col("taxa_am_pct") < 1.2, "1").otherwise("1.5")
    out = export_rounded(npv(spark, sf_dir)).select(F.concat_ws("@", "cenario", rate).alias("k"), F.col("vpl_valor").alias("vpl"))
    golden = out.withColumn("vpl", F.col("vpl") * F.when(F.col("k") == "otimista@1.5", 1.002).otherwise(1.0005))
    return reconcile.reconcile(*[reconcile.long_values(t, F.col("k"), {"vpl": "rel"}, "npv") for t in (out, golden)])


@register("reconcile_npv", "SELECT * FROM b_check_npv")
def reconcile_npv(spark, sf_dir):
    return npv_checks(spark, sf_dir)


# --- consistency, shape, lineage -------------------------------------------


def rollup_row(check: str, computed: str, golden: str, tol: str) -> str:
    gap = o.r(f"abs({computed} - {golden})", 6)
    return f"""SELECT '{check}' AS "check", {computed} AS computed, {golden} AS golden, {tol} AS tol, {gap} AS diff, {gap} <= {tol} AS passed"""


TOTAL_N = "(SELECT CAST(contratos AS DOUBLE) FROM b_kpis)"
TOTAL_P = "(SELECT principal_total FROM b_kpis)"


@register(
    "rollup_consistency",
    " UNION ALL ".join(
        [
            rollup_row("rating contratos_n", "(SELECT CAST(sum(contratos_n) AS DOUBLE) FROM b_rating)", TOTAL_N, "0.0e0"),
            rollup_row(
                "rating principal",
                "(SELECT CAST(sum(CAST(principal AS DECIMAL(28,2))) AS DOUBLE) FROM b_rating)",
                TOTAL_P,
                "5.0e0",
            ),
            rollup_row("faixas contratos_n", "(SELECT CAST(sum(contratos_n) AS DOUBLE) FROM b_bands_out)", TOTAL_N, "0.0e0"),
            rollup_row("faixas acumulado", "(SELECT max(acumulado) FROM b_bands_out)", "100.0e0", "0.01e0"),
        ]
    ),
)
def rollup_consistency(spark, sf_dir):
    loans, totals = book.loans(spark, sf_dir), kpis(spark, sf_dir)
    n = totals.select("contratos").scalar()
    rating = reconcile.rollup_consistency(
        export_rounded(portfolio.rating_profile(loans)),
        {
            "contratos_n": (F.sum("contratos_n"), n),
            "principal": (F.sum(F.col("principal").cast("decimal(28,2)")), totals.select("principal_total").scalar()),
        },
        {"contratos_n": 0, "principal": 5.0},
        "rating",
    )
    bands = reconcile.rollup_consistency(
        export_rounded(portfolio.delinquency_bands(loans)),
        {"contratos_n": (F.sum("contratos_n"), n), "acumulado": (F.max("acumulado"), F.lit(100.0))},
        {"contratos_n": 0, "acumulado": 0.01},
        "faixas",
    )
    return rating.unionByName(bands)


@register(
    "monotonic_curves",
    """SELECT curva, safra, count(*) AS quedas FROM (
         SELECT curva, safra, v, lag(v) OVER (PARTITION BY curva, safra ORDER BY mob) AS antes FROM (
           SELECT 'perda' AS curva, safra, mob, p AS v FROM b_curve UNION ALL
           SELECT 'receita', safra, mob, r FROM b_curve UNION ALL
           SELECT 'incremento', safra, mob, perda FROM b_mob)) WHERE v < antes - 1e-9 GROUP BY 1, 2""",
)
def monotonic_curves(spark, sf_dir):
    """Both cumulative curves, which must not fall, and monthly losses as the planted violation, which do."""
    chain = Curves(spark, sf_dir)
    curve = materialise(chain.curve(), "curves")
    monthly = cohorts.loss_revenue_by_mob(chain.loans, chain.inst, PARAMS, chain.cells)
    checked = (
        ("perda", curves.loss_curve(curve), "perda_acum_pct"),
        ("receita", curves.revenue_curve(curve), "receita_acum_pct"),
        ("incremento", monthly, "perda"),
    )
    found = [
        reconcile.monotonic_curves(df, "safra", "mob", value).select(F.lit(name).alias("curva"), "safra", "quedas")
        for name, df, value in checked
    ]
    return found[0].unionByName(found[1]).unionByName(found[2])


def golden_states(profile: DataFrame) -> DataFrame:
    """State summary whose money is ten times larger and whose counts differ for some states."""
    off = F.when(F.col("uf").like("%_1"), 1).otherwise(0)
    return profile.where(F.col("uf") != "NATION_2").select(
        "uf", (F.col("contratos_n") + off).alias("contratos"), (F.col("principal") * 10).alias("principal")
    )


o.CTES["b_golden_uf"] = """
SELECT uf, contratos_n + CASE WHEN uf LIKE '%_1' THEN 1 ELSE 0 END AS contratos, principal * 10 AS principal
FROM b_uf WHERE uf <> 'NATION_2'"""


@register(
    "lineage_by_group",
    f"""SELECT uf, contratos_n AS detalhe_n, contratos AS resumo_n, coalesce(contratos_n = contratos, false) AS confere,
        {o.r('b_uf.principal / b_golden_uf.principal', 4)} AS razao_principal, over60_n AS detalhe_over60
        FROM b_uf FULL JOIN b_golden_uf USING (uf)""",
)
def lineage_by_group(spark, sf_dir):
    detail = portfolio.state_profile(book.loans(spark, sf_dir, attributes=True))
    return reconcile.lineage_by_group(detail, golden_states(detail), "uf")


@register(
    "stage_scale_ratio",
    f"""SELECT {o.r('a')} AS total_a, {o.r('b')} AS total_b, {o.r('a / b', 4)} AS razao
        FROM (SELECT sum(principal) AS b FROM b_uf), (SELECT sum(principal) AS a FROM b_golden_uf)""",
)
def stage_scale_ratio(spark, sf_dir):
    detail = portfolio.state_profile(book.loans(spark, sf_dir, attributes=True))
    ratio = reconcile.stage_scale_ratio(golden_states(detail), detail, "principal")
    return ratio.withColumns({c: reconcile.rounded(F.col(c), 2) for c in ("total_a", "total_b")})


def fpd_fractions(fpd: DataFrame) -> DataFrame:
    """The other stage: fractions, later vintages only, one vintage with a deviation."""
    off = F.when(F.col("safra") == "1998-03", 0.001).otherwise(0.0)
    return fpd.where(F.col("safra") >= "1997-01").select(
        "safra",
        (F.col("fpd_n") / F.col("contratos_n") + off).alias("fpd30_qtd_frac"),
        (F.col("fpd_val_pct") / 100).alias("fpd30_val_frac"),
    )


o.CTES["b_frac"] = """
SELECT safra, CAST(fpd_n AS DOUBLE) / contratos_n + CASE WHEN safra = '1998-03' THEN 0.001e0 ELSE 0 END AS qf,
  fpd_val_pct / 100 AS vf FROM b_fpd WHERE safra >= '1997-01'"""


@register(
    "overlap_compare",
    f"""SELECT safra, fpd_qtd_pct, {o.r('qf * 100', 4)} AS fpd30_qtd_frac, {o.r(f"abs(fpd_qtd_pct - {o.r('qf * 100', 4)})", 4)} AS dif_fpd_qtd_pct,
        fpd_val_pct, {o.r('vf * 100', 4)} AS fpd30_val_frac, {o.r(f"abs(fpd_val_pct - {o.r('vf * 100', 4)})", 4)} AS dif_fpd_val_pct
        FROM b_fpd JOIN b_frac USING (safra)""",
)
def overlap_compare(spark, sf_dir):
    fpd = fpd_table(spark, sf_dir)
    pairs = [("fpd_qtd_pct", "fpd30_qtd_frac"), ("fpd_val_pct", "fpd30_val_frac")]
    return reconcile.overlap_compare(fpd, fpd_fractions(fpd), "safra", pairs)


@register(
    "overlap_coverage",
    """SELECT (SELECT count(*) FROM b_fpd JOIN b_frac USING (safra)) AS comparadas, (SELECT count(*) FROM b_fpd) AS total_a,
       (SELECT count(*) FROM b_frac) AS total_b""",
)
def overlap_coverage(spark, sf_dir):
    fpd = fpd_table(spark, sf_dir)
    return reconcile.overlap_coverage(fpd, fpd_fractions(fpd), "safra")


KNOWN = ("rating principal@2", "rating over60_n@4", "rating contratos_n@3", "rating contratos_n@X")


@register(
    "regression_gate",
    f"""SELECT count(*) AS total, count(*) FILTER (WHERE status = 'pass') AS aprovados,
        count(*) FILTER (WHERE status <> 'pass') AS reprovados,
        count(*) FILTER (WHERE status <> 'pass' AND "check" || '@' || key IN {KNOWN}) AS conhecidos,
        count(*) FILTER (WHERE status <> 'pass' AND "check" || '@' || key NOT IN {KNOWN}) AS novos,
        CASE WHEN count(*) FILTER (WHERE status <> 'pass' AND "check" || '@' || key NOT IN {KNOWN}) = 0 THEN 'GREEN' ELSE 'RED' END
          AS resultado FROM b_check_rating""",
)
def regression_gate(spark, sf_dir):
    known = inline_table(spark, "check_name", [(k,) for k in KNOWN])
    return reconcile.regression_gate(rating_checks(spark, sf_dir), known)


@register(
    "regression_new_failures",
    f"""SELECT "check" || '@' || key AS nome, status FROM b_check_rating
        WHERE status <> 'pass' AND "check" || '@' || key NOT IN {KNOWN}""",
)
def regression_new_failures(spark, sf_dir):
    known = inline_table(spark, "check_name", [(k,) for k in KNOWN])
    return reconcile.new_failures(rating_checks(spark, sf_dir), known).select("nome", "status")


@register(
    "max_deviation",
    "SELECT kind, max(diff) AS max_diff FROM (SELECT * FROM b_check_fpd UNION ALL SELECT * FROM b_check_npv) GROUP BY kind",
)
def max_deviation(spark, sf_dir):
    return reconcile.max_deviation(fpd_checks(spark, sf_dir).unionByName(npv_checks(spark, sf_dir)))


# --- the audit of a whole run ----------------------------------------------

NPV_GOLDEN = (
    "(SELECT k, vpl_valor * CASE WHEN k = 'otimista@1.5' THEN 1.002e0 ELSE 1.0005e0 END AS vpl_valor "
    "FROM (SELECT k, vpl AS vpl_valor FROM b_npv_out))"
)
o.CTES["b_audit"] = " UNION ALL ".join(
    f"SELECT * FROM ({part})"
    for part in (
        "SELECT * FROM b_check_rating",
        "SELECT * FROM b_check_fpd",
        compare_sql(
            long_sql("b_bands_out", "faixa", BANDS, "faixas"),
            long_sql("(SELECT * FROM b_bands_out WHERE faixa <> '1 a 30 dias')", "faixa", BANDS, "faixas"),
        ),
        compare_sql(
            long_sql("(SELECT k, vpl AS vpl_valor FROM b_npv_out)", "k", {"vpl_valor": "rel"}, "npv"),
            long_sql(NPV_GOLDEN, "k", {"vpl_valor": "rel"}, "npv"),
        ),
        *[
            f"""SELECT 'curva {table}' AS "check", '' AS key, CAST(count(DISTINCT safra) AS DOUBLE) AS computed, 0.0e0 AS golden,
                CAST(count(DISTINCT safra) AS DOUBLE) AS diff, 0.0e0 AS tol, 'count' AS kind,
                CASE WHEN count(*) = 0 THEN 'pass' ELSE 'fail' END AS status
                FROM (SELECT safra, v, lag(v) OVER (PARTITION BY safra ORDER BY mob) AS antes
                      FROM (SELECT safra, mob, {o.r(value, 4)} AS v FROM b_curve)) WHERE v < antes - 1e-9"""
            for table, value in (("perda_acumulada", "p"), ("receita_acumulada", "r"))
        ],
    )
)


def audited_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit_checks(*audited_tables(spark, sf_dir))


def audited_tables(spark: SparkSession, sf_dir: str) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    """Tables of a real run, and golden tables that differ from them in known places."""
    bundle = portfolio_results(spark, sf_dir)
    names = ("rating", "faixas_atraso", "fpd_safras", "vpl_cenarios", "perda_acumulada", "receita_acumulada")
    bundle = {n: materialise(bundle[n], n) for n in names}
    safra, rate = F.col("safra"), F.when(F.col("taxa_am_pct") < 1.2, "1").otherwise("1.5")
    factor = F.when(F.concat_ws("@", "cenario", rate) == "otimista@1.5", 1.002).otherwise(1.0005)
    golden = {
        "rating": golden_rating(bundle["rating"]),
        "faixas_atraso": bundle["faixas_atraso"].where("faixa <> '1 a 30 dias'"),
        "fpd_safras": bundle["fpd_safras"]
        .where(~safra.like("%-12"))
        .withColumn("fpd_qtd_pct", F.col("fpd_qtd_pct") + F.when(safra.like("%-07"), 0.25).otherwise(0.0)),
        "vpl_cenarios": bundle["vpl_cenarios"].withColumn("vpl_valor", F.col("vpl_valor") * factor),
    }
    return bundle, golden


@register("audit_exported_run", "SELECT * FROM b_audit")
def audit_exported_run(spark, sf_dir):
    """The same audit of a bundle that was committed as text and read back."""
    bundle, golden = audited_tables(spark, sf_dir)
    folder = new_folder(spark, "exported")
    export_bundle(bundle, folder, "csv")
    return audit_folder(spark, folder, golden)


AUDIT_UF = {"contratos_n": "count", "principal": "money", "over60_n": "count"}
o.CTES["b_golden_detail"] = "SELECT * REPLACE (contratos_n + CASE WHEN uf LIKE '%_1' THEN 1 ELSE 0 END AS contratos_n) FROM b_uf WHERE uf <> 'NATION_2'"


@register("audit_lineage", compare_sql(long_sql("b_uf", "uf", AUDIT_UF, "linhagem uf"), long_sql("b_golden_detail", "uf", AUDIT_UF, "linhagem uf")))
def audit_lineage(spark, sf_dir):
    """Golden states against the loans themselves, with a state that is missing and one that is off."""
    loans = book.loans(spark, sf_dir, attributes=True)
    profile = export_rounded(portfolio.state_profile(loans)).where("uf <> 'NATION_2'")
    off = F.when(F.col("uf").like("%_1"), 1).otherwise(0)
    return lineage_checks(loans, {"uf": profile.withColumn("contratos_n", F.col("contratos_n") + off)})


@register(
    "compare_stages",
    f"""SELECT 'uf' AS tabela, {o.r('a')} AS total_a, {o.r('b')} AS total_b, {o.r('a / b', 4)} AS razao, comparadas, total_chaves_a, total_chaves_b
        FROM (SELECT sum(principal) AS a, count(*) AS total_chaves_a FROM b_golden_uf), (SELECT sum(principal) AS b, count(*) AS total_chaves_b FROM b_uf),
        (SELECT count(*) AS comparadas FROM b_uf JOIN b_golden_uf USING (uf))""",
)
def compare_stages(spark, sf_dir):
    detail = portfolio.state_profile(book.loans(spark, sf_dir, attributes=True))
    return round_columns(stage_comparison({"uf": golden_states(detail)}, {"uf": detail}), {"total_a": 2, "total_b": 2})


@register("audit_run", "SELECT * FROM b_audit")
def audit_run(spark, sf_dir):
    return audited_run(spark, sf_dir)


@register(
    "audit_summary",
    """SELECT count(*) AS total, count(*) FILTER (WHERE status = 'pass') AS aprovados, count(*) FILTER (WHERE status <> 'pass') AS reprovados,
       count(*) FILTER (WHERE status <> 'pass' AND "check" LIKE 'npv%') AS conhecidos,
       count(*) FILTER (WHERE status <> 'pass' AND "check" NOT LIKE 'npv%') AS novos,
       CASE WHEN count(*) FILTER (WHERE status <> 'pass' AND "check" NOT LIKE 'npv%') = 0 THEN 'GREEN' ELSE 'RED' END AS resultado
       FROM b_audit""",
)
def audit_summary_query(spark, sf_dir):
    known = inline_table(spark, "check_name", [("npv vpl_valor@otimista@1.5",)])
    return audit_summary(audited_run(spark, sf_dir), known)
