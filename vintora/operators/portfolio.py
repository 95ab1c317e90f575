"""Loan-only aggregates: KPIs, bands, profiles, matrices, due schedule, exposure."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from vintora.functions.calendar import int_range, months_diff, year_month
from vintora.functions.numbers import cents, exact, exact_sum, from_cents, pct, ratio, sum_cents
from vintora.operators.inline_tables import inline_table
from vintora.params import DELINQUENCY_BANDS, NO_BAND, NOT_INFORMED, TERM_BANDS, Params


def days_late() -> Column:
    return F.coalesce(F.col("dias_maior_atraso"), F.lit(0.0))


def n_over(days: int) -> Column:
    return F.count_if(days_late() > days)


def book_totals(loans: DataFrame) -> DataFrame:
    """One row with every whole-book figure, from a single scan.

    A caller that selects a few of them scans only the columns they need.
    """
    n, principal = F.count(F.lit(1)), sum_cents(F.col("principal"))
    known = F.when(F.col("safra") != NOT_INFORMED, F.col("safra"))
    known_day = F.when(F.col("safra") != NOT_INFORMED, F.col("data_aquisicao"))
    total = exact_sum(F.col("principal"))
    exposure = cents(F.col("pmt")) * F.col("num_parcelas")
    species = F.bool_or(F.col("especie_beneficio") != NOT_INFORMED)
    unrated = F.bool_or(F.col("rating_concessao") == NOT_INFORMED)
    return loans.agg(
        n.alias("contratos"),
        from_cents(principal).alias("principal_total"),
        ratio(from_cents(principal), n).alias("ticket_medio"),
        F.when(total > 0, exact_sum(F.col("taxa_cliente") * F.col("principal")) / total).otherwise(0.0).alias("taxa_media"),
        F.avg("num_parcelas").alias("prazo_medio"),
        *[n_over(d).alias(f"over{d}_n") for d in (30, 60, 90)],
        *[ratio(n_over(d), n).alias(f"over{d}_pct") for d in (30, 60, 90)],
        F.min(known).alias("safra_min"),
        F.max(known).alias("safra_max"),
        F.count_if(F.col("safra") == NOT_INFORMED).alias("safra_ni_n"),
        from_cents(F.coalesce(F.sum(exposure), F.lit(0))).alias("ead_total"),
        from_cents(F.coalesce(F.sum(F.when(days_late() > 60, exposure)), F.lit(0))).alias("ead_inadimplente"),
        F.max("num_parcelas").alias("max_prazo"),
        F.trunc(F.min(known_day), "MM").alias("primeiro_mes"),
        F.coalesce(species, F.lit(False)).alias("tem_especie"),
        (~F.coalesce(unrated, F.lit(False))).alias("todos_rated"),
    )


KPI_COLUMNS = (
    ("contratos", "principal_total", "ticket_medio", "taxa_media", "prazo_medio")
    + tuple(f"over{d}_n" for d in (30, 60, 90))
    + tuple(f"over{d}_pct" for d in (30, 60, 90))
    + ("safra_min", "safra_max", "safra_ni_n")
)


def kpi_row(totals: DataFrame, reneg_ids: DataFrame) -> DataFrame:
    renegotiated = reneg_ids.agg(F.count(F.lit(1)).alias("n"))
    return totals.select(*KPI_COLUMNS, renegotiated.scalar().alias("renegociacoes"))


def portfolio_kpis(loans: DataFrame, reneg_ids: DataFrame) -> DataFrame:
    """One row of headline figures; the vintage range ignores unknown vintages."""
    return kpi_row(book_totals(loans), reneg_ids)


def exposure_row(totals: DataFrame) -> DataFrame:
    return totals.select("ead_total", "ead_inadimplente")


def exposure_at_default(loans: DataFrame) -> DataFrame:
    """Instalment times term at origination, in total and for loans over 60 days late."""
    return exposure_row(book_totals(loans))


def all_rated_flag(loans: DataFrame) -> DataFrame:
    return book_totals(loans).select("todos_rated")


def _band(value: Column, bands) -> Column:
    """Ordinal of the band holding the value; null when it falls between two bands."""
    out = None
    for i, (_, lo, hi) in enumerate(bands):
        inside = value <= hi if lo is None else value >= lo if hi is None else value.between(lo, hi)
        out = F.when(inside, i) if out is None else out.when(inside, i)
    return out


# Key of a cut in the results, and the loan column behind it.
CUT_COLUMNS = {
    "rating": "rating_concessao",
    "bhv": "bhv_m",
    "uf": "uf",
    "especie": "especie_beneficio",
    "profissao": "profissao",
    "canal": "canal_originacao",
    "situacao": "situacao_beneficio",
    "safra": "safra",
}
CUT_KEYS = ("faixa_atraso", "faixa_prazo", *CUT_COLUMNS)


def cut_keys() -> dict[str, Column]:
    """Grouping expressions of the cuts, by the name they have in the results."""
    return {
        "faixa_atraso": _band(days_late(), DELINQUENCY_BANDS),
        "faixa_prazo": _band(F.col("num_parcelas"), TERM_BANDS),
    } | {k: F.col(c) for k, c in CUT_COLUMNS.items()}


# The cuts a whole run needs; the one without a key is the total.
CUTS = (
    (),
    ("faixa_atraso",),
    ("faixa_prazo",),
    ("rating",),
    ("rating", "bhv"),
    ("uf",),
    ("especie",),
    ("profissao",),
    ("especie", "situacao"),
    ("canal", "situacao"),
    ("safra",),
)


def _addends() -> dict[str, Column]:
    """What the measures add up, computed once a loan however many cuts it is counted in."""
    return {
        "_principal_c": cents(F.col("principal")),
        "_over60": days_late() > 60,
        "_over90": days_late() > 90,
        "_taxa_principal": exact(F.col("taxa_cliente") * F.col("principal")),
        "_peso": exact(F.col("principal")),
    }


def _measures() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("contratos_n"),
        F.coalesce(F.sum("_principal_c"), F.lit(0).cast("bigint")).alias("principal_c"),
        F.count_if(F.col("_over60")).alias("over60_n"),
        F.count_if(F.col("_over90")).alias("over90_n"),
        exact_sum(F.col("_taxa_principal")).alias("taxa_principal"),
        exact_sum(F.col("_peso")).alias("peso"),
    ]


def loan_cut(loans: DataFrame, *keys: str) -> DataFrame:
    """Counts and sums of one cut."""
    known = cut_keys()
    return _keyed(loans, {k: known[k] for k in keys}).groupBy(*keys).agg(*_measures())


def _keyed(loans: DataFrame, keys: dict[str, Column]) -> DataFrame:
    return loans.select(*[c.alias(n) for n, c in (keys | _addends()).items()])


def loan_cube(loans: DataFrame) -> DataFrame:
    """All cuts of a run from one scan, told apart by ``corte``."""
    sets = [[F.col(k) for k in cut] for cut in CUTS]
    return _keyed(loans, cut_keys()).groupingSets(sets, *CUT_KEYS).agg(F.grouping_id().alias("corte"), *_measures())


def cube_cut(cube: DataFrame, *keys: str) -> DataFrame:
    """The rows of one cut; the grouping id has a bit set for every key left out."""
    mask = sum(1 << i for i, k in enumerate(reversed(CUT_KEYS)) if k not in keys)
    return cube.where(F.col("corte") == mask).drop("corte", *[k for k in CUT_KEYS if k not in keys])


def cube_total(cube: DataFrame) -> Column:
    """Cents of principal of all loans, a scalar."""
    return cube_cut(cube).select("principal_c").scalar()


def principal_total(loans: DataFrame) -> Column:
    """As ``cube_total`` from the loans, of which it scans one column."""
    return loans.agg(sum_cents(F.col("principal")).alias("principal_c")).scalar()


def shares(cut: DataFrame, total: Column) -> DataFrame:
    """Adds money, share of the ``total`` and percentages to a cut."""
    return cut.withColumns(
        {
            "principal": from_cents(F.col("principal_c")),
            "part_pct": pct(F.col("principal_c"), total),
            "over60_pct": pct(F.col("over60_n"), F.col("contratos_n")),
            "over90_pct": pct(F.col("over90_n"), F.col("contratos_n")),
            "taxa_pond_pct": F.when(F.col("peso") > 0, F.col("taxa_principal") / F.col("peso")).otherwise(0.0) * 100,
        }
    )


def _all_bands(cut: DataFrame, key: str, bands) -> DataFrame:
    """Every band with its cut, zero where it is empty; values between bands come last.

    Loans in no band share a last row of their own, so counts always add up to all loans.
    """
    labels = inline_table(cut.sparkSession, f"{key}, faixa", [(i, b[0]) for i, b in enumerate(bands)])
    numbers = [c for c in cut.columns if c != key]
    return labels.join(cut, key, "full").na.fill(0, numbers).na.fill(NO_BAND, ["faixa"])


def delinquency_rows(cut: DataFrame) -> DataFrame:
    rows = _all_bands(cut, "faixa_atraso", DELINQUENCY_BANDS)
    n, everyone = F.col("contratos_n"), Window.partitionBy()
    order = Window.orderBy(F.col("faixa_atraso").asc_nulls_last())
    running = order.rowsBetween(Window.unboundedPreceding, 0)
    return rows.select(
        "faixa",
        "contratos_n",
        pct(n, F.sum(n).over(everyone)).alias("pct_carteira"),
        pct(F.sum(n).over(running), F.sum(n).over(everyone)).alias("acumulado"),
    )


def delinquency_bands(loans: DataFrame) -> DataFrame:
    """Five bands of days late, with share and cumulative share; all bands present, loans between bands last."""
    return delinquency_rows(loan_cut(loans, "faixa_atraso"))


def term_rows(cut: DataFrame) -> DataFrame:
    rows = _all_bands(cut, "faixa_prazo", TERM_BANDS)
    return rows.orderBy(F.col("faixa_prazo").asc_nulls_last()).select(
        "faixa",
        "contratos_n",
        from_cents(F.col("principal_c")).alias("principal"),
        "over60_n",
        pct(F.col("over60_n"), F.col("contratos_n")).alias("over60_pct"),
    )


def term_bands(loans: DataFrame) -> DataFrame:
    """Seven term bands with count, principal and over-60 share; all bands present, loans in none last."""
    return term_rows(loan_cut(loans, "faixa_prazo"))


PROFILE = ("contratos_n", "principal", "part_pct", "over60_n", "over60_pct")


def rating_rows(cut: DataFrame, total: Column) -> DataFrame:
    return (
        shares(cut, total)
        .select("rating", "contratos_n", "principal", "over60_n", "over60_pct", "taxa_pond_pct", "part_pct")
        .orderBy("rating")
    )


def rating_profile(loans: DataFrame) -> DataFrame:
    """Counts, over-60 share, principal-weighted rate and share by rating."""
    return rating_rows(loan_cut(loans, "rating"), principal_total(loans))


def profile_rows(cut: DataFrame, total: Column, *labels: str, extra: tuple[str, ...] = ()) -> DataFrame:
    """Counts and shares of a cut, largest principal first."""
    return shares(cut, total).select(*labels, *PROFILE, *extra).orderBy(F.desc("principal"), *labels)


def profile(loans: DataFrame, key: str) -> DataFrame:
    return profile_rows(loan_cut(loans, key), principal_total(loans), key)


def state_profile(loans: DataFrame) -> DataFrame:
    return profile(loans, "uf")


def segment_rows(species: DataFrame, professions: DataFrame, informed: Column, total: Column) -> DataFrame:
    """The species cut when any loan has one (``informed``, a scalar), else the profession cut."""

    def labelled(cut: DataFrame, key: str) -> DataFrame:
        return cut.select(F.lit(key).alias("rotulo"), F.col(key).alias("perfil"), *[c for c in cut.columns if c != key])

    chosen = labelled(species, "especie").where(informed).unionByName(labelled(professions, "profissao").where(~informed))
    return profile_rows(chosen, total, "rotulo", "perfil")


def segment_profile(loans: DataFrame) -> DataFrame:
    """Profile by benefit species when any loan has one, else by profession."""
    informed = loans.agg(F.coalesce(F.bool_or(F.col("especie_beneficio") != NOT_INFORMED), F.lit(False)).alias("i")).scalar()
    return segment_rows(loan_cut(loans, "especie"), loan_cut(loans, "profissao"), informed, principal_total(loans))


def cross_rows(cut: DataFrame, label: str, total: Column) -> DataFrame:
    return profile_rows(cut, total, label, "situacao", extra=("over90_pct",))


def cross_profile(loans: DataFrame, label: str) -> DataFrame:
    """Counts and shares by an attribute and the benefit status."""
    return cross_rows(loan_cut(loans, label, "situacao"), label, principal_total(loans))


MATRIX_MEASURES = ("contratos_n", "principal", "part_pct", "over60_n", "over60_pct")


def matrix_rows(cut: DataFrame, total: Column) -> DataFrame:
    """Every rating with every behaviour score, absent pairs filled with zero.

    The grid is the result itself: each rating with the list of scores, joined to the cut by both.
    """
    scores = cut.agg(F.array_sort(F.collect_set("bhv")).alias("notas")).scalar()
    grid = cut.select("rating").distinct().select("rating", F.explode(scores).alias("bhv"))
    cells = shares(cut, total).select("rating", "bhv", *MATRIX_MEASURES)
    return grid.join(cells, ["rating", "bhv"], "left").na.fill(0)


def rating_matrix(loans: DataFrame) -> DataFrame:
    return matrix_rows(loan_cut(loans, "rating", "bhv"), principal_total(loans))


def matrix_over60(matrix: DataFrame) -> DataFrame:
    return matrix.select("rating", "bhv", "contratos_n", "over60_n", "over60_pct")


def matrix_balance(matrix: DataFrame) -> DataFrame:
    return matrix.select("rating", "bhv", "principal", "part_pct")


def future_flow(loans: DataFrame, p: Params) -> DataFrame:
    """Instalments due after the snapshot: cents per vintage, month and month offset.

    Loans are first added up by vintage, term and whether their due day falls after the
    snapshot's day, the only thing the exact date decides. The groups are bounded by the
    calendar, so the explode never touches single loans, and it starts at the first
    instalment still due.
    """
    base, acquired = F.lit(p.snapshot), F.col("data_aquisicao")
    due_day = F.least(F.day(acquired), F.day(F.last_day(base)))
    terms = (
        loans.where(acquired.isNotNull())
        .groupBy(
            "safra",
            months_diff(acquired, base).alias("idade"),
            (due_day > F.day(base)).alias("depois"),
            "num_parcelas",
        )
        .agg(sum_cents(F.col("pmt")).alias("pmt_c"))
    )
    passed = F.col("idade") + F.when(F.col("depois"), 0).otherwise(1)
    first = F.greatest(F.lit(1), passed)
    offset = F.col("p") - F.col("idade")
    return (
        terms.select("*", F.explode(int_range(first, F.col("num_parcelas"))).alias("p"))
        .groupBy("safra", offset.alias("dp"))
        .agg(F.sum("pmt_c").alias("pmt_c"))
        .select("safra", year_month(F.add_months(F.trunc(base, "MM"), F.col("dp"))).alias("mes"), "dp", "pmt_c")
    )


def due_schedule(flow: DataFrame) -> DataFrame:
    return flow.groupBy("mes").agg(from_cents(F.sum("pmt_c")).alias("pmt_total")).orderBy("mes")


def future_due_schedule(loans: DataFrame, p: Params) -> DataFrame:
    """Total instalments still to come, per month."""
    return due_schedule(future_flow(loans, p))

