"""Probability of default, scenario NPV, expected loss and the long KPI table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from vintora.functions.numbers import from_cents, pct, ratio
from vintora.operators.portfolio import loan_cut
from vintora.params import Params


def default_rows(cut: DataFrame) -> DataFrame:
    return cut.select("safra", ratio(F.col("over60_n"), F.col("contratos_n")).alias("pd"))


def pd_by_vintage(loans: DataFrame) -> DataFrame:
    """Share of contracts over 60 days late per vintage, unknown vintage included."""
    return default_rows(loan_cut(loans, "safra"))


def lgd(ltm: DataFrame) -> Column:
    """Loss given default: LTM mean of the over-90 chain, as a scalar subquery."""
    return ltm.select("effic90").scalar()


def future_cashflow_by_vintage(flow: DataFrame) -> DataFrame:
    return flow.select("safra", "dp", from_cents(F.col("pmt_c")).alias("pmt_sum"))


def risky_flow(flow: DataFrame, default_rates: DataFrame, ltm: DataFrame) -> DataFrame:
    """Future flow with the loss share of its vintage."""
    return (
        future_cashflow_by_vintage(flow)
        .join(default_rates, "safra", "left")
        .withColumn("perda_pct", F.coalesce(F.col("pd"), F.lit(0.0)) * lgd(ltm))
    )


def npv_grid(flow: DataFrame, default_rates: DataFrame, ltm: DataFrame, principal: Column, p: Params) -> DataFrame:
    """Present value of the net future flow for every discount rate and stress."""
    scenarios = F.array(
        *[
            F.struct(F.lit(r).alias("taxa"), F.lit(name).alias("cenario"), F.lit(f).alias("fator"))
            for r in p.npv_rates
            for name, f in p.npv_stress
        ]
    )
    value = F.col("pmt_sum") * (1 - F.col("perda_pct") * F.col("fator")) / F.pow(1 + F.col("taxa"), F.col("dp"))
    return (
        risky_flow(flow, default_rates, ltm)
        .select("pmt_sum", "perda_pct", "dp", F.inline(scenarios))
        .groupBy("taxa", "cenario")
        .agg(F.sum(value).alias("vpl_valor"))
        .withColumn("total", principal)
        .select(
            (F.col("taxa") * 100).alias("taxa_am_pct"),
            "cenario",
            "vpl_valor",
            F.when(F.col("total") > 0, F.col("vpl_valor") / F.col("total") * 100).otherwise(0.0).alias("vpl_pct_principal"),
        )
    )


def net_future_flow(flow: DataFrame, default_rates: DataFrame, ltm: DataFrame) -> DataFrame:
    """Gross future instalments, their expected loss and the difference."""
    sums = risky_flow(flow, default_rates, ltm).agg(
        F.coalesce(F.sum("pmt_sum"), F.lit(0.0)).alias("pmt_bruto_futuro"),
        F.coalesce(F.sum(F.col("pmt_sum") * F.col("perda_pct")), F.lit(0.0)).alias("perda_estimada"),
    )
    return sums.withColumn("fluxo_liquido", F.col("pmt_bruto_futuro") - F.col("perda_estimada"))


def expected_loss_row(kpis: DataFrame, ead: DataFrame, ltm: DataFrame) -> DataFrame:
    """One row of PD, EAD, LGD and PE."""
    return (
        ead.withColumn("pd", kpis.select("over60_pct").scalar())
        .withColumn("principal_total", kpis.select("principal_total").scalar())
        .withColumn("lgd", lgd(ltm))
        .withColumn("pe", F.col("ead_total") * F.col("pd") * F.col("lgd"))
        .withColumn("pe_pct", pct(F.col("pe"), F.col("principal_total")))
    )


def expected_loss(kpis: DataFrame, ead: DataFrame, ltm: DataFrame) -> DataFrame:
    """Six parameters of the expected loss with unit and definition."""
    # Labels, units and definitions of the parameter table.
    rows = (
        ("PD (over60 em quantidade)", F.col("pd") * 100, 2, "%", "n_over60 / n_total — em quantidade de contratos"),
        ("EAD Total", F.col("ead_total"), 2, "R$", "PMT × prazo_original, medido no momento zero da concessão"),
        (
            "EAD Inadimplente (over60)",
            F.col("ead_inadimplente"),
            2,
            "R$",
            "EAD dos contratos com dias_maior_atraso > 60, calculado como PMT × prazo_original",
        ),
        (
            "LGD = Effic 90 LTM",
            F.col("lgd") * 100,
            4,
            "%",
            "Produto encadeado rolagens 61-90d a >180d, média LTM 12 meses",
        ),
        (
            "PE = EAD_total × PD × LGD",
            F.col("pe"),
            2,
            "R$",
            "Perda Esperada = EAD Total × Probabilidade de Default (PD) × Loss Given Default (LGD)",
        ),
        ("PE % do principal", F.col("pe_pct"), 2, "%", "PE / principal originado total"),
    )
    table = F.array(
        *[
            F.struct(
                F.lit(label).alias("parametro"),
                F.round(value.cast("decimal(38,10)"), decimals).cast("double").alias("valor"),
                F.lit(unit).alias("unidade"),
                F.lit(text).alias("definicao"),
            )
            for label, value, decimals, unit, text in rows
        ]
    )
    return expected_loss_row(kpis, ead, ltm).select(F.inline(table))


def _text(value: Column, decimals: int) -> Column:
    """Number as text with a fixed number of decimals."""
    return F.round(value.cast("decimal(38,10)"), decimals).cast(f"decimal(38,{decimals})").cast("string")


def _long(df: DataFrame, category: str, values: dict[str, Column]) -> DataFrame:
    rows = [
        F.struct(F.lit(category).alias("categoria"), F.lit(k).alias("chave"), v.cast("string").alias("valor"))
        for k, v in values.items()
    ]
    return df.select(F.inline(F.array(*rows)))


def kpi_long(
    kpis: DataFrame, meta: DataFrame, ltm: DataFrame, ead: DataFrame, npv: DataFrame, net_flow: DataFrame
) -> DataFrame:
    """All scalar results as (categoria, chave, valor) text rows."""
    col = F.col
    pe = expected_loss_row(kpis, ead, ltm)
    parts = [
        _long(meta, "meta", {c: col(c) for c in ("nome_cliente", "data_base", "analista", "produto")}),
        _long(
            kpis,
            "kpi",
            {
                "contratos": col("contratos"),
                "principal_total": _text(col("principal_total"), 2),
                "ticket_medio": _text(col("ticket_medio"), 2),
                "taxa_media_pct": _text(col("taxa_media") * 100, 4),
                "prazo_medio": _text(col("prazo_medio"), 1),
                "safra_min": col("safra_min"),
                "safra_max": col("safra_max"),
                "renegociacoes": col("renegociacoes"),
            },
        ),
        _long(
            kpis,
            "over",
            {f"over{d}_n": col(f"over{d}_n") for d in (30, 60, 90)}
            | {f"over{d}_pct": _text(col(f"over{d}_pct") * 100, 2) for d in (30, 60, 90)},
        ),
        _long(
            ltm,
            "effic",
            {
                "effic60_ltm_pct": _text(col("effic60") * 100, 4),
                "effic90_ltm_pct": _text(col("effic90") * 100, 4),
                "lgd_pct": _text(col("effic90") * 100, 4),
            },
        ),
        _long(ead, "ead", {c: _text(col(c), 2) for c in ("ead_total", "ead_inadimplente")}),
        _long(
            pe,
            "pe",
            {
                "pd_pct": _text(col("pd") * 100, 2),
                "lgd_pct": _text(col("lgd") * 100, 4),
                "pe_valor": _text(col("pe"), 2),
                "pe_pct_principal": _text(col("pe_pct"), 2),
            },
        ),
        _long(
            net_flow,
            "vpl",
            {c: _text(col(c), 2) for c in ("pmt_bruto_futuro", "perda_estimada", "fluxo_liquido")},
        ),
        _npv_long(npv),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _npv_long(npv: DataFrame) -> DataFrame:
    rate = F.format_string("%04d", F.rint(F.col("taxa_am_pct") * 10).cast("int"))
    key = F.concat(F.lit("vpl_"), F.col("cenario"), F.lit("_taxa"), rate)
    rows = [
        F.struct(F.lit("vpl").alias("categoria"), F.concat(key, F.lit(f"_{suffix}")).alias("chave"), _text(F.col(c), 2).alias("valor"))
        for suffix, c in (("valor", "vpl_valor"), ("pct", "vpl_pct_principal"))
    ]
    return npv.select(F.inline(F.array(*rows)))


def run_metadata(totals: DataFrame, ltm: DataFrame, p: Params) -> DataFrame:
    """Facts about the run: rating completeness, profile used, efficiencies, rates."""
    facts = totals.select(
        F.initcap(F.col("todos_rated").cast("string")).alias("rated"),
        F.when(F.col("tem_especie"), "especie_beneficio").otherwise("profissao").alias("coluna"),
        F.when(F.col("tem_especie"), "especie").otherwise("profissao").alias("rotulo"),
        *[ltm.select(e).scalar().alias(e) for e in ("effic60", "effic90")],
    )
    values = {
        "todos_rated": F.col("rated"),
        "col_perfil_usada": F.col("coluna"),
        "label_perfil": F.col("rotulo"),
        "effic60_ltm_pct": _text(F.col("effic60") * 100, 4),
        "effic90_ltm_pct": _text(F.col("effic90") * 100, 4),
    } | {f"taxa_vpl_{i + 1}": _text(F.lit(r * 100), 2) for i, r in enumerate(p.npv_rates)}
    rows = [F.struct(F.lit(k).alias("chave"), v.alias("valor")) for k, v in values.items()]
    return facts.select(F.inline(F.array(*rows)))
