"""Vintage loss and revenue curves: realised part, group shapes and projection.

Inputs are vintage x MOB cells, whose number is bounded by the calendar.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from vintora.functions.calendar import int_range
from vintora.functions.numbers import from_cents
from vintora.operators.cohorts import mob_cells, observed_mob
from vintora.operators.inline_tables import inline_table
from vintora.params import RISK_GROUPS, Params


def vintage_months(cells: DataFrame, principals: DataFrame, totals: DataFrame, p: Params) -> DataFrame:
    """Vintage x MOB spine with monthly increments in % of principal, zero-filled.

    Runs to the longest term, or to the clean MOB when that is later. Vintages without
    principal have no percentages and are left out.
    """
    longest = F.coalesce(totals.select("max_prazo").scalar(), F.lit(0))
    vintages = observed_mob(cells, principals.where(F.col("principal_c") > 0), p)
    spine = vintages.withColumn("max_prazo", longest).withColumn(
        "mob", F.explode(int_range(F.lit(1), F.greatest("max_prazo", "mob_limpo")))
    )
    by_mob = Window.partitionBy("safra").orderBy("mob").rowsBetween(Window.unboundedPreceding, 0)
    loss = F.coalesce(F.col("loss_c"), F.lit(0))
    filled = spine.join(mob_cells(cells), ["safra", "mob"], "left").select(
        "safra",
        "mob",
        "principal_c",
        "mob_limpo",
        (F.col("mob") <= F.col("mob_limpo")).alias("limpo"),
        (F.col("mob") <= F.col("max_prazo")).alias("no_prazo"),
        (loss / F.col("principal_c") * 100).alias("inc_perda"),
        (F.coalesce(F.col("revenue"), F.lit(0.0)) / from_cents(F.col("principal_c")) * 100).alias("inc_receita"),
        (F.sum(loss).over(by_mob) / F.col("principal_c") * 100).alias("perda_acum"),
    )
    return filled.withColumn("sobrevivencia", survival(F.col("perda_acum"), p))


def survival(cumulative_loss_pct: Column, p: Params) -> Column:
    """Share of the vintage still performing, never below the shape floor."""
    return F.greatest(1 - cumulative_loss_pct / 100, F.lit(p.shape_floor))


def survival_factor(months: DataFrame) -> DataFrame:
    return months.where("limpo").select("safra", "mob", "perda_acum", "sobrevivencia")


def at_clean_mob(p: Params) -> Column:
    """The row of a mature vintage that holds its whole clean loss."""
    return (F.col("mob") == F.col("mob_limpo")) & (F.col("mob_limpo") >= p.mature_mob)


def realised_loss_final(months: DataFrame, p: Params) -> DataFrame:
    """Cumulative loss at the clean MOB of mature vintages."""
    return months.where(at_clean_mob(p)).select(
        "safra", "mob_limpo", F.col("perda_acum").alias("perda_realizada")
    )


def risk_groups(months: DataFrame, p: Params) -> DataFrame:
    """Risk group of every vintage and the groups whose shape it feeds.

    With three mature vintages or more the loss terciles split the mature ones and the
    rest are ``medio`` without feeding any shape. With fewer, every vintage is ``alto``
    and feeds all groups.
    """
    everyone = Window.partitionBy()
    loss, mature = F.col("perda_realizada"), F.col("perda_realizada").isNotNull()
    cuts = F.percentile("perda_realizada", F.array(*[F.lit(q) for q in p.group_quantiles]))
    by_loss = F.when(loss >= F.col("q")[1], "alto").when(loss >= F.col("q")[0], "medio").otherwise("baixo")
    enough = F.col("n") >= 3
    return (
        months.groupBy("safra", "principal_c", "mob_limpo")
        .agg(F.max(F.when(at_clean_mob(p), F.col("perda_acum"))).alias("perda_realizada"))
        .withColumns({"n": F.count("perda_realizada").over(everyone), "q": cuts.over(everyone)})
        .select(
            "safra",
            "principal_c",
            "mob_limpo",
            "perda_realizada",
            F.when(~enough, "alto").when(mature, by_loss).otherwise("medio").alias("grupo_risco"),
            F.when(~enough, F.array(*[F.lit(g) for g in RISK_GROUPS]))
            .when(mature, F.array(by_loss))
            .otherwise(F.array().cast("array<string>"))
            .alias("alimenta"),
        )
    )


def revenue_decay(groups: DataFrame, p: Params) -> DataFrame:
    """Monthly revenue decay per group from its mean realised loss against the book's."""
    overall = F.avg("perda_realizada").over(Window.partitionBy())
    means = (
        groups.withColumn("geral", overall)
        .select(F.explode("alimenta").alias("grupo"), "perda_realizada", "geral")
        .groupBy("grupo")
        .agg(F.avg("perda_realizada").alias("media"), F.max("geral").alias("geral"))
    )
    base = F.lit(p.revenue_decay_base)
    relative = F.when(F.col("geral") > 0, F.col("media") / F.col("geral")).otherwise(1.0)
    return (
        inline_table(groups.sparkSession, "grupo", [(g,) for g in RISK_GROUPS])
        .join(means, "grupo", "left")
        .select(
            "grupo",
            F.when(F.col("media").isNull(), base)
            .otherwise(F.pow(base, F.pow(relative, F.lit(p.revenue_decay_power))))
            .alias("decay_receita"),
        )
    )


def group_shape_raw(months: DataFrame, groups: DataFrame, totals: DataFrame, p: Params) -> DataFrame:
    """Typical monthly increment per group and MOB over vintages with that MOB clean.

    Median, or the mean when the median is not positive, or the floor when neither is;
    null where no vintage reaches the MOB.
    """
    spark = months.sparkSession
    longest = F.coalesce(totals.select("max_prazo").scalar(), F.lit(0))
    fed = groups.select("safra", F.explode("alimenta").alias("grupo"))
    typical = (
        months.where("limpo")
        .join(fed, "safra")
        .withColumn("inc_sobrevivente", F.col("inc_receita") * F.col("sobrevivencia"))
        .groupBy("grupo", "mob")
        .agg(*[
            agg(c).alias(f"{name}_{kind}")
            for kind, c in (("perda", "inc_perda"), ("receita", "inc_sobrevivente"))
            for name, agg in (("mediana", F.median), ("media", F.avg))
        ])
    )

    def pick(kind: str) -> Column:
        median, mean = F.col(f"mediana_{kind}"), F.col(f"media_{kind}")
        return F.when(median > 0, median).when(mean > 0, mean).when(median.isNotNull(), p.shape_floor)

    spine = inline_table(spark, "grupo", [(g,) for g in RISK_GROUPS]).select(
        "grupo", F.explode(int_range(F.lit(1), longest)).alias("mob")
    )
    return spine.join(typical, ["grupo", "mob"], "left").select(
        "grupo", "mob", pick("perda").alias("perda"), pick("receita").alias("receita")
    )


def shape_decay_fill(raw: DataFrame, decay: DataFrame, p: Params) -> DataFrame:
    """Replace missing or floor increments by the last real one decayed per month.

    Written in closed form: the last increment above the floor times the decay to the
    number of months since, never below the floor.
    """
    seen = Window.partitionBy("grupo").orderBy("mob").rowsBetween(Window.unboundedPreceding, 0)
    floor = F.lit(p.shape_floor)

    def filled(kind: str, rate: Column) -> Column:
        real = F.col(kind) > floor
        value = F.last(F.when(real, F.col(kind)), ignorenulls=True).over(seen)
        since = F.col("mob") - F.last(F.when(real, F.col("mob")), ignorenulls=True).over(seen)
        decayed = F.when(since == 0, value).otherwise(F.greatest(value * F.pow(rate, since), floor))
        return F.coalesce(decayed, floor)

    return raw.join(decay, "grupo").select(
        "grupo",
        "mob",
        filled("perda", F.lit(p.loss_decay)).alias("perda"),
        filled("receita", F.col("decay_receita")).alias("receita"),
    )


def group_shapes(months: DataFrame, groups: DataFrame, totals: DataFrame, p: Params) -> DataFrame:
    return shape_decay_fill(group_shape_raw(months, groups, totals, p), revenue_decay(groups, p), p)


def with_shape(months: DataFrame, groups: DataFrame, shapes: DataFrame) -> DataFrame:
    shape = shapes.select(
        F.col("grupo").alias("grupo_risco"), "mob", F.col("perda").alias("forma_perda"), F.col("receita").alias("forma_receita")
    )
    return months.join(groups.select("safra", "grupo_risco"), "safra").join(shape, ["grupo_risco", "mob"], "left")


def scale_columns(total: Callable[[Column], Column], p: Params) -> dict[str, Column]:
    """Realised over shape up to the clean MOB, floored; 1 for young vintages.

    ``total`` sums over the clean months of a vintage.
    """

    def scale(realised: Column, shape: str) -> Column:
        base = total(F.when(F.col("limpo"), F.coalesce(F.col(shape), F.lit(0.0))))
        fitted = F.when(base > 0, total(F.when(F.col("limpo"), realised)) / base).otherwise(1.0)
        return F.greatest(F.when(F.col("mob_limpo") >= p.scale_mob, fitted).otherwise(1.0), F.lit(p.scale_floor))

    return {
        "escala_perda": scale(F.col("inc_perda"), "forma_perda"),
        "escala_receita": scale(F.col("inc_receita") * F.col("sobrevivencia"), "forma_receita"),
    }


def vintage_scale(shaped: DataFrame, p: Params) -> DataFrame:
    scales = scale_columns(F.sum, p)
    return shaped.groupBy("safra", "mob_limpo").agg(*[c.alias(n) for n, c in scales.items()]).drop("mob_limpo")


def project_curves(months: DataFrame, groups: DataFrame, shapes: DataFrame, p: Params) -> DataFrame:
    """Cumulative loss and revenue per vintage and MOB, realised then projected."""
    floor = F.lit(p.shape_floor)
    loss = F.greatest(F.coalesce(F.col("forma_perda"), floor) * F.col("escala_perda"), floor)
    revenue = F.greatest(
        F.coalesce(F.col("forma_receita"), floor) * F.col("escala_receita"), F.lit(p.revenue_floor)
    )
    vintage = Window.partitionBy("safra")
    by_mob = vintage.orderBy("mob").rowsBetween(Window.unboundedPreceding, 0)
    return (
        with_shape(months, groups, shapes)
        .withColumns(scale_columns(lambda c: F.sum(c).over(vintage), p))
        .where("no_prazo")
        .select(
            "safra",
            "mob",
            F.sum(F.when(F.col("limpo"), F.col("inc_perda")).otherwise(loss)).over(by_mob).alias("perda_acum_pct"),
            F.sum(F.when(F.col("limpo"), F.col("inc_receita")).otherwise(revenue)).over(by_mob).alias("receita_acum_pct"),
            F.when(F.col("limpo"), "realizado").otherwise("projetado").alias("tipo"),
            "principal_c",
            "mob_limpo",
            "grupo_risco",
            "escala_perda",
        )
    )


def loss_curve(curves: DataFrame) -> DataFrame:
    return curves.select("safra", "mob", "perda_acum_pct", "tipo")


def revenue_curve(curves: DataFrame) -> DataFrame:
    return curves.select("safra", "mob", "receita_acum_pct", "tipo")


def vintage_summary(curves: DataFrame, decay: DataFrame) -> DataFrame:
    """One row per vintage: size, clean MOB, group, scale, decay and final values."""
    last = curves.groupBy("safra", "principal_c", "mob_limpo", "grupo_risco", "escala_perda").agg(
        F.max_by("perda_acum_pct", "mob").alias("perda_acum_final_pct"),
        F.max_by("receita_acum_pct", "mob").alias("receita_acum_final_pct"),
    )
    return last.join(decay, F.col("grupo_risco") == F.col("grupo")).select(
        "safra",
        from_cents(F.col("principal_c")).alias("principal"),
        F.col("mob_limpo").alias("max_mob_limpo"),
        "grupo_risco",
        "escala_perda",
        "decay_receita",
        "perda_acum_final_pct",
        "receita_acum_final_pct",
    )
