"""Compare results with golden tables: keyed checks, lineage, curve shape, gate.

Both sides are long tables ``(check, key, value)``; golden rows also carry ``kind``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from vintora.functions.numbers import rounded

# Tolerance per kind of value; "rel" is relative to the golden value.
TOLERANCES = {"count": 0.0, "money": 1.0, "pct": 0.01, "rel": 0.001}
MONOTONIC_SLACK = 1e-9


def long_values(df: DataFrame, key: Column, measures: Mapping[str, str], check: str) -> DataFrame:
    """Stack measures of a keyed table to (check, key, value, kind)."""
    rows = [
        F.struct(
            F.lit(f"{check} {m}").alias("check"),
            key.cast("string").alias("key"),
            F.col(m).cast("double").alias("value"),
            F.lit(kind).alias("kind"),
        )
        for m, kind in measures.items()
    ]
    return df.select(F.inline(F.array(*rows)))


def reconcile(
    actual: DataFrame, golden: DataFrame, tolerances: Mapping[str, float] = TOLERANCES
) -> DataFrame:
    """Full keyed comparison; keys on one side only are reported, never skipped."""
    a = actual.select("check", "key", F.col("value").alias("computed"), F.col("kind").alias("_ka"), F.lit(True).alias("_a"))
    g = golden.select("check", "key", F.col("value").alias("golden"), F.col("kind").alias("_kg"), F.lit(True).alias("_g"))
    kind = F.coalesce("_kg", "_ka")
    tol = None
    for name, value in tolerances.items():
        tol = F.when(kind == name, value) if tol is None else tol.when(kind == name, value)
    gap = F.abs(F.col("computed") - F.col("golden"))
    size = F.abs(F.col("golden"))
    scaled = F.when(kind == "rel", gap / F.when(size == 0, 1.0).otherwise(size)).otherwise(gap)
    both_null = F.col("computed").isNull() & F.col("golden").isNull()
    status = (
        F.when(F.col("_a").isNull(), "missing_actual")
        .when(F.col("_g").isNull(), "missing_golden")
        .when(both_null, "pass")
        .when(F.col("diff") <= F.col("tol"), "pass")
        .otherwise("fail")
    )
    return (
        a.join(g, ["check", "key"], "full")
        .withColumns({"kind": kind, "tol": tol, "diff": rounded(scaled, 6)})
        .select("check", "key", "computed", "golden", "diff", "tol", "kind", status.alias("status"))
    )


def rollup_consistency(
    parts: DataFrame, sums: Mapping[str, tuple[Column, float]], tolerances: Mapping[str, float], check: str
) -> DataFrame:
    """Totals of a table against scalars; ``sums`` maps a name to (total, target column value)."""
    row = parts.agg(
        *[total.cast("double").alias(f"t_{name}") for name, (total, _) in sums.items()]
    )
    rows = [
        F.struct(
            F.lit(f"{check} {name}").alias("check"),
            F.col(f"t_{name}").alias("computed"),
            target.cast("double").alias("golden"),
            F.lit(float(tolerances[name])).alias("tol"),
        )
        for name, (_, target) in sums.items()
    ]
    gap = rounded(F.abs(F.col("computed") - F.col("golden")), 6)
    return row.select(F.inline(F.array(*rows))).select(
        "*", gap.alias("diff"), (gap <= F.col("tol")).alias("passed")
    )


def curve_drops(curves: DataFrame, key: str, order: str, value: str) -> DataFrame:
    """Points of a curve that lie below the previous point."""
    before = F.lag(value).over(Window.partitionBy(key).orderBy(order))
    return curves.withColumn("anterior", before).where(F.col(value) < F.col("anterior") - MONOTONIC_SLACK)


def monotonic_curves(curves: DataFrame, key: str, order: str, value: str) -> DataFrame:
    """Keys whose curve decreases somewhere, with the number of drops."""
    return curve_drops(curves, key, order, value).groupBy(key).agg(F.count(F.lit(1)).alias("quedas"))


def lineage_by_group(detail: DataFrame, summary: DataFrame, key: str) -> DataFrame:
    """Counts and principal of the detail roll-up against a summary table; groups on one side only do not agree."""
    d = detail.select(
        key, F.col("contratos_n").alias("detalhe_n"), F.col("principal").alias("detalhe_p"), F.col("over60_n").alias("detalhe_over60")
    )
    s = summary.select(key, F.col("contratos").alias("resumo_n"), F.col("principal").alias("resumo_p"))
    ratio = F.when(F.col("resumo_p") != 0, rounded(F.col("detalhe_p") / F.col("resumo_p"), 4))
    return d.join(s, key, "full").select(
        key,
        "detalhe_n",
        "resumo_n",
        F.coalesce(F.col("detalhe_n") == F.col("resumo_n"), F.lit(False)).alias("confere"),
        ratio.alias("razao_principal"),
        "detalhe_over60",
    )


def stage_scale_ratio(a: DataFrame, b: DataFrame, value: str) -> DataFrame:
    """Total of one stage over the total of the other; shows a factor of ten at once."""
    den = b.agg(F.sum(value).alias("t")).scalar()
    return a.agg(F.sum(value).alias("total_a")).withColumn("total_b", den).select(
        "total_a",
        "total_b",
        F.when(F.col("total_b") != 0, rounded(F.col("total_a") / F.col("total_b"), 4)).alias("razao"),
    )


def overlap_compare(percents: DataFrame, fractions: DataFrame, key: str, measures: Sequence[tuple[str, str]]) -> DataFrame:
    """Percent measures against fractions for keys on both sides."""
    pairs = percents.alias("a").join(fractions.alias("b"), key)
    cols = []
    for left, right in measures:
        other = rounded(F.col(f"b.{right}") * 100, 4)
        cols += [
            F.col(f"a.{left}").alias(left),
            other.alias(right),
            rounded(F.abs(F.col(f"a.{left}") - other), 4).alias(f"dif_{left}"),
        ]
    return pairs.select(key, *cols)


def overlap_coverage(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Keys compared and keys on each side."""
    sides = a.select(key, F.lit(1).alias("l"), F.lit(0).alias("r")).unionByName(
        b.select(key, F.lit(0).alias("l"), F.lit(1).alias("r"))
    )
    per_key = sides.groupBy(key).agg(F.max("l").alias("l"), F.max("r").alias("r"))
    return per_key.agg(
        F.count_if((F.col("l") == 1) & (F.col("r") == 1)).alias("comparadas"),
        F.count_if(F.col("l") == 1).alias("total_a"),
        F.count_if(F.col("r") == 1).alias("total_b"),
    )


def regression_gate(checks: DataFrame, known: DataFrame) -> DataFrame:
    """GREEN when every failing check is a known one."""
    allowed = known.select(F.col("check_name").alias("nome")).distinct().withColumn("conhecida", F.lit(True))
    named = checks.withColumn("nome", F.concat_ws("@", "check", "key"))
    failed = F.col("status") != "pass"
    excused = F.coalesce("conhecida", F.lit(False))
    new = F.count_if(failed & ~excused)
    return named.join(allowed, "nome", "left").agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(~failed).alias("aprovados"),
        F.count_if(failed).alias("reprovados"),
        F.count_if(failed & excused).alias("conhecidos"),
        new.alias("novos"),
        F.when(new == 0, "GREEN").otherwise("RED").alias("resultado"),
    )


def new_failures(checks: DataFrame, known: DataFrame) -> DataFrame:
    """Failing checks that are not on the allow-list."""
    named = checks.where("status <> 'pass'").withColumn("nome", F.concat_ws("@", "check", "key"))
    return named.join(known.select(F.col("check_name").alias("nome")), "nome", "left_anti")


def max_deviation(checks: DataFrame) -> DataFrame:
    """Largest difference per kind of value."""
    return checks.groupBy("kind").agg(F.max("diff").alias("max_diff"))
