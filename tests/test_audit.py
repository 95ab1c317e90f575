from __future__ import annotations

from vintora.plans.audit_run import audit_checks, audit_deviations, audit_summary


def test_audit_of_a_small_bundle(spark):
    curve = "safra string, mob int, perda_acum_pct double, receita_acum_pct double"
    curves = spark.createDataFrame([("2020-01", 1, 1.0, 1.0), ("2020-01", 2, 2.0, 0.5), ("2020-02", 1, 0.0, 3.0)], curve)
    rating = spark.createDataFrame([("A", 2, 100.0, 1), ("B", 1, 50.0, 0)], "rating string, contratos_n long, principal double, over60_n long")
    bundle = {"perda_acumulada": curves, "receita_acumulada": curves, "rating": rating}
    golden = {"rating": spark.createDataFrame([("A", 2, 100.9, 1), ("C", 1, 1.0, 0)], rating.schema)}
    checks = audit_checks(bundle, golden)
    got = {(r.check, r.key): r.status for r in checks.collect()}
    assert got["curva perda_acumulada", ""] == "pass" and got["curva receita_acumulada", ""] == "fail"
    assert {got[f"rating {m}", "A"] for m in ("contratos_n", "principal", "over60_n")} == {"pass"}
    assert got["rating principal", "B"] == "missing_golden" and got["rating principal", "C"] == "missing_actual"
    assert audit_summary(checks).first()["resultado"] == "RED"
    known = spark.createDataFrame([(f"{c}@{k}",) for (c, k), s in got.items() if s != "pass"], "check_name string")
    row = audit_summary(checks, known).first()
    assert (row["resultado"], row["novos"], row["total"]) == ("GREEN", 0, len(got))


def test_audit_covers_scalars_states_sums_and_tables(spark):
    curves = spark.createDataFrame([("2020-01", 1, 1.0, 1.0)], "safra string, mob int, perda_acum_pct double, receita_acum_pct double")
    profile = "string, contratos_n long, principal double, over60_n long"
    uf = spark.createDataFrame([("SP", 2, 100.0, 1), ("RJ", 1, 50.0, 0)], f"uf {profile}")
    rating = spark.createDataFrame([("A", 2, 100.0, 1)], f"rating {profile}")
    bands = spark.createDataFrame([("x", 3, 100.0, 100.0)], "faixa string, contratos_n long, pct_carteira double, acumulado double")
    long = "categoria string, chave string, valor string"
    kpis = [("kpi", "contratos", "3"), ("kpi", "principal_total", "150.00"), ("kpi", "safra_min", "2020-01"), ("over", "over60_n", "1")]
    pe = "parametro string, valor double"
    fpd = "safra string, fpd_qtd_pct double, fpd_val_pct double"
    bundle = {
        "perda_acumulada": curves,
        "receita_acumulada": curves,
        "uf": uf,
        "rating": rating,
        "faixas_atraso": bands,
        "kpis": spark.createDataFrame(kpis, long),
        "parametros_pe": spark.createDataFrame([("EAD Total", 10.0), ("PE = EAD", 5.0), ("PE %", 1.0)], pe),
        "fpd_safras": spark.createDataFrame([("2020-01", 1.0, 2.0)], fpd),
    }
    golden = {
        "uf": spark.createDataFrame([("SP", 2, 1000.0, 1), ("RJ", 1, 50.0, 0)], uf.schema),
        "kpis": spark.createDataFrame([("kpi", "contratos", "4"), ("kpi", "principal_total", "150.90"), ("kpi", "safra_min", "2020-02"), kpis[3]], long),
        "parametros_pe": spark.createDataFrame([("EAD Total", 12.0), ("PE = EAD", 5.5), ("PE %", 1.02)], pe),
        "faixas_atraso": bands,
        "fpd_safras": spark.createDataFrame([("2020-01", 1.25, 2.0)], fpd),
        "vpl_cenarios": bands,
        "outra": bands,
    }
    checks = audit_checks(bundle, golden).cache()
    bad = {(r.check, r.key): r.status for r in checks.where("status <> 'pass'").collect()}
    assert bad == {
        ("uf principal", "SP"): "fail",
        ("kpi valor", "kpi.contratos"): "fail",
        ("kpi valor", "kpi.safra_min"): "fail",
        ("pe valor", "EAD Total"): "fail",
        ("pe valor", "PE %"): "fail",
        ("fpd fpd_qtd_pct", "2020-01"): "fail",
        ("soma rating contratos_n", ""): "fail",
        ("soma rating principal", ""): "fail",
        ("tabela", "rating"): "missing_golden",
        ("tabela", "vpl_cenarios"): "missing_actual",
        ("tabela", "outra"): "fail",
    }
    good = {r.check for r in checks.where("status = 'pass'").collect()}
    assert {"soma uf contratos_n", "soma uf principal", "soma faixas_atraso contratos_n", "soma faixas_atraso acumulado"} <= good
    assert {r.kind: r.max_diff for r in audit_deviations(checks).collect()} == {"pct": 0.25}
    assert audit_summary(checks).first()["resultado"] == "RED"
