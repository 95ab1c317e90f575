from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from vintora.catalog import reconcile_queries
from vintora.operators import cohorts, reconcile as rc


def side(spark, rows):
    return spark.createDataFrame(rows, "check string, key string, value double, kind string")


def test_reconcile_statuses(spark):
    actual = side(
        spark,
        [
            ("a", "1", 10.0, "count"),
            ("a", "2", 10.0, "count"),
            ("m", "1", 100.0, "money"),
            ("m", "2", 100.0, "money"),
            ("n", "1", None, "money"),
            ("n", "2", None, "money"),
            ("n", "3", 1.0, "money"),
            ("r", "1", 1000.0, "rel"),
            ("r", "2", 1000.0, "rel"),
            ("z", "1", 0.0005, "rel"),
            ("p", "1", 23.84, "pct"),
            ("x", "1", 1.0, "count"),
        ],
    )
    golden = side(
        spark,
        [
            ("a", "1", 10.0, "count"),
            ("a", "2", 11.0, "count"),
            ("m", "1", 101.0, "money"),
            ("m", "2", 101.01, "money"),
            ("n", "1", None, "money"),
            ("n", "2", 1.0, "money"),
            ("n", "3", None, "money"),
            ("r", "1", 1001.0, "rel"),
            ("r", "2", 1002.0, "rel"),
            ("z", "1", 0.0, "rel"),
            ("p", "1", 23.85, "pct"),
            ("y", "1", 1.0, "count"),
        ],
    )
    got = {(r["check"], r["key"]): r["status"] for r in rc.reconcile(actual, golden).collect()}
    assert got == {
        ("a", "1"): "pass", ("a", "2"): "fail", ("m", "1"): "pass", ("m", "2"): "fail", ("n", "1"): "pass",
        ("n", "2"): "fail", ("n", "3"): "fail", ("r", "1"): "pass", ("r", "2"): "fail", ("z", "1"): "pass",
        ("p", "1"): "pass", ("x", "1"): "missing_golden", ("y", "1"): "missing_actual",
    }


def test_gate_is_green_with_known_failures_only(spark):
    checks = spark.createDataFrame(
        [("a", "1", "pass", 0.0, "count"), ("a", "2", "fail", 2.0, "count"), ("b", "", "missing_actual", None, "money")],
        "check string, key string, status string, diff double, kind string",
    )
    known = spark.createDataFrame([("a@2",), ("a@2",)], "check_name string")
    row = rc.regression_gate(checks, known).first()
    assert tuple(row) == (3, 1, 2, 1, 1, "RED")
    assert [r.nome for r in rc.new_failures(checks, known).collect()] == ["b@"]
    both = known.unionByName(spark.createDataFrame([("b@",)], "check_name string"))
    assert rc.regression_gate(checks, both).first().resultado == "GREEN"
    assert {r.kind: r.max_diff for r in rc.max_deviation(checks).collect()} == {"count": 2.0, "money": None}


def test_monotonic(spark):
    curve = spark.createDataFrame(
        [("2025-09", 1, 0.17431), ("2025-09", 2, 0.12872), ("2025-08", 1, 0.1), ("2025-08", 2, 0.1 - 1e-10), ("2025-08", 3, 0.2)],
        "safra string, mob int, fraction double",
    )
    assert [tuple(r) for r in rc.monotonic_curves(curve, "safra", "mob", "fraction").collect()] == [("2025-09", 1)]


def test_rollup(spark):
    parts = spark.createDataFrame([("A", 3, 10.0), ("B", 2, 22.0)], "r string, n int, p double")
    got = rc.rollup_consistency(parts, {"n": (F.sum("n"), F.lit(5)), "p": (F.sum("p"), F.lit(38.0))}, {"n": 0, "p": 5.0}, "rating")
    assert [(r["check"], r.diff, r.passed) for r in got.collect()] == [("rating n", 0.0, True), ("rating p", 6.0, False)]


def test_lineage_and_scale(spark):
    detail = spark.createDataFrame([("SP", 5, 100.0, 1), ("RJ", 2, 50.0, 0)], "uf string, contratos_n int, principal double, over60_n int")
    summary = spark.createDataFrame([("SP", 5, 1000.0), ("RJ", 3, 0.0), ("MG", 1, 1.0)], "uf string, contratos int, principal double")
    got = {r.uf: (r.confere, r.razao_principal) for r in rc.lineage_by_group(detail, summary, "uf").collect()}
    assert got == {"SP": (True, 0.1), "RJ": (False, None), "MG": (False, None)}  # groups on one side do not agree
    assert rc.stage_scale_ratio(summary, detail, "principal").first().razao == pytest.approx(6.6733)


def test_overlap(spark):
    pct = spark.createDataFrame([("a", 5.0), ("b", 2.0)], "safra string, fpd double")
    frac = spark.createDataFrame([("a", 0.0512), ("c", 0.1)], "safra string, f double")
    row = rc.overlap_compare(pct, frac, "safra", [("fpd", "f")]).first()
    assert tuple(row) == ("a", 5.0, 5.12, 0.12)
    assert tuple(rc.overlap_coverage(pct, frac, "safra").first()) == (1, 2, 2)


def test_cells_of_a_book_are_added_up_once_for_all_curves(spark, monkeypatch):
    calls, cells = [], cohorts.cohort_cells
    monkeypatch.setattr(cohorts, "cohort_cells", lambda *a: calls.append(a) or cells(*a))
    assert "incremento" in {r.curva for r in reconcile_queries.monotonic_curves(spark, "/root/testdata/sf0.001").collect()}
    assert len(calls) == 1
