"""What the physical plans of the heavy queries must and must not contain."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from vintora.catalog import book, queries
from vintora.catalog.queries import raw_book
from vintora.functions.numbers import exact_sum
from vintora.operators import cohorts, portfolio, quality, rolls
from vintora.session import row_bytes, size_shuffles
from vintora.sources.readers import norm_columns
from vintora.sources.normalise import dedup_loans, normalise_installments
from vintora.sources.workspace import materialise

SF = "/root/testdata/sf0.001"
P = book.PARAMS


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark):
    loans = materialise(book.loans(spark, SF, attributes=True), "loans")
    inst = materialise(book.installments(spark, SF), "inst")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield loans, inst
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def heavy(loans, inst):
    return {
        "cells": cohorts.cohort_cells(loans, inst, P),
        "fpd": cohorts.first_payment_default(loans, inst),
        "aging": rolls.aging_cells(loans, inst, P),
        "grid": rolls.contract_month_grid(loans, inst, P),
        "oldest": rolls.oldest_unpaid_due(loans, inst, P),
        "flow": portfolio.future_flow(loans, P),
        "cube": portfolio.loan_cube(loans),
        "cross": quality.dq_cross(loans, inst),
        "dedup": dedup_loans(loans),
        "matrix": portfolio.rating_matrix(loans),
    }


def test_no_nested_loops_no_python(stored):
    for name, df in heavy(*stored).items():
        text = plan(df)
        for bad in ("NestedLoop", "Cartesian", "PythonUDF", "EvalPython", "InPandas", "ExistingRDD"):
            assert bad not in text, (name, bad)


def exchanges(text: str) -> list[str]:
    return re.findall(r"Exchange (hashpartitioning\([^)]*\)|SinglePartition|rangepartitioning)", text)


def test_roll_timeline_uses_one_exchange_per_contract_side(stored):
    text = plan(rolls.aging_cells(*stored, P))
    by_contract = [e for e in exchanges(text) if re.fullmatch(r"hashpartitioning\(id_contrato#\d+, \d+\)", e)]
    assert len(by_contract) == 2  # the timeline and the loans; windows and join share them
    before = [e for e in exchanges(text) if "venc" in e]
    assert len(before) == 1  # instalments are added up before they are grouped by contract


def test_columns_and_filters_reach_the_scan(stored):
    loans, inst = stored
    text = plan(cohorts.first_payment_default(loans, inst))
    assert "EqualTo(num_parcela,1)" in text and "IsNotNull(data_vencimento)" in text
    reads = re.findall(r"ReadSchema: struct<([^>]*)>", text)
    assert not any("valor_pago" in r or "bhv_m" in r for r in reads)
    text = plan(portfolio.exposure_at_default(loans))
    assert re.findall(r"ReadSchema: struct<([^>]*)>", text) == ["pmt:double,num_parcelas:int,dias_maior_atraso:double"]


def test_profiles_take_their_total_from_one_column(stored):
    loans, _ = stored
    profiles = (portfolio.rating_profile(loans), portfolio.rating_matrix(loans), portfolio.segment_profile(loans), portfolio.cross_profile(loans, "canal"))
    for df in profiles:
        text = plan(df)
        assert "Window" not in text  # no cut is gathered in one task for its total
    assert "ReadSchema: struct<principal:double>" in plan(portfolio.rating_profile(loans))
    assert plan(portfolio.delinquency_bands(loans)).count("FileScan parquet") == 1


def test_a_run_reads_cuts_without_windows(spark, stored):
    cube = materialise(portfolio.loan_cube(stored[0]), "cube")
    total = portfolio.cube_total(cube)
    cut = lambda *keys: portfolio.cube_cut(cube, *keys)
    for df in (
        portfolio.rating_rows(cut("rating"), total),
        portfolio.segment_rows(cut("especie"), cut("profissao"), F.lit(True), total),
        portfolio.matrix_rows(cut("rating", "bhv"), total),
    ):
        assert "Window" not in plan(df)


def test_sums_do_not_depend_on_the_order_of_rows(spark):
    values = spark.range(20_000).selectExpr("cast(id as double) / 7 * if(id % 3 = 0, 1e6, 0.001) AS x")
    sums = {values.orderBy(F.rand(seed)).repartition(n).agg(exact_sum(F.col("x"))).first()[0] for seed, n in ((1, 1), (2, 7), (3, 13))}
    assert len(sums) == 1


def test_dedup_limits_groups_before_the_shuffle(stored):
    text = plan(dedup_loans(stored[0]))
    assert text.index("row_number(), 1, Final") < text.index("Exchange hashpartitioning(id_contrato") < text.index("row_number(), 1, Partial")


def test_id_presence_scans_each_input_once(stored):
    assert plan(quality.dq_cross(*stored)).count("FileScan parquet") == 2


def test_validation_scans(spark):
    raw = [materialise(df, "raw") for df in raw_book(spark, SF)]
    assert plan(quality.validate_book(spark, *raw, P)).count("FileScan parquet") == 6


def test_a_hot_contract_is_split_in_the_cohort_join(spark, stored):
    loans, inst = stored
    hot = inst.crossJoin(spark.range(40)).drop("id").withColumn("id_contrato", F.lit(loans.first().id_contrato))
    skewed = materialise(inst.unionByName(hot).repartition(16), "skewed")
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.shuffle.partitions": "8",
    }
    old = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        cells = cohorts.cohort_cells(loans, skewed, P)
        got = {(r.safra, r.mob): (r.loss_c, round(r.revenue, 2), r.observadas) for r in cells.collect()}
        assert "skew=true" in plan(cells)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    plain = {(r.safra, r.mob): (r.loss_c, round(r.revenue, 2), r.observadas) for r in cohorts.cohort_cells(loans, skewed, P).collect()}
    assert got == plain


def test_text_parsing_stays_in_generated_code(spark):
    raw = materialise(norm_columns(book.messy_installments(spark, SF)), "text")
    df = normalise_installments(raw)
    df.count()
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "Project" in text and "Python" not in text


def test_shuffle_sizing_only_grows(spark):
    current = int(spark.conf.get("spark.sql.shuffle.partitions"))
    try:
        assert size_shuffles(spark, 80) == current
        assert size_shuffles(spark, 8 * 10**12) == 8 * 10**12 // (128 * 1024 * 1024) + 1
        assert size_shuffles(spark, 8 * 10**16) == 100_000
        assert size_shuffles(spark, 8 * 10**13, limit=10**6) == 8 * 10**13 // (128 * 1024 * 1024) + 1
        same = spark.range(10**6).selectExpr("cast(1 as double) AS a", "cast('x' as string) AS b")
        stored = materialise(same, "same")  # compresses to a few bytes a row
        assert row_bytes(stored) == 24 * 10**6
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.initialPartitionNum")


def test_the_derived_book_is_stored_before_a_run(spark, monkeypatch):
    seen = {}

    def run(loans, inst, ids, p, store):
        seen.update(loans=loans, inst=inst)
        return {}

    monkeypatch.setattr(queries, "run_portfolio", run)
    queries.portfolio_results(spark, SF)
    for df in seen.values():
        assert "Join" not in plan(df) and df.count() > 0


def test_the_cube_computes_addends_before_it_multiplies_rows(stored):
    text = plan(portfolio.loan_cube(stored[0]))
    assert "Expand" in text and not re.search(r"sum\([^)]*cast\(", text)


def test_timeline_and_aging_run_without_lambdas_and_expand_sums(stored):
    text = plan(rolls.aging_cells(*stored, P))
    assert "lambda" not in text
    assert re.search(r"hashpartitioning\(mais_antiga#\d+, cal#\d+", text)
