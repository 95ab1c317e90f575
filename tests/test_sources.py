from __future__ import annotations

import os
import re

import pytest
from pyspark.sql import functions as F

from vintora.functions import parsing
from vintora.operators import quality
from vintora.operators.quality import dq_malformed_lines
from vintora.sources import layouts, normalise, readers, sinks
from vintora.sources.layouts import INSTALLMENTS
from vintora.sources.sinks import mark_columns
from vintora.sources.workspace import NoSharedFolder, hadoop_path, materialise, new_folder, run_scratch, scratch_root, together


def write(path, *lines):
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")
    return str(path)


def test_headers_are_trimmed_lower_case_and_in_order(spark):
    df = spark.createDataFrame([(1, 2, 3)], ["  ID_Contrato  ", "\tprincipal\n", "PMT"])
    assert readers.norm_columns(df).columns == ["id_contrato", "principal", "pmt"]


def test_id_alias_only_without_an_id(spark):
    df = spark.createDataFrame([(1, 2)], ["unique id", "[srm] codigo operacao"])
    assert readers.norm_id_alias(df).columns == ["id_contrato", "[srm] codigo operacao"]
    both = spark.createDataFrame([(1, 2)], ["unique id", "id_contrato"])
    assert readers.norm_id_alias(both).columns == ["unique id", "id_contrato"]


def test_malformed_lines_are_dropped_whatever_is_selected(spark, tmp_path):
    path = write(tmp_path / "LOANS.csv", "Unique ID;PMT;Principal", "1;2;3", "4;5", "6;7;8;9", "10;;12")
    df = readers.read_loans(spark, path)
    assert df.columns == ["id_contrato", "pmt", "principal"]
    assert df.count() == 2 and df.select("pmt").count() == 2
    assert [tuple(r) for r in df.orderBy("id_contrato").collect()] == [("1", "2", "3"), ("10", None, "12")]


def test_quoted_values_and_counted_malformed_lines(spark, tmp_path):
    lines = ["a;b;c", '1;"a ""q"" ; b";10', "2;plain;20", "3;short", '4;"it\\";30', '5;"x ""y""";50', "6;a;b;c"]
    path = write(tmp_path / "t.csv", *lines)
    got = sorted(tuple(r) for r in readers.read_text_table(spark, path).collect())
    assert got == [("1", 'a "q" ; b', "10"), ("2", "plain", "20"), ("4", "it\\", "30"), ("5", 'x "y"', "50")]
    found = dq_malformed_lines(readers.read_text_lines(spark, path), layouts.LOANS, max_share=0.5).first()
    assert (found["n_bad"], found["n_total"], found["severity"]) == (2, 6, "aviso")
    assert dq_malformed_lines(readers.read_text_lines(spark, path), layouts.LOANS).first()["severity"] == "erro"


def test_wrong_separator_is_an_error(spark, tmp_path):
    path = write(tmp_path / "LOANS.csv", "id_contrato,principal,pmt", "1,2,3")
    with pytest.raises(normalise.MissingColumns):
        normalise.normalise_loans(readers.read_loans(spark, path))


def test_missing_renegotiations_are_none(spark, tmp_path):
    df = readers.read_renegotiations(spark, str(tmp_path / "none.csv"))
    assert readers.renegotiated_ids(df).count() == 0
    assert df.columns == list(layouts.RENEGOTIATIONS.columns)


def test_renegotiated_ids_are_distinct_trimmed_not_null(spark):
    df = spark.createDataFrame([(" 1 ",), ("1",), (None,), ("2",)], "id_contrato_origem string")
    assert sorted(r[0] for r in readers.renegotiated_ids(df).collect()) == ["1", "2"]


def test_meta_precedence(spark, tmp_path):
    path = write(tmp_path / "META.csv", "Nome_Cliente;data_base", " Banco ;2026-05-31")
    row = readers.portfolio_meta(spark, path).first()
    assert tuple(row) == ("Banco", "2026-05", "N/I", "Crédito")
    row = readers.portfolio_meta(spark, path, client="Outro", snapshot="2025-01-31").first()
    assert tuple(row)[:2] == ("Outro", "2025-01")
    row = readers.portfolio_meta(spark, str(tmp_path / "none.csv")).first()
    assert tuple(row) == ("Cliente", "", "N/I", "Crédito")


def test_table_profile(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    got = {r["dataset"]: tuple(r)[1:] for r in readers.table_profile({"x": df, "y": df.where("a > 1"), "z": None}).collect()}
    assert got == {"x": (1, 2, "ok"), "y": (0, 2, "vazio"), "z": (0, 0, "ausente")}


def test_normalise_loans_with_missing_columns(spark):
    raw = spark.createDataFrame(
        [(" 7 ", "1.000,50", "12", "1,5", None, "nan", "SP"), ("8", "x", None, None, "15/02/2024", "B", None)],
        "id_contrato string, principal string, num_parcelas string, taxa_cliente string, data_aquisicao string, "
        "rating_concessao string, regiao string",
    ).selectExpr("*", "cast(null as string) AS pmt", "cast(null as string) AS dias_maior_atraso")
    a, b = normalise.normalise_loans(raw).orderBy("id_contrato").collect()
    assert (a.id_contrato, a.principal, a.pmt, a.num_parcelas, a.taxa_cliente) == ("7", 1000.5, 0.0, 12, 0.015)
    assert (a.safra, a.rating_concessao, a.uf, a.profissao, a.dias_maior_atraso) == ("N/I", "N/I", "SP", "N/I", 0.0)
    assert (b.principal, b.num_parcelas, b.safra, b.rating_concessao, b.uf) == (0.0, 0, "2024-02", "B", "N/I")


def test_installments_keep_null_and_zero_garbage(spark):
    raw = spark.createDataFrame(
        [("1", None, "x", "", "3,7"), ("1", "10", None, "nan", None)],
        "id_contrato string, valor_parcela string, valor_pago string, data_pagamento string, num_parcela string",
    ).selectExpr("*", "'p' AS id_parcela", "cast(null as string) AS data_vencimento", "'0' AS dias_atraso")
    a, b = normalise.normalise_installments(raw).collect()
    assert (a.valor_parcela, a.valor_pago, a.data_pagamento, a.num_parcela) == (None, 0.0, None, 4)
    assert (b.valor_parcela, b.valor_pago, b.num_parcela) == (10.0, None, None)


def test_dedup_keeps_latest_and_every_row_without_id(spark):
    rows = [("1", 5.0, "2020-01-01"), ("1", 9.0, "2021-01-01"), ("1", 7.0, "2021-01-01"), (None, 1.0, None), (None, 1.0, None)]
    df = spark.createDataFrame(rows, "id_contrato string, principal double, d string").withColumn(
        "data_aquisicao", F.col("d").cast("date")
    ).drop("d")
    got = sorted((r.id_contrato or "", r.principal) for r in normalise.dedup_loans(df).collect())
    assert got == [("", 1.0), ("", 1.0), ("1", 9.0)]
    chosen = normalise.dedup_loans(df, order=[F.col("principal")]).where("id_contrato = '1'").first()
    assert chosen.principal == 5.0


def test_cleaning_report(spark):
    raw = spark.createDataFrame([("1", "x"), ("a", None), (None, "2020-01-01"), ("2,5", "")], "v string, d string")
    got = {r.coluna: (r.nulos, r.rejeitados, r.linhas) for r in normalise.cleaning_report(raw, "T", ["v"], ["d"]).collect()}
    assert got == {"v": (1, 1, 4), "d": (1, 1, 4)}


def test_stage_is_reused_and_unfinished_copies_are_rewritten(spark, tmp_path):
    header = "id_contrato;id_parcela;num_parcela;data_vencimento;data_pagamento;valor_parcela;valor_pago;dias_atraso"
    src = write(tmp_path / "INSTALLMENTS.csv", header, "1;a;1;15/01/2024;;1.000,00;;45")
    dst = str(tmp_path / "inst.parquet")
    first = sinks.stage_installments(spark, src, dst)
    assert first.count() == 1 and first.first().valor_parcela == 1000.0
    marked = os.stat(os.path.join(dst, sinks.STAGED)).st_mtime_ns
    assert sinks.stage_installments(spark, src, dst).count() == 1
    assert os.stat(os.path.join(dst, sinks.STAGED)).st_mtime_ns == marked
    write(tmp_path / "INSTALLMENTS.csv", header, "1;a;1;15/01/2024;;1;;0", "2;b;1;15/01/2024;;1;;0")
    assert sinks.stage_installments(spark, src, dst).count() == 2
    with pytest.raises(normalise.MissingColumns):
        sinks.stage_installments(spark, src, dst, sep=",")
    os.remove(os.path.join(dst, sinks.STAGED))
    assert sinks.stage_installments(spark, src, dst).count() == 2
    assert sinks.text_bytes(spark, src, str(tmp_path / "none.csv")) == os.path.getsize(src)


def test_write_result_replaces_old_tables_by_empty_ones(spark, tmp_path):
    df = spark.createDataFrame([(1, "ação")], "n int, t string")
    assert sinks.write_result(df, str(tmp_path / "a"), "csv")
    assert readers.read_text_table(spark, str(tmp_path / "a")).collect()[0].t == "ação"
    assert sinks.write_result(df, str(tmp_path / "b"))
    assert not sinks.write_result(df.where("n > 1"), str(tmp_path / "b"))
    assert spark.read.parquet(str(tmp_path / "b")).count() == 0


def test_scratch_folder_comes_from_the_session(spark):
    assert new_folder(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    kept = materialise(spark.range(3), "x")
    assert kept.count() == 3 and "FileScan parquet" in kept._jdf.queryExecution().executedPlan().toString()


def test_no_local_scratch_on_a_cluster():
    class Conf:
        def get(self, key, default=None):
            return default

    class Session:
        conf = Conf()
        sparkContext = type("Context", (), {"master": "spark://host:7077"})()

    with pytest.raises(NoSharedFolder):
        scratch_root(Session())


def test_run_folder_is_removed_also_after_a_failure(spark):
    with pytest.raises(ZeroDivisionError):
        with run_scratch(spark) as folder:
            kept = together({"a": lambda: materialise(spark.range(3), "x")})["a"]
            assert kept.inputFiles()[0].split(":", 1)[-1].lstrip("/").startswith(folder.split(":", 1)[-1].lstrip("/"))
            1 / 0
    files, target = hadoop_path(spark, folder)
    assert not files.exists(target)


def test_together_returns_and_raises(spark):
    assert together({"a": lambda: spark.range(2).count(), "b": lambda: spark.range(5).count()}) == {"a": 2, "b": 5}
    with pytest.raises(ZeroDivisionError):
        together({"a": lambda: 1 / 0})


def odd_instalments(spark):
    texts = [None, "", " ", "nan", "1", " 1.234,56\t", "1,234.56", "1,2,3", "1.2.3", ",5", "-3", "+4.", "1e2", "x", "\n-7,1 ", "5 ,"]
    dates = ["1/2/2020", " 01/12/0000", "31/02/2020", "2020-1-2", "0000-01-01", "2020-01-02 1:2:3.5 ", "2020-01-02\t10:00:00", "1/2/2020 10:00", "2020-01-02 ", "1/2/2020 ", "2020-01-02x"]
    values = texts + dates
    rows = [tuple(values[(i * (j + 1) + j) % len(values)] for j in range(8)) for i in range(len(values))]
    rows = [(r[0], r[1], "1" if r[2] in dates else r[2], *r[3:]) for r in rows]
    names = ("id_contrato", "id_parcela", "num_parcela", "data_vencimento", "data_pagamento", "valor_parcela", "valor_pago", "dias_atraso")
    return spark.createDataFrame(rows, ", ".join(f"{n} string" for n in names)).withColumn(readers.MALFORMED, F.lit(None).cast("string"))


def test_values_read_once_are_those_of_the_column_functions(spark):
    raw = odd_instalments(spark)
    typed = normalise.normalise_installments(raw, *mark_columns(quality.installment_marks().bits))
    numbers = ("valor_parcela", "valor_pago", "dias_atraso")
    want = raw.select(
        *[parsing.norm_id(F.col(c)).alias(c) for c in ("id_contrato", "id_parcela")],
        parsing.norm_int(F.col("num_parcela"), null_as_zero=False).alias("num_parcela"),
        *[parsing.norm_date(F.col(c)).alias(c) for c in ("data_vencimento", "data_pagamento")],
        *[parsing.norm_decimal(F.col(c), null_as_zero=False).alias(c) for c in numbers],
        F.lit(False).alias("_fora"),
        quality.marks_of([*quality.null_checks(raw, INSTALLMENTS), *quality.installment_checks(raw)]).bits.alias("_falhas"),
    )
    assert typed.collect() == want.collect()


def test_staging_compiles_to_methods_of_bounded_size(spark):
    """The JIT compiles no method above 8,000 bytes; longer ones run interpreted, row by row."""
    columns = ", ".join(f"{c} string" for c in (*INSTALLMENTS.raw_schema.names, readers.MALFORMED))
    raw = spark.createDataFrame(spark.sparkContext.parallelize([], 1), columns)
    typed = normalise.normalise_installments(raw, *mark_columns(quality.installment_marks().bits), F.sha1("id_parcela"))
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("codegen")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", typed._jdf.queryExecution().explainString(mode))]
    assert sizes and max(sizes) < 8000
