"""Several files with headers of their own, values over line ends, staging by file, committed bundles, counts from staging."""

from __future__ import annotations

import csv
import gzip
import io
import os
import random

import pytest
from pyspark.sql import functions as F

from vintora.operators import quality
from vintora.params import Params
from vintora.plans.audit_run import audit_folder
from vintora.plans.portfolio_run import run_from_files, stage_book, validate_files
from vintora.sources import files, layouts, readers, records, sinks

INST = "id_contrato;id_parcela;num_parcela;data_vencimento;data_pagamento;valor_parcela;valor_pago;dias_atraso"


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8", newline="")
    return str(path)


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


@pytest.fixture
def split_bytes(spark):
    """Sets the size of the byte ranges that files are read in."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    yield lambda n: [spark.conf.set(k, v) for k, v in zip(names, (n, 0))]
    for k in names:
        spark.conf.unset(k)


# --- headers ----------------------------------------------------------------


def test_files_are_read_by_their_own_headers(spark, tmp_path):
    put(tmp_path / "b" / "1.csv", "Unique ID;principal; PMT \n1;200;7\n")
    put(tmp_path / "b" / "2 {x}.csv", "pmt;PRINCIPAL;uf;unique id\n7;200;SP;2\nshort;line\n")
    put(tmp_path / "b" / "3.csv", "")
    put(tmp_path / "b" / "_hidden.csv", "x;y\n1;2\n")
    with gzip.open(tmp_path / "b" / "4.csv.gz", "wt", encoding="utf-8-sig") as f:
        f.write('principal;"pmt";unique id\n200;7;"a\nb"\n')
    df = readers.read_loans(spark, str(tmp_path / "b"))
    assert rows(df, "id_contrato", "principal", "pmt", "uf") == [("1", "200", "7", None), ("2", "200", "7", "SP"), ("a\nb", "200", "7", None)]
    lines = readers.read_text_lines(spark, str(tmp_path / "b"), source="f")
    found = quality.dq_malformed_lines(lines, layouts.LOANS).first()
    assert (found.n_bad, found.n_total) == (1, 4) and lines.select("f").distinct().count() == 3


def test_unnamed_and_repeated_columns_are_told_apart(spark, tmp_path):
    path = put(tmp_path / "t.csv", "a;A;;b\n1;2;3;4\n")
    assert rows(readers.read_text_table(spark, path), "*") == [("1", "2", "3", "4")]
    assert readers.read_text_table(spark, path).columns == ["a0", "a1", "_c2", "b"]


def test_an_empty_file_has_no_columns(spark, tmp_path):
    assert readers.read_text_lines(spark, put(tmp_path / "t.csv", "")).columns == [readers.MALFORMED]


# --- line ends inside values ------------------------------------------------

VALUES = ["x", "", "a;b", 'say ""', '"', "p\nq", "\n", "\n\n", 'é"\n"', ";\n;", '";"', "long " * 9, '"\n;"x']


def written(rng, n) -> tuple[str, list[tuple]]:
    out = [tuple(rng.choice(VALUES) for _ in range(3)) for _ in range(n)]
    text = io.StringIO()
    writer = csv.writer(text, delimiter=";", quoting=rng.choice([csv.QUOTE_MINIMAL, csv.QUOTE_ALL]), lineterminator="\n")
    writer.writerow(["a", "b", "c"])
    writer.writerows(out)
    return text.getvalue(), out


@pytest.mark.parametrize("size", [2, 7, 64])
def test_whole_records_from_any_byte_ranges(spark, tmp_path, split_bytes, size):
    want = []
    for i in range(2):
        text, values = written(random.Random(10 * size + i), 14)
        put(tmp_path / f"{i}.csv", text)
        want += [tuple(v or None for v in r) for r in values]
    split_bytes(size)
    lines = readers.read_text_lines(spark, str(tmp_path))
    got = [tuple(v or None for v in r) for r in lines.collect()]
    assert sorted(got, key=repr) == sorted(((*r, None) for r in want if any(r)), key=repr) or sorted(got, key=repr) == sorted(
        ((*r, None) for r in want), key=repr
    )


@pytest.mark.parametrize("size", [9, 10**6])
def test_unclosed_and_stray_quotes(spark, tmp_path, split_bytes, size):
    put(tmp_path / "1.csv", 'a;b\n1;"x\ny"\n2;5" pipe\n3;"open\n4;z\n5;w\n')
    put(tmp_path / "2.csv", 'a;b\n6;"it""s"\n7;q\n')
    split_bytes(size)
    lines = readers.read_text_lines(spark, str(tmp_path))
    assert rows(readers.well_formed(lines), "a", "b") == [("1", "x\ny"), ("2", '5" pipe'), ("6", 'it"s'), ("7", "q")]
    found = quality.dq_malformed_lines(lines, layouts.LOANS).first()
    assert (found.n_bad, found.n_total, found.severity) == (3, 7, "erro")  # each line of the open value counts


@pytest.mark.parametrize("size", [5, 10**6])
def test_records_of_too_many_lines_are_lines(spark, tmp_path, split_bytes, monkeypatch, size):
    monkeypatch.setattr(records, "MAX_LINES", 4)
    put(tmp_path / "1.csv", 'a;b\n1;"' + "x\n" * 11 + '"\n2;"p\nq"\n3;z\n')
    split_bytes(size)
    lines = readers.read_text_lines(spark, str(tmp_path))
    assert rows(readers.well_formed(lines), "a", "b") == [("2", "p\nq"), ("3", "z")]
    assert lines.where(F.col(readers.MALFORMED).isNotNull()).count() == 12


def test_files_without_line_ends_are_read_as_lines(spark, tmp_path):
    path = put(tmp_path / "t.csv", 'a;b\n1;"x;""y"\n')
    plan = readers.read_text_lines(spark, path)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan csv") == 1 and "Exchange" not in plan and "FileScan text" not in plan


# --- staging ----------------------------------------------------------------


def parsed_files(monkeypatch) -> list:
    seen = []
    monkeypatch.setattr(sinks, "_parse_files", lambda spark, new, *rest, parse=sinks._parse_files: (seen.append([n.split("/")[-1] for n in new]), parse(spark, new, *rest))[1])
    return seen


def test_only_new_and_changed_files_are_parsed(spark, tmp_path, monkeypatch):
    seen, src, dst = parsed_files(monkeypatch), tmp_path / "inst", str(tmp_path / "staged")
    put(src / "a.csv", f"{INST}\n1;a;1;15/01/2024;;1.000,00;;45\n")
    put(src / "b.csv", f"valor_pago;{INST}\n9;2;b;1;15/01/2024;;7;;0\nbroken\n".replace(";valor_pago;", ";x;", 1))
    ids = lambda: rows(sinks.stage_installments(spark, str(src), dst), "id_contrato", "valor_parcela")
    assert ids() == [("1", 1000.0), ("2", 7.0)] and seen == [["a.csv", "b.csv"]]
    put(src / "c.csv", f"{INST}\n3;c;1;15/01/2024;;3;;0\n")
    put(src / "empty.csv", f"{INST}\n")
    assert ids() == [("1", 1000.0), ("2", 7.0), ("3", 3.0)] and seen[1:] == [["c.csv", "empty.csv"]]
    put(src / "a.csv", f"{INST}\n1;a;1;15/01/2024;;2;;45\n4;a;1;15/01/2024;;4;;45\n")
    assert ids() == [("1", 2.0), ("2", 7.0), ("3", 3.0), ("4", 4.0)] and seen[2:] == [["a.csv"]]
    os.remove(src / "b.csv")
    assert ids() == [("1", 2.0), ("3", 3.0), ("4", 4.0)] and len(seen) == 3
    folders = [d for run in os.listdir(dst) if run.startswith("run-") for d in os.listdir(f"{dst}/{run}") if d.startswith("arquivo=")]
    assert len(folders) == 2  # of a and c; copies that nothing names are gone
    assert sinks.staged_installments(spark, str(src), dst).where("_fora").count() == 0


def test_a_failed_staging_leaves_the_copy(spark, tmp_path):
    src, dst = tmp_path / "inst", str(tmp_path / "staged")
    put(src / "a.csv", f"{INST}\n1;a;1;15/01/2024;;1;;45\n")
    assert sinks.stage_installments(spark, str(src), dst).count() == 1
    put(src / "b.csv", f"{INST}\n2;b;99999999999;15/01/2024;;1;;45\n")
    with pytest.raises(Exception, match="out of range"):
        sinks.stage_installments(spark, str(src), dst)
    os.remove(src / "b.csv")
    assert sinks.stage_installments(spark, str(src), dst).count() == 1


# --- bundles ----------------------------------------------------------------


def small_tables(spark, n):
    curve = spark.createDataFrame([("2020-01", 1, float(n), 1.0)], "safra string, mob int, perda_acum_pct double, receita_acum_pct double")
    mixed = spark.createDataFrame([(n, 'a "q"; ç\nb', None, True)], "n long, t string, d date, ok boolean")
    return {"perda_acumulada": curve, "receita_acumulada": curve, "m": mixed, "vazia": mixed.where("n < 0")}


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_a_bundle_is_committed_as_a_whole(spark, tmp_path, fmt):
    path = str(tmp_path / "out")
    with pytest.raises(sinks.NoBundle):
        sinks.read_bundle(spark, path)
    assert sinks.export_bundle(small_tables(spark, 1), path, fmt) == {"perda_acumulada": True, "receita_acumulada": True, "m": True, "vazia": False}
    killed = small_tables(spark, 2)
    killed["m"] = killed["m"].withColumn("n", F.raise_error(F.lit("killed")).cast("long"))
    with pytest.raises(Exception, match="killed"):
        sinks.export_bundle(killed, path, fmt)
    got = sinks.read_bundle(spark, path)
    assert {n: df.schema for n, df in got.items()} == {n: df.schema for n, df in small_tables(spark, 1).items()}
    assert got["perda_acumulada"].first().perda_acum_pct == 1.0 and got["vazia"].count() == 0
    if fmt == "parquet":
        assert tuple(got["m"].first()) == (1, 'a "q"; ç\nb', None, True)
    assert len([n for n in os.listdir(path) if n.startswith("run-")]) == 1  # nothing of the failed run is left
    for n in (3, 4, 5):
        sinks.export_bundle(small_tables(spark, n), path, fmt)
    assert sinks.read_bundle(spark, path)["perda_acumulada"].first().perda_acum_pct == 5.0
    assert len([n for n in os.listdir(path) if n.startswith("run-")]) == sinks.BUNDLES_KEPT
    checks = audit_folder(spark, path, {})
    assert {r.check: r.status for r in checks.collect()} == {"curva perda_acumulada": "pass", "curva receita_acumulada": "pass"}


def test_small_files_appear_whole(spark, tmp_path):
    path = str(tmp_path / "a" / "x.json")
    assert files.read_small(spark, path) is None and files.names_in(spark, str(tmp_path / "a")) == []
    files.write_small(spark, path, "um")
    files.write_small(spark, path, "dois é")
    assert files.read_small(spark, path) == "dois é" and len(os.listdir(tmp_path / "a")) <= 2


# --- the gate ---------------------------------------------------------------

LOANS = "Unique ID;principal;pmt;num_parcelas;data_aquisicao;taxa_cliente;rating_concessao;dias_maior_atraso;tipo_produto\n"


@pytest.fixture
def folder(tmp_path):
    put(tmp_path / "LOANS.csv", LOANS + "1;1.200,00;100,00;12;10/01/2020;1,5;A;0;Consignado\n 2 ;x;-5;0;2020-13-10;0.02;;75;y\nbad\n3;9;9;900;10/07/2020;1;;;\n")
    put(
        tmp_path / "INSTALLMENTS.csv",
        f'{INST}\n1;a;1;10/02/2020;10/02/2020;100,00;110,00;0\n7;"b\nc";2;10/03/2020;x;-1;;-7\n;;;;;;;\nbad;line\n',
    )
    put(tmp_path / "RENEGOCIACAO.csv", ";".join(layouts.RENEGOTIATIONS.columns) + "\nn;1;;x;-4;;;;;;\nn; 9 ;;;;;;;;;\n")
    return str(tmp_path)


def test_counts_of_the_staging_equal_those_of_the_text(spark, folder):
    p = Params.at("2020-06")
    book = stage_book(spark, folder, p)
    assert rows(book.findings(p), *quality.FINDING) == rows(validate_files(spark, folder, p), *quality.FINDING)
    plan = book.findings(p)._jdf.queryExecution().executedPlan().toString()
    assert "FileScan csv" not in plan and "FileScan text" not in plan


def test_text_is_parsed_once_in_a_run(spark, folder, monkeypatch):
    reads = []
    original = readers.read_text_lines
    monkeypatch.setattr("vintora.sources.sinks.read_text_lines", lambda s, path, *a, **k: (reads.append(str(path)), original(s, path, *a, **k))[1])
    with pytest.raises(quality.ValidationFailed):
        run_from_files(spark, folder, f"{folder}/out", "2020-06")
    assert len(reads) == 1  # the gate has failed on what the staging counted
    with pytest.raises(quality.ValidationFailed):
        run_from_files(spark, folder, f"{folder}/out", "2020-06")
    assert len(reads) == 1


def test_missing_inputs_and_columns_stop_before_parsing(spark, folder, monkeypatch):
    put(__import__("pathlib").Path(folder) / "LOANS.csv", "id_contrato;pmt\n1;2\n")
    monkeypatch.setattr("vintora.plans.portfolio_run.parse_loans", lambda *a: pytest.fail("parsed"))
    with pytest.raises(quality.ValidationFailed, match="5 erros|6 erros"):
        run_from_files(spark, folder, f"{folder}/out", "2020-06")
    os.remove(f"{folder}/LOANS.csv")
    with pytest.raises(quality.ValidationFailed, match="1 erros"):
        run_from_files(spark, folder, f"{folder}/out", "2020-06")


def test_everything_opens_where_only_the_session_knows(spark, folder, tmp_path):
    spark.conf.set("fs.viewfs.mounttable.abc.link./book", tmp_path.as_uri())
    found = stage_book(spark, "viewfs://abc/book", Params.at("2020-06")).findings(Params.at("2020-06"))
    assert found.where("check = 'linhas_malformadas' AND n_bad = 1").count() == 2
    sinks.export_bundle(small_tables(spark, 1), "viewfs://abc/book/out", "csv")
    assert sinks.read_bundle(spark, "viewfs://abc/book/out")["perda_acumulada"].count() == 1
