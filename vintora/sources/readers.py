"""Delimited-text readers, id helpers and portfolio metadata."""

from __future__ import annotations

import csv
import io
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from vintora.functions.parsing import clean_text, norm_id
from vintora.params import NOT_INFORMED
from vintora.sources.files import data_files, file_states, literal, read_head
from vintora.sources.layouts import ID_ALIASES, META, RENEGOTIATIONS, Layout
from vintora.sources.records import files_with_line_ends, text_records

MALFORMED = "_linha_malformada"
Reader = Callable[[SparkSession, str, str], DataFrame]


def norm_columns(df: DataFrame) -> DataFrame:
    """Strip and lower-case every header, keeping the order."""
    return df.toDF(*[c.strip().lower() for c in df.columns])


def norm_id_alias(df: DataFrame) -> DataFrame:
    """Rename the first known alias to ``id_contrato`` when that column is absent."""
    if "id_contrato" in df.columns:
        return df
    alias = next((a for a in ID_ALIASES if a in df.columns), None)
    return df if alias is None else df.withColumnRenamed(alias, "id_contrato")


def read_text_table(spark: SparkSession, path: str, sep: str = ";") -> DataFrame:
    """All-text read of a headed delimited file without its malformed lines.

    ``read_text_lines`` keeps these, and ``quality.dq_malformed_lines`` counts them.
    """
    return well_formed(read_text_lines(spark, path, sep))


def read_text_lines(spark: SparkSession, path: str | list[str], sep: str = ";", source: str | None = None) -> DataFrame:
    """All-text read of every record; ``MALFORMED`` holds it where its columns do not match the header of its file.

    Every file is read by its own header, and files are put together by column name, stripped and lower-cased; a
    column that a file lacks is null. Quoting is that of RFC 4180: a quote inside a quoted value is doubled, a backslash is
    an ordinary character. Values may span lines: files in which they do are found by one scan, and only these are read by
    ``text_records``. ``path`` may be any URI Spark can open, also a folder or a pattern, or the URIs of
    files as ``data_files`` gives them. Column pruning is off in the parser
    so that a line counts as malformed whichever columns the query selects. ``source`` names a column for the file.
    """
    files = path if isinstance(path, list) else data_files(spark, path)
    groups: dict[tuple[tuple[str, ...], bool], list[str]] = {}
    with_ends = _with_line_ends(spark, files, sep)
    for file, names in headers(spark, files, sep).items():
        if names:
            groups.setdefault((names, file in with_ends), []).append(file)
    if not groups:
        groups[(), False] = files
    out = None
    for (names, ends), part in groups.items():
        rows = (_spanning_lines if ends else _single_lines)(spark, part, sep, names, source)
        out = rows if out is None else out.unionByName(rows, allowMissingColumns=True)
    return out.select(*[F.col(f"`{c}`") for c in out.columns if c not in (MALFORMED, source)], *[c for c in (source, MALFORMED) if c])


OPTIONS = {"quote": '"', "escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": MALFORMED}
_LINE_ENDS: dict[tuple, set[str]] = {}  #: by files with their states: the gate and the staging share one scan


def _with_line_ends(spark: SparkSession, files: list[str], sep: str) -> set[str]:
    states = tuple(sorted(file_states(spark, files).items()))
    key = spark.sparkContext.applicationId, sep, states
    if key not in _LINE_ENDS:
        if len(_LINE_ENDS) >= 64:
            _LINE_ENDS.clear()
        _LINE_ENDS[key] = files_with_line_ends(spark, files, sep) if files else set()
    return _LINE_ENDS[key]


def headers(spark: SparkSession, files: list[str], sep: str) -> dict[str, tuple[str, ...]]:
    """Column names of each file, none for an empty one; unnamed and repeated ones are told apart by their number."""

    def names(file: str) -> tuple[str, ...]:
        head = read_head(spark, file).decode("utf-8-sig", errors="ignore")
        row = next((r for r in csv.reader(io.StringIO(head), delimiter=sep) if any(c.strip() for c in r)), [])
        found = [c.strip().lower() for c in row]
        return tuple(f"_c{i}" if not c else f"{c}{i}" if found.count(c) > 1 else c for i, c in enumerate(found))

    with ThreadPoolExecutor(max_workers=16) as pool:
        return dict(zip(files, pool.map(names, files)))


def _text_schema(names: tuple[str, ...]) -> StructType:
    return StructType([StructField(c, StringType()) for c in [*names, MALFORMED]])


def _single_lines(spark: SparkSession, files: list[str], sep: str, names: tuple[str, ...], source: str | None) -> DataFrame:
    reader = spark.read.options(header=True, sep=sep, columnPruning=False, **OPTIONS).schema(_text_schema(names))
    rows = reader.csv([literal(spark, f) for f in files])
    return rows if source is None else rows.select("*", F.col("_metadata.file_path").alias(source))


def _spanning_lines(spark: SparkSession, files: list[str], sep: str, names: tuple[str, ...], source: str | None) -> DataFrame:
    records = text_records(spark, files, sep)
    schema = ", ".join(f"`{f.name.replace('`', '``')}` string" for f in _text_schema(names))
    parsed = records.select("file", "value", "broken", F.from_csv("value", schema, {"sep": sep, **OPTIONS}).alias("p"))
    values = [F.when(~F.col("broken"), F.col("p")[c]).alias(c) for c in names]
    wrong = F.when(F.col("broken"), F.col("value")).otherwise(F.col("p")[MALFORMED]).alias(MALFORMED)
    return parsed.select(*values, wrong, *([F.col("file").alias(source)] if source else []))


def with_data_column(lines: DataFrame) -> DataFrame:
    """The same rows by a filter that is always true: Spark does not read the malformed column without another."""
    return lines.where(F.hash(F.col(f"`{lines.columns[0]}`")) >= -(2**31))


def well_formed(lines: DataFrame) -> DataFrame:
    return with_data_column(lines).where(F.col(MALFORMED).isNull()).drop(MALFORMED)


def read_or_none(spark: SparkSession, path: str, sep: str = ";", read: Reader | None = None) -> DataFrame | None:
    """As ``read_text_table`` or the reader given, None when the path does not exist."""
    try:
        return (read or read_text_table)(spark, path, sep)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def read_loans(spark: SparkSession, path: str, sep: str = ";") -> DataFrame:
    return norm_id_alias(read_text_table(spark, path, sep))


def empty_raw(spark: SparkSession, layout: Layout) -> DataFrame:
    return spark.createDataFrame([], layout.raw_schema)


def read_renegotiations(spark: SparkSession, path: str, sep: str = ";") -> DataFrame:
    """Missing file means no renegotiations."""
    df = read_or_none(spark, path, sep)
    return empty_raw(spark, RENEGOTIATIONS) if df is None else df


def renegotiated_ids(reneg: DataFrame) -> DataFrame:
    """Distinct non-null trimmed origin ids."""
    ids = reneg.select(norm_id(F.col("id_contrato_origem")).alias("id_contrato"))
    return ids.where(F.col("id_contrato").isNotNull()).distinct()


def portfolio_meta(
    spark: SparkSession,
    path: str | None,
    client: str | None = None,
    snapshot: str | None = None,
    sep: str = ";",
) -> DataFrame:
    """One row of run metadata: argument, else META row, else default.

    An analyst that is named nowhere is ``N/I``.
    """
    raw = read_or_none(spark, path, sep) if path else None
    return meta_row(empty_raw(spark, META) if raw is None else raw, client, snapshot)


def meta_row(raw: DataFrame, client: str | None = None, snapshot: str | None = None) -> DataFrame:
    def field(name: str) -> Column:
        return clean_text(F.first(F.col(name))) if name in raw.columns else F.lit(None).cast("string")

    def choose(name: str, argument: str | None, default: str) -> Column:
        return F.lit(argument) if argument else F.coalesce(field(name), F.lit(default))

    return raw.agg(
        choose("nome_cliente", client, "Cliente").alias("nome_cliente"),
        F.substring(choose("data_base", snapshot, ""), 1, 7).alias("data_base"),
        choose("analista", None, NOT_INFORMED).alias("analista"),
        choose("produto", None, "Crédito").alias("produto"),
    )


def table_profile(tables: Mapping[str, DataFrame | None]) -> DataFrame:
    """Rows, columns and status of each input; None stands for a missing file."""
    spark = next(df for df in tables.values() if df is not None).sparkSession
    parts = []
    for name, df in tables.items():
        exists = df is not None
        counted = df.agg(F.count(F.lit(1)).alias("linhas")) if exists else spark.range(1).select(
            F.lit(0).cast("bigint").alias("linhas")
        )
        status = F.when(~F.lit(exists), "ausente").when(F.col("linhas") == 0, "vazio").otherwise("ok")
        parts.append(
            counted.select(
                F.lit(name).alias("dataset"),
                "linhas",
                F.lit(len(df.columns) if exists else 0).cast("bigint").alias("colunas"),
                status.alias("status"),
            )
        )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
