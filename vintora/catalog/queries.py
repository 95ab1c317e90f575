"""One registered query per operator, each with its oracle SQL where SQL can state it."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from vintora.catalog import book
from vintora.catalog import oracle as o
from vintora.catalog.book import PARAMS, table
from vintora.functions.calendar import dpd_bucket, months_diff, vintage
from vintora.functions.numbers import format_locale, round_columns, rounded
from vintora.functions.parsing import (
    date_status,
    norm_category,
    norm_date,
    norm_decimal,
    norm_decimal_strict,
    norm_id,
    norm_int,
    norm_rate,
    norm_report_value,
)
from vintora.operators import cohorts, curves, portfolio, quality, reconcile, rolls, valuation
from vintora.plans.portfolio_run import export_rounded, run_portfolio
from vintora.sources import layouts, normalise, readers, sinks
from vintora.sources.files import remove
from vintora.sources.workspace import hadoop_path, materialise, new_folder, together

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = o.sql(sql)
        return fn

    return add


# --- sources and sinks -----------------------------------------------------


def write_text(df: DataFrame, name: str) -> str:
    """Write an unquoted ``;`` text copy to the scratch folder and return its path."""
    path = new_folder(df.sparkSession, name)
    (
        df.write.option("header", True)
        .option("sep", ";")
        .option("quote", "\u0000")
        .option("emptyValue", "")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
    return path


def broken_loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messy loans in which one line in 29 has a separator too many, and some values are quoted."""
    df = book.messy_loans(spark, sf_dir)
    key = norm_id(F.col("` Unique ID `")).cast("bigint")
    term = F.when(key % 29 == 0, F.concat("num_parcelas", F.lit(";;"))).otherwise(F.col("num_parcelas"))
    quoted = F.when(key % 31 == 0, '"a ""q"", b"').when(key % 37 == 0, '"it\\"').otherwise(F.col("regiao"))
    return df.withColumn("num_parcelas", term).withColumn("regiao", quoted)


RAW_LOANS_SQL = f"""
SELECT '  ' || id_contrato || ' ' AS "id_contrato", {o.money_text('principal', '(k % 5)')} AS principal,
  {o.money_text('pmt', '((k + 1) % 5)')} AS pmt, CAST(num_parcelas AS VARCHAR) AS num_parcelas,
  {o.date_text('data_aquisicao', '(k % 4)')} AS data_aquisicao,
  replace(CAST(CAST(taxa_cliente * CASE WHEN k % 7 = 0 THEN 100 ELSE 1 END AS DECIMAL(10, 4)) AS VARCHAR), '.', ',') AS taxa_cliente,
  CASE WHEN k % 11 = 0 THEN NULL ELSE CAST(CAST(dias_maior_atraso AS INTEGER) AS VARCHAR) END AS dias_maior_atraso,
  CASE WHEN k % 13 = 0 THEN 'NaN' ELSE rating_concessao END AS rating_concessao, situacao_beneficio AS regiao
FROM b_loans"""


QUOTED_SQL = "CASE WHEN k % 31 = 0 THEN 'a \"q\", b' WHEN k % 37 = 0 THEN 'it\\' ELSE situacao_beneficio END AS regiao"


@register("src_loans_csv", RAW_LOANS_SQL.replace("situacao_beneficio AS regiao", QUOTED_SQL) + " WHERE k % 29 <> 0")
def src_loans_csv(spark, sf_dir):
    path = write_text(broken_loans(spark, sf_dir), "loans-csv")
    return readers.read_loans(spark, path)


def write_quoted(df: DataFrame, path: str) -> None:
    """Text with quoted values where they hold a separator, a quote or a line end."""
    options = {"header": True, "sep": ";", "escape": '"', "emptyValue": "", "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    df.write.options(**options).csv(path)


def loan_files(spark: SparkSession, sf_dir: str) -> str:
    """Folder of loan files: a third with reversed columns, a third without ``regiao``, regions that hold line ends and quotes."""
    df, folder = book.messy_loans(spark, sf_dir), new_folder(spark, "loan-files")
    key = norm_id(F.col("` Unique ID `")).cast("bigint")
    spanning = F.when(key % 31 == 0, 'a\n"q"; b\n').when(key % 37 == 0, "\n").otherwise(F.col("regiao"))
    df = df.withColumn("regiao", spanning)
    for part, columns in enumerate((df.columns, df.columns[::-1], [c for c in df.columns if c != "regiao"])):
        write_quoted(df.where(key % 3 == part).select(*[F.col(f"`{c}`") for c in columns]), f"{folder}/{part}")
    return folder


FILES_SQL = RAW_LOANS_SQL.replace(
    "situacao_beneficio AS regiao",
    """CASE WHEN k % 3 = 2 THEN NULL WHEN k % 31 = 0 THEN 'a' || chr(10) || '"q"; b' || chr(10)
         WHEN k % 37 = 0 THEN chr(10) ELSE situacao_beneficio END AS regiao""",
)


@register("src_loans_files", FILES_SQL)
def src_loans_files(spark, sf_dir):
    return readers.read_loans(spark, f"{loan_files(spark, sf_dir)}/*")


@register("src_path_config", FILES_SQL)
def src_path_config(spark, sf_dir):
    """The same files through another file system, which only the session's settings name."""
    files, folder = hadoop_path(spark, loan_files(spark, sf_dir))
    name = f"book{uuid.uuid4().hex}"
    spark.conf.set(f"fs.viewfs.mounttable.{name}.link./loans", files.makeQualified(folder).toString())
    return readers.read_loans(spark, f"viewfs://{name}/loans/*")


@register("src_renegotiated_ids", "SELECT DISTINCT CAST(origem AS VARCHAR) AS id_contrato FROM b_reneg")
def src_renegotiated_ids(spark, sf_dir):
    return readers.renegotiated_ids(book.renegotiations(spark, sf_dir))


def _paid_date(style: str) -> str:
    return f"CASE WHEN {style} = 3 THEN NULL ELSE data_pagamento END"


TYPED_INST_SQL = f"""
SELECT id_contrato, id_parcela, num_parcela,
  CASE WHEN k % 4 = 3 THEN NULL ELSE data_vencimento END AS data_vencimento,
  CASE WHEN (k + 1) % 4 = 3 THEN NULL ELSE data_pagamento END AS data_pagamento,
  {o.styled('valor_parcela', 'k % 5')} AS valor_parcela,
  CASE WHEN valor_pago IS NULL AND (k + 2) % 5 <> 4 THEN NULL ELSE {o.styled('valor_pago', '(k + 2) % 5')} END AS valor_pago,
  dias_atraso FROM b_inst"""


@register("stage_installments_parquet", TYPED_INST_SQL)
def stage_installments_parquet(spark, sf_dir):
    src = write_text(book.messy_installments(spark, sf_dir), "inst-csv")
    return sinks.stage_installments(spark, src, new_folder(spark, "inst-parquet"))


@register("stage_changed_files", TYPED_INST_SQL)
def stage_changed_files(spark, sf_dir):
    """Staging of a folder that has got a second file since it was staged first, and lost a third."""
    messy, src, dst = book.messy_installments(spark, sf_dir), new_folder(spark, "inst-files"), new_folder(spark, "inst-staged")
    key = F.trim("ID_CONTRATO").cast("bigint")
    write_quoted(messy.where(key % 2 == 0), f"{src}/even")
    write_quoted(messy.where(key % 7 == 0), f"{src}/gone")
    sinks.stage_installments(spark, f"{src}/*", dst)
    remove(spark, f"{src}/gone")
    write_quoted(messy.where(key % 2 == 1), f"{src}/odd")
    return sinks.stage_installments(spark, f"{src}/*", dst)


@register(
    "portfolio_meta",
    """SELECT max(c_name) AS nome_cliente, strftime((SELECT max(o_orderdate) FROM orders), '%Y-%m') AS data_base,
       'N/I' AS analista, max(c_mktsegment) AS produto FROM customer""",
)
def portfolio_meta(spark, sf_dir):
    last = table(spark, sf_dir, "orders").agg(F.max(F.col("o_orderdate").cast("date").cast("string")).alias("d"))
    meta = table(spark, sf_dir, "customer").agg(
        F.concat(F.lit(" "), F.max("c_name")).alias("Nome_Cliente"), F.max("c_mktsegment").alias("PRODUTO")
    )
    return readers.portfolio_meta(spark, write_text(meta.withColumn("data_base", last.scalar()), "meta"))


@register("sink_result_table", f"SELECT faixa, CAST(contratos_n AS VARCHAR) AS contratos_n, CAST({o.r('pct_raw')} AS VARCHAR) AS pct_carteira FROM b_bands")
def sink_result_table(spark, sf_dir):
    path = new_folder(spark, "faixas")
    bands = export_rounded(portfolio.delinquency_bands(book.loans(spark, sf_dir)))
    sinks.write_result(bands, path, "csv")
    return readers.read_text_table(spark, path).select("faixa", "contratos_n", "pct_carteira")


BUNDLE_ROWS = {
    "kpis": "42",
    "faixas_atraso": "5",
    "faixas_prazo": "7",
    "rating": "(SELECT count(*) FROM b_rating)",
    "uf": "(SELECT count(*) FROM b_uf)",
    "perfil": "(SELECT count(DISTINCT especie_beneficio) FROM b_loans)",
    "especie_situacao": "(SELECT count(DISTINCT (especie_beneficio, situacao_beneficio)) FROM b_loans)",
    "canal_situacao": "(SELECT count(DISTINCT (canal_originacao, situacao_beneficio)) FROM b_loans)",
    "fpd_safras": "(SELECT count(*) FROM b_fpd_raw)",
    "vencimentario": "(SELECT count(DISTINCT strftime(venc, '%Y-%m')) FROM b_flow)",
    "comportamento_pagamento": "(SELECT count(*) FROM b_vp)",
    "rolagens": "(SELECT count(*) FROM b_spine)",
    "vpl_cenarios": "6",
    "parametros_pe": "6",
    "perda_acumulada": "(SELECT count(*) * any_value(t) FROM b_vp, b_term)",
    "receita_acumulada": "(SELECT count(*) * any_value(t) FROM b_vp, b_term)",
    "safras_meta": "(SELECT count(*) FROM b_vp)",
    "matriz_over60": "(SELECT count(DISTINCT rating_concessao) * count(DISTINCT bhv_m) FROM b_loans)",
    "matriz_saldo": "(SELECT count(DISTINCT rating_concessao) * count(DISTINCT bhv_m) FROM b_loans)",
    "meta_execucao": "7",
}


@register(
    "export_bundle",
    " UNION ALL ".join(f"SELECT '{t}' AS tabela, CAST({n} AS BIGINT) AS linhas" for t, n in BUNDLE_ROWS.items()),
)
def export_bundle(spark, sf_dir):
    path = new_folder(spark, "bundle")
    sinks.export_bundle(portfolio_results(spark, sf_dir), path)
    counts = [
        df.agg(F.lit(name).alias("tabela"), F.count(F.lit(1)).alias("linhas"))
        for name, df in sinks.read_bundle(spark, path).items()
    ]
    return quality.union_all(counts)


def portfolio_results(spark: SparkSession, sf_dir: str, store: bool = True) -> dict[str, DataFrame]:
    """All result tables of the derived book; with ``store`` it is derived once and stored, as a run expects its inputs."""
    ids = readers.renegotiated_ids(book.renegotiations(spark, sf_dir))
    loans, inst = book.loans(spark, sf_dir, attributes=True), book.installments(spark, sf_dir)
    if store:
        stored = together({"loans": lambda: materialise(loans, "loans"), "inst": lambda: materialise(inst, "inst")})
        loans, inst = stored["loans"], stored["inst"]
    return run_portfolio(loans, inst, ids, PARAMS, store=store)


@register(
    "table_profile",
    """SELECT 'LOANS' AS dataset, count(*) AS linhas, CAST(9 AS BIGINT) AS colunas, 'ok' AS status FROM b_loans
       UNION ALL SELECT 'INSTALLMENTS', count(*), 8, 'ok' FROM b_inst
       UNION ALL SELECT 'RENEGOCIACAO', count(*), 11, 'ok' FROM b_reneg
       UNION ALL SELECT 'VAZIO', 0, 11, 'vazio' UNION ALL SELECT 'META', 0, 0, 'ausente'""",
)
def table_profile(spark, sf_dir):
    reneg = book.renegotiations(spark, sf_dir)
    return readers.table_profile(
        {
            "LOANS": book.messy_loans(spark, sf_dir),
            "INSTALLMENTS": book.messy_installments(spark, sf_dir),
            "RENEGOCIACAO": reneg,
            "VAZIO": reneg.where(F.col("id_contrato_novo").isNull()),
            "META": None,
        }
    )


# --- projections and scalar functions --------------------------------------


def stored_text(df: DataFrame, name: str) -> DataFrame:
    """The text table as an input on storage, so queries time the parsing alone."""
    return materialise(readers.norm_columns(df), name)


def messy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.norm_id_alias(stored_text(book.messy_loans(spark, sf_dir), "texto-loans"))


def messy_inst(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored_text(book.messy_installments(spark, sf_dir), "texto-inst")


@register(
    "norm_columns",
    RAW_LOANS_SQL.replace('"id_contrato"', '"unique id"'),
)
def norm_columns(spark, sf_dir):
    df = readers.norm_columns(book.messy_loans(spark, sf_dir))
    return df.withColumn("data_aquisicao", F.when(F.col("data_aquisicao") != "", F.col("data_aquisicao")))


@register("norm_id_alias", RAW_LOANS_SQL)
def norm_id_alias(spark, sf_dir):
    df = messy(spark, sf_dir)
    return df.withColumn("data_aquisicao", F.when(F.col("data_aquisicao") != "", F.col("data_aquisicao")))


@register("norm_id", "SELECT id_contrato FROM b_loans")
def norm_id_query(spark, sf_dir):
    return messy(spark, sf_dir).select(norm_id(F.col("id_contrato")).alias("id_contrato"))


@register(
    "norm_decimal",
    f"SELECT id_contrato, {o.styled('principal', 'k % 5')} AS principal, {o.styled('pmt', '(k + 1) % 5')} AS pmt FROM b_loans",
)
def norm_decimal_query(spark, sf_dir):
    return messy(spark, sf_dir).select(
        norm_id(F.col("id_contrato")).alias("id_contrato"),
        norm_decimal(F.col("principal")).alias("principal"),
        norm_decimal(F.col("pmt")).alias("pmt"),
    )


@register(
    "round_half",
    "SELECT o_orderkey AS k, CAST(round((o_orderkey % 4001 - 2000) * 0.001, 2) AS DOUBLE) AS v FROM orders",
)
def round_half(spark, sf_dir):
    """Thousandths of both signs to two decimals, ties away from zero."""
    value = (F.col("o_orderkey") % 4001 - 2000) / 1000
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), rounded(value, 2).alias("v"))


@register("norm_int", "SELECT o_orderkey AS k, CAST(round_even((o_orderkey % 160) / 4.0e0, 0) AS INTEGER) AS n FROM orders")
def norm_int_query(spark, sf_dir):
    key = F.col("o_orderkey")
    quarters = ((key % 160) / 4).cast("decimal(10,2)").cast("string")
    written = F.when(key % 2 == 0, F.translate(quarters, ".", ",")).otherwise(quarters)
    return table(spark, sf_dir, "orders").select(key.alias("k"), norm_int(written).alias("n"))


def dated_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Due dates as text: three formats, blanks, and two kinds of invalid date."""
    key = F.col("id_contrato").cast("bigint")
    t = book.installments(spark, sf_dir)
    bad = F.when(key % 10 == 8, "13/13/2026").when(key % 10 == 9, "not-a-date")
    written = F.coalesce(bad, book.date_style(F.col("data_vencimento"), key % 4)).alias("texto")
    return stored_text(t.select("id_contrato", "id_parcela", written), "texto-datas")


@register(
    "norm_date",
    "SELECT id_contrato, id_parcela, CASE WHEN k % 10 < 8 AND k % 4 < 3 THEN data_vencimento END AS d FROM b_inst",
)
def norm_date_query(spark, sf_dir):
    return dated_text(spark, sf_dir).select("id_contrato", "id_parcela", norm_date(F.col("texto")).alias("d"))


@register(
    "date_parse_status",
    """SELECT id_contrato, id_parcela, CASE WHEN k % 10 >= 8 THEN 'invalid' WHEN k % 4 = 3 THEN 'absent' ELSE 'valid' END
       AS status FROM b_inst""",
)
def date_parse_status(spark, sf_dir):
    return dated_text(spark, sf_dir).select("id_contrato", "id_parcela", date_status(F.col("texto")).alias("status"))


@register("norm_rate", "SELECT id_contrato, taxa_cliente AS taxa FROM b_loans")
def norm_rate_query(spark, sf_dir):
    return messy(spark, sf_dir).select(
        norm_id(F.col("id_contrato")).alias("id_contrato"), norm_rate(F.col("taxa_cliente")).alias("taxa")
    )


@register("vintage_month", "SELECT id_contrato, CASE WHEN k % 4 = 3 THEN 'N/I' ELSE safra END AS safra FROM b_loans")
def vintage_month(spark, sf_dir):
    return messy(spark, sf_dir).select(
        norm_id(F.col("id_contrato")).alias("id_contrato"), vintage(norm_date(F.col("data_aquisicao"))).alias("safra")
    )


@register(
    "norm_categories",
    """SELECT id_contrato, rating_concessao, 'N/I' AS bhv_m, 'N/I' AS especie_beneficio, 'N/I' AS situacao_beneficio,
       'N/I' AS canal_originacao, situacao_beneficio AS uf, situacao_beneficio AS regiao, 'N/I' AS profissao FROM b_loans""",
)
def norm_categories(spark, sf_dir):
    df = messy(spark, sf_dir)
    columns = normalise.category_columns(df)
    return df.select(norm_id(F.col("id_contrato")).alias("id_contrato"), *[c.alias(n) for n, c in columns.items()])


DEDUP_SOURCE_SQL = """
SELECT k % 5000 AS id, data_aquisicao, principal, num_parcelas FROM b_loans"""


@register(
    "dedup_loans",
    f"""SELECT CAST(id AS VARCHAR) AS id_contrato, data_aquisicao, principal, num_parcelas FROM ({DEDUP_SOURCE_SQL})
        QUALIFY row_number() OVER (PARTITION BY id ORDER BY data_aquisicao DESC, principal DESC) = 1""",
)
def dedup_loans(spark, sf_dir):
    key = F.col("id_contrato").cast("bigint")
    repeated = book.loans(spark, sf_dir).select(
        (key % 5000).cast("string").alias("id_contrato"), "data_aquisicao", "principal", "num_parcelas"
    )
    return normalise.dedup_loans(repeated)


@register(
    "months_between_calendar",
    f"""SELECT id_contrato, CAST((year({o.SNAPSHOT}) - year(data_aquisicao)) * 12 + month({o.SNAPSHOT})
        - month(data_aquisicao) AS INTEGER) AS meses FROM b_loans""",
)
def months_between_calendar(spark, sf_dir):
    return book.loans(spark, sf_dir).select(
        "id_contrato", months_diff(F.col("data_aquisicao"), F.lit(PARAMS.snapshot)).alias("meses")
    )


@register(
    "format_locale_columns",
    """SELECT rating, 'R$ ' || translate(format('{:,.2f}', principal), ',.', '.,') AS principal,
       replace(format('{:.2f}', over60_pct / 100 * 100), '.', ',') || '%' AS over60_pct,
       replace(format('{:,}', contratos_n), ',', '.') AS contratos_n FROM b_rating""",
)
def format_locale_columns(spark, sf_dir):
    rating = export_rounded(portfolio.rating_profile(book.loans(spark, sf_dir)))
    columns = rating.select("rating", "principal", (F.col("over60_pct") / 100).alias("over60_pct"), "contratos_n")
    return format_locale(columns, money=["principal"], pct=["over60_pct"], ints=["contratos_n"])


@register(
    "dpd_bucket",
    f"""SELECT {o.BUCKET.format(d='dias_atraso')} AS bucket, dias_atraso, count(*) AS n
        FROM b_inst GROUP BY ALL""",
)
def dpd_bucket_query(spark, sf_dir):
    """Unknown days are in the last bucket."""
    inst = book.installments(spark, sf_dir)
    return inst.groupBy(dpd_bucket(F.col("dias_atraso")).alias("bucket"), "dias_atraso").agg(F.count(F.lit(1)).alias("n"))


@register(
    "norm_decimal_strict",
    """SELECT id_contrato, CASE k % 5 WHEN 0 THEN CAST(replace(CAST(CAST(principal AS DECIMAL(18,2)) AS VARCHAR), '.', '') AS DOUBLE)
         WHEN 1 THEN principal WHEN 2 THEN principal
         WHEN 3 THEN TRY_CAST(translate(format('{:,.2f}', principal), ',.', '.') AS DOUBLE) END AS principal FROM b_loans""",
)
def norm_decimal_strict_query(spark, sf_dir):
    return messy(spark, sf_dir).select(
        norm_id(F.col("id_contrato")).alias("id_contrato"), norm_decimal_strict(F.col("principal")).alias("principal")
    )


REPORT_KINDS = ("money", "money", "pct", "count", "decimal", "money")


@register(
    "norm_report_value",
    """SELECT id_contrato, kind, CASE k % 6 WHEN 0 THEN principal WHEN 1 THEN principal WHEN 2 THEN dias_maior_atraso / 4
       WHEN 3 THEN CAST(k AS DOUBLE) WHEN 4 THEN dias_maior_atraso / 4 END AS value
       FROM (SELECT *, CASE k % 6 WHEN 2 THEN 'pct' WHEN 3 THEN 'count' WHEN 4 THEN 'decimal' ELSE 'money' END AS kind FROM b_loans)""",
)
def norm_report_value_query(spark, sf_dir):
    key = F.col("id_contrato").cast("bigint")
    style = key % 6
    money = F.col("principal").cast("decimal(18,2)")
    local = F.translate(F.format_number(money, 2), ",.", ".,")
    quarter = (F.col("dias_maior_atraso") / 4).cast("decimal(10,2)").cast("string")
    printed = (
        F.when(style == 0, F.concat(F.lit("R$ "), local, F.lit(" (70.63% do Principal)")))
        .when(style == 1, F.concat(F.lit("R$ "), money.cast("string")))
        .when(style == 2, F.concat(quarter, F.lit("%")))
        .when(style == 3, F.translate(F.format_number(key, 0), ",", "."))
        .when(style == 4, F.translate(quarter, ".", ","))
        .otherwise("#DIV/0!")
    )
    kind = F.element_at(F.array(*[F.lit(k) for k in REPORT_KINDS]), (style + 1).cast("int"))
    return book.loans(spark, sf_dir).select("id_contrato", kind.alias("kind"), norm_report_value(printed, kind).alias("value"))


TYPED_LOANS_SQL = f"""
SELECT id_contrato, {o.styled('principal', 'k % 5')} AS principal, {o.styled('pmt', '(k + 1) % 5')} AS pmt, num_parcelas,
  CASE WHEN k % 4 = 3 THEN NULL ELSE data_aquisicao END AS data_aquisicao, taxa_cliente, dias_maior_atraso,
  CASE WHEN k % 4 = 3 THEN 'N/I' ELSE safra END AS safra, rating_concessao, 'N/I' AS bhv_m, 'N/I' AS especie_beneficio,
  'N/I' AS situacao_beneficio, 'N/I' AS canal_originacao, situacao_beneficio AS uf, situacao_beneficio AS regiao,
  'N/I' AS profissao FROM b_loans"""


@register("normalise_loans", TYPED_LOANS_SQL)
def normalise_loans(spark, sf_dir):
    return normalise.normalise_loans(messy(spark, sf_dir))


@register("normalise_installments", TYPED_INST_SQL)
def normalise_installments(spark, sf_dir):
    return normalise.normalise_installments(messy_inst(spark, sf_dir))


@register(
    "normalise_renegotiations",
    """SELECT novo AS id_contrato_novo, CAST(origem AS VARCHAR) AS id_contrato_origem, 'P' || k AS id_parcela_reneg,
       d AS data_renegociacao, d AS data_vencimento, CAST(NULL AS DATE) AS data_pagamento, CAST(1 AS INTEGER) AS num_parcela,
       valor AS valor_refinanciado, CAST(0 AS DOUBLE) AS valor_troco, valor AS valor_parcela, CAST(NULL AS DOUBLE) AS valor_pago
       FROM b_reneg""",
)
def normalise_renegotiations(spark, sf_dir):
    return normalise.normalise_renegotiations(book.renegotiations(spark, sf_dir))


@register(
    "cleaning_report",
    """SELECT 'INSTALLMENTS' AS dataset, 'valor_parcela' AS coluna, CAST(0 AS BIGINT) AS nulos,
         count(*) FILTER (WHERE k % 5 = 4) AS rejeitados, count(*) AS linhas FROM b_inst
       UNION ALL SELECT 'INSTALLMENTS', 'valor_pago', count(*) FILTER (WHERE valor_pago IS NULL AND (k + 2) % 5 <> 4),
         count(*) FILTER (WHERE (k + 2) % 5 = 4), count(*) FROM b_inst
       UNION ALL SELECT 'INSTALLMENTS', 'dias_atraso', count(*) FILTER (WHERE dias_atraso IS NULL), 0, count(*) FROM b_inst
       UNION ALL SELECT 'INSTALLMENTS', 'data_vencimento', 0, 0, count(*) FROM b_inst""",
)
def cleaning_report(spark, sf_dir):
    return normalise.cleaning_report(
        messy_inst(spark, sf_dir), "INSTALLMENTS", numbers=["valor_parcela", "valor_pago", "dias_atraso"], dates=["data_vencimento"]
    )


# --- loan-level aggregations -----------------------------------------------


def kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = readers.renegotiated_ids(book.renegotiations(spark, sf_dir))
    return portfolio.portfolio_kpis(book.loans(spark, sf_dir), ids)


@register(
    "portfolio_kpis",
    f"""SELECT contratos, principal_total, {o.r('ticket_medio')} AS ticket_medio, {o.r('taxa_media', 6)} AS taxa_media,
        {o.r('prazo_medio', 4)} AS prazo_medio, over30_n, over60_n, over90_n, over30_pct, over60_pct, over90_pct,
        safra_min, safra_max, safra_ni_n, renegociacoes FROM b_kpis""",
)
def portfolio_kpis(spark, sf_dir):
    return round_columns(kpis(spark, sf_dir), {"ticket_medio": 2, "taxa_media": 6, "prazo_medio": 4})


@register(
    "delinquency_bands",
    f"SELECT faixa, contratos_n, {o.r('pct_raw')} AS pct_carteira, {o.r('acum_raw')} AS acumulado FROM b_bands",
)
def delinquency_bands(spark, sf_dir):
    return export_rounded(portfolio.delinquency_bands(book.loans(spark, sf_dir)))


@register(
    "term_bands",
    o.bands(
        o.TERMS,
        f"faixa, coalesce(n, 0) AS contratos_n, coalesce(p, 0) AS principal, coalesce(o, 0) AS over60_n, "
        f"{o.r(o.pct('coalesce(o, 0)', 'coalesce(n, 0)'))} AS over60_pct",
    ),
)
def term_bands(spark, sf_dir):
    return export_rounded(portfolio.term_bands(book.loans(spark, sf_dir)))


@register(
    "rating_profile",
    "SELECT rating, contratos_n, principal, over60_n, over60_pct, taxa_pond_pct, part_pct FROM b_rating",
)
def rating_profile(spark, sf_dir):
    return export_rounded(portfolio.rating_profile(book.loans(spark, sf_dir)))


@register("state_profile", "SELECT * FROM b_uf")
def state_profile(spark, sf_dir):
    return export_rounded(portfolio.state_profile(book.loans(spark, sf_dir, attributes=True)))


@register("segment_profile", o.cut("'especie' AS rotulo, especie_beneficio AS perfil", ""))
def segment_profile(spark, sf_dir):
    return export_rounded(portfolio.segment_profile(book.loans(spark, sf_dir, attributes=True)))


OVER90_PCT = f", {o.r(o.pct(o.OVER90, 'count(*)'))} AS over90_pct"


@register("cross_profile_species", o.cut("especie_beneficio AS especie, situacao_beneficio AS situacao", OVER90_PCT))
def cross_profile_species(spark, sf_dir):
    loans = book.loans(spark, sf_dir, attributes=True)
    return export_rounded(portfolio.cross_profile(loans, "especie"))


@register("cross_profile_channel", o.cut("canal_originacao AS canal, situacao_beneficio AS situacao", OVER90_PCT))
def cross_profile_channel(spark, sf_dir):
    loans = book.loans(spark, sf_dir, attributes=True)
    return export_rounded(portfolio.cross_profile(loans, "canal"))


def sparse_loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All loans, those of one rating x score pair under another score, so that the matrix has an empty cell."""
    loans = book.loans(spark, sf_dir, attributes=True)
    pair = (F.col("rating_concessao") == "1") & (F.col("bhv_m") == "MACHINERY")
    return loans.withColumn("bhv_m", F.when(pair, "BUILDING").otherwise(F.col("bhv_m")))


def _matrix_sql(columns: str) -> str:
    return f"""
SELECT rating, bhv, {columns} FROM (SELECT DISTINCT rating_concessao AS rating FROM b_loans) CROSS JOIN
  (SELECT DISTINCT bhv_m AS bhv FROM b_loans) LEFT JOIN
  (SELECT rating_concessao AS rating, CASE WHEN rating_concessao = '1' AND bhv_m = 'MACHINERY' THEN 'BUILDING' ELSE bhv_m END AS bhv,
   count(*) AS n, {o.money('principal')} AS p, {o.OVER60} AS o60 FROM b_loans GROUP BY 1, 2) USING (rating, bhv)"""


@register(
    "matrix_over60",
    _matrix_sql(
        f"coalesce(n, 0) AS contratos_n, coalesce(o60, 0) AS over60_n, {o.r(o.pct('coalesce(o60, 0)', 'coalesce(n, 0)'))} AS over60_pct"
    ),
)
def matrix_over60(spark, sf_dir):
    return export_rounded(portfolio.matrix_over60(portfolio.rating_matrix(sparse_loans(spark, sf_dir))))


@register(
    "matrix_balance",
    _matrix_sql(f"coalesce(p, 0) AS principal, {o.r('coalesce(p, 0) / sum(p) OVER () * 100')} AS part_pct"),
)
def matrix_balance(spark, sf_dir):
    return export_rounded(portfolio.matrix_balance(portfolio.rating_matrix(sparse_loans(spark, sf_dir))))


@register(
    "future_due_schedule",
    f"SELECT strftime(venc, '%Y-%m') AS mes, {o.money('pmt')} AS pmt_total FROM b_flow GROUP BY 1",
)
def future_due_schedule(spark, sf_dir):
    return export_rounded(portfolio.future_due_schedule(book.loans(spark, sf_dir), PARAMS))


@register("exposure_at_default", "SELECT * FROM b_ead")
def exposure_at_default(spark, sf_dir):
    return portfolio.exposure_at_default(book.loans(spark, sf_dir))


@register("all_rated_flag", "SELECT NOT bool_or(rating_concessao = 'N/I') AS todos_rated FROM b_loans")
def all_rated_flag(spark, sf_dir):
    return portfolio.all_rated_flag(book.loans(spark, sf_dir))


# --- cohorts ---------------------------------------------------------------


def loans_and_inst(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return book.loans(spark, sf_dir), book.installments(spark, sf_dir)


@register("first_payment_default", "SELECT * FROM b_fpd")
def first_payment_default(spark, sf_dir):
    return export_rounded(cohorts.first_payment_default(*loans_and_inst(spark, sf_dir)))


@register("fpd_signal", f"SELECT id_contrato, {o.SIGNAL.format(q='(k % 101 - 0.5e0)')} AS sinalizacao FROM b_loans")
def fpd_signal(spark, sf_dir):
    share = F.col("id_contrato").cast("bigint") % 101 - 0.5
    return book.loans(spark, sf_dir).select("id_contrato", cohorts.fpd_signal(share).alias("sinalizacao"))


@register("payment_behaviour", "SELECT * FROM b_behaviour")
def payment_behaviour(spark, sf_dir):
    return export_rounded(cohorts.payment_behaviour(*loans_and_inst(spark, sf_dir), PARAMS))


@register("loss_revenue_by_mob", f"SELECT safra, mob, perda, {o.r('receita')} AS receita FROM b_mob")
def loss_revenue_by_mob(spark, sf_dir):
    return round_columns(cohorts.loss_revenue_by_mob(*loans_and_inst(spark, sf_dir), PARAMS), {"receita": 2})


@register("vintage_principal", "SELECT safra, principal FROM b_vp")
def vintage_principal(spark, sf_dir):
    return cohorts.vintage_principal(book.loans(spark, sf_dir)).select("safra", (F.col("principal_c") / 100).alias("principal"))


@register("observed_mob", "SELECT safra, max_mob, mob_limpo FROM b_obs")
def observed_mob(spark, sf_dir):
    loans, inst = loans_and_inst(spark, sf_dir)
    cells = cohorts.cohort_cells(loans, inst, PARAMS)
    return cohorts.observed_mob(cells, cohorts.vintage_principal(loans), PARAMS).select("safra", "max_mob", "mob_limpo")


# --- roll rates ------------------------------------------------------------


@register("month_spine", "SELECT cal FROM b_spine")
def month_spine(spark, sf_dir):
    return rolls.month_spine(book.loans(spark, sf_dir), PARAMS)


@register("contract_event_bounds", "SELECT id_contrato, min_venc, min_event FROM b_first")
def contract_event_bounds(spark, sf_dir):
    return rolls.contract_event_bounds(book.installments(spark, sf_dir))


@register("contract_month_grid", "SELECT id_contrato, cal FROM b_grid")
def contract_month_grid(spark, sf_dir):
    return rolls.contract_month_grid(*loans_and_inst(spark, sf_dir), PARAMS)


@register("payment_effective_month", "SELECT * FROM b_pay")
def payment_effective_month(spark, sf_dir):
    return rolls.payment_effective_month(book.installments(spark, sf_dir))


@register("cumulative_payments", "SELECT * FROM b_cum")
def cumulative_payments(spark, sf_dir):
    return rolls.cumulative_payments(*loans_and_inst(spark, sf_dir), PARAMS)


@register("oldest_unpaid_due", "SELECT * FROM b_oldest")
def oldest_unpaid_due(spark, sf_dir):
    return rolls.oldest_unpaid_due(*loans_and_inst(spark, sf_dir), PARAMS)


@register("outstanding_balance_bucket", "SELECT * FROM b_state")
def outstanding_balance_bucket(spark, sf_dir):
    return rolls.outstanding_balance_bucket(*loans_and_inst(spark, sf_dir), PARAMS)


def aging(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The monthly totals, stored once because several later steps read them."""
    return materialise(rolls.aging_balance(*loans_and_inst(spark, sf_dir), PARAMS), "aging")


def chained(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rolls.chain_efficiency(rolls.roll_rates(aging(spark, sf_dir)))


def ltm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rolls.ltm_averages(chained(spark, sf_dir), PARAMS)


@register("aging_balance", "SELECT * FROM b_aging")
def aging_balance(spark, sf_dir):
    return rolls.aging_balance(*loans_and_inst(spark, sf_dir), PARAMS)


ROLL_NAMES = rolls.ROLL_COLUMNS
SIX = {n: 6 for n in ROLL_NAMES + rolls.EFFICIENCIES}


def _six(names) -> str:
    return ", ".join(f"{o.r(n, 6)} AS {n}" for n in names)


@register("roll_rates", f"SELECT mes, {_six(ROLL_NAMES)} FROM b_rolls")
def roll_rates(spark, sf_dir):
    return round_columns(rolls.roll_rates(aging(spark, sf_dir)).drop("cal"), SIX)


@register("chain_efficiency", f"SELECT mes, {_six(rolls.EFFICIENCIES)} FROM b_chain")
def chain_efficiency(spark, sf_dir):
    return round_columns(chained(spark, sf_dir).select("mes", *rolls.EFFICIENCIES), SIX)


LTM_COLUMNS = tuple(f"{n}_pct" for n, _, _ in o.PAIRS) + rolls.EFFICIENCIES


@register("ltm_averages", f"SELECT {_six(LTM_COLUMNS)}, meses FROM b_ltm")
def ltm_averages(spark, sf_dir):
    return round_columns(ltm(spark, sf_dir), {n: 6 for n in LTM_COLUMNS})


@register(
    "roll_table",
    f"""SELECT mes, {', '.join(f'{o.r(n + " * 100", 5)} AS {n}' for n in ROLL_NAMES + rolls.EFFICIENCIES)} FROM b_chain
        UNION ALL SELECT 'Média LTM', {', '.join(o.r(f'{n}_pct') for n, _, _ in o.PAIRS)}, NULL,
        {o.r('effic60 * 100')}, {o.r('effic90 * 100')} FROM b_ltm""",
)
def roll_table(spark, sf_dir):
    c = chained(spark, sf_dir)
    return rolls.roll_table(c, rolls.ltm_averages(c, PARAMS))


# --- vintage curves --------------------------------------------------------


class Curves:
    """The curve chain of one book; the vintage x MOB table is stored once."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        loans, inst = loans_and_inst(spark, sf_dir)
        self.totals = materialise(portfolio.book_totals(loans).select("max_prazo"), "totals")
        self.loans, self.inst = loans, inst
        self.cells = materialise(cohorts.cohort_cells(loans, inst, PARAMS), "cells")
        months = curves.vintage_months(self.cells, cohorts.vintage_principal(loans), self.totals, PARAMS)
        self.months = materialise(months, "months")
        self.groups = curves.risk_groups(self.months, PARAMS)

    def decay(self) -> DataFrame:
        return curves.revenue_decay(self.groups, PARAMS)

    def raw(self) -> DataFrame:
        return curves.group_shape_raw(self.months, self.groups, self.totals, PARAMS)

    def shapes(self) -> DataFrame:
        return materialise(curves.shape_decay_fill(self.raw(), self.decay(), PARAMS), "shapes")

    def curve(self) -> DataFrame:
        return curves.project_curves(self.months, self.groups, self.shapes(), PARAMS)


@register("realised_loss_final", f"SELECT safra, mob_limpo, {o.r('perda_realizada', 6)} AS perda_realizada FROM b_final")
def realised_loss_final(spark, sf_dir):
    return round_columns(curves.realised_loss_final(Curves(spark, sf_dir).months, PARAMS), {"perda_realizada": 6})


@register(
    "risk_groups", f"SELECT safra, mob_limpo, {o.r('perda_realizada', 6)} AS perda_realizada, grupo AS grupo_risco FROM b_groups"
)
def risk_groups(spark, sf_dir):
    groups = Curves(spark, sf_dir).groups.select("safra", "mob_limpo", "perda_realizada", "grupo_risco")
    return round_columns(groups, {"perda_realizada": 6})


@register("revenue_decay", f"SELECT grupo, {o.r('decay_receita', 8)} AS decay_receita FROM b_decay")
def revenue_decay(spark, sf_dir):
    return round_columns(Curves(spark, sf_dir).decay(), {"decay_receita": 8})


@register(
    "survival_factor",
    f"""SELECT safra, mob, {o.r('acum', 6)} AS perda_acum, {o.r('greatest(1 - acum / 100, 0.001e0)', 8)} AS sobrevivencia
        FROM b_vm WHERE limpo""",
)
def survival_factor(spark, sf_dir):
    return round_columns(
        curves.survival_factor(Curves(spark, sf_dir).months), {"perda_acum": 6, "sobrevivencia": 8}
    )


@register("group_shape_raw", f"SELECT grupo, mob, {o.r('perda', 6)} AS perda, {o.r('receita', 6)} AS receita FROM b_raw")
def group_shape_raw(spark, sf_dir):
    return round_columns(Curves(spark, sf_dir).raw(), {"perda": 6, "receita": 6})


@register("shape_decay_fill", f"SELECT grupo, mob, {o.r('perda', 6)} AS perda, {o.r('receita', 6)} AS receita FROM b_shape")
def shape_decay_fill(spark, sf_dir):
    return round_columns(Curves(spark, sf_dir).shapes(), {"perda": 6, "receita": 6})


@register("vintage_scale", f"SELECT safra, {o.r('ep', 6)} AS escala_perda, {o.r('er', 6)} AS escala_receita FROM b_scale")
def vintage_scale(spark, sf_dir):
    c = Curves(spark, sf_dir)
    shaped = curves.with_shape(c.months, c.groups, c.shapes())
    return round_columns(curves.vintage_scale(shaped, PARAMS), {"escala_perda": 6, "escala_receita": 6})


@register("loss_curve", f"SELECT safra, mob, {o.r('p', 4)} AS perda_acum_pct, tipo FROM b_curve")
def loss_curve(spark, sf_dir):
    return export_rounded(curves.loss_curve(Curves(spark, sf_dir).curve()))


@register("revenue_curve", f"SELECT safra, mob, {o.r('r', 4)} AS receita_acum_pct, tipo FROM b_curve")
def revenue_curve(spark, sf_dir):
    return export_rounded(curves.revenue_curve(Curves(spark, sf_dir).curve()))


@register(
    "vintage_summary",
    f"""SELECT g.safra, g.principal, g.mob_limpo AS max_mob_limpo, g.grupo AS grupo_risco, {o.r('ep', 4)} AS escala_perda,
        {o.r('decay_receita', 4)} AS decay_receita, {o.r('p', 4)} AS perda_acum_final_pct, {o.r('r', 4)} AS receita_acum_final_pct
        FROM b_groups g JOIN b_scale USING (safra) JOIN b_decay d ON d.grupo = g.grupo
        JOIN b_curve c ON c.safra = g.safra AND c.mob = (SELECT t FROM b_term)""",
)
def vintage_summary(spark, sf_dir):
    c = Curves(spark, sf_dir)
    return export_rounded(curves.vintage_summary(c.curve(), c.decay()))


# --- valuation -------------------------------------------------------------


@register("pd_by_vintage", "SELECT safra, pd FROM b_pd")
def pd_by_vintage(spark, sf_dir):
    return valuation.pd_by_vintage(book.loans(spark, sf_dir))


@register("future_cashflow_by_vintage", f"SELECT safra, dp, {o.money('pmt')} AS pmt_sum FROM b_flow GROUP BY safra, dp")
def future_cashflow_by_vintage(spark, sf_dir):
    return valuation.future_cashflow_by_vintage(portfolio.future_flow(book.loans(spark, sf_dir), PARAMS))


def flow_parts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    loans = book.loans(spark, sf_dir)
    return portfolio.future_flow(loans, PARAMS), valuation.pd_by_vintage(loans), ltm(spark, sf_dir)


def npv(spark: SparkSession, sf_dir: str) -> DataFrame:
    total = kpis(spark, sf_dir).select("principal_total").scalar()
    return valuation.npv_grid(*flow_parts(spark, sf_dir), total, PARAMS)


NPV_SQL = f"""SELECT taxa_am_pct, cenario, {o.r('vpl')} AS vpl_valor,
  {o.r('vpl / (SELECT principal_total FROM b_kpis) * 100')} AS vpl_pct_principal FROM b_npv"""


@register("npv_grid", NPV_SQL)
def npv_grid(spark, sf_dir):
    return export_rounded(npv(spark, sf_dir))


@register(
    "net_future_flow",
    f"SELECT {o.r('bruto')} AS pmt_bruto_futuro, {o.r('perda')} AS perda_estimada, {o.r('liquido')} AS fluxo_liquido FROM b_net",
)
def net_future_flow(spark, sf_dir):
    cols = {"pmt_bruto_futuro": 2, "perda_estimada": 2, "fluxo_liquido": 2}
    return round_columns(valuation.net_future_flow(*flow_parts(spark, sf_dir)), cols)


PE_ROWS = (
    ("PD (over60 em quantidade)", o.r("pd * 100"), "%", "n_over60 / n_total — em quantidade de contratos"),
    ("EAD Total", o.r("ead_total"), "R$", "PMT × prazo_original, medido no momento zero da concessão"),
    (
        "EAD Inadimplente (over60)",
        o.r("ead_inadimplente"),
        "R$",
        "EAD dos contratos com dias_maior_atraso > 60, calculado como PMT × prazo_original",
    ),
    ("LGD = Effic 90 LTM", o.r("lgd * 100", 4), "%", "Produto encadeado rolagens 61-90d a >180d, média LTM 12 meses"),
    (
        "PE = EAD_total × PD × LGD",
        o.r("pe"),
        "R$",
        "Perda Esperada = EAD Total × Probabilidade de Default (PD) × Loss Given Default (LGD)",
    ),
    ("PE % do principal", o.r("pe / principal_total * 100"), "%", "PE / principal originado total"),
)


@register(
    "expected_loss",
    " UNION ALL ".join(
        f"SELECT '{n}' AS parametro, {v} AS valor, '{u}' AS unidade, '{d}' AS definicao FROM b_pe" for n, v, u, d in PE_ROWS
    ),
)
def expected_loss(spark, sf_dir):
    ead = portfolio.exposure_at_default(book.loans(spark, sf_dir))
    return valuation.expected_loss(kpis(spark, sf_dir), ead, ltm(spark, sf_dir))


KPI_ROWS = (
    [("meta", "nome_cliente", "'Cliente'", "b_ead"), ("meta", "data_base", "'2001-01'", "b_ead")]
    + [("meta", "analista", "'N/I'", "b_ead"), ("meta", "produto", "'Crédito'", "b_ead")]
    + [("kpi", c, f"CAST({c} AS VARCHAR)", "b_kpis") for c in ("contratos", "safra_min", "safra_max", "renegociacoes")]
    + [("kpi", c, o.text(c, 2), "b_kpis") for c in ("principal_total", "ticket_medio")]
    + [("kpi", "taxa_media_pct", o.text("taxa_media * 100", 4), "b_kpis"), ("kpi", "prazo_medio", o.text("prazo_medio", 1), "b_kpis")]
    + [("over", f"over{d}_n", f"CAST(over{d}_n AS VARCHAR)", "b_kpis") for d in (30, 60, 90)]
    + [("over", f"over{d}_pct", o.text(f"over{d}_pct * 100", 2), "b_kpis") for d in (30, 60, 90)]
    + [("effic", f"effic{d}_ltm_pct", o.text(f"effic{d} * 100", 4), "b_ltm") for d in (60, 90)]
    + [("effic", "lgd_pct", o.text("effic90 * 100", 4), "b_ltm")]
    + [("ead", c, o.text(c, 2), "b_ead") for c in ("ead_total", "ead_inadimplente")]
    + [("pe", "pd_pct", o.text("pd * 100", 2), "b_pe"), ("pe", "lgd_pct", o.text("lgd * 100", 4), "b_pe")]
    + [("pe", "pe_valor", o.text("pe", 2), "b_pe"), ("pe", "pe_pct_principal", o.text("pe / principal_total * 100", 2), "b_pe")]
    + [("vpl", "pmt_bruto_futuro", o.text("bruto", 2), "b_net"), ("vpl", "perda_estimada", o.text("perda", 2), "b_net")]
    + [("vpl", "fluxo_liquido", o.text("liquido", 2), "b_net")]
)
NPV_KEY = "'vpl_' || cenario || '_taxa' || CASE WHEN taxa_am_pct < 1.2 THEN '0010' ELSE '0015' END"


@register(
    "kpi_long",
    " UNION ALL ".join(f"SELECT '{c}' AS categoria, '{k}' AS chave, {v} AS valor FROM {t}" for c, k, v, t in KPI_ROWS)
    + f" UNION ALL SELECT 'vpl', {NPV_KEY} || '_valor', {o.text('vpl', 2)} FROM b_npv"
    + f" UNION ALL SELECT 'vpl', {NPV_KEY} || '_pct', {o.text('vpl / (SELECT principal_total FROM b_kpis) * 100', 2)} FROM b_npv",
)
def kpi_long(spark, sf_dir):
    return portfolio_results(spark, sf_dir)["kpis"]


@register(
    "run_metadata",
    f"""SELECT 'todos_rated' AS chave, CASE WHEN bool_or(rating_concessao = 'N/I') THEN 'False' ELSE 'True' END AS valor FROM b_loans
        UNION ALL SELECT 'col_perfil_usada', 'especie_beneficio' UNION ALL SELECT 'label_perfil', 'especie'
        UNION ALL SELECT 'effic60_ltm_pct', {o.text('effic60 * 100', 4)} FROM b_ltm
        UNION ALL SELECT 'effic90_ltm_pct', {o.text('effic90 * 100', 4)} FROM b_ltm
        UNION ALL SELECT 'taxa_vpl_1', '1.00' UNION ALL SELECT 'taxa_vpl_2', '1.50'""",
)
def run_metadata(spark, sf_dir):
    loans = book.loans(spark, sf_dir, attributes=True)
    return valuation.run_metadata(portfolio.book_totals(loans), ltm(spark, sf_dir), PARAMS)


# --- validation ------------------------------------------------------------


def finding_sql(dataset: str, check: str, column: str, bad: str, total: str, severity: str, message: str, source: str) -> str:
    level = severity if severity.startswith("CASE") else f"CASE WHEN {bad} > 0 THEN '{severity}' ELSE 'ok' END"
    return (
        f"""SELECT '{dataset}' AS dataset, '{check}' AS "check", '{column}' AS "column", {level} AS severity, """
        f"CAST({bad} AS BIGINT) AS n_bad, CAST({total} AS BIGINT) AS n_total, {o.pct(bad, total)} AS pct, "
        f"'{message}' AS message {source}"
    )


def raw_loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The messy loans with normalised headers and some invalid values."""
    loans = messy(spark, sf_dir)
    key = norm_id(F.col("id_contrato")).cast("bigint")
    return loans.withColumns(
        {
            "id_contrato": norm_id(F.col("id_contrato")),
            "pmt": F.when(key % 97 == 0, "-10,00").otherwise(F.col("pmt")),
            "num_parcelas": F.when(key % 89 == 0, "0").when(key % 83 == 0, "abc").otherwise(F.col("num_parcelas")),
            "data_aquisicao": F.when(key % 79 == 0, "31/02/2000").otherwise(F.col("data_aquisicao")),
            "rating_concessao": F.when(key % 13 == 0, F.lit(None)).otherwise(F.col("rating_concessao")),
            "tipo_produto": F.when(key % 7 == 0, "Crédito CONSIGNADO").otherwise("Pessoal"),
        }
    )


def raw_inst(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The messy instalments with normalised headers and some invalid values."""
    line = norm_id(F.col("id_contrato")).cast("bigint")
    return messy_inst(spark, sf_dir).withColumns(
        {
            "data_pagamento": F.when(line % 61 == 0, "ontem").otherwise(F.col("data_pagamento")),
            "valor_parcela": F.when(line % 67 == 0, "-1.234,50").otherwise(F.col("valor_parcela")),
            "dias_atraso": F.when(line % 71 == 0, "-3").otherwise(F.col("dias_atraso")),
        }
    )


def raw_book(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return raw_loans(spark, sf_dir), raw_inst(spark, sf_dir), book.renegotiations(spark, sf_dir)


PRESENCE_SQL = " UNION ALL ".join(
    [
        finding_sql("LOANS", "presenca", "", "CAST(count(*) = 0 AS BIGINT)", "count(*)", "erro", "linhas de dados", "FROM b_loans"),
        finding_sql("RENEGOCIACAO", "presenca", "", "CAST(count(*) = 0 AS BIGINT)", "count(*)", "aviso", "linhas de dados", "FROM b_reneg WHERE k < 0"),
        "SELECT 'INSTALLMENTS', 'presenca', '', 'erro', 1, 0, 0.0e0, 'arquivo nao encontrado'",
    ]
)


@register("dq_presence", PRESENCE_SQL)
def dq_presence(spark, sf_dir):
    empty = book.renegotiations(spark, sf_dir).where(F.col("id_contrato_novo").isNull())
    return quality.dq_presence(
        spark,
        [
            (messy(spark, sf_dir), layouts.LOANS),
            (None, layouts.INSTALLMENTS),
            (empty, layouts.RENEGOTIATIONS),
        ],
    )


def _layout_sql(dataset: str, required: str, optional: str, missing: str, unmapped: str) -> str:
    """Findings of a layout: names are blank-separated lists; ``missing`` ones are optional columns."""
    names = [("coluna_obrigatoria", c, "ok") for c in required.split()]
    names += [("coluna_opcional", c, "ok") for c in optional.split()]
    names += [("coluna_opcional", c, "aviso") for c in missing.split()]
    names += [("coluna_nao_mapeada", c, "aviso") for c in unmapped.split()]
    values = ", ".join(f"('{check}', '{c}', '{level}')" for check, c, level in names)
    return (
        f"""SELECT '{dataset}' AS dataset, c AS "check", n AS "column", s AS severity, CAST(s <> 'ok' AS BIGINT) AS n_bad, """
        f"CAST(1 AS BIGINT) AS n_total, CASE WHEN s = 'ok' THEN 0.0e0 ELSE 100.0e0 END AS pct, 'layout' AS message "
        f"FROM (VALUES {values}) v(c, n, s)"
    )


COLUMNS_SQL = " UNION ALL ".join(
    [
        _layout_sql(
            "LOANS",
            "principal pmt num_parcelas data_aquisicao taxa_cliente rating_concessao id_contrato dias_maior_atraso",
            "regiao tipo_produto",
            "vencimento_primeira_parcela vencimento_ultima_parcela bhv_m uf idade especie_beneficio situacao_beneficio "
            "canal_originacao competencia_averbacao competencia_inicio_desconto margem_consignavel_utilizada "
            "prazo_remanescente taxa_funding profissao",
            "",
        ),
        _layout_sql(
            "INSTALLMENTS",
            "num_parcela data_vencimento id_contrato id_parcela data_pagamento valor_pago valor_parcela dias_atraso",
            "",
            "motivo_falha_repasse",
            "",
        ),
        _layout_sql(
            "RENEGOCIACAO",
            "id_contrato_novo id_contrato_origem id_parcela_reneg data_renegociacao valor_refinanciado valor_troco "
            "num_parcela data_vencimento valor_parcela data_pagamento valor_pago",
            "",
            "",
            "",
        ),
    ]
)


HELD_SQL = " UNION ALL ".join(
    f"SELECT '{name}' AS dataset, '{column}' AS \"column\", CAST(count({value}) AS BIGINT) AS linhas {source}"
    for name, column, value, source in (
        ("LOANS", "id_contrato", "id_contrato", "FROM b_loans"),
        ("LOANS", "principal", "principal", "FROM b_loans"),
        ("LOANS", "pmt", "pmt", "FROM b_loans"),
        ("LOANS", "num_parcelas", "num_parcelas", "FROM b_loans"),
        ("LOANS", "data_aquisicao", "k", "FROM b_loans"),
        ("LOANS", "taxa_cliente", "taxa_cliente", "FROM b_loans"),
        ("LOANS", "rating_concessao", "CASE WHEN k % 13 <> 0 THEN 1 END", "FROM b_loans"),
        ("LOANS", "dias_maior_atraso", "CASE WHEN k % 11 <> 0 THEN 1 END", "FROM b_loans"),
        ("RENEGOCIACAO", "id_contrato_novo", "k", "FROM b_reneg"),
        ("RENEGOCIACAO", "id_contrato_origem", "origem", "FROM b_reneg"),
        ("RENEGOCIACAO", "data_pagamento", "NULL", "FROM b_reneg"),
    )
)

HELD_REST_SQL = " UNION ALL ".join(
    f"SELECT '{name}' AS dataset, '{column}' AS \"column\", CAST(count(*) FILTER (WHERE NOT ({empty})) AS BIGINT) AS linhas {source}"
    for name, column, empty, source in (
        ("INSTALLMENTS", "num_parcela", "false", "FROM b_inst"),
        ("INSTALLMENTS", "data_vencimento", "false", "FROM b_inst"),
        ("INSTALLMENTS", "id_contrato", "false", "FROM b_inst"),
        ("INSTALLMENTS", "id_parcela", "false", "FROM b_inst"),
        ("INSTALLMENTS", "data_pagamento", "data_pagamento IS NULL AND (k + 1) % 4 <> 3 AND k % 61 <> 0", "FROM b_inst"),
        ("INSTALLMENTS", "valor_pago", "valor_pago IS NULL AND (k + 2) % 5 <> 4", "FROM b_inst"),
        ("INSTALLMENTS", "valor_parcela", "false", "FROM b_inst"),
        ("INSTALLMENTS", "dias_atraso", "dias_atraso IS NULL AND k % 71 <> 0", "FROM b_inst"),
        ("RENEGOCIACAO", "id_parcela_reneg", "false", "FROM b_reneg"),
        ("RENEGOCIACAO", "data_renegociacao", "false", "FROM b_reneg"),
        ("RENEGOCIACAO", "valor_refinanciado", "false", "FROM b_reneg"),
        ("RENEGOCIACAO", "valor_troco", "false", "FROM b_reneg"),
        ("RENEGOCIACAO", "num_parcela", "false", "FROM b_reneg"),
        ("RENEGOCIACAO", "data_vencimento", "false", "FROM b_reneg"),
        ("RENEGOCIACAO", "valor_parcela", "false", "FROM b_reneg"),
        ("RENEGOCIACAO", "valor_pago", "true", "FROM b_reneg"),
    )
)


@register("dq_required_columns", f"{HELD_SQL} UNION ALL {HELD_REST_SQL}")
def dq_required_columns(spark, sf_dir):
    """Rows that hold a value, for every required column of the three inputs."""
    loans, inst, reneg = raw_book(spark, sf_dir)
    held = quality.rows_held(loans, layouts.LOANS).unionByName(quality.rows_held(inst, layouts.INSTALLMENTS))
    return held.unionByName(quality.rows_held(reneg, layouts.RENEGOTIATIONS))


def _null_rows(dataset: str, source: str, conditions: dict[str, tuple[str, str]]) -> str:
    return " UNION ALL ".join(
        finding_sql(dataset, "nulos", c, f"count(*) FILTER (WHERE {cond})", "count(*)", sev, "valores nulos", source)
        for c, (cond, sev) in conditions.items()
    )


NULLS_SQL = _null_rows(
    "LOANS",
    "FROM b_loans",
    {
        "principal": ("false", "erro"),
        "pmt": ("false", "erro"),
        "num_parcelas": ("false", "erro"),
        "data_aquisicao": ("false", "erro"),
        "taxa_cliente": ("false", "erro"),
        "rating_concessao": ("k % 13 = 0", "erro"),
        "id_contrato": ("false", "ok"),
        "dias_maior_atraso": ("k % 11 = 0", "ok"),
    },
) + " UNION ALL " + _null_rows(
    "INSTALLMENTS",
    "FROM b_inst",
    {
        "num_parcela": ("false", "erro"),
        "data_vencimento": ("false", "erro"),
        "id_contrato": ("false", "ok"),
        "id_parcela": ("false", "ok"),
        "data_pagamento": ("data_pagamento IS NULL AND (k + 1) % 4 <> 3 AND k % 61 <> 0", "ok"),
        "valor_pago": ("valor_pago IS NULL AND (k + 2) % 5 <> 4", "ok"),
        "valor_parcela": ("false", "ok"),
        "dias_atraso": ("dias_atraso IS NULL AND k % 71 <> 0", "ok"),
    },
)


@register("dq_nulls", NULLS_SQL)
def dq_nulls(spark, sf_dir):
    loans, inst, _ = raw_book(spark, sf_dir)
    return quality.dq_nulls(loans, layouts.LOANS).unionByName(quality.dq_nulls(inst, layouts.INSTALLMENTS))


def _rows(dataset: str, source: str, checks: list[tuple[str, str, str, str, str]]) -> str:
    return " UNION ALL ".join(
        finding_sql(dataset, check, column, f"count(*) FILTER (WHERE {cond})", "count(*)", sev, msg, source)
        for check, column, cond, sev, msg in checks
    )


LOAN_VALUES_SQL = _rows(
    "LOANS",
    "FROM b_loans",
    [
        ("nao_numerico", "principal", "k % 5 = 4", "aviso", "nao numericos"),
        ("negativo", "principal", "false", "erro", "negativos"),
        ("nao_numerico", "pmt", "(k + 1) % 5 = 4 AND k % 97 <> 0", "aviso", "nao numericos"),
        ("negativo", "pmt", "k % 97 = 0", "erro", "negativos"),
        ("prazo_minimo", "num_parcelas", "k % 89 = 0 OR k % 83 = 0", "erro", "num_parcelas < 1"),
        ("prazo_maximo", "num_parcelas", "false", "erro", "num_parcelas acima do limite"),
        ("data_invalida", "data_aquisicao", "k % 79 = 0", "erro", "datas invalidas"),
    ],
)


@register(
    "dq_malformed_lines",
    finding_sql(
        "LOANS", "linhas_malformadas", "", "count(*) FILTER (WHERE k % 29 = 0)", "count(*)", "erro", "linhas fora do cabecalho",
        "FROM b_loans",
    ),
)
def dq_malformed_lines(spark, sf_dir):
    lines = readers.read_text_lines(spark, write_text(broken_loans(spark, sf_dir), "loans-csv"))
    return quality.dq_malformed_lines(lines, layouts.LOANS)


@register("dq_loans_values", LOAN_VALUES_SQL)
def dq_loans_values(spark, sf_dir):
    return quality.dq_loans(raw_loans(spark, sf_dir))


INST_VALUES_SQL = _rows(
    "INSTALLMENTS",
    "FROM b_inst",
    [
        ("data_invalida", "data_vencimento", "false", "erro", "datas invalidas"),
        ("data_invalida", "data_pagamento", "k % 61 = 0", "aviso", "datas invalidas"),
        ("negativo", "valor_parcela", "k % 67 = 0", "aviso", "negativos"),
        ("negativo", "dias_atraso", "k % 71 = 0", "aviso", "negativos"),
    ],
) + " UNION ALL " + finding_sql(
    "INSTALLMENTS", "sem_parcela_1", "num_parcela", "CAST(count(*) FILTER (WHERE num_parcela = 1) = 0 AS BIGINT)",
    "count(*)", "erro", "nenhuma parcela 1", "FROM b_inst",
)


@register("dq_installments_values", INST_VALUES_SQL)
def dq_installments_values(spark, sf_dir):
    return quality.dq_installments(raw_inst(spark, sf_dir))


RENEG_VALUES_SQL = _rows(
    "RENEGOCIACAO",
    "FROM b_reneg",
    [
        ("data_invalida", "data_renegociacao", "d IS NULL", "aviso", "datas invalidas"),
        ("negativo", "valor_refinanciado", "valor < 0", "aviso", "negativos"),
    ],
)


@register("dq_renegotiation_values", RENEG_VALUES_SQL)
def dq_renegotiation_values(spark, sf_dir):
    return quality.dq_renegotiations(book.renegotiations(spark, sf_dir))


@register(
    "dq_orphan_installments",
    "SELECT DISTINCT id_contrato FROM b_inst_orphans WHERE id_contrato NOT IN (SELECT id_contrato FROM b_loans)",
)
def dq_orphan_installments(spark, sf_dir):
    return quality.orphan_installments(book.loans(spark, sf_dir), book.installments_with_orphans(spark, sf_dir))


@register(
    "dq_loans_without_installments",
    "SELECT id_contrato FROM b_loans WHERE id_contrato NOT IN (SELECT id_contrato FROM b_inst_orphans)",
)
def dq_loans_without_installments(spark, sf_dir):
    return quality.loans_without_installments(
        book.loans(spark, sf_dir), book.installments_with_orphans(spark, sf_dir)
    )


WITHOUT = "(SELECT count(*) FROM b_loans WHERE id_contrato NOT IN (SELECT id_contrato FROM b_inst_orphans))"
CROSS_SQL = " UNION ALL ".join(
    [
        finding_sql(
            "INSTALLMENTS", "orfaos_parcelas", "id_contrato",
            "count(DISTINCT id_contrato) FILTER (WHERE id_contrato LIKE 'X%')", "count(DISTINCT id_contrato)",
            "aviso", "ids sem correspondencia", "FROM b_inst_orphans",
        ),
        finding_sql(
            "LOANS", "contratos_sem_parcela", "id_contrato", WITHOUT, "count(*)",
            f"CASE WHEN {WITHOUT} * 100.0 / count(*) > 20 THEN 'erro' WHEN {WITHOUT} * 100.0 / count(*) > 5 THEN 'aviso' ELSE 'ok' END",
            "ids sem correspondencia", "FROM b_loans",
        ),
        finding_sql(
            "RENEGOCIACAO", "orfaos_renegociacao", "id_contrato_origem",
            "count(DISTINCT origem) FILTER (WHERE CAST(origem AS VARCHAR) NOT IN (SELECT id_contrato FROM b_loans))",
            "count(DISTINCT origem)", "aviso", "ids sem correspondencia", "FROM b_reneg",
        ),
    ]
)


@register("dq_cross", CROSS_SQL)
def dq_cross(spark, sf_dir):
    return quality.dq_cross(
        book.loans(spark, sf_dir), book.installments_with_orphans(spark, sf_dir), book.renegotiations(spark, sf_dir)
    )


@register(
    "dq_orphan_renegotiations",
    "SELECT DISTINCT CAST(origem AS VARCHAR) AS id_contrato FROM b_reneg WHERE CAST(origem AS VARCHAR) NOT IN (SELECT id_contrato FROM b_loans)",
)
def dq_orphan_renegotiations(spark, sf_dir):
    return quality.orphan_renegotiations(book.loans(spark, sf_dir), book.renegotiations(spark, sf_dir))


CONDITIONAL_SQL = finding_sql(
    "INSTALLMENTS", "coluna_condicional", "motivo_falha_repasse", "count(*) FILTER (WHERE k % 7 = 0)", "count(*)",
    "erro", "exigida por consignado", "FROM b_loans",
)


@register("dq_conditional_column", CONDITIONAL_SQL)
def dq_conditional_column(spark, sf_dir):
    loans, inst, _ = raw_book(spark, sf_dir)
    return quality.dq_conditional_column(loans, inst)


VALID_DATE = "k % 79 <> 0 AND k % 4 <> 3"
SNAPSHOT_SQL = finding_sql(
    "LOANS", "data_base", "data_aquisicao", f"count(*) FILTER (WHERE {VALID_DATE} AND data_aquisicao > {o.SNAPSHOT})",
    f"count(*) FILTER (WHERE {VALID_DATE})", "aviso", "posteriores a data_base", "FROM b_loans",
)


@register("dq_snapshot_date", SNAPSHOT_SQL)
def dq_snapshot_date(spark, sf_dir):
    return quality.dq_snapshot(raw_loans(spark, sf_dir), PARAMS)


@register(
    "dq_snapshot_facts",
    f"""SELECT min(safra) AS safra_min, max(safra) AS safra_max, count(DISTINCT safra) AS safras, count(*) AS datas_validas,
        count(*) FILTER (WHERE data_aquisicao > {o.SNAPSHOT}) AS posteriores FROM b_loans WHERE {VALID_DATE}""",
)
def dq_snapshot_facts(spark, sf_dir):
    return quality.snapshot_facts(raw_loans(spark, sf_dir), PARAMS)


@register(
    "dq_gate",
    f"""SELECT count(*) FILTER (WHERE severity = 'erro') AS erros, count(*) FILTER (WHERE severity = 'aviso') AS avisos,
        CASE WHEN count(*) FILTER (WHERE severity = 'erro') = 0 THEN 'APROVADO' ELSE 'REPROVADO' END AS resultado
        FROM ({NULLS_SQL} UNION ALL {LOAN_VALUES_SQL} UNION ALL {INST_VALUES_SQL} UNION ALL {RENEG_VALUES_SQL}
        UNION ALL {SNAPSHOT_SQL} UNION ALL {CONDITIONAL_SQL})""",
)
def dq_gate(spark, sf_dir):
    loans, inst, reneg = raw_book(spark, sf_dir)
    found = [
        quality.dq_nulls(loans, layouts.LOANS),
        quality.dq_nulls(inst, layouts.INSTALLMENTS),
        quality.dq_loans(loans),
        quality.dq_installments(inst),
        quality.dq_renegotiations(reneg),
        quality.dq_snapshot(loans, PARAMS),
        quality.dq_conditional_column(loans, inst),
    ]
    return quality.dq_gate(quality.union_all(found))


def _counted(source: str, dataset: str, severity: str) -> str:
    return finding_sql(
        dataset, "presenca", "", "CAST(count(*) = 0 AS BIGINT)", "count(*)", severity, "linhas de dados", f"FROM {source}"
    )


RENEG_NULLS_SQL = _null_rows(
    "RENEGOCIACAO",
    "FROM b_reneg",
    {c: ("false", "erro") for c in ("id_contrato_novo", "id_contrato_origem")}
    | {
        c: ("true" if c in ("data_pagamento", "valor_pago") else "false", "ok")
        for c in layouts.RENEGOTIATIONS.nullable
    },
)
VALIDATE_SQL = " UNION ALL ".join(
    [
        _counted("b_loans", "LOANS", "erro"),
        _counted("b_inst", "INSTALLMENTS", "erro"),
        _counted("b_reneg", "RENEGOCIACAO", "aviso"),
        COLUMNS_SQL,
        NULLS_SQL,
        RENEG_NULLS_SQL,
        LOAN_VALUES_SQL,
        INST_VALUES_SQL,
        RENEG_VALUES_SQL,
        SNAPSHOT_SQL,
        CROSS_SQL.replace("b_inst_orphans", "b_inst"),
        CONDITIONAL_SQL,
    ]
)


@register("validate_book", VALIDATE_SQL)
def validate_book(spark, sf_dir):
    return quality.validate_book(spark, *raw_book(spark, sf_dir), PARAMS)
