"""Loan book derived from the orders and lineitem test tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from vintora.params import Params
from vintora.sources.normalise import canonical_loans

PARAMS = Params(snapshot=date(2001, 1, 1))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _order_columns() -> dict[str, Column]:
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    return {
        "id_contrato": key.cast("string"),
        "principal": F.col("o_totalprice"),
        "num_parcelas": (1 + key % 80).cast("int"),
        "pmt": F.floor(F.col("o_totalprice") / 40).cast("double"),
        "data_aquisicao": F.col("o_orderdate").cast("date"),
        "taxa_cliente": F.when(key % 7 == 0, F.lit(1.5) + cust % 5).otherwise(
            F.lit(0.01) + (cust % 5) * F.lit(0.005)
        ),
        "dias_maior_atraso": F.when(key % 11 == 0, F.lit(None))
        .when(key % 3 == 0, F.lit(0))
        .otherwise((key * 37) % 200)
        .cast("double"),
        "rating_concessao": F.when(key % 13 == 0, F.lit(None)).otherwise(
            F.substring("o_orderpriority", 1, 1)
        ),
        "situacao_beneficio": F.col("o_orderstatus"),
    }


def typed_loans(spark: SparkSession, sf_dir: str, attributes: bool = False) -> DataFrame:
    """Typed loans before defaults; customer attributes only when asked for."""
    orders = table(spark, sf_dir, "orders")
    cols = _order_columns()
    if attributes:
        orders = (
            orders.join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
            .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
            .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        )
        cols |= {
            "bhv_m": F.col("c_mktsegment"),
            "especie_beneficio": F.col("c_mktsegment"),
            "uf": F.col("n_name"),
            "canal_originacao": F.col("r_name"),
        }
    return orders.select(*[c.alias(n) for n, c in cols.items()])


def loans(spark: SparkSession, sf_dir: str, attributes: bool = False) -> DataFrame:
    return canonical_loans(typed_loans(spark, sf_dir, attributes))


def installments(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").join(
        table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate"),
        F.col("l_orderkey") == F.col("o_orderkey"),
    )
    number = (F.col("l_linenumber") + 7 * (F.col("l_suppkey") % 4)).cast("int")
    due = F.add_months(F.col("o_orderdate").cast("date"), F.col("num_parcela"))
    paid = (
        F.when((F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "O"), F.lit(None))
        .when(F.col("l_returnflag") == "N", F.col("data_vencimento"))
        .otherwise(F.date_add(F.col("data_vencimento"), ((F.col("l_partkey") % 260) - 30).cast("int")))
    )
    amount = F.floor(F.col("l_extendedprice") * (1 - F.col("l_discount"))).cast("double")
    late = F.datediff(F.coalesce(F.col("data_pagamento"), F.lit(PARAMS.snapshot)), F.col("data_vencimento"))
    return (
        lines.withColumn("num_parcela", number)
        .withColumn("data_vencimento", due)
        .withColumn("data_pagamento", paid)
        .select(
            F.col("l_orderkey").cast("string").alias("id_contrato"),
            F.concat_ws("-", "l_orderkey", "l_linenumber").alias("id_parcela"),
            "num_parcela",
            "data_vencimento",
            "data_pagamento",
            F.col("l_extendedprice").alias("valor_parcela"),
            F.when(F.col("data_pagamento").isNotNull(), amount).alias("valor_pago"),
            F.when(F.col("l_partkey") % 19 == 0, F.lit(None))
            .otherwise(F.greatest(late, F.lit(0)))
            .cast("double")
            .alias("dias_atraso"),
        )
    )


def installments_with_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Adds a copy under an unknown contract id for one order in 101."""
    base = installments(spark, sf_dir)
    orphans = base.where(F.col("id_contrato").cast("bigint") % 101 == 0)
    return base.unionByName(
        orphans.withColumn("id_contrato", F.concat(F.lit("X"), F.col("id_contrato")))
    )


def renegotiations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw text renegotiations of one order in 17, some with an unknown origin.

    The refinanced amount of one order in 85 is negative and the date of one in 51 is
    not a date.
    """
    key = F.col("o_orderkey")
    origins = F.when(key % 170 == 0, F.array(key, key + 10000000)).otherwise(F.array(key))
    orders = table(spark, sf_dir, "orders").where(key % 17 == 0).withColumn("origem", F.explode(origins))
    amount = F.when(key % 85 == 0, -F.col("o_totalprice")).otherwise(F.col("o_totalprice"))
    when = F.when(key % 51 == 0, "2000-13-45").otherwise(
        F.date_format(F.col("o_orderdate").cast("date"), "dd/MM/yyyy")
    )
    return orders.select(
        F.concat(F.lit("R"), key.cast("string")).alias("id_contrato_novo"),
        F.col("origem").cast("string").alias("id_contrato_origem"),
        F.concat(F.lit("P"), key.cast("string")).alias("id_parcela_reneg"),
        when.alias("data_renegociacao"),
        amount.cast("decimal(18,2)").cast("string").alias("valor_refinanciado"),
        F.lit("0").alias("valor_troco"),
        F.lit("1").alias("num_parcela"),
        when.alias("data_vencimento"),
        amount.cast("decimal(18,2)").cast("string").alias("valor_parcela"),
        F.lit(None).cast("string").alias("data_pagamento"),
        F.lit(None).cast("string").alias("valor_pago"),
    )


def money_style(value: Column, style: Column) -> Column:
    """Render money in one of five styles; style 4 is unparseable."""
    plain = value.cast("decimal(18,2)").cast("string")
    grouped = F.format_number(value.cast("decimal(18,2)"), 2)
    return (
        F.when(style == 0, plain)
        .when(style == 1, F.translate(grouped, ",.", ".,"))
        .when(style == 2, F.translate(plain, ".", ","))
        .when(style == 3, grouped)
        .otherwise("garbage")
    )


def date_style(value: Column, style: Column) -> Column:
    """Render a date in one of three formats; style 3 is blank."""
    return (
        F.when(style == 0, F.date_format(value, "dd/MM/yyyy"))
        .when(style == 1, value.cast("string"))
        .when(style == 2, F.concat(value.cast("string"), F.lit(" 12:30:45")))
        .otherwise("")
    )


def messy_loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text loans in mixed locales, as an export would hold them."""
    key = F.col("id_contrato").cast("bigint")
    t = typed_loans(spark, sf_dir)
    return t.select(
        F.concat(F.lit("  "), F.col("id_contrato"), F.lit(" ")).alias(" Unique ID "),
        money_style(F.col("principal"), key % 5).alias("PRINCIPAL"),
        money_style(F.col("pmt"), (key + 1) % 5).alias("Pmt"),
        F.col("num_parcelas").cast("string").alias("num_parcelas"),
        date_style(F.col("data_aquisicao"), key % 4).alias("Data_Aquisicao"),
        F.translate(F.col("taxa_cliente").cast("decimal(10,4)").cast("string"), ".", ",").alias("taxa_cliente"),
        F.col("dias_maior_atraso").cast("int").cast("string").alias("dias_maior_atraso"),
        F.when(key % 13 == 0, "NaN").otherwise(F.col("rating_concessao")).alias("rating_concessao"),
        F.col("situacao_beneficio").alias("regiao"),
    )


def messy_installments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text instalments in mixed locales."""
    key = F.col("id_contrato").cast("bigint")
    t = installments(spark, sf_dir)
    return t.select(
        F.concat(F.lit(" "), F.col("id_contrato")).alias("ID_CONTRATO"),
        "id_parcela",
        F.col("num_parcela").cast("string").alias("num_parcela"),
        date_style(F.col("data_vencimento"), key % 4).alias("data_vencimento"),
        date_style(F.col("data_pagamento"), (key + 1) % 4).alias("data_pagamento"),
        money_style(F.col("valor_parcela"), key % 5).alias("valor_parcela"),
        money_style(F.col("valor_pago"), (key + 2) % 5).alias("valor_pago"),
        F.col("dias_atraso").cast("int").cast("string").alias("dias_atraso"),
    )
