"""One registered query per operator, over whole tables, with oracle SQL where SQL can state it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vintora.llm import (
    attribution,
    embedding_join,
    hard_negatives,
    lexical_search,
    licenses,
    ngram_join,
    oracle,
    packing,
    piece_sampling,
    quality_knn,
    quality_rules,
    url_filter,
    vector_packing,
    warc,
)
from vintora.llm.common import read

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return add


@register("op1_token_counts")
def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return attribution.attribute_tokens(read(spark, sf_dir, "documents"), rule="share")


@register("op2_best_fit_packing")
def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"), max_tokens=1024, end_id=2)


@register("op8_license_scan")
def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(read(spark, sf_dir, "documents"))


@register("op10_quality_rules", oracle.QUALITY_RULES)
def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.report(quality_rules.judge_documents(read(spark, sf_dir, "documents")))


@register("op3_url_filter")
def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page is labelled through the document that its path names by number."""
    pages = read(spark, sf_dir, "pages").select("page_id", "url")
    _, path = url_filter.host_and_path(F.col("url"))
    number = F.expr("try_cast(regexp_extract(path, '/([0-9]+)', 1) as bigint)")
    named = pages.select("page_id", path.alias("path")).select("page_id", number.alias("doc_id"))
    labels = named.join(read(spark, sf_dir, "labels"), "doc_id").select("page_id", (1 - F.col("quality")).alias("bad"))
    return url_filter.judge_urls(pages, labels)


@register("op9_quality_classifier")
def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = quality_knn.classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    return scored.select("doc_id", "held_out", "score", "predicted")


@register("op4_ngram_jaccard_join", oracle.NGRAM_JOIN)
def op4_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_components(read(spark, sf_dir, "documents"), n=4, percent=85)


@register("op6_embedding_near_dedup", oracle.EMBEDDINGS)
def op6_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_join.embedding_components(read(spark, sf_dir, "embeddings"), cosine=0.9)


@register("op7_warc", oracle.WARC)
def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.page_report(warc.archive_pages(read(spark, sf_dir, "pages"), min_bytes=0))


@register("op5_sentencepiece_sampling")
def op5_sentencepiece_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    samples = piece_sampling.sample_pieces(read(spark, sf_dir, "documents"), k=2)
    return samples.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


@register("op11_hard_negatives", oracle.HARD_NEGATIVES)
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine_hard_negatives(vectors.withColumn("label", moved), F.col("vec_id") % 100 == 0)


@register("op12_vector_packing")
def op12_vector_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_packing.pack_documents(read(spark, sf_dir, "documents"))


@register("op13_lexical_search", oracle.LEXICAL_SEARCH)
def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"), k=20)
