"""The registered queries of this package: each operator over its whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakequery.llm import (
    ann,
    conversation_trie,
    decontaminate,
    language,
    licenses,
    near_duplicates,
    packing,
    pii,
    resampling,
    secrets,
    suffix_dedup,
    url_filters,
    warc,
)

PLANS: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(run: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    PLANS[run.__name__] = run
    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(spark, table(spark, sf_dir, "documents"))


@query
def op2_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(spark, table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


@query
def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(
        spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


@query
def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.find_secrets(table(spark, sf_dir, "documents"))


@query
def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_pages(spark, table(spark, sf_dir, "pages"))


@query
def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.find_classes(spark, table(spark, sf_dir, "documents"))


@query
def op7_repeated_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(spark, table(spark, sf_dir, "documents"), with_text=False)


@query
def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.find_licenses(spark, table(spark, sf_dir, "documents"))


ORACLES["op8_licenses"] = licenses.oracle_sql()


@query
def op9_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_personal_data(table(spark, sf_dir, "documents"))


@query
def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


@query
def op13_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filters.judge_urls(spark, table(spark, sf_dir, "pages"))


ORACLES["op13_url_filters"] = url_filters.oracle_sql()


@query
def op12_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLES["op12_resampling"] = resampling.oracle_sql()


@query
def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie.prefix_trie(spark, table(spark, sf_dir, "conversations"))


ORACLES["op11_prefix_trie"] = conversation_trie.oracle_sql()
