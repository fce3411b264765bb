"""Raw documents to packed training sequences, one stage per operator, each written and read again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lakequery.llm.common import stored
from lakequery.llm.decontaminate import decontamination_stage
from lakequery.llm.language import language_stage
from lakequery.llm.near_duplicates import near_duplicate_stage
from lakequery.llm.packing import packing_stage
from lakequery.llm.secrets import secrets_stage

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("secret_scan", secrets_stage),
    ("packing", packing_stage),
]

# Learned languages, sketches, tilings and packings are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(spark, stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
