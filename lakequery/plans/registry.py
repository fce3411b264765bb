"""Registered plans: a Spark query over the given tables and the SQL that must agree with it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Plan = Callable[[SparkSession, str], DataFrame]

PLANS: dict[str, Plan] = {}
ORACLES: dict[str, str] = {}


def plan(sql: str | None = None, name: str | None = None) -> Callable[[Plan], Plan]:
    """Register a query, under its function name unless given one, with its SQL twin if any."""

    def register(run: Plan) -> Plan:
        key = name or run.__name__
        PLANS[key] = run
        if sql is not None:
            ORACLES[key] = sql
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def views(spark: SparkSession, sf_dir: str, *names: str) -> None:
    for name in names:
        table(spark, sf_dir, name).createOrReplaceTempView(name)
