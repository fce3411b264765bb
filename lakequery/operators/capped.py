"""Results, capped where a limit is asked for, and their column metadata."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

from lakequery.functions.encode import native_type


class ColumnMeta(NamedTuple):
    name: str
    data_type: str


def columns(df: DataFrame) -> list[ColumnMeta]:
    """Name and type of each column, repeated names included; a source's own type name wins."""
    return [
        ColumnMeta(f.name, native_type(f) or f.dataType.simpleString())
        for f in df.schema.fields
    ]


def row_cap(limit: int | None) -> int | None:
    """The cap to use, if any; 0 asks for the columns alone."""
    if limit is not None and int(limit) < 0:
        raise ValueError(f"limit must not be negative: {limit}")
    return None if limit is None else int(limit)


def query(spark: SparkSession, sql: str, limit: int | None = None) -> DataFrame:
    """The result of one SQL statement, whole unless a limit is given; SQL itself is Spark's."""
    return cap(spark.sql(sql), limit)


def cap(df: DataFrame, limit: int | None = None) -> DataFrame:
    """The first ``limit`` rows in result order, or all of them; 0 keeps the columns and no rows."""
    n = row_cap(limit)
    return df if n is None else df.limit(n)
