"""CSV files as named views."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from lakequery.sinks.formats import CSV_OPTIONS
from lakequery.sources.csv_split import read_csv_split


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | str | None = None,
    multi_line: bool = True,
    split: bool = False,
) -> DataFrame:
    """CSV with a header line; types are detected unless ``schema`` is given.

    A cell its type cannot hold, and a row of the wrong length, fail the query. Detection reads the
    data once more, so give a schema for large inputs. Quoted cells may hold
    line breaks, which keeps a file in one task; ``multi_line=False`` promises that they do not. With ``split``
    tasks share a large file either way: see ``read_csv_split``.
    """
    if split:
        return read_csv_split(spark, path, schema)
    reader = spark.read.option("header", True).option("multiLine", multi_line)
    reader = reader.option("escape", CSV_OPTIONS["escape"]).option("mode", "FAILFAST")
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return reader.csv(path)


def register_csv(
    spark: SparkSession,
    name: str,
    path: str | list[str],
    schema: T.StructType | str | None = None,
    multi_line: bool = True,
    split: bool = False,
) -> DataFrame:
    """``read_csv`` under a view name that lives as long as the session."""
    df = read_csv(spark, path, schema, multi_line, split)
    df.createOrReplaceTempView(name)
    return df
