"""Exports as a directory of part files, written by all tasks at once."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lakequery.functions.encode import EMBEDDED, row_json, stringify
from lakequery.operators.infer import infer_types, normalize, project_typed
from lakequery.sinks.formats import (
    APPEND,
    CSV,
    CSV_OPTIONS,
    EXCEL,
    JSON,
    ORC,
    OVERWRITE,
    PARQUET,
    ExportError,
    SaveResult,
    check_append,
    csv_options,
    parse_format,
    parse_mode,
)
from lakequery.sinks.xlsx import XlsxDataSource
from lakequery.storage import Storage, scratch_dir

DECLARED, INFERRED = "declared", "inferred"


def distinct_names(df: DataFrame) -> None:
    """Files cannot hold two columns of one name, whatever its case."""
    seen = set()
    for name in df.columns:
        if name.lower() in seen:
            raise ExportError(f"cannot export two columns named {name}; give each its own alias")
        seen.add(name.lower())


def export_frame(
    df: DataFrame, file_format: str, dialect: str = EMBEDDED, typing: str = DECLARED
) -> DataFrame:
    """``df`` as the columns a format stores.

    Columnar formats take the declared types of the result, or with ``typing="inferred"`` those
    found in all its rows, so that every value is kept.
    """
    distinct_names(df)
    if typing not in (DECLARED, INFERRED):
        raise ExportError(f"unknown typing: {typing} (declared or inferred)")
    if file_format == CSV:
        return stringify(df, dialect)
    if file_format == JSON:
        return row_json(df, dialect, "value")
    if typing == INFERRED and file_format in (PARQUET, ORC):
        return _inferred(df, dialect)
    return normalize(df, dialect)


def _inferred(df: DataFrame, dialect: str) -> DataFrame:
    """Types of all rows; the encoded rows are stored once, so the result is computed once."""
    spark, path = df.sparkSession, scratch_dir(df.sparkSession, "encoded")
    row_json(df, dialect).withColumn("ord", F.monotonically_increasing_id()).write.parquet(path)
    rows = spark.read.schema("row string, ord long").parquet(path)
    found = infer_types(rows, "row", df.columns, "ord").collect()  # one row per column
    rows = rows.select("row")
    kinds = {row["column_name"]: row["column_type"] for row in found}
    return project_typed(rows, "row", {name: kinds[name] for name in df.columns})


def write_parts(frame: DataFrame, file_format: str, path: str) -> None:
    """Add part files to ``path`` from a frame made by ``export_frame``."""
    writer = frame.write.mode("append")
    if file_format == CSV:
        writer.option("header", True).options(**csv_options(frame)).csv(path)
    elif file_format == JSON:
        writer.text(path)
    elif file_format == ORC:
        writer.orc(path)
    elif file_format == PARQUET:
        writer.parquet(path)
    elif file_format == EXCEL:
        spark = frame.sparkSession
        spark.dataSource.register(XlsxDataSource)
        writer.format("xlsx").save(Storage(spark).qualify(path))


def counted(frame: DataFrame) -> tuple[DataFrame, Observation]:
    """The frame with a row count taken while it is written, so no second job runs."""
    seen = Observation()
    return frame.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def superseded(storage: Storage, path: str) -> list[str]:
    """Data a finished overwrite replaces; commit markers are rewritten in place."""
    return [
        entry.path
        for entry in storage.children(path)
        if entry.name != "_SUCCESS" and not entry.name.startswith("_temporary")
    ]


def check_json_rows(spark: SparkSession, path: str) -> None:
    """An append must extend JSON rows, so look at the first line that is there."""
    lines = spark.read.text(path).select(F.ltrim("value").alias("line"))
    first = lines.where("line != ''").first()
    if first and not first["line"].startswith("{"):
        raise ExportError(f"cannot append JSON to {path}: it does not hold JSON rows")


def check_csv_columns(spark: SparkSession, path: str, names: list[str]) -> None:
    """An append must have the columns, in the order, of the header that is there."""
    first = spark.read.text(path).where("value != ''").first()
    there = spark.read.option("header", True).options(**CSV_OPTIONS).csv(path).columns if first else names
    if there != names:
        raise ExportError(f"cannot append to {path}: its columns are {there}, not {names}")


def write_dataset(
    df: DataFrame,
    file_type: str,
    path: str,
    mode: str | None = None,
    dialect: str = EMBEDDED,
    typing: str = DECLARED,
) -> SaveResult:
    """Export every row of ``df`` to the directory ``path``.

    An overwrite replaces the old data only after the new is complete, so a failed job leaves the
    target as it was and a result may read the data it replaces.
    """
    spark = df.sparkSession
    file_format, save_mode = parse_format(file_type), parse_mode(mode)
    check_append(spark, file_format, save_mode, path)
    storage, given = Storage(spark), path
    path = storage.qualify(path).rstrip("/")
    if save_mode == APPEND and not storage.is_empty(path):
        if storage.is_file(path):
            raise ExportError(f"{path} is one file, not a directory of parts")
        if file_format == JSON:
            check_json_rows(spark, path)
        else:
            check_csv_columns(spark, path, df.columns)
    frame, seen = counted(export_frame(df, file_format, dialect, typing))
    if save_mode == OVERWRITE and storage.exists(path):
        _replace(storage, frame, file_format, path)
    else:
        write_parts(frame, file_format, path)
    return SaveResult(given, file_format, seen.get["rows"])


def _replace(storage: Storage, frame: DataFrame, file_format: str, path: str) -> None:
    """Swap in a finished directory where that is a rename; else add the new, then drop the old."""
    if storage.renames_cheaply(path):
        staging, old = storage.beside(path, "new"), storage.beside(path, "old")
        try:
            write_parts(frame, file_format, staging)
        except BaseException:
            storage.delete(staging)
            raise
        storage.rename(path, old)
        try:
            storage.rename(staging, path)
        except BaseException:
            storage.rename(old, path)  # the target is as it was
            raise
        storage.delete(old)
    else:
        old_parts = [path] if storage.is_file(path) else superseded(storage, path)
        write_parts(frame, file_format, path)
        storage.delete_all(old_parts)
